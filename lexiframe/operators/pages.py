"""What a page says: title, links, sections, metadata, index list, description, index fields.

A page is shredded once into arrays held on its own row, and every rule below is an expression
over those arrays, so nothing in this module shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.constants import ASCII_DIGITS, DIGITS, LINE_BREAK, METADATA_LABELS
from lexiframe.functions.html import compose, read_page
from lexiframe.functions.names import base_name, join_path, parse_flag
from lexiframe.functions.text import collapse, strip, tidy_lines
from lexiframe.operators.skew import made_once

ANNOTATIONS = [*METADATA_LABELS.values(), "description", "content"]


def shred(pages: DataFrame) -> DataFrame:
    """Add `page`: the title, links, tables and rows found in `html`."""
    return pages.withColumn("page", read_page(F.col("html")))


def page_rows(shredded: DataFrame) -> DataFrame:
    """One row per table row of a page, in document order."""
    return shredded.select("filename", F.posexplode("page.rows").alias("row_no", "row")).select(
        "filename",
        "row_no",
        F.col("row.tables").alias("in_table"),
        F.col("row.text").alias("row_text"),
        F.col("row.cells").alias("cells"),
        F.col("row.hrefs").alias("links"),
    )


def page_titles(shredded: DataFrame) -> DataFrame:
    return shredded.withColumn("title", F.coalesce("page.title", F.lit("")))


def links_with_extension(hrefs: Column, extension: str) -> Column:
    """The extension is tested on the whole href, so `x.htm#top` is not a link."""
    return F.filter(hrefs, lambda href: F.lower(href).endswith(extension.lower()))


def page_links(shredded: DataFrame, folder: str, extension: str = ".htm") -> DataFrame:
    """Links of every page as rows; the columns of `shredded` other than the page stay."""
    kept = [name for name in shredded.columns if name not in ("html", "page", "error")]
    links = shredded.select(
        *kept,
        F.posexplode(links_with_extension(F.col("page.hrefs"), extension)).alias("link_pos", "href"),
    )
    return links.select(
        *kept,
        "link_pos",
        base_name(F.col("href")).alias("link_name"),
        join_path(F.lit(folder), F.col("href")).alias("link_path"),
    )


def _inside(table: Column):
    return lambda row: F.array_contains(row["tables"], table)


def _position(rows: Column, test) -> Column:
    """One-based position of the first row that passes, 0 if none."""
    return F.coalesce(F.array_position(F.transform(rows, test), F.lit(True)), F.lit(0)).cast("int")


def _header(rows: Column, label: str) -> Column:
    inside = _inside(F.lit(0))
    return _position(rows, lambda row: inside(row) & strip(row["text"]).startswith(label))


def _after(rows: Column, position: Column) -> Column:
    rest = F.slice(rows, position + 1, F.greatest(F.size(rows) - position, F.lit(0)))
    return F.when(position > 0, rest)


def _until_blank(rows: Column) -> Column:
    blank = _position(rows, lambda row: strip(row["text"]) == "")
    return F.when(blank > 0, F.slice(rows, 1, blank - 1)).otherwise(rows)


def _section_links(rows: Column, label: str) -> Column:
    section = _until_blank(_after(rows, _header(rows, label)))
    hrefs = F.flatten(F.transform(section, lambda row: row["hrefs"]))
    return F.coalesce(links_with_extension(hrefs, ".htm"), F.array().cast("array<string>"))


def table_sections(shredded: DataFrame) -> DataFrame:
    """Add `index_hrefs` and `field_hrefs`: links below the header up to the first blank row.

    The walk follows document order and may leave the first table.
    """
    rows = F.col("page.rows")
    return shredded.withColumn("index_hrefs", _section_links(rows, "Indexes")).withColumn(
        "field_hrefs", _section_links(rows, "Field")
    )


def table_triggers(shredded: DataFrame) -> DataFrame:
    """Add `triggers`: the nonblank cells of every later row that has any."""
    rows = F.col("page.rows")
    below = _after(rows, _header(rows, "Triggers:"))
    cells = F.transform(
        below,
        lambda row: F.filter(
            F.transform(row["cells"], lambda cell: strip(cell["text"])), lambda text: text != ""
        ),
    )
    kept = F.filter(cells, lambda texts: F.size(texts) > 0)
    return shredded.withColumn(
        "triggers", F.coalesce(kept, F.array().cast("array<array<string>>"))
    )


def field_metadata(shredded: DataFrame) -> DataFrame:
    """Add the eleven labelled values of the second table; a repeated label keeps its last."""
    inside = _inside(F.lit(1))
    rows = F.filter(F.col("page.rows"), lambda row: inside(row) & (F.size(row["cells"]) >= 2))
    pairs = F.transform(
        rows,
        lambda row: F.struct(
            strip(F.replace(F.lower(row["cells"][0]["joined"]), F.lit(":"), F.lit(""))).alias("name"),
            row["cells"][1]["joined"].alias("value"),
        ),
    )
    found = made_once(shredded.withColumn("_pairs", pairs), ["_pairs"])

    def last_value(label: str) -> Column:
        matching = F.filter("_pairs", lambda pair: pair["name"] == label)
        return F.coalesce(F.try_element_at(matching, F.lit(-1))["value"], F.lit(""))

    return found.withColumns(
        {column: last_value(label) for label, column in METADATA_LABELS.items()}
    ).drop("_pairs")


def field_indexes(shredded: DataFrame) -> DataFrame:
    """Add `indexes`: link texts of the first table whose text starts with `Indexes:`."""
    lists = F.filter("page.tables", lambda table: table["first_text"].startswith("Indexes:"))
    links = F.try_element_at(lists, F.lit(1))["links"]
    return shredded.withColumn("indexes", F.coalesce(links, F.array().cast("array<string>")))


def field_sections(shredded: DataFrame) -> DataFrame:
    """Add `description` and `content` from the last table.

    Header rows cut the table into blocks. The content is everything below the first `Content:`
    header after the last `Description:` header. The description is the last nonempty
    `Description:` block that no further `Description:` header follows.
    """
    last = _inside(F.size("page.tables") - 1)
    texts = F.transform(F.filter("page.rows", last), lambda row: row["joined"])
    framed = made_once(shredded.withColumn("_texts", texts), ["_texts"])

    kind = lambda text: F.when(text.contains("Description:"), "d").when(
        text.contains("Content:"), "c"
    )
    marks = F.transform("_texts", lambda text, at: F.struct(kind(text).alias("kind"), (at + 1).alias("at")))
    heads = F.filter(marks, lambda mark: mark["kind"].isNotNull())
    framed = made_once(framed.withColumn("_heads", heads), ["_heads"])

    size = F.size("_texts")

    def lines(start: Column, end: Column) -> Column:
        block = F.slice("_texts", start + 1, F.greatest(end - start, F.lit(0)))
        plain = F.filter(block, lambda text: (text != "") & kind(text).isNull())
        return F.array_join(plain, "\n")

    def block_text(head: Column, number: Column) -> Column:
        following = F.get("_heads", number + 1)
        wanted = (head["kind"] == "d") & ~F.equal_null(following["kind"], F.lit("d"))
        return F.when(wanted, lines(head["at"], F.coalesce(following["at"] - 1, size)))

    blocks = F.filter(F.transform("_heads", block_text), lambda text: text != "")
    last_description = F.coalesce(
        F.array_max(F.transform("_heads", lambda head: F.when(head["kind"] == "d", head["at"]))),
        F.lit(0),
    )
    openers = F.filter(
        "_heads", lambda head: (head["kind"] == "c") & (head["at"] > last_description)
    )
    start = F.get(openers, F.lit(0))["at"]
    return framed.withColumns(
        {
            "description": F.coalesce(F.try_element_at(blocks, F.lit(-1)), F.lit("")),
            "content": F.coalesce(F.when(start.isNotNull(), lines(start, size)), F.lit("")),
        }
    ).drop("_texts", "_heads")


def clean_annotations(frame: DataFrame) -> DataFrame:
    """Collapse white space (by line in description and content) and bring text to NFC."""
    tidy = {
        name: tidy_lines(F.col(name)) if name in ("description", "content") else collapse(F.col(name))
        for name in ANNOTATIONS
    }
    # Without this, every name would make all thirteen texts again, from the page's rows on.
    tidied = made_once(frame.withColumns(tidy), ANNOTATIONS)
    packed = made_once(tidied.withColumn("_values", compose(*ANNOTATIONS)), ["_values"])
    return packed.withColumns(
        {name: F.col("_values")[at] for at, name in enumerate(ANNOTATIONS)}
    ).select(frame.columns)


def annotate_pages(pages: DataFrame) -> DataFrame:
    """Field pages to their thirteen texts and index list."""
    shredded = shred(pages)
    found = field_sections(field_indexes(field_metadata(shredded))).drop("html", "page")
    return clean_annotations(found)


def _yes_no(lines: Column, label: str) -> Column:
    """First line with the label whose value is recognised."""
    named = F.filter(lines, lambda line: F.lower(line).startswith(label))
    flags = F.transform(
        named, lambda line: parse_flag(F.regexp_replace(line, r"(?s)^[^:]*:", ""))
    )
    return F.try_element_at(F.filter(flags, lambda flag: flag.isNotNull()), F.lit(1))


def index_pages(shredded: DataFrame) -> DataFrame:
    """Add `is_primary`, `is_unique`, `is_word` and `fields` of an index page."""
    rows = F.filter(
        "page.rows",
        lambda row: (F.size(row["cells"]) >= 4) & row["cells"][0]["joined"].rlike(r"^\p{Nd}+\z"),
    )
    fields = F.transform(
        rows,
        lambda row: F.struct(
            F.translate(row["cells"][0]["joined"], DIGITS, ASCII_DIGITS)
            .try_cast("bigint")
            .alias("field_sequence"),
            row["cells"][1]["joined"].alias("field_name"),
            row["cells"][2]["joined"].alias("field_order"),
            row["cells"][3]["joined"].alias("abbreviated"),
        ),
    )
    lines = F.split("page.lines", LINE_BREAK)
    return shredded.withColumns(
        {
            "is_primary": _yes_no(lines, "primary"),
            "is_unique": _yes_no(lines, "unique"),
            "is_word": _yes_no(lines, "word"),
            "fields": fields,
        }
    )
