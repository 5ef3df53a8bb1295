"""JSON dictionaries, JSON annotations, catalogue snapshots, CSV files and config texts.

A dictionary may be spread over any number of documents, for instance one per table; every
document is parsed on its own, and the order of rows is `(path, module_pos, table_pos, field_pos)`.
Files of any size are read by `json_blocks` and `csv_blocks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.constants import ACTIVE_LIST_MARKER
from lexiframe.functions.names import normalize_table_code
from lexiframe.functions.text import strip
from lexiframe.schemas import CSV_COLUMNS, LINKS

ANNOTATED_FIELD = (
    "struct<label: string, type: string, format: string, decimals: string, initial: string, "
    "extent: string, mandatory: string, val_exp: string, val_msg: string, help: string, "
    "trigger: string, indexes: string, description: string, content: string>"
)
#: A table without its fields, which are the larger part of a document.
ANNOTATED_TABLE = "struct<title: string, indexes: array<string>, triggers: array<array<string>>>"
DICTIONARY_TABLE = (
    "struct<filename: string, title: string, indexes: array<array<string>>, "
    "fields: array<array<string>>, triggers: array<array<string>>, error: string>"
)
_MODULES = "struct<modules: map<string, struct<code: string, title: string, tables: map<string, {table}>>>>"
_DICTIONARY = _MODULES.format(table=DICTIONARY_TABLE)
_ANNOTATED_TABLES = _MODULES.format(table=ANNOTATED_TABLE)
_ANNOTATIONS = _MODULES.format(
    table=ANNOTATED_TABLE.removesuffix(">") + f", fields: map<string, {ANNOTATED_FIELD}>>"
)
_TABLE = (
    "struct<id: string, name: string, fullyQualifiedName: string, displayName: string, "
    "description: string, columns: array<string>, dataProducts: array<struct<id: string, "
    "name: string, fullyQualifiedName: string, displayName: string>>>"
)
_COLUMN = "struct<name: string, displayName: string, description: string>"


def _entries(value: Column) -> Column:
    """Entries of a parsed JSON object as `key, value, pos`.

    A repeated key keeps its last value at its first place.
    """
    keys = F.map_keys(value)
    placed = F.transform(
        F.map_entries(value),
        lambda entry, at: F.struct(
            entry["key"].alias("key"), entry["value"].alias("value"), at.alias("pos")
        ),
    )
    backwards = F.reverse(keys)
    last = F.filter(
        placed,
        lambda entry: F.array_position(backwards, entry["key"]) == F.size(keys) - entry["pos"],
    )
    single = F.transform(
        last,
        lambda entry: F.struct(
            entry["key"].alias("key"),
            entry["value"].alias("value"),
            (F.array_position(keys, entry["key"]) - 1).cast("int").alias("pos"),
        ),
    )
    has_repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(has_repeats, single).otherwise(placed)


def _tables(documents: DataFrame, schema: str) -> DataFrame:
    parsed = documents.select("path", F.from_json("text", schema).alias("doc"))
    modules = parsed.select("path", F.explode(_entries(F.col("doc.modules"))).alias("m"))
    return modules.select(
        "path",
        F.col("m.key").alias("module_code"),
        F.col("m.pos").alias("module_pos"),
        F.coalesce("m.value.code", F.lit("")).alias("code"),
        F.coalesce("m.value.title", F.lit("")).alias("module_title"),
        F.explode(_entries(F.col("m.value.tables"))).alias("t"),
    ).select(
        "path",
        "module_code",
        "module_pos",
        "code",
        "module_title",
        F.col("t.key").alias("table_name"),
        F.col("t.pos").alias("table_pos"),
        "t.value.*",
    )


def json_dictionary(documents: DataFrame) -> DataFrame:
    """Dictionary documents as rows of `dictionary_tables`."""
    return dictionary_rows(_tables(documents, _DICTIONARY))


def dictionary_rows(tables: DataFrame) -> DataFrame:
    """Tables parsed as `DICTIONARY_TABLE` as rows of `dictionary_tables`."""

    def pairs(links: str) -> Column:
        return F.transform(
            links,
            lambda link: F.struct(link[0].alias("filename"), F.get(link, F.lit(1)).alias("path")),
        ).cast(LINKS)

    return tables.select(
        "path",
        "module_pos",
        "module_code",
        "module_title",
        "table_name",
        "table_pos",
        "filename",
        "title",
        pairs("indexes").alias("indexes"),
        pairs("fields").alias("fields"),
        "triggers",
        "error",
    )


def json_tables(documents: DataFrame) -> DataFrame:
    """Annotation documents as one row per table, without its fields."""
    return _tables(documents, _ANNOTATED_TABLES)


def json_fields(documents: DataFrame) -> DataFrame:
    """Annotation documents as one row per field."""
    fields = _tables(documents, _ANNOTATIONS).select(
        "path",
        "module_code",
        "module_pos",
        "code",
        "table_name",
        "table_pos",
        F.explode(_entries(F.col("fields"))).alias("f"),
    )
    return fields.select(
        "path",
        "module_code",
        "module_pos",
        "code",
        "table_name",
        "table_pos",
        F.col("f.key").alias("field_name"),
        F.col("f.pos").alias("field_pos"),
        "f.value.*",
    ).withColumnRenamed("type", "field_type")


def dictionary_documents(tables: DataFrame) -> DataFrame:
    """`dictionary_tables` as documents `(text)` that `json_dictionary` reads, one for each table."""

    def pairs(links: str) -> Column:
        return F.transform(links, lambda link: F.array(link["filename"], link["path"]))

    table = F.struct(
        "filename",
        F.when(F.col("error").isNull(), F.col("title")).alias("title"),
        pairs("indexes").alias("indexes"),
        pairs("fields").alias("fields"),
        "triggers",
        "error",
    )
    return tables.select(_document(F.col("module_code"), F.col("module_title"), F.col("table_name"), table))


def annotation_documents(tables: DataFrame, fields: DataFrame, block: int = 1000) -> DataFrame:
    """Tables and annotated fields as documents `(text)` that `json_tables` and `json_fields` read.

    A table has one document for every `block` places of its fields, so no document grows with a
    table, and one without fields that holds its links.
    """
    names = [c for c in fields.columns if c not in ("module_code", "table_id", "field_name", "field_pos")]
    entry = F.struct("field_pos", "field_name", F.struct(*names).alias("field"))
    blocks = fields.groupBy(
        "module_code", "table_id", F.floor(F.col("field_pos") / block).alias("_block")
    ).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    as_map = F.map_from_entries(
        F.transform("entries", lambda e: F.struct(e["field_name"].alias("key"), e["field"].alias("value")))
    )
    links = F.transform("indexes", lambda link: F.array(link["filename"], link["path"]))
    whole = tables.select(
        _document(
            F.col("module_code"), F.lit(None).cast("string"), F.col("table_id"),
            F.struct("title", links.alias("indexes"), "triggers"),
        )
    )
    parts = blocks.select(
        _document(
            F.col("module_code"), F.lit(None).cast("string"), F.col("table_id"),
            F.struct(as_map.alias("fields")),
        )
    )
    return whole.unionByName(parts)


def _document(code: Column, module_title: Column, name: Column, table: Column) -> Column:
    module = F.struct(
        code.alias("code"), module_title.alias("title"), F.create_map(name, table).alias("tables")
    )
    return F.to_json(F.struct(F.create_map(code, module).alias("modules"))).alias("text")


def catalog_tables(documents: DataFrame) -> DataFrame:
    """Catalogue table objects, one document each. Presence of a key is kept apart from null."""
    keys = F.json_object_keys("text")
    return documents.select("text", F.from_json("text", _TABLE).alias("t")).select(
        F.col("t.fullyQualifiedName").alias("table_fqn"),
        "t.id",
        "t.name",
        F.col("t.displayName").alias("display_name"),
        "t.description",
        F.array_contains(keys, "displayName").alias("has_display_name"),
        F.array_contains(keys, "description").alias("has_description"),
        F.col("t.dataProducts").alias("data_products"),
        F.col("text").alias("raw"),
    )


def catalog_columns(documents: DataFrame) -> DataFrame:
    """Columns of catalogue table objects; `raw` is the column's own JSON text."""
    parsed = documents.select(F.from_json("text", _TABLE).alias("t")).select(
        F.col("t.fullyQualifiedName").alias("table_fqn"),
        F.posexplode("t.columns").alias("ordinal", "raw"),
    )
    keys = F.json_object_keys("raw")
    return parsed.withColumn("c", F.from_json("raw", _COLUMN)).select(
        "table_fqn",
        "ordinal",
        F.coalesce("c.name", F.lit("")).alias("name"),
        F.col("c.displayName").alias("display_name"),
        F.col("c.description").alias("description"),
        F.array_contains(keys, "displayName").alias("has_display_name"),
        F.array_contains(keys, "description").alias("has_description"),
        "raw",
    )


def parse_csv_lines(lines: DataFrame) -> DataFrame:
    """CSV records held as text in `line`, for records that arrive in a table.

    A list of one record keeps Spark from reading the line again for every later filter.
    """
    schema = ", ".join(f"{name} string" for name in CSV_COLUMNS)
    record = F.from_csv("line", F.lit(schema), {"escape": '"'})
    return lines.select("path", "record_no", F.inline(F.array(record)))


def active_tables(texts: DataFrame) -> DataFrame:
    """Table codes in the bracketed list behind the marker of each config text.

    Codes always lose the default prefix. A text without a list gives one row with `error`.
    """
    after = F.regexp_extract("text", rf"(?s){ACTIVE_LIST_MARKER}(.*)\z", 1)
    listed = F.regexp_extract(after, r"(?s)\A[^\[]*\[([^\]]*)\]", 1)
    has_list = after.rlike(r"(?s)\A[^\[]*\[[^\]]*\]")
    error = F.when(~F.contains("text", F.lit(ACTIVE_LIST_MARKER)), "marker not found").when(
        ~has_list, "invalid list"
    )
    flat = F.replace(listed, F.lit("\n"), F.lit(" "))
    items = F.regexp_extract_all(
        flat, F.lit(r'(?:\A|,)("(?:[^"]|"")*"[^,]*|[^,]*)'), F.lit(1)
    )
    bare = F.transform(
        items, lambda item: F.btrim(F.btrim(strip(item), F.lit('"')), F.lit("'"))
    )
    kept = F.filter(bare, lambda item: item != "")
    codes = texts.select(
        "path",
        error.alias("error"),
        F.explode(F.when(error.isNull(), kept).otherwise(F.array(F.lit("")))).alias("item"),
    )
    return codes.select(
        "path",
        F.when(F.col("error").isNull(), normalize_table_code(F.col("item"))).alias("table_code"),
        "error",
    ).distinct()


def latest_snapshot(files: DataFrame, now: Column, max_age: str = "INTERVAL 1 DAY") -> DataFrame:
    """Newest artefact of each kind, and whether it is young enough to be used again."""
    return files.groupBy("kind").agg(
        F.max_by("path", F.struct("mtime", "path")).alias("path"), F.max("mtime").alias("mtime")
    ).withColumn("is_fresh", now - F.col("mtime") < F.expr(max_age))
