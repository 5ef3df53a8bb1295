"""From page corpus to dictionary and field annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.functions.names import base_name, join_path, stem
from lexiframe.operators.pages import (
    ANNOTATIONS,
    annotate_pages,
    links_with_extension,
    page_titles,
    shred,
    table_sections,
    table_triggers,
)
from lexiframe.operators.skew import hot_key_join
from lexiframe.schemas import LINKS
from lexiframe.sources.pages import module_pages


def _module_lists(pages: DataFrame) -> DataFrame:
    """One row per module: code, title and hrefs. Of two pages with one code the last name wins."""
    code = F.upper(F.replace("filename", F.lit("tbl.htm"), F.lit("")))
    listed = page_titles(shred(module_pages(pages))).select(
        code.alias("module_code"),
        F.struct(
            F.col("title"), links_with_extension(F.col("page.hrefs"), ".htm").alias("hrefs")
        ).alias("found"),
        "filename",
    )
    return (
        listed.groupBy("module_code")
        .agg(F.max_by("found", "filename").alias("found"))
        .select("module_code", F.col("found.title").alias("module_title"), "found.hrefs")
    )


def dictionary_modules(pages: DataFrame) -> DataFrame:
    return _module_lists(pages).select("module_code", "module_title")


def module_tables(pages: DataFrame, folder: str) -> DataFrame:
    """Links of each module page, in page order."""
    links = _module_lists(pages).select(
        "module_code", "module_title", F.posexplode("hrefs").alias("table_pos", "href")
    )
    return links.select(
        "module_code",
        "module_title",
        "table_pos",
        base_name(F.col("href")).alias("filename"),
        join_path(F.lit(folder), F.col("href")).alias("path"),
    )


def dictionary_tables(pages: DataFrame, folder: str) -> DataFrame:
    """One row per table of a module with its title, links, triggers or error."""

    def as_links(hrefs):
        return F.transform(
            hrefs,
            lambda href: F.struct(
                base_name(href).alias("filename"),
                join_path(F.lit(folder), href).alias("path"),
            ),
        ).cast(LINKS)

    listed = (
        module_tables(pages, folder)
        .withColumn("table_name", stem(F.col("filename")))
        .groupBy("module_code", "module_title", "table_name")
        .agg(
            F.max_by(F.struct("filename", "path"), "table_pos").alias("link"),
            F.max("table_pos").alias("table_pos"),
        )
        .select("module_code", "module_title", "table_name", "table_pos", "link.filename", "link.path")
    )
    # Pages are narrowed to those that are listed and read once; only what was read joins the lists.
    wanted = pages.select("path", "html", "error").join(
        listed.select("path").distinct(), "path", "left_semi"
    )
    sections = table_triggers(table_sections(shred(wanted))).select(
        "path",
        "error",
        F.struct(F.col("page.title").alias("title")).alias("page"),
        "index_hrefs",
        "field_hrefs",
        "triggers",
        F.lit(True).alias("_found"),
    )
    parsed = listed.join(sections, "path", "left")
    failed = F.when(F.col("_found").isNull(), "page not found").otherwise(F.col("error"))
    ok = failed.isNull()
    return parsed.select(
        "module_code",
        "module_title",
        "table_name",
        "table_pos",
        "filename",
        F.when(ok, F.coalesce("page.title", F.lit(""))).alias("title"),
        F.when(ok, as_links("index_hrefs")).alias("indexes"),
        F.when(ok, as_links("field_hrefs")).alias("fields"),
        F.when(ok, F.col("triggers")).alias("triggers"),
        failed.alias("error"),
    )


def extract_audit(modules: DataFrame, tables: DataFrame) -> DataFrame:
    """Counts over all modules; each failed table counts once."""
    total_modules = modules.agg(F.count(F.lit(1))).scalar()
    return tables.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count("error").alias("failed_tables"),
    ).select(
        total_modules.alias("total_modules"),
        total_modules.alias("expected_modules"),
        "total_tables",
        "failed_tables",
    )


def failed_tables(tables: DataFrame) -> DataFrame:
    return tables.filter(F.col("error").isNotNull()).select(
        "module_code", "table_name", "filename", "error"
    )


def _short_name(name: Column) -> Column:
    """Table name without the `tbl` of its file name."""
    short = F.substring(name, F.lit(1), F.length(name) - 3)
    return F.when(F.lower(name).endswith("tbl"), short).otherwise(name)


def annotation_links(tables: DataFrame, pages: DataFrame) -> DataFrame:
    """Every field link with the annotations of its page; `found` is false without a page.

    Each linked page is read once, however many links point to it. `is_latest` is false on links
    of a table that a later table of the same short name replaces.
    """
    named = tables.withColumn("table_id", _short_name(F.col("table_name")))
    last = named.groupBy("module_code", "table_id").agg(F.max("table_pos").alias("last_pos"))
    links = named.join(last, ["module_code", "table_id"]).select(
        "module_code",
        "table_id",
        "table_pos",
        (F.col("table_pos") == F.col("last_pos")).alias("is_latest"),
        F.posexplode("fields").alias("field_pos", "link"),
    ).select(
        "module_code",
        "table_id",
        "table_pos",
        "is_latest",
        "field_pos",
        stem(F.col("link.filename")).alias("field_name"),
        F.col("link.path").alias("path"),
    )
    wanted = pages.join(links.select("path").distinct(), "path", "left_semi")
    notes = annotate_pages(wanted).select(
        "path", *ANNOTATIONS, "indexes", F.col("error").isNull().alias("found")
    )
    spread = ["module_code", "table_id", "field_pos"]
    return hot_key_join(links, notes, ["path"], spread=spread).withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def latest_tables(tables: DataFrame) -> DataFrame:
    """Tables under their short name; of two tables with one short name the later one stays."""
    packed = F.struct("title", "indexes", "triggers")
    return (
        tables.withColumn("table_id", _short_name(F.col("table_name")))
        .groupBy("module_code", "table_id")
        .agg(F.max_by(packed, "table_pos").alias("found"), F.max("table_pos").alias("table_pos"))
        .select("module_code", "table_id", "table_pos", "found.*")
    )


def annotate_fields(links: DataFrame) -> DataFrame:
    """One row per field: the last link's values at the first link's place.

    `links` holds the rows of `annotation_links`; only the latest table of a short name counts.
    """
    values = F.struct(*ANNOTATIONS, "indexes")
    return (
        links.filter("found AND is_latest")
        .groupBy("module_code", "table_id", "field_name")
        .agg(F.max_by(values, "field_pos").alias("found"), F.min("field_pos").alias("field_pos"))
        .select("module_code", "table_id", "field_name", "field_pos", "found.*")
    )


def annotate_audit(modules: DataFrame, tables: DataFrame, links: DataFrame) -> DataFrame:
    """Modules, tables, and links estimated, processed and failed."""
    return links.agg(
        F.count(F.lit(1)).alias("total_fields"),
        F.count_if("found").alias("total_fields_processed"),
        F.count_if(~F.col("found")).alias("total_fields_failed"),
    ).select(
        modules.agg(F.count(F.lit(1))).scalar().alias("total_modules"),
        tables.agg(F.count(F.lit(1))).scalar().alias("total_tables"),
        "total_fields",
        "total_fields_processed",
        "total_fields_failed",
    )
