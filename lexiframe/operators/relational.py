"""The five-table relational model, its views and its integrity report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.functions.names import clean_index_name, parse_flag
from lexiframe.operators.pages import index_pages, shred
from lexiframe.operators.skew import spread_join
from lexiframe.schemas import FIELD_COLUMNS, INDEX_ENTRY, INDEX_FIELDS, row_key, with_missing
from lexiframe.sources.pages import resolve_pages


def rel_modules(modules: DataFrame) -> DataFrame:
    return modules.select("module_code", F.coalesce("module_title", F.lit("")).alias("module_title")).distinct()


def rel_tables(tables: DataFrame, schema_prefix: str = "") -> DataFrame:
    """One row per bare table name; of two modules with one name the first code keeps it."""
    prefix = f"{schema_prefix.rstrip('.')}." if schema_prefix else ""
    return (
        tables.groupBy("table_id")
        .agg(F.min_by(F.struct("module_code", "title"), "module_code").alias("first"))
        .select(
            "table_id",
            F.concat(F.lit(prefix), "table_id").alias("table_name"),
            "first.module_code",
            F.coalesce("first.title", F.lit("")).alias("table_title"),
        )
    )


def rel_fields(fields: DataFrame) -> DataFrame:
    """Annotated fields in relational form; ids sort by place inside a table."""
    typed = fields.withColumnsRenamed({"type": "field_type"}).withColumns(
        {
            "indexes": F.to_json("indexes"),
            "id": row_key(F.col("module_code"), F.col("table_id"), seq=F.col("field_pos")),
        }
    )
    return typed.select(FIELD_COLUMNS)


def index_links(tables: DataFrame) -> DataFrame:
    """Index entries that are links to an index page."""
    return tables.select(
        "module_code", "table_id", F.posexplode("indexes").alias("index_pos", "link")
    ).select("module_code", "table_id", "index_pos", "link.filename", "link.path")


def parsed_index_links(links: DataFrame, pages: DataFrame, folder: str) -> DataFrame:
    """Index links with the flags and fields of their page, if there is one.

    `pages` may be a whole corpus: whatever its name, a page counts if a link leads to it, and only
    such pages are read.
    """
    resolved = resolve_pages(links, pages, folder)
    wanted = resolved.select(F.col("resolved").alias("path")).filter("path IS NOT NULL").distinct()
    notes = index_pages(shred(pages.join(wanted, "path", "left_semi"))).select(
        F.col("path").alias("resolved"), "is_primary", "is_unique", "is_word", "fields"
    )
    # A link without a page keeps a key of its own: nulls would meet in one partition.
    own_key = F.concat_ws("/", F.lit("no page"), "module_code", "table_id", "filename")
    return (
        resolved.withColumn("resolved", F.coalesce("resolved", own_key))
        .join(notes, "resolved", "left")
        .withColumn("index_name", clean_index_name(F.col("filename"), F.col("table_id")))
        .select(
            "module_code",
            "table_id",
            "index_pos",
            "index_name",
            "is_primary",
            "is_unique",
            "is_word",
            F.col("filename").alias("source_file"),
            F.coalesce("fields", F.array().cast(INDEX_FIELDS)).alias("fields"),
        )
    )


def annotated_indexes(tables: DataFrame, pages: DataFrame, folder: str) -> DataFrame:
    """Index entries of `json_tables` rows as `parsed_index_links` gives them.

    Objects keep their names, flags and fields; links are read from their page. Entries of another
    kind give an index without a name. Places follow the order of documents and entries.
    """
    entries = tables.select(
        "module_code",
        F.col("table_name").alias("table_id"),
        "path",
        F.posexplode("indexes").alias("_at", "_text"),
    ).withColumn("index_pos", F.concat_ws("/", "path", F.lpad(F.col("_at").cast("string"), 6, "0")))
    is_object = F.col("_text").startswith("{")
    entry = F.from_json("_text", INDEX_ENTRY)
    objects = entries.filter(is_object).withColumn("_entry", entry)
    own = objects.select(
        "module_code",
        "table_id",
        "index_pos",
        F.coalesce("_entry.name", F.lit("")).alias("index_name"),
        parse_flag(F.col("_entry.primary")).alias("is_primary"),
        parse_flag(F.col("_entry.unique")).alias("is_unique"),
        parse_flag(F.col("_entry.word")).alias("is_word"),
        F.coalesce("_entry.source_file", F.lit("")).alias("source_file"),
        F.coalesce(
            F.transform(
                "_entry.fields",
                lambda f: F.struct(
                    f["sequence"].try_cast("bigint").alias("field_sequence"),
                    f["name"].alias("field_name"),
                    f["order"].alias("field_order"),
                    f["abbreviated"].alias("abbreviated"),
                ),
            ),
            F.array().cast(INDEX_FIELDS),
        ).alias("fields"),
    )
    link = F.from_json("_text", "array<string>")
    others = entries.filter(~is_object).withColumn("_link", link)
    is_link = F.coalesce(F.size("_link"), F.lit(0)) > 0
    links = others.filter(is_link).select(
        "module_code",
        "table_id",
        "index_pos",
        F.get("_link", F.lit(0)).alias("filename"),
        F.get("_link", F.lit(1)).alias("path"),
    )
    nameless = others.filter(~is_link).select(
        "module_code",
        "table_id",
        "index_pos",
        F.lit("").alias("index_name"),
        *[F.lit(None).cast("boolean").alias(c) for c in ("is_primary", "is_unique", "is_word")],
        F.lit("").alias("source_file"),
        F.array().cast(INDEX_FIELDS).alias("fields"),
    )
    return own.unionByName(parsed_index_links(links, pages, folder)).unionByName(nameless)


def annotated_fields(fields: DataFrame) -> DataFrame:
    """`json_fields` rows in the form that `rel_fields` takes; places include the document."""
    return fields.withColumnsRenamed({"field_type": "type", "table_name": "table_id"}).withColumns(
        {
            "indexes": F.from_json("indexes", "array<string>"),
            "field_pos": F.concat_ws("/", "path", F.lpad(F.col("field_pos").cast("string"), 10, "0")),
        }
    )


def rel_indexes(entries: DataFrame) -> DataFrame:
    """`entries` are parsed links and dictionary entries alike; flags become 1, 0 or null."""
    return entries.select(
        row_key(F.col("module_code"), F.col("table_id"), seq=F.col("index_pos")).alias("id"),
        "module_code",
        "table_id",
        F.coalesce("index_name", F.lit("")).alias("index_name"),
        F.col("is_primary").cast("int").alias("is_primary"),
        F.col("is_unique").cast("int").alias("is_unique"),
        F.col("is_word").cast("int").alias("is_word"),
        F.coalesce("source_file", F.lit("")).alias("source_file"),
    )


def rel_index_fields(entries: DataFrame) -> DataFrame:
    key = row_key(F.col("module_code"), F.col("table_id"), seq=F.col("index_pos"))
    rows = entries.select(key.alias("index_id"), F.posexplode("fields").alias("_pos", "field"))
    return rows.select(
        row_key(F.col("index_id"), seq=F.col("_pos")).alias("id"),
        "index_id",
        "field.field_sequence",
        F.coalesce("field.field_name", F.lit("")).alias("field_name"),
        F.coalesce("field.field_order", F.lit("")).alias("field_order"),
        F.coalesce("field.abbreviated", F.lit("")).alias("abbreviated"),
    )


def field_details(fields: DataFrame, tables: DataFrame, modules: DataFrame) -> DataFrame:
    full = with_missing(fields, FIELD_COLUMNS)
    known = spread_join(full, modules.select("module_code"), ["module_code"], "left_semi", ["id"])
    named = spread_join(known, tables.select("table_id", "table_name"), ["table_id"], spread=["id"])
    kept = [name for name in FIELD_COLUMNS if name not in ("id", "module_code", "table_id")]
    return named.select("module_code", "table_name", *kept)


def index_details(
    indexes: DataFrame, index_fields: DataFrame, tables: DataFrame, modules: DataFrame
) -> DataFrame:
    """Indexes with their fields; an index without fields gives one row of nulls."""
    known = spread_join(indexes, modules.select("module_code"), ["module_code"], "left_semi")
    named = spread_join(known, tables.select("table_id", "table_name"), ["table_id"])
    full = with_missing(index_fields, ["field_order", "abbreviated"])
    parts = full.select("index_id", "field_sequence", "field_name", "field_order", "abbreviated")
    columns = [
        "module_code", "table_name", "index_name", "is_primary", "is_unique", "is_word",
        "source_file", "field_sequence", "field_name", "field_order", "abbreviated",
    ]
    joined = named.withColumnRenamed("id", "index_id").join(parts, "index_id", "left")
    return with_missing(joined, columns).select(columns)


def closed_prefix(prefix: str) -> str:
    """A schema prefix with its dot, or nothing."""
    return prefix if not prefix or prefix.endswith(".") else prefix + "."


def rel_metadata(counted: dict[str, DataFrame], provenance: dict[str, str]) -> DataFrame:
    """Key and value rows: the given texts and one row count per relation."""
    counts = [
        frame.agg(F.count(F.lit(1)).cast("string").alias("value")).select(
            F.lit(key).alias("key"), "value"
        )
        for key, frame in counted.items()
    ]
    spark = next(iter(counted.values())).sparkSession
    texts = spark.createDataFrame(list(provenance.items()), "key string, value string")
    return reduce(DataFrame.unionByName, counts, texts)


def rel_key_violations(
    modules: DataFrame,
    tables: DataFrame,
    fields: DataFrame,
    indexes: DataFrame,
    index_fields: DataFrame,
) -> DataFrame:
    """Repeated primary keys and references without a target, one row per key value.

    References are counted per key first, so the anti-joins see each key once.
    """

    def repeated(frame: DataFrame, name: str, key: str) -> DataFrame:
        counts = frame.groupBy(F.col(key).cast("string").alias("key_value")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        return counts.filter("rows > 1").select(F.lit(f"{name}.{key}: repeated").alias("violation"), "*")

    def orphans(frame: DataFrame, name: str, key: str, target: DataFrame, target_key: str) -> DataFrame:
        counts = frame.filter(F.col(key).isNotNull()).groupBy(
            F.col(key).cast("string").alias("key_value")
        ).agg(F.count(F.lit(1)).alias("rows"))
        known = target.select(F.col(target_key).cast("string").alias("key_value"))
        return counts.join(known, "key_value", "left_anti").select(
            F.lit(f"{name}.{key}: no target").alias("violation"), "*"
        )

    return reduce(
        DataFrame.unionByName,
        [
            repeated(modules, "modules", "module_code"),
            repeated(tables, "tables", "table_id"),
            orphans(tables, "tables", "module_code", modules, "module_code"),
            orphans(fields, "fields", "module_code", modules, "module_code"),
            orphans(fields, "fields", "table_id", tables, "table_id"),
            orphans(indexes, "table_indexes", "module_code", modules, "module_code"),
            orphans(indexes, "table_indexes", "table_id", tables, "table_id"),
            orphans(index_fields, "table_index_fields", "index_id", indexes, "id"),
        ],
    )


def search_fields(fields: DataFrame, tables: DataFrame, pattern: str) -> DataFrame:
    """Fields whose description matches, in module and table order.

    The field name takes part in the order, so the sort can cut a large table into ranges.
    """
    hits = fields.filter(F.col("description").ilike(pattern)).select(
        "table_id", "module_code", "field_name", "label", "description"
    )
    named = spread_join(hits, tables.select("table_id", "table_name"), ["table_id"])
    return named.select(
        "module_code", "table_name", "field_name", "label", "description"
    ).orderBy("module_code", "table_name", "field_name")
