"""The dictionary side of a comparison: tables and columns with labels, texts and provenance.

Every source ends in the same two relations:
`src_tables(table_code, warehouse_table_name, label, description, source_ref)` and
`src_columns(table_code, column_name, label, description, help, content, source_ref)`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.constants import DEFAULT_PREFIX, LEGACY_HEADING, LEGACY_SECTIONS
from lexiframe.functions.names import (
    clean_identifier,
    clean_table_label,
    normalize_column_name,
    normalize_table_code,
    normalize_table_name,
    parse_flag,
    stem,
    without_table_prefix,
)
from lexiframe.functions.text import (
    clean_description,
    clean_text,
    index_list_text,
    legacy_entries,
    section_text,
    strip,
)
from lexiframe.operators.skew import made_once, short_join, spread_join
from lexiframe.schemas import FIELD_COLUMNS, IN_LOWER_CASE, INDEX_ENTRY, INDEX_FIELDS, with_missing


def normalize_sources(
    frame: DataFrame, table: str, column: str, prefix: str = DEFAULT_PREFIX
) -> DataFrame:
    """Add the normalised table code, warehouse name and column name."""
    named = with_column_name(with_table_code(frame, table, prefix), column)
    return named.withColumn(
        "warehouse_table_name", normalize_table_name(F.col("table_code"), prefix)
    )


def with_table_code(frame: DataFrame, table: str, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    return frame.withColumn("table_code", normalize_table_code(F.col(table), prefix))


def with_column_name(frame: DataFrame, column: str, name: str = "column_name") -> DataFrame:
    """Add the column name of `column` under the row's `table_code`."""
    return frame.withColumn(name, normalize_column_name(F.col(column), F.col("table_code")))


def with_legacy_description(frame: DataFrame, name: str) -> DataFrame:
    """Add the legacy text of a column; sections whose attribute is absent stay out.

    Each section is cleaned in a projection of its own, so it is cleaned once.
    """
    present = [(label, column) for label, column in LEGACY_SECTIONS if column in frame.columns]
    cleaned = frame.withColumns(
        {
            f"_{column}": section_text(
                index_list_text(F.col(column)) if column == "indexes" else F.col(column), label
            )
            for label, column in present
        }
    )
    parts = [
        F.when(F.col(f"_{column}") != "", F.concat(F.lit(f"{label}:\n"), f"_{column}"))
        for label, column in present
    ]
    body = cleaned.withColumn("_body", F.concat_ws("\n\n", *parts))
    text = F.when(F.col("_body") != "", F.concat(F.lit(LEGACY_HEADING + "\n\n"), "_body"))
    return body.withColumn(name, text).drop("_body", *[f"_{column}" for _, column in present])


def index_columns_text(fields: Column) -> Column:
    names = F.array_join(F.transform(fields, lambda field: field["field_name"]), ", ")
    return F.coalesce(F.nullif(names, F.lit("")), F.lit("unknown"))


def index_line(name: Column, primary: Column, unique: Column, word: Column, columns: Column) -> Column:
    traits = F.concat_ws(
        ", ",
        F.when(primary, F.lit("primary")),
        F.when(unique, F.lit("unique")),
        F.when(word, F.lit("word")),
    )
    suffix = F.when(traits == "", "").otherwise(F.concat(F.lit(" ("), traits, F.lit(")")))
    return F.concat(name, suffix, F.lit(": "), columns)


def description_from_lines(primary_lines: Column, lines: Column) -> Column:
    """Table text from arrays of lines that are in index order."""
    return legacy_entries(
        [
            ("Primary Key", F.array_join(primary_lines, "\n")),
            ("Indexes", F.array_join(lines, "\n")),
        ]
    )


def source_indexes(
    indexes: DataFrame,
    index_fields: DataFrame,
    tables: DataFrame,
    prefix: str = DEFAULT_PREFIX,
) -> DataFrame:
    """Indexes of known tables with their fields in sequence; one row per index.

    The list of one index is a single value of the result (a line of a description), which is
    why it may be gathered; indexes themselves stay rows.
    """
    full = with_missing(index_fields, ["field_order", "abbreviated"])
    lists = full.groupBy(F.col("index_id").alias("id")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("field_sequence").cast("bigint").alias("field_sequence"),
                    clean_identifier(F.col("field_name")).alias("field_name"),
                    clean_text(F.col("field_order")).alias("field_order"),
                    clean_text(F.col("abbreviated")).alias("abbreviated"),
                )
            )
        ).alias("fields")
    )
    known = tables.select(normalize_table_code(F.col("table_id"), prefix).alias("table_code")).distinct()
    coded = indexes.select(
        "id",
        "table_id",
        normalize_table_code(F.col("table_id"), prefix).alias("table_code"),
        F.col("index_name").alias("raw_name"),
        clean_identifier(F.col("index_name")).alias("index_name"),
        parse_flag(F.col("is_primary")).alias("is_primary"),
        parse_flag(F.col("is_unique")).alias("is_unique"),
        parse_flag(F.col("is_word")).alias("is_word"),
    )
    return (
        spread_join(coded, known, ["table_code"], "left_semi")
        .join(lists, "id", "left")
        .withColumn("fields", F.coalesce("fields", F.array().cast(INDEX_FIELDS)))
    )


def table_descriptions(indexes: DataFrame) -> DataFrame:
    """One description per table from the rows of `source_indexes`."""
    line = index_line(
        F.col("index_name"),
        F.col("is_primary"),
        F.col("is_unique"),
        F.col("is_word"),
        index_columns_text(F.col("fields")),
    )
    primary = F.when(
        F.col("is_primary"),
        F.concat("index_name", F.lit(": "), index_columns_text(F.col("fields"))),
    )
    lines = indexes.select(
        "table_code",
        F.struct(
            "table_id", "raw_name", "id", line.alias("line"), primary.alias("primary_line")
        ).alias("entry"),
    )
    gathered = lines.groupBy("table_code").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    primary_lines = F.filter(
        F.transform("entries", lambda entry: entry["primary_line"]), lambda text: text.isNotNull()
    )
    return gathered.select(
        "table_code",
        description_from_lines(
            primary_lines, F.transform("entries", lambda entry: entry["line"])
        ).alias("description"),
    )


def relational_tables(
    tables: DataFrame,
    indexes: DataFrame | None = None,
    index_fields: DataFrame | None = None,
    prefix: str = DEFAULT_PREFIX,
    path: str = "",
) -> DataFrame:
    """`src_tables` of the relational model; of ids with one code the last id wins."""
    code = normalize_table_code(F.col("table_id"), prefix)
    merged = (
        tables.withColumn("table_code", code)
        .groupBy("table_code")
        .agg(
            F.max("table_id").alias("table_id"),
            F.max_by("table_title", "table_id").alias("table_title"),
        )
    )
    base = merged.select(
        "table_code",
        normalize_table_name(F.col("table_code"), prefix).alias("warehouse_table_name"),
        clean_table_label(F.col("table_code"), F.col("table_title")).alias("label"),
        F.concat(F.lit(f"{path}:tables:"), "table_id").alias("source_ref"),
    )
    if indexes is None:
        return base.withColumn("description", F.lit(None).cast("string"))
    if index_fields is None:
        index_fields = indexes.sparkSession.createDataFrame(
            [], "index_id string, field_sequence bigint, field_name string"
        )
    texts = table_descriptions(source_indexes(indexes, index_fields, tables, prefix))
    return base.join(texts, "table_code", "left")


def relational_columns(
    fields: DataFrame,
    tables: DataFrame,
    prefix: str = DEFAULT_PREFIX,
    path: str = "",
    wanted: DataFrame | None = None,
) -> DataFrame:
    """`src_columns` of the relational model; of rows with one name the last id wins.

    The winner is chosen before its texts are built, so each text is built once. With `wanted`
    only columns of its `table_code`s are made; others leave before anything is done with them.
    """
    coded = with_table_code(fields, "table_id", prefix)
    known = tables.select(normalize_table_code(F.col("table_id"), prefix).alias("table_code")).distinct()
    if wanted is not None:
        known = known.join(wanted.select("table_code"), "table_code", "left_semi")
    named = with_column_name(
        short_join(coded, known, ["table_code"], "left_semi", spread=["id"]), "field_name"
    )
    order = ["table_id", "id"]
    present = [n for n in FIELD_COLUMNS if n in fields.columns and n not in ("module_code", *order)]
    # The order leads the row, so that it travels once.
    last = (
        named.groupBy("table_code", "column_name")
        .agg(F.max(F.struct(*order, *present)).alias("row"))
        .select("table_code", "column_name", "row.*")
    )
    source_ref = F.concat(F.lit(f"{path}:fields:"), "table_id", F.lit("."), "field_name")
    return _source_columns(last.withColumn("source_ref", source_ref))


def _source_columns(rows: DataFrame) -> DataFrame:
    full = with_missing(with_legacy_description(rows, "_legacy"), ["help", "content"])
    return full.select(
        "table_code",
        F.col("column_name").alias("column_name", metadata=IN_LOWER_CASE),
        clean_text(F.col("label")).alias("label"),
        F.col("_legacy").alias("description"),
        clean_text(F.col("help")).alias("help"),
        clean_description(F.col("content")).alias("content"),
        "source_ref",
    )


def json_indexes(entries: Column, table_code: Column) -> Column:
    """Index entries held as JSON texts: objects keep flags and fields, links give a name."""

    def fields_of(entry: Column) -> Column:
        named = F.filter(
            entry["fields"], lambda field: F.coalesce(field["name"], F.lit("")) != ""
        )
        return F.transform(
            named,
            lambda field: F.struct(
                strip(field["sequence"]).try_cast("bigint").alias("field_sequence"),
                clean_identifier(field["name"]).alias("field_name"),
                clean_text(field["order"]).alias("field_order"),
                clean_text(field["abbreviated"]).alias("abbreviated"),
            ),
        )

    def one(text: Column) -> Column:
        entry = F.when(text.startswith("{"), F.from_json(text, INDEX_ENTRY))
        link = F.from_json(text, "array<string>")
        link_name = clean_identifier(without_table_prefix(stem(link[0]), table_code))
        return F.struct(
            F.when(entry.isNotNull(), clean_identifier(entry["name"]))
            .otherwise(link_name)
            .alias("index_name"),
            parse_flag(entry["primary"]).alias("is_primary"),
            parse_flag(entry["unique"]).alias("is_unique"),
            parse_flag(entry["word"]).alias("is_word"),
            F.coalesce(fields_of(entry), F.array().cast(INDEX_FIELDS)).alias("fields"),
        )

    usable = F.filter(
        entries,
        lambda text: text.startswith("{") | (F.size(F.from_json(text, "array<string>")) > 0),
    )
    return F.transform(usable, one)


def indexes_description(indexes: Column) -> Column:
    """Table text from an array of `json_indexes`, in array order."""
    primary = F.filter(indexes, lambda index: F.coalesce(index["is_primary"], F.lit(False)))
    return description_from_lines(
        F.transform(
            primary,
            lambda index: F.concat(
                index["index_name"], F.lit(": "), index_columns_text(index["fields"])
            ),
        ),
        F.transform(
            indexes,
            lambda index: index_line(
                index["index_name"],
                index["is_primary"],
                index["is_unique"],
                index["is_word"],
                index_columns_text(index["fields"]),
            ),
        ),
    )


def _first_nonnull(value: Column, seq: Column) -> Column:
    # min_by passes over rows whose order is null.
    return F.min_by(value, F.when(value.isNotNull(), seq))


def annotation_tables(tables: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """`src_tables` of annotation documents: first table wins, then the first nonblank label."""
    seq = F.struct("path", "module_pos", "table_pos")
    coded = tables.withColumn("table_code", normalize_table_code(F.col("table_name"), prefix))
    prepared = coded.select(
        "table_code",
        seq.alias("seq"),
        clean_table_label(F.col("table_code"), F.col("title")).alias("label"),
        "indexes",
        F.concat("path", F.lit(":modules."), "code", F.lit("."), "table_name").alias("source_ref"),
    )
    merged = prepared.groupBy("table_code").agg(
        _first_nonnull(F.col("label"), F.col("seq")).alias("label"),
        F.min_by(F.struct("indexes", "source_ref"), "seq").alias("first"),
    )
    return merged.select(
        "table_code",
        normalize_table_name(F.col("table_code"), prefix).alias("warehouse_table_name"),
        "label",
        indexes_description(json_indexes(F.col("first.indexes"), F.col("table_code"))).alias(
            "description"
        ),
        "first.source_ref",
    )


def annotation_columns(fields: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """`src_columns` of annotation documents: of rows with one name the last one wins."""
    named = with_column_name(with_table_code(fields, "table_name", prefix), "field_name")
    texts = ["label", "code", "table_name", "field_name", *[name for _, name in LEGACY_SECTIONS]]
    last = (
        named.groupBy("table_code", "column_name")
        .agg(
            F.max_by(
                F.struct("path", *texts),
                F.struct("path", "module_pos", "table_pos", "field_pos"),
            ).alias("row")
        )
        .select("table_code", "column_name", "row.*")
    )
    source_ref = F.concat(
        "path", F.lit(":modules."), "code", F.lit("."), "table_name", F.lit("."), "field_name"
    )
    return _source_columns(last.withColumn("source_ref", source_ref))


def _coded_records(records: DataFrame, prefix: str) -> DataFrame:
    line = (F.col("record_no") + 1).cast("string")
    return (
        made_once(with_table_code(records, "table_code", prefix), ["table_code"])
        .filter("table_code <> ''")
        .withColumn("source_ref", F.concat("path", F.lit(":"), line))
    )


def csv_tables(records: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """`src_tables` of CSV records: the first nonblank label and description of a table.

    Labels keep a leading `CODE -`. A line number is the record number plus one.
    """
    rows = _coded_records(records, prefix).select(
        "table_code",
        F.struct("path", "record_no").alias("seq"),
        clean_text(F.col("table_label")).alias("label"),
        clean_description(F.col("table_description")).alias("description"),
        "source_ref",
    )
    merged = rows.groupBy("table_code").agg(
        _first_nonnull(F.col("label"), F.col("seq")).alias("label"),
        _first_nonnull(F.col("description"), F.col("seq")).alias("description"),
        F.min_by("source_ref", "seq").alias("source_ref"),
    )
    return merged.withColumn(
        "warehouse_table_name", normalize_table_name(F.col("table_code"), prefix)
    )


def csv_columns(records: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """`src_columns` of CSV records: of rows with one name the last one wins."""
    rows = _coded_records(records, prefix)
    named = with_column_name(
        rows.withColumn("column_name", F.coalesce("column_name", F.lit(""))), "column_name", "name"
    )
    last = made_once(named, ["name"]).filter("name <> ''").groupBy("table_code", "name").agg(
        F.max_by(
            F.struct("column_label", "column_description", "source_ref"),
            F.struct("path", "record_no"),
        ).alias("row")
    )
    nothing = F.lit(None).cast("string")
    return last.select(
        "table_code",
        F.col("name").alias("column_name", metadata=IN_LOWER_CASE),
        clean_text(F.col("row.column_label")).alias("label"),
        clean_description(F.col("row.column_description")).alias("description"),
        nothing.alias("help"),
        nothing.alias("content"),
        "row.source_ref",
    )
