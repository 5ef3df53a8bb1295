"""Report of primary-unique keys and transaction columns.

Lists are rows with an order column, not arrays: a table of any width never has to fit in one
group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.functions.names import normalize_field_name
from lexiframe.operators.skew import spread_join

TRANS_PREFIX = "trans"
TRANS_PATTERN = "trans%"


def table_list(tables: DataFrame) -> DataFrame:
    return tables.select("table_name").orderBy(F.lower("table_name"))


def primary_unique_indexes(details: DataFrame) -> DataFrame:
    """Key columns of every index that is primary and unique, from `index_details` rows.

    An index without fields gives one row with a null column, which counts as a key.
    """
    return details.filter("is_primary = 1 AND is_unique = 1").select(
        "table_name", "index_name", "field_sequence", F.col("field_name").alias("column_name")
    )


def pk_columns(unique_indexes: DataFrame) -> DataFrame:
    """Columns of each table's first primary-unique index, by lower-case index name."""
    first = unique_indexes.groupBy("table_name").agg(
        F.min(F.struct(F.lower("index_name").alias("folded"), "index_name")).alias("first")
    ).select("table_name", F.col("first.index_name").alias("index_name"))
    return spread_join(unique_indexes, first, ["table_name", "index_name"], "left_semi").select(
        "table_name", "field_sequence", "column_name"
    )


def trans_columns(fields: DataFrame, tables: DataFrame) -> DataFrame:
    """Distinct normalised `trans*` columns with the id of their first occurrence.

    The bare table id is the prefix that is removed, so a schema prefix does not hide columns.
    """
    ids = tables.select("table_id", "table_name")
    named = spread_join(fields.select("id", "table_id", "field_name"), ids, ["table_id"], spread=["id"])
    column = normalize_field_name(F.col("field_name"), F.col("table_id"))
    return (
        named.select("table_name", column.alias("column_name"), "id")
        .filter(F.col("column_name").startswith(TRANS_PREFIX))
        .groupBy("table_name", "column_name")
        .agg(F.min("id").alias("first_id"))
    )


def key_flags(tables: DataFrame, unique_indexes: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per table: is there a primary-unique key, and is there a `transdttmz` column."""
    keyed = unique_indexes.select("table_name").distinct().withColumn("has_key", F.lit(True))
    stamped = (
        transactions.filter(F.lower("column_name") == "transdttmz")
        .select("table_name")
        .distinct()
        .withColumn("has_stamp", F.lit(True))
    )
    return (
        tables.select("table_name")
        .join(keyed, "table_name", "left")
        .join(stamped, "table_name", "left")
        .select(
            "table_name",
            F.coalesce("has_key", F.lit(False)).alias("has_primary_unique_key"),
            F.coalesce("has_stamp", F.lit(False)).alias("has_transdttmz"),
        )
    )


def _listed(tables: DataFrame, list_name: str, entries: DataFrame) -> DataFrame:
    """Entries of one list for every table; a table with an empty list has one row of nulls."""
    empty = tables.select("table_name").join(
        entries.select("table_name").distinct(), "table_name", "left_anti"
    )
    columns = ["table_name", "index_name", "position", "column_name", "is_empty"]
    full = entries.withColumn("is_empty", F.lit(False))
    bare = empty.withColumns(
        {
            "index_name": F.lit(None).cast("string"),
            "position": F.lit(None).cast("string"),
            "column_name": F.lit(None).cast("string"),
            "is_empty": F.lit(True),
        }
    )
    return full.select(columns).unionByName(bare.select(columns)).select(
        F.lit(list_name).alias("list_name"), *columns
    )


def _entries(frame: DataFrame, position: str) -> DataFrame:
    index_name = "index_name" if "index_name" in frame.columns else "cast(null as string) AS index_name"
    return frame.selectExpr(
        "table_name", index_name, f"cast({position} as string) AS position", "column_name"
    )


def key_report_simple(tables: DataFrame, unique_indexes: DataFrame, transactions: DataFrame) -> DataFrame:
    """Rows of the lists `pk_columns` and `transaction_columns` of every table."""
    keys = _entries(pk_columns(unique_indexes), "field_sequence")
    changes = _entries(transactions, "first_id")
    return _listed(tables, "pk_columns", keys).unionByName(
        _listed(tables, "transaction_columns", changes)
    )


def key_report_full(tables: DataFrame, unique_indexes: DataFrame, transactions: DataFrame) -> DataFrame:
    """The simple lists, all primary-unique indexes, and the two flags on every row."""
    keys = _entries(pk_columns(unique_indexes), "field_sequence")
    indexes = _entries(unique_indexes, "field_sequence")
    changes = _entries(transactions, "first_id")
    lists = (
        _listed(tables, "primary_unique_key_columns", keys)
        .unionByName(_listed(tables, "primary_unique_indexes", indexes))
        .unionByName(_listed(tables, "trans_columns", changes))
    )
    return spread_join(lists, key_flags(tables, unique_indexes, transactions), ["table_name"])


def key_report_counts(tables: DataFrame, unique_indexes: DataFrame, transactions: DataFrame) -> DataFrame:
    keyed = unique_indexes.select("table_name").distinct().withColumn("has_key", F.lit(True))
    changed = transactions.select("table_name").distinct().withColumn("has_trans", F.lit(True))
    return (
        tables.select("table_name")
        .join(keyed, "table_name", "left")
        .join(changed, "table_name", "left")
        .agg(
            F.count(F.lit(1)).alias("tables_count"),
            F.count("has_key").alias("tables_with_primary_unique_key_count"),
            F.count("has_trans").alias("tables_with_trans_columns_count"),
        )
        .withColumn("trans_pattern", F.lit(TRANS_PATTERN))
    )
