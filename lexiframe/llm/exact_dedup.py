"""Exact deduplication by full content, safe against hot groups; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.shared import attach, lower_ascii, shuffle_partitions, stored


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each distinct text: digest, keep_id, group_size and a second hash.

    Three combining steps, each of which compares the whole text and not only its digest:
    every task first puts its own equal texts together, the salted groups of a digest are merged
    next (the salt is the input task's, so a task gives at most one row for a text), and last the
    winners of all salts. A group of any size thus sends at most one row per task and, in the last
    step, at most one row per salt.
    """
    salts = max(4, shuffle_partitions(docs.sparkSession) // 4)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("_content"),
    ).select(
        "_id",
        "_content",
        F.sha2("_content", 256).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"),
    )
    salted = rows.groupBy("digest", "_salt", "_content").agg(
        F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n")
    )
    merged = salted.groupBy("digest", "_content").agg(
        F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size")
    )
    return merged.withColumn("_other", F.xxhash64("_content")).drop("_content")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group of every document: `id_col`, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z; null counts as empty. The largest id of a
    group stays. Rows that repeat an id are rows of their own (each counts in group_size), all of
    them kept if the id wins. A null id loses to any other; a group of null ids only has a null
    keep_id, and its rows are kept. Other columns of `docs` are ignored; an empty table gives none.

    The merge keeps texts apart by their content, whatever their digests; only then do digest and a
    second, independent hash stand for a text, to lead its documents to their group.
    """
    groups = stored(winners(docs, id_col, text_col), "exact-groups")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("_content"),
    ).select(
        "_id", F.sha2("_content", 256).alias("_digest"), F.xxhash64("_content").alias("_other")
    )
    key = F.concat_ws(":", "_digest", F.hex("_other"))
    keyed = rows.select("_id", "_digest", key.alias("_key"))
    named = groups.select(
        F.concat_ws(":", "digest", F.hex("_other")).alias("_key"), "keep_id", "group_size"
    )
    return attach(keyed, named, "_key", "group_size").select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.coalesce(F.col("_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_each: bool = False
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Without `one_each`, rows with the id of a kept row stay, whatever their texts. With it, one row
    of each text stays: rows are told apart by id and text, and of equal ones any one stays.
    """
    if not one_each:
        kept = exact_dedup(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias("_keep"))
        return docs.join(kept, docs[id_col].eqNullSafe(kept["_keep"]), "left_semi")
    content = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))

    def key(id_: Column, digest: Column, other: Column) -> Column:
        return F.concat_ws(":", digest, F.hex(other), F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("null")))

    own = key(F.col(id_col), F.sha2(content, 256), F.xxhash64(content)).alias("_key")
    # One column to group and to join by, so that texts are shuffled once for both.
    first = docs.select(F.struct(*docs.columns).alias("_row"), own).dropDuplicates(["_key"])
    kept = winners(docs, id_col, text_col).select(key(F.col("keep_id"), F.col("digest"), F.col("_other")).alias("_key"))
    return first.join(stored(kept, "exact-kept"), "_key", "left_semi").select("_row.*")
