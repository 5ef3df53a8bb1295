"""Line deduplication across documents; DataFrame functions only.

Lines become 16-byte hashes that are range-partitioned together with a slice of the documents, and
sorted by document and position inside. The first row of each run is the first occurrence in its
slice, all others are decided at once; only first rows go on to the second pass, where a hash has at
most one row per slice. No text moves in either pass: what returns is one run-length bitmap of kept
lines for each document that loses any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.shared import lower_ascii, set_aside, shuffle_partitions, stored

BLANKS = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_rows(docs: DataFrame, min_chars: int, parts: int) -> DataFrame:
    """(_doc, _row, _slice, _pos, _h1, _h2) of every line whose key is long enough."""
    exploded = docs.select(
        F.col("_doc"),
        F.xxhash64("_text").alias("_row"),
        F.pmod(F.xxhash64("_doc"), F.lit(parts)).alias("_slice"),
        F.posexplode(_lines(F.col("_text"))).alias("_pos", "_line"),
    )
    keyed = exploded.filter(F.col("_doc").isNotNull()).select(
        "_doc", "_row", "_slice", "_pos", lower_ascii(F.btrim("_line", F.lit(BLANKS))).alias("_key")
    )
    # Two hashes with different seeds; together they stand for the line.
    return keyed.filter(F.char_length("_key") >= min_chars).select(
        "_doc",
        "_row",
        "_slice",
        "_pos",
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit("line"), "_key").alias("_h2"),
    )


def dropped_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_doc, _row, _pos) of each line that an earlier document holds already."""
    parts = shuffle_partitions(docs.sparkSession)
    lines = _line_rows(docs, min_chars, parts)
    ranged = lines.repartitionByRange(parts, "_h1", "_h2", "_slice")
    in_slice = Window.partitionBy("_h1", "_h2", "_slice").orderBy("_doc", "_pos", "_row")
    before = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = stored(
        ranged.withColumn("_first", F.first("_doc").over(before)).select(
            "_h1",
            "_h2",
            "_doc",
            "_row",
            "_pos",
            (F.col("_doc") == F.col("_first")).alias("_leads"),
        ),
        "line-pass",
    )
    # A leading document may have several of these lines; they share one decision.
    leaders = (
        passed.filter("_leads")
        .groupBy("_h1", "_h2", "_doc", "_row")
        .agg(F.collect_set("_pos").alias("_all"))
    )
    across = Window.partitionBy("_h1", "_h2").orderBy("_doc", "_row")
    late = (
        leaders.withColumn("_first", F.first("_doc").over(across))
        .filter(F.col("_doc") != F.col("_first"))
        .select("_doc", "_row", F.explode("_all").alias("_pos"))
    )
    return passed.filter("NOT _leads").select("_doc", "_row", "_pos").unionByName(late)


def _runs(positions: Column, n_lines: Column) -> Column:
    """Lengths of kept, dropped, kept, ... runs from the sorted dropped positions."""
    starts = F.filter(positions, lambda x, i: (i == 0) | (F.get(positions, i - 1) != x - 1))
    ends = F.filter(
        positions, lambda x, i: (i == F.size(positions) - 1) | (F.get(positions, i + 1) != x + 1)
    )
    pairs = F.flatten(
        F.transform(
            F.arrays_zip(starts.alias("s"), ends.alias("e")),
            lambda run, i: F.array(
                run["s"] - F.coalesce(F.get(ends, i - 1), F.lit(-1)) - 1, run["e"] - run["s"] + 1
            ),
        )
    )
    return F.concat(pairs, F.array(n_lines - 1 - F.element_at(positions, -1)))


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """(id, row hash, n_dropped, positions) of each document that loses lines."""
    renamed = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    return (
        dropped_lines(renamed, min_chars)
        .groupBy("_doc", "_row")
        .agg(F.array_sort(F.collect_set("_pos")).alias("_dropped"))
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10
) -> DataFrame:
    """All columns of `docs` with `n_lines`, `n_dropped`, `keep_bitmap` and `kept_text`.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least
    `min_chars` characters lose their lines in all documents but the one with the smallest id.
    keep_bitmap holds run lengths: lines kept, lines dropped, kept, and so on; null keeps all.
    Null and empty texts have one empty line. Rows with a null id neither lose lines nor make others
    lose any. Rows that share an id are one document: none of them loses a line to the other. The
    four result columns replace columns of the same names; an empty table gives none.
    """
    bitmaps = line_bitmaps(docs, id_col, text_col, min_chars)
    docs = docs.drop("n_lines", "n_dropped", "keep_bitmap", "kept_text")
    docs, moved = set_aside(docs, ["_id", "_hash", "_doc", "_row", "_dropped", "_lines", "_flags"])
    rows = docs.withColumns({"_id": F.col(id_col), "_hash": F.xxhash64(F.col(text_col))})
    joined = rows.join(
        bitmaps, (F.col("_id") == F.col("_doc")) & (F.col("_hash") == F.col("_row")), "left"
    )
    lines = _lines(F.col(text_col))
    runs = F.when(F.col("_dropped").isNotNull(), _runs(F.col("_dropped"), F.size(lines)))
    flags = F.flatten(
        F.transform(F.col("keep_bitmap"), lambda n, i: F.array_repeat(i % 2 == 0, n))
    )
    kept = F.filter(F.col("_lines"), lambda line, i: F.get(F.col("_flags"), i))
    return (
        joined.withColumns({"_lines": lines, "keep_bitmap": runs})
        .withColumn("_flags", flags)
        .select(
            *[F.col(f"`{c}`") for c in docs.columns],
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
            "keep_bitmap",
            F.when(F.col("keep_bitmap").isNull(), F.coalesce(F.col(text_col), F.lit("")))
            .otherwise(F.array_join(kept, "\n"))
            .alias("kept_text"),
        )
        .withColumnsRenamed(moved)
    )
