"""Ranks that the checks' inputs need."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucketed_rank(
    frame: DataFrame, group: str, order: str, name: str, width: int = 100_000
) -> DataFrame:
    """Distinct rows of `frame` with the zero-based rank of the integer `order` inside `group`;
    `order` is unique in its group once rows are distinct.

    Rows are ranked inside buckets of `width` order values, so no task sees more than `width`
    rows of a group; the bucket sizes then give the offsets. Rows go to their buckets once: there
    they are made distinct, and both ranks and sizes are read. Rows without a group or order get
    no rank; all three tests are named, so that both readers share one exchange.
    """
    whole = frame.withColumn("_bucket", F.floor(F.col(order) / width)).filter(
        F.col(group).isNotNull() & F.col(order).isNotNull() & F.col("_bucket").isNotNull()
    )
    bucketed = whole.repartition(group, "_bucket").distinct()
    bucket = Window.partitionBy(group, "_bucket")
    ranked = bucketed.withColumns(
        {
            "_rank": F.row_number().over(bucket.orderBy(order)) - 1,
            "_size": F.count(F.lit(1)).over(bucket),
        }
    )
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.filter("_rank = 0").select(
        group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ranked.join(offsets, [group, "_bucket"])
        .withColumn(name, (F.col("_rank") + F.col("_offset")).cast("int"))
        .drop("_bucket", "_rank", "_size", "_offset")
    )
