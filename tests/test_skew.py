"""Skew-proof joins and ranks give what plain ones give, with one key holding a third of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.ranks import bucketed_rank
from lexiframe.operators.skew import hot_key_join, spread_join


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.col("id").alias("v"),
    )


@pytest.fixture(scope="module")
def dims(spark):
    return spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("d")).union(
        spark.createDataFrame([("hot", -1), ("unused", -2)], "k string, d bigint")
    )


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(map(str, left.select(columns).collect())) == sorted(map(str, right.select(columns).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast_limit", ["10m", "-1"])
def test_joins(spark, facts, dims, how, broadcast_limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        plain = facts.join(dims, "k", how)
        same(spread_join(facts, dims, ["k"], how, ["v"]), plain)
        same(hot_key_join(facts, dims, ["k"], how, ["v"], floor=100), plain)
        same(hot_key_join(facts, dims, ["k"], how), plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_hot_key_is_shared_by_many_tasks(facts):
    salted = facts.filter("k = 'hot'").select(F.xxhash64("v").bitwiseAND(F.lit(7)).alias("salt"))
    sizes = [row["count"] for row in salted.groupBy("salt").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_salts_must_be_a_power_of_two(facts, dims):
    with pytest.raises(ValueError):
        spread_join(facts, dims, ["k"], salts=6)


def test_rank_in_buckets(facts):
    window = Window.partitionBy("k").orderBy("v")
    plain = facts.withColumn("r", (F.row_number().over(window) - 1).cast("int"))
    same(bucketed_rank(facts, "k", "v", "r", width=70), plain)
