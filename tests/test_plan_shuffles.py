"""Source texts are shuffled once on their way into a plan, and catalogue rows once before they are ranked."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.ranks import bucketed_rank
from lexiframe.operators import reconcile, source_model
from lexiframe.operators.skew import short_join

MATCHED = "table_code string, table_fqn string, warehouse_table_name string, has_display_name boolean"
CAT_COLUMNS = (
    "table_fqn string, ordinal int, name string, display_name string, description string, "
    "has_display_name boolean, has_description boolean"
)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def sources(spark):
    tables = spark.createDataFrame([("A", "x"), ("b", "y")], "table_id string, table_title string")
    fields = spark.createDataFrame(
        [(1, "A", "C1", "One", "first"), (2, "a", "c1", "Later", "second"), (3, "b", "A", "", ""), (4, "z", "c", "", "")],
        "id long, table_id string, field_name string, label string, description string",
    )
    return source_model.relational_columns(fields, tables)


def test_texts_of_a_source_column_are_shuffled_once(spark, no_broadcasts):
    matched = spark.createDataFrame([("a", "s.a", "a", True), ("b", "s.b", "b", True)], MATCHED)
    known = spark.createDataFrame([("s.a", 0, "C1", "old", "text", True, True)], CAT_COLUMNS)
    found = reconcile.plan_columns(matched, sources(spark), known)
    assert len(re.findall(r"Exchange hashpartitioning\(table_code#\d+, \w+#", plan_of(found))) == 1
    shown = found.select("table_code", "column_name", "label", "current_display_name", "ordinal")
    assert sorted(map(tuple, shown.collect())) == [("a", "c1", "Later", "old", 0), ("b", "a", None, None, None)]


def test_a_code_may_stand_for_two_full_names(spark):
    matched = spark.createDataFrame([("a", "s.a", "a", True), ("a", "s.other", "a", True)], MATCHED)
    known = spark.createDataFrame(
        [("s.a", 4, "C1", "one", "", True, True), ("s.other", 5, "c1", "two", "", True, True)], CAT_COLUMNS
    )
    found = reconcile.plan_columns(matched, sources(spark), known)
    assert rows(found.select("table_fqn", "current_display_name", "ordinal")) == [
        "Row(table_fqn='s.a', current_display_name='one', ordinal=4)",
        "Row(table_fqn='s.other', current_display_name='two', ordinal=5)",
    ]


@pytest.mark.parametrize("most", [0, 1 << 20])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_short_join_gives_what_a_join_gives(spark, no_broadcasts, how, most):
    fact = spark.range(40).select(F.concat(F.lit("k"), F.col("id") % 7).alias("k"), "id")
    dim = spark.createDataFrame([("k1", 1), ("k2", None), (None, 3)], "k string, d int")
    found = short_join(fact, dim, ["k"], how, ["id"], most=most)
    assert rows(found.select(sorted(found.columns))) == rows(fact.join(dim, "k", how).select(sorted(found.columns)))
    assert ("BroadcastHashJoin" in plan_of(found)) == bool(most)


def test_repeated_rows_have_one_rank(spark):
    twice = spark.createDataFrame([("a", 5), ("a", 5), ("a", 70), ("b", 1), (None, 2), ("a", None)], "k string, v long")
    assert rows(bucketed_rank(twice, "k", "v", "r", width=50)) == rows(
        spark.createDataFrame([("a", 5, 0), ("a", 70, 1), ("b", 1, 0)], "k string, v long, r int")
    )
