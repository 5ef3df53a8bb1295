"""An apply to a store sends catalogue rows once, and stored steps leave no shuffle files."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from lexiframe.operators import patch
from lexiframe.plans.storage import CLEANUP_SETTING, stored

CAT_COLUMNS = (
    "table_fqn string, ordinal int, name string, display_name string, description string, "
    "has_display_name boolean, has_description boolean"
)
WRITES = (
    "table_fqn string, column_name string, display_name_action string, description_action string, "
    "proposed_display_name string, proposed_description string, table_code string, is_column boolean, source_column string, ordinal int"
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


def test_catalogue_rows_travel_once_to_the_bucket_they_are_written_to(spark, no_broadcasts):
    bucket = F.pmod(F.xxhash64("table_fqn", F.lower("name")), F.lit(4)).cast("int")
    cat = spark.createDataFrame(
        [("s.t", i, name, "old", "text", True, True) for i, name in enumerate(["C0", "c1", "C1", "c3"])]
        + [("s.t", 3, "c3", "old", "text", True, True), ("s.u", 0, None, None, None, False, False)],
        CAT_COLUMNS,
    )
    tables = spark.createDataFrame([], "table_fqn string, display_name string, description string, has_display_name boolean, has_description boolean")
    # Two source tables with one full name: the later code wins, value by value.
    writes = spark.createDataFrame(
        [("s.t", "c1", "write", "write", "early", "early text", "a", True, "c1", 1),
         ("s.t", "C1", "write", "keep", "late", None, "b", True, "c1", 1),
         ("s.t", "c3", "write", "keep", "three", None, "b", True, "c3", 3),
         ("s.t", "c0", "write", "keep", "old", None, "b", True, "c0", 0)],
        WRITES,
    )
    turns = writes.groupBy("table_fqn").agg(F.min("table_code").alias("_turn"))
    where = F.pmod(F.xxhash64("table_fqn", F.lower("column_name")), F.lit(4)).cast("int")
    found = patch.patch_turned_columns(writes, cat.withColumn("_bucket", bucket), turns, 4, where)
    plan = plan_of(found)
    assert len(re.findall(r"Exchange hashpartitioning\(_bucket", plan)) == 1 and "ordinal#" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line
    )
    assert rows(found.select(cat.columns)) == rows(patch.apply_patches(writes, tables, cat)[1])
    # The second c3 has the same keys and is patched as well; c0 has its value already.
    assert [(r.name, r._turn, r._old.display_name) for r in found.filter("_old IS NOT NULL").orderBy("ordinal").collect()] == [
        ("c1", "a", "old"), ("c3", "a", "old"), ("c3", "a", "old"),
    ]
    assert found.filter("_old IS NULL AND _turn IS NOT NULL").count() == 0


def test_a_stored_step_leaves_no_shuffle_files(spark):
    def shuffle_files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}

    before, setting = shuffle_files(), spark.conf.get(CLEANUP_SETTING, None)
    step = stored(spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count(), "step")
    until = time.time() + 20
    while shuffle_files() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files() - before
    assert step.count() == 50 and spark.conf.get(CLEANUP_SETTING, None) == setting
