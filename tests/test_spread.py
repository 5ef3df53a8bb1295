"""Costly work is shared out among tasks, whatever the size of its input files, and done once."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import plan_checks
from checks.inputs import Inputs
from lexiframe.operators import patch, reconcile

PARTS = "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int"


def test_pages_of_one_small_file_are_read_by_many_tasks(spark, tmp_path):
    rows = [(key, f"name {key}", "TYPE", "Brand", 1) for key in range(400)]
    spark.createDataFrame(rows, PARTS).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pages = Inputs(spark, str(tmp_path)).field_pages
    sizes = pages.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 200 and sum(sizes) == 400


def test_a_filter_on_actions_does_not_repeat_the_texts(spark, tmp_path):
    """The plan's filter reads decided values; it holds none of the expressions that made the texts."""
    names = "table_code string, table_fqn string, warehouse_table_name string, catalog_name string, label string, " + (
        "description string, source_ref string, current_display_name string, current_description string, "
        "has_display_name boolean, has_description boolean"
    )
    rows = [("a", "s.a", "csd_a", "csd_a", " A  b", "text\tb", "r", None, "", False, False)]
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/matched")
    matched = spark.read.parquet(f"{tmp_path}/matched")
    options = reconcile.PlanOptions(service="s")
    columns = (
        matched.withColumns({"column_name": F.lit("c"), "ordinal": F.lit(1), "column_has_description": F.lit(True)})
        .withColumnRenamed("has_display_name", "table_has_display_name")
        .withColumn("column_has_display_name", F.lit(True))
    )
    detail = reconcile.plan_detail(matched, columns, options)
    written = detail.filter(reconcile.will_write())
    plan = written._jdf.queryExecution().optimizedPlan().toString().split("\n")
    filters = [line for line in plan if "Filter " in line]
    assert not any("regexp_replace" in line for line in filters)
    found = {row.entity_type: row for row in written.collect()}
    assert found["table"].proposed_description == "text b"
    assert found["column"].reason == "displayName is blank/default; description is blank"


def test_an_apply_that_stops_makes_its_plan_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(plan_checks, "stored", lambda frame, name: made.append(name) or frame)
    plan_checks.apply_state_stopped(Inputs(spark, "/root/testdata/sf0.001"))
    assert made == ["plan", "checks"]


def test_verification_compares_a_text_once(spark, tmp_path):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    names = "table_code string, is_column boolean, source_column string, entity_type string, table_fqn string, " + (
        "column_name string, ordinal int, display_name_action string, description_action string, "
        "proposed_display_name string, proposed_description string"
    )
    rows = [("t1", False, None, "table", "wh.dw.core.csd_t1", None, None, "write", "write", "a", "b")]
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/writes")
    writes = spark.read.parquet(f"{tmp_path}/writes")
    checks = patch.verify_patches(writes, inputs.cat_tables, inputs.cat_columns)
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    # Of tables and of columns, the text seen and the text proposed.
    assert plan.count("(?iu)<br") == 4
    assert checks.select("error").first()[0].startswith("table displayName did not verify")
