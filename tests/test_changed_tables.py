"""Tables that change, found without the whole plan."""

from __future__ import annotations

import pytest

from lexiframe.constants import OVERWRITE, OVERWRITE_PHRASE
from lexiframe.operators import reconcile, source_model
from lexiframe.operators.reconcile import PlanOptions


def options(**changes):
    return PlanOptions(service="wh", source_prefix="csd_", **changes)


FORCED = {"confirm_overwrite": OVERWRITE_PHRASE, "allow_overwrite_description": True}


@pytest.mark.parametrize("asked", [options(), options(description_mode=OVERWRITE, **FORCED), options(limit=3)])
def test_changed_tables_are_those_of_the_plan(spark, asked):
    codes = ["own", "columns", "none", "nothing", "gone"]
    tables = spark.createDataFrame(
        [(c, f"T {c}" if c == "own" else "") for c in codes], "table_id string, table_title string"
    )
    fields = spark.createDataFrame(
        [(i, c, "c1", "Label", "about") for i, c in enumerate(codes) if c != "nothing"],
        "id long, table_id string, field_name string, label string, description string",
    )
    fqns = [f"wh.dw.core.csd_{c}" for c in codes[:4]]
    cat_tables = spark.createDataFrame(
        [(f, f.split(".")[-1], "", "", False, False) for f in fqns],
        "table_fqn string, name string, display_name string, description string, "
        "has_display_name boolean, has_description boolean",
    )
    cat_columns = spark.createDataFrame(
        [(f, 0, "C1", "" if "columns" in f else "Chosen", "kept", True, True) for f in fqns],
        "table_fqn string, ordinal int, name string, display_name string, description string, "
        "has_display_name boolean, has_description boolean",
    )
    scope = cat_tables.select("table_fqn")
    src_tables = source_model.relational_tables(tables, prefix="csd_")
    seen = []

    def columns_of(wanted):
        seen.extend(row.table_code for row in wanted.collect())
        made = source_model.relational_columns(fields, tables, "csd_", wanted=wanted)
        assert {row.table_code for row in made.collect()} <= set(seen)
        return made

    found = reconcile.changed_tables(src_tables, columns_of, scope, cat_tables, cat_columns, asked)
    plan = reconcile.reconcile_plan(
        src_tables, source_model.relational_columns(fields, tables, "csd_"), scope, cat_tables, cat_columns, asked
    )
    want = sorted(row[0] for row in plan.writes.select("table_fqn").distinct().collect())
    assert sorted(row[0] for row in found.collect()) == want
    assert "own" not in seen and "wh.dw.core.csd_columns" in want
    assert ("wh.dw.core.csd_none" in want) == (asked.description_mode == OVERWRITE)
