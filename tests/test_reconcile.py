"""Plans, patches and verification on small hand-made catalogues."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lexiframe.constants import MARKER_END, MARKER_START, OVERWRITE_PHRASE
from lexiframe.operators import patch, reconcile, scope
from lexiframe.operators.reconcile import PlanOptions
from lexiframe.plans.loader import apply_plan, stored_plan
from lexiframe.sources.documents import catalog_columns, catalog_tables

OPTIONS = PlanOptions(service="Wh")
FQN = "Wh.dw.core.csd_parcel"
TABLE = "table_code string, warehouse_table_name string, label string, description string, source_ref string"
COLUMN = (
    "table_code string, column_name string, label string, description string, help string, "
    "content string, source_ref string"
)


def parcel(**changes):
    table = {
        "id": "id-7",
        "name": "csd_parcel",
        "fullyQualifiedName": FQN,
        "displayName": "csd_parcel",
        "columns": [{"name": "weightkg", "displayName": "", "description": "", "dataType": "DECIMAL", "tags": [{"tagFQN": "Tier.Gold"}]}],
    }
    table.update(changes)
    return {key: value for key, value in table.items() if value is not ...}


def catalogue(spark, *tables):
    texts = spark.createDataFrame([(json.dumps(table),) for table in tables], "text string")
    return catalog_tables(texts), catalog_columns(texts)


def sources(spark, columns=(("weightkg", "Weight kg", "gross weight"),), label="Parcel Data", description=None):
    tables = [("parcel", "csd_parcel", label, description, "s:2"), ("zone", "csd_zone", "Other", None, "s:3")]
    rows = [("parcel", name, text, about, None, None, f"s:{name}") for name, text, about in columns]
    return spark.createDataFrame(tables, TABLE), spark.createDataFrame(rows, COLUMN)


def plan_of(spark, source, *tables, options=OPTIONS, stored=False):
    cat_tables, cat_columns = catalogue(spark, *tables)
    names = cat_tables.select("table_fqn")
    make = stored_plan if stored else reconcile.reconcile_plan
    return make(*source, names, cat_tables, cat_columns, options), cat_tables, cat_columns


def by_entity(plan):
    return {row.column_name or "": row for row in plan.rows.collect()}


def test_curated_names_are_conflicts_and_blanks_are_filled(spark):
    plan, *_ = plan_of(spark, sources(spark), parcel(displayName="Chosen", description="curated"))
    rows = by_entity(plan)
    assert rows[""].display_name_action == "skip_conflict"
    assert rows[""].description_action == "skip_no_source"
    assert rows[""].reason == "current displayName is curated; no source description"
    assert rows["weightkg"].display_name_action == "write"
    assert rows["weightkg"].reason == "displayName is blank/default; description is blank"
    assert rows["weightkg"].table_name == "csd_parcel" and rows["weightkg"].source_ref == "s:weightkg"
    assert [row.table_code for row in plan.unmatched_tables.collect()] == ["zone"]
    summary = reconcile.plan_summary(plan).first().asDict()
    assert summary == {
        "plan_rows": 2, "tables_updated": 1, "metadata_writes": 2, "no_ops": 0, "conflicts_skipped": 1,
        "unmatched_dictionary_tables": 1, "unmatched_dictionary_columns": 0, "tables_without_dictionary": 0,
    }


def test_an_empty_catalogue_gives_zeros(spark):
    plan, *_ = plan_of(spark, sources(spark), parcel(fullyQualifiedName="x.y"))
    summary = reconcile.plan_summary(plan).first()
    assert summary.plan_rows == 0 and summary.metadata_writes == 0
    assert summary.unmatched_dictionary_tables == 2 and summary.tables_without_dictionary == 1


def test_written_text_loses_blank_lines_only(spark):
    text = "Legacy Data Dictionary Entries:\n\nDescription:\ngross  weight\n\nContent:\n0 = light\n1 = heavy"
    plan, *_ = plan_of(spark, sources(spark, [("weightkg", "A", text)]), parcel())
    assert by_entity(plan)["weightkg"].proposed_description == (
        "Legacy Data Dictionary Entries:\nDescription:\ngross weight\nContent:\n0 = light\n1 = heavy"
    )


def test_missing_and_doubled_columns(spark):
    columns = [{"name": "A", "displayName": "first"}, {"name": "x"}, {"name": "a", "description": "last"}]
    source = sources(spark, [("a", "Label", "text"), ("gone", "L", "t")])
    plan, cat_tables, cat_columns = plan_of(spark, source, parcel(columns=columns))
    row = by_entity(plan)["a"]
    assert row.current_display_name is None and row.description_action == "skip_conflict"
    assert [r.column_ref for r in plan.unmatched_columns.collect()] == ["parcel.gone"]
    operations = patch.patch_ops(plan.writes).filter("is_column").collect()
    assert [(op.op, op.path, op.value) for op in operations] == [("replace", "/columns/0/displayName", "Label")]
    checks = patch.verify_patches(plan.writes, *patch.apply_patches(plan.writes, cat_tables, cat_columns))
    errors = {c.column_name: c.error for c in checks.collect()}
    assert errors == {None: None, "a": f"column displayName did not verify for {FQN}"}


def test_column_display_name_needs_the_field_on_both_objects_to_replace(spark):
    plan, *_ = plan_of(spark, sources(spark), parcel(displayName=...))
    operations = patch.patch_ops(plan.writes).orderBy("is_column", "field_order").collect()
    assert [(op.op, op.path) for op in operations] == [
        ("add", "/displayName"), ("add", "/columns/0/displayName"), ("replace", "/columns/0/description"),
    ]


def test_append_mode_treats_tables_and_columns_differently(spark):
    options = PlanOptions(service="Wh", description_mode="append-with-marker")
    marked = f"old\n{MARKER_START}\nx\n{MARKER_END}"
    source = sources(
        spark, [("a", "A", "new"), ("b", "B", "same"), ("c", "C", "new"), ("d", "D", None)], description="new"
    )
    columns = [{"name": n, "description": t} for n, t in [("a", marked), ("b", "same"), ("c", "old"), ("d", "old")]]
    plan, *_ = plan_of(spark, source, parcel(columns=columns, description=marked), options=options)
    rows = by_entity(plan)
    assert rows[""].reason.endswith("legacy marker already present")
    assert rows["a"].reason.endswith("description already matches")
    assert rows["b"].description_action == "write"
    assert rows["c"].proposed_description == f"old\n\n{MARKER_START}\nnew\n{MARKER_END}"
    assert rows["d"].proposed_description is None and rows["d"].description_action == "skip_no_source"
    same, *_ = plan_of(spark, sources(spark, description="same"), parcel(description=" same"), options=options)
    assert by_entity(same)[""].description_action == "skip_noop"


def test_overwriting_needs_flag_and_phrase():
    with pytest.raises(ValueError):
        PlanOptions(service="w", display_name_mode="overwrite")
    with pytest.raises(ValueError):
        PlanOptions(service="w", allow_overwrite_description=True)
    with pytest.raises(ValueError):
        PlanOptions(service="w", display_name_mode="overwrite", allow_overwrite_display_name=True)
    with pytest.raises(ValueError):
        PlanOptions(service="w", description_mode="append")
    PlanOptions(
        service="w", display_name_mode="overwrite", allow_overwrite_display_name=True, confirm_overwrite=OVERWRITE_PHRASE
    )


def test_include_comes_before_limit_and_zero_means_all(spark):
    tables, _ = sources(spark)
    codes = lambda **k: [r.table_code for r in reconcile.planned_tables(tables, PlanOptions(service="w", **k)).collect()]
    assert codes(limit=1) == ["parcel"]
    assert codes(limit=1, include_tables=("CSD_zone",)) == ["zone"]
    assert sorted(codes(limit=0)) == ["parcel", "zone"]


def test_payload_keeps_foreign_keys(spark):
    plan, _, cat_columns = plan_of(spark, sources(spark), parcel())
    rows = patch.patch_payload(plan.writes, cat_columns).collect()
    assert [(r.member, r.value) for r in rows if r.member == "displayName"] == [("displayName", "Parcel Data")]
    (column,) = [json.loads(r.value) for r in rows if r.member == "columns"]
    assert column == {
        "name": "weightkg", "displayName": "Weight kg", "description": "gross weight",
        "dataType": "DECIMAL", "tags": [{"tagFQN": "Tier.Gold"}],
    }


def test_apply_and_verify(spark):
    plan, cat_tables, cat_columns = plan_of(spark, sources(spark), parcel(), stored=True)
    done = apply_plan(plan, cat_tables, cat_columns)
    assert [(r.table_fqn, r.success, r.patched, r.error) for r in done.results.collect()] == [(FQN, True, True, None)]
    assert done.tables.first().display_name == "Parcel Data"
    assert done.columns.first().description == "gross weight"
    assert json.loads(done.columns.first().raw)["dataType"] == "DECIMAL"
    assert done.backup_tables.first().raw == json.dumps(parcel())
    again, *_ = plan_of(spark, sources(spark), parcel(displayName="Parcel Data", columns=[json.loads(done.columns.first().raw)]))
    assert again.writes.count() == 0


def test_results_stop_at_the_first_failure(spark):
    checks = spark.createDataFrame(
        [("b", False, None, "t.b", None), ("c", True, "y", "t.c", "second"), ("c", True, "x", "t.c", "first"), ("d", False, None, "t.d", None)],
        "table_code string, is_column boolean, source_column string, table_fqn string, error string",
    )
    stop = {r.table_fqn: r.error for r in patch.apply_results(checks).collect()}
    assert stop == {"t.b": None, "t.c": "first"}
    go_on = {r.table_fqn: r.error for r in patch.apply_results(checks, True).collect()}
    assert go_on == {"t.b": None, "t.c": "first", "t.d": None}
    fine = patch.apply_results(checks.filter("error IS NULL"))
    assert fine.count() == 2


def test_everything_ends_at_the_first_failure(spark):
    tables = spark.createDataFrame([(c, f"csd_{c}", c.upper() * 2, None, "s") for c in "abc"], TABLE)
    entries = [parcel(name=f"csd_{c}", fullyQualifiedName=f"Wh.dw.core.csd_{c}", displayName="", columns=[]) for c in "abc"]
    source = tables, sources(spark, [])[1]
    plan, cat_tables, cat_columns = plan_of(spark, source, *entries, stored=True)
    seen = cat_tables.withColumn("display_name", F.when(F.col("table_fqn").endswith("_a"), "AA").otherwise("no"))
    done = apply_plan(plan, cat_tables, cat_columns, new_state=(seen, cat_columns))
    names = lambda frame: sorted({r.table_fqn[-1] for r in frame.collect()})
    assert {r.table_fqn[-1]: r.success for r in done.results.collect()} == {"a": True, "b": False}
    assert names(done.writes) == names(done.operations) == names(done.checks) == ["a", "b"]
    assert {r.table_fqn[-1]: r.display_name for r in done.tables.collect()} == {"a": "AA", "b": "BB", "c": ""}
    assert names(done.backup_tables) == ["a", "b", "c"]
    go_on = apply_plan(plan, cat_tables, cat_columns, True, new_state=(seen, cat_columns))
    assert names(go_on.operations) == ["a", "b", "c"] and go_on.results.count() == 3


def test_members_of_another_schema_stay_out(spark):
    names = spark.createDataFrame([("w.d.core.x",), ("w.d.core2.x",)], "table_fqn string")
    none = names.limit(0)
    got = scope.scope_tables(names, none, none, names, "w", "d", "core").collect()
    assert [r.table_fqn for r in got] == ["w.d.core.x"]


def test_a_lost_column_is_a_failure(spark):
    plan, cat_tables, cat_columns = plan_of(spark, sources(spark), parcel())
    checks = patch.verify_patches(plan.writes, cat_tables, cat_columns.limit(0)).filter("is_column").first()
    assert checks.error == f"{FQN}.weightkg was not found after patch"


def test_schema_test_has_no_closing_dot(spark):
    frame = spark.createDataFrame([("w.d.core.x",), ("w.d.core2.x",), ("w.d.cor.x",)], "table_fqn string")
    kept = scope.scope_schema(frame, "w", " d", "core").collect()
    assert sorted(r.table_fqn for r in kept) == ["w.d.core.x", "w.d.core2.x"]


def test_product_spellings(spark):
    products = spark.createDataFrame([(" Hub Main/Gold",), ("A.B",), ("B",)], "fullyQualifiedName string")
    requests = spark.createDataFrame([("Shop - Hub.Hub Main/Gold",), ("A.B",), ("none",)], "requested string")
    got = {r.requested: r.product_fqn for r in scope.resolve_product(requests, products).collect()}
    assert got == {"Shop - Hub.Hub Main/Gold": " Hub Main/Gold", "A.B": "A.B"}


def test_product_membership(spark):
    tables, _ = catalogue(
        spark,
        parcel(fullyQualifiedName="by-id", dataProducts=[{"id": "prod-9", "fullyQualifiedName": "other"}]),
        parcel(fullyQualifiedName="by-name", dataProducts=[{"id": ""}, {"fullyQualifiedName": " Core"}]),
        parcel(fullyQualifiedName="no", dataProducts=[{"fullyQualifiedName": "Core"}, {"name": ""}]),
        parcel(fullyQualifiedName="none"),
    )
    product = spark.createDataFrame(
        [("prod-9", " Core", " Core", "")], "id string, name string, fullyQualifiedName string, displayName string"
    )
    got = scope.product_members(tables, product).select("table_fqn").orderBy(F.col("table_fqn")).collect()
    assert [r.table_fqn for r in got] == ["by-id", "by-name"]
