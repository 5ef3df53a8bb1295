"""Plan and apply: compare, store, back up, patch, verify."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.constants import DEFAULT_PREFIX
from lexiframe.operators import patch, source_model
from lexiframe.operators.reconcile import Plan, PlanOptions, reconcile_plan, will_write
from lexiframe.operators.scope import (
    product_assets,
    product_members,
    resolve_product,
    scope_active,
    scope_include,
    scope_tables,
)
from lexiframe.plans.storage import read_relational, stored
from lexiframe.sources import csv_blocks, json_blocks
from lexiframe.sources.documents import active_tables


@dataclass(frozen=True)
class Applied:
    """Stored plan rows and what came of them; columns stay rows next to their table."""

    writes: DataFrame
    operations: DataFrame
    backup_tables: DataFrame
    backup_columns: DataFrame
    tables: DataFrame
    columns: DataFrame
    checks: DataFrame
    results: DataFrame


def read_source(
    spark: SparkSession, path: str, kind: str | None = None, prefix: str = DEFAULT_PREFIX
) -> tuple[DataFrame, DataFrame]:
    """`(src_tables, src_columns)` of dictionary files of any kind.

    `kind` is `json` (annotations), `csv` or `relational` (a folder of the relational model); without
    it the ending of `path` tells, and a path without one is a relational model. A folder of JSON
    or CSV files needs its kind.
    """
    kind = kind or os.path.splitext(path.rstrip("/"))[1].lower().removeprefix(".") or "relational"
    if kind == "json":
        members = json_blocks.read_members(spark, path)
        return (
            source_model.annotation_tables(json_blocks.table_rows(members), prefix),
            source_model.annotation_columns(json_blocks.field_rows(members), prefix),
        )
    if kind == "csv":
        records = csv_blocks.read_csv(spark, path)
        return source_model.csv_tables(records, prefix), source_model.csv_columns(records, prefix)
    if kind == "relational":
        names = ["tables", "fields", "table_indexes", "table_index_fields"]
        model = read_relational(spark, path, names)
        tables = source_model.relational_tables(
            model["tables"], model["table_indexes"], model["table_index_fields"], prefix, path
        )
        return tables, source_model.relational_columns(model["fields"], model["tables"], prefix, path)
    raise ValueError(f"no dictionary of kind {kind!r}: {path}")


def stored_plan(
    src_tables: DataFrame,
    src_columns: DataFrame,
    scope: DataFrame,
    cat_tables: DataFrame,
    cat_columns: DataFrame,
    options: PlanOptions,
    path: str | None = None,
) -> Plan:
    """A plan whose rows are a stored table, so that summary, preview and patches share one run."""
    plan = reconcile_plan(src_tables, src_columns, scope, cat_tables, cat_columns, options)
    return Plan(
        matched=plan.matched,
        columns=plan.columns,
        everything=stored(plan.everything, "plan", path),
        unmatched_tables=plan.unmatched_tables,
        tables_without_dictionary=plan.tables_without_dictionary,
    )


def plan_from_options(
    src_tables: DataFrame,
    src_columns: DataFrame,
    cat_tables: DataFrame,
    cat_columns: DataFrame,
    products: DataFrame,
    assets: DataFrame,
    requests: DataFrame,
    options: PlanOptions,
    configs: DataFrame | None = None,
    require_membership: bool = True,
    path: str | None = None,
) -> Plan:
    """From sources, catalogue and options to a stored plan.

    Included tables come first, then those of the active lists in `configs(path, text)`, then the
    scope of the requested product: the active tables, else its assets, else its members.
    `assets(product_id, assets)` and `requests(requested)` are as for the scope operators.
    """
    where = options.service, options.database, options.schema
    tables = src_tables
    if options.include_tables:
        spark = src_tables.sparkSession
        asked = spark.createDataFrame([(c,) for c in options.include_tables], "table_code string")
        tables = scope_include(tables, asked, options.source_prefix)
    active = cat_tables.select("table_fqn").limit(0)
    if configs is not None:
        active = scope_active(tables, active_tables(configs), *where)
        tables = active.drop("table_fqn")
    found = resolve_product(requests, products).select(F.col("product_fqn").alias("fullyQualifiedName"))
    chosen = products.join(found, "fullyQualifiedName", "left_semi")
    owned = product_assets(assets).join(
        chosen.select(F.col("id").alias("product_id")), "product_id", "left_semi"
    )
    names = scope_tables(
        cat_tables, active, owned, product_members(cat_tables, chosen), *where, require_membership
    )
    return stored_plan(tables, src_columns, names, cat_tables, cat_columns, options, path)


def apply_plan(
    plan: Plan,
    cat_tables: DataFrame,
    cat_columns: DataFrame,
    continue_on_error: bool = False,
    new_state: tuple[DataFrame, DataFrame] | None = None,
    path: str | None = None,
) -> Applied:
    """Apply the writes of a stored plan to the snapshot and verify them.

    `new_state` is the catalogue as read after the operations were sent to it; without it, the
    patched snapshot itself is verified. Everything returned ends at the first failure, unless
    told to continue: state, operations, checks and results name the same tables. The backup of all
    tables that may change is stored before anything else.
    """
    planned = plan.detail.filter(will_write())
    backup = [
        stored(frame, f"backup-{name}", path and f"{path}/backup_{name}")
        for name, frame in zip(
            ("tables", "columns"), patch.backup_tables(planned, cat_tables, cat_columns)
        )
    ]
    after = new_state or patch.apply_patches(planned, cat_tables, cat_columns)
    checks = stored(patch.verify_patches(planned, *after), "checks")
    results = stored(
        patch.apply_results(checks, continue_on_error), "results", path and f"{path}/results"
    )
    writes = patch.attempted_writes(planned, results)
    tables, columns = patch.apply_patches(writes, cat_tables, cat_columns)
    return Applied(
        writes=writes,
        operations=patch.patch_ops(writes),
        backup_tables=backup[0],
        backup_columns=backup[1],
        tables=tables,
        columns=columns,
        checks=patch.attempted_writes(checks, results),
        results=results,
    )
