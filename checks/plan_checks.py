"""Checks of the comparison: scope, plan, patches, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import DATABASE, OPTIONS, PREFIX, SCHEMA, SERVICE, Inputs, sql
from checks.registry import check
from checks.sql import PLAN_COLUMNS, multiline, over_plan, plan_views, with_views
from lexiframe.constants import (
    APPEND_WITH_MARKER,
    OVERWRITE,
    OVERWRITE_PHRASE,
)
from lexiframe.functions.richtext import description_matches
from lexiframe.operators import patch, reconcile, scope
from lexiframe.operators.reconcile import Plan, PlanOptions
from lexiframe.plans import catalog_store
from lexiframe.plans.loader import plan_from_options
from lexiframe.plans.storage import new_path, stored
from lexiframe.operators.source_model import relational_columns, relational_tables


def source_tables(inputs: Inputs) -> DataFrame:
    return relational_tables(
        inputs.dict_tables, inputs.dict_indexes, inputs.dict_index_fields, PREFIX, "rel"
    )


def source_columns(inputs: Inputs, wanted: DataFrame | None = None) -> DataFrame:
    return relational_columns(inputs.dict_fields, inputs.dict_tables, PREFIX, "rel", wanted)


def product(inputs: Inputs) -> DataFrame:
    """The one product of these inputs, next to the region names as other products."""
    return sql(
        inputs.spark,
        """
SELECT CASE WHEN r_regionkey = 0 THEN 'dp-id' ELSE concat('p', r_regionkey) END AS id,
  CASE WHEN r_regionkey = 1 THEN 'other' ELSE concat(' ', r_name) END AS name,
  concat(' Dom.', r_name) AS fullyQualifiedName, r_name AS displayName FROM {region}""",
        region=inputs.table("region"),
    )


def product_scope(inputs: Inputs) -> DataFrame:
    members = scope.product_members(inputs.cat_tables, product(inputs).filter("id = 'dp-id'"))
    return scope.scope_schema(members.select("table_fqn"), SERVICE, DATABASE, SCHEMA)


def build_plan(inputs: Inputs, options: PlanOptions = OPTIONS) -> Plan:
    return reconcile.reconcile_plan(
        source_tables(inputs),
        source_columns(inputs),
        product_scope(inputs),
        inputs.cat_tables,
        inputs.cat_columns,
        options,
    )


def stored_writes(inputs: Inputs) -> DataFrame:
    """Rows to be written, stored as an apply job stores its plan: they are read several times."""
    return stored(build_plan(inputs).writes, "plan")


def changed_tables(inputs: Inputs) -> DataFrame:
    """Names of the tables the plan writes to, stored as an apply job stores its plan."""
    names = reconcile.changed_tables(
        source_tables(inputs),
        lambda wanted: source_columns(inputs, wanted),
        product_scope(inputs),
        inputs.cat_tables,
        inputs.cat_columns,
        OPTIONS,
    )
    return stored(names, "changed")


def options_with(**changes: object) -> PlanOptions:
    return PlanOptions(
        service=SERVICE, database=DATABASE, schema=SCHEMA, source_prefix=PREFIX, **changes
    )


OVERWRITING = options_with(
    description_mode=OVERWRITE,
    display_name_mode=OVERWRITE,
    allow_overwrite_description=True,
    allow_overwrite_display_name=True,
    confirm_overwrite=OVERWRITE_PHRASE,
)

# Scope -------------------------------------------------------------------------------------


@check(
    "scope_include",
    with_views("""SELECT s.table_code, s.column_name, s.label FROM src_columns s
      JOIN (SELECT DISTINCT 't' || n_nationkey AS code FROM nation) n ON n.code = s.table_code""",
      src_columns=plan_views()["src_columns"]),
)
def scope_include(inputs: Inputs) -> DataFrame:
    codes = sql(
        inputs.spark,
        "SELECT concat('CSD_T', n_nationkey) AS table_code FROM {nation}", nation=inputs.table("nation")
    )
    return scope.scope_include(source_columns(inputs), codes, PREFIX).select(
        "table_code", "column_name", "label"
    )


_ACTIVE = "SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 9"


def active_configs(inputs: Inputs) -> DataFrame:
    """One config text per supplier; every tenth has no list or no marker."""
    return sql(
        inputs.spark,
        """
SELECT concat('conf/', s_suppkey) AS path, CASE s_suppkey % 20 WHEN 9 THEN 'other: [a]'
  WHEN 19 THEN 'csd_active_source_tables: none' ELSE concat('x: [q]', chr(10),
  'csd_active_source_tables: [', chr(10), ' "T', s_suppkey, '",', chr(10), chr(39), 'csd_u', s_suppkey, chr(39),
  ', , v', s_suppkey, ']', chr(10), 'y: [z]') END AS text FROM {supplier}""",
        supplier=inputs.table("supplier"),
    )


@check(
    "active_tables",
    f"""SELECT 'conf/' || s_suppkey AS path, p || s_suppkey AS table_code, CAST(NULL AS VARCHAR) AS error
      FROM ({_ACTIVE}) s, (SELECT unnest(['t', 'u', 'v']) AS p) x
    UNION ALL SELECT 'conf/' || s_suppkey, NULL, CASE WHEN s_suppkey % 20 = 9 THEN 'marker not found'
      ELSE 'invalid list' END FROM supplier WHERE s_suppkey % 10 = 9""",
)
def active_tables(inputs: Inputs) -> DataFrame:
    from lexiframe.sources.documents import active_tables as read_active

    return read_active(active_configs(inputs))


@check(
    "scope_active",
    with_views(f"""SELECT table_code, label, 'wh.dw.core.' || warehouse_table_name AS table_fqn FROM src_tables
      WHERE table_code IN (SELECT 't' || s_suppkey FROM ({_ACTIVE}) a)""", src_tables=plan_views()["src_tables"]),
)
def scope_active(inputs: Inputs) -> DataFrame:
    return scope.scope_active(
        source_tables(inputs), active_tables(inputs), SERVICE, DATABASE, SCHEMA
    ).select("table_code", "label", "table_fqn")


def asset_lists(inputs: Inputs) -> DataFrame:
    """One product per supplier with four assets of different shape."""
    return sql(
        inputs.spark,
        """
SELECT concat('p', s_suppkey) AS product_id, array(
  concat('{"type":"table","fullyQualifiedName":"wh.dw.core.csd_t', s_suppkey, '"}'),
  concat('{"name":"n","entity":{"entityType":"Table","fqn":"wh.dw.core2.csd_t', s_suppkey, '"}}'),
  concat('{"name":"plain', s_suppkey, '"}'),
  concat('{"type":"dashboard","fullyQualifiedName":"dash', s_suppkey, '"}'),
  concat('{"type":"thing","href":"http://x/tables/1","fullyQualifiedName":"link', s_suppkey, '"}'),
  '{"type":"table"}') AS assets FROM {supplier}""",
        supplier=inputs.table("supplier"),
    )


_ASSETS = """SELECT 'p' || s_suppkey AS product_id, p || s_suppkey AS table_fqn FROM supplier,
  (SELECT unnest(['wh.dw.core.csd_t', 'wh.dw.core2.csd_t', 'plain', 'link']) AS p) x"""


@check("product_assets", _ASSETS)
def product_assets(inputs: Inputs) -> DataFrame:
    return scope.product_assets(asset_lists(inputs))


@check("scope_schema", f"SELECT * FROM ({_ASSETS}) a WHERE table_fqn LIKE 'wh.dw.core%'")
def scope_schema(inputs: Inputs) -> DataFrame:
    return scope.scope_schema(product_assets(inputs), SERVICE, DATABASE, SCHEMA)


@check(
    "product_members",
    with_views("""SELECT table_fqn, CASE data_product_id WHEN 'other' THEN 'p1' ELSE 'dp-id' END AS product_id
      FROM cat_tables"""),
)
def product_members(inputs: Inputs) -> DataFrame:
    return scope.product_members(inputs.cat_tables, product(inputs))


@check(
    "resolve_product",
    """SELECT x || c_custkey || y AS requested, CASE WHEN k = 0 THEN 'A' ELSE ' A' END || c_custkey AS product_fqn,
      rank FROM customer, (SELECT unnest(['A', ' A', 'Dom.A', ' A']) AS x, unnest(['', ' ', '', '']) AS y,
      unnest([0, 1, 0, 1]) AS k, CAST(unnest([0, 2, 3, 0]) AS INT) AS rank) z WHERE c_custkey % 2 = k""",
)
def resolve_product(inputs: Inputs) -> DataFrame:
    """Even customers are products named `A<key>`, odd ones ` A<key>`, asked for in four ways."""
    products = sql(
        inputs.spark,
        "SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE ' A' END, c_custkey) AS fullyQualifiedName FROM {c}",
        c=inputs.table("customer"),
    )
    requests = sql(
        inputs.spark,
        """SELECT explode(CASE WHEN c_custkey % 2 = 0 THEN array(concat('A', c_custkey), concat('Dom.A', c_custkey))
          ELSE array(concat(' A', c_custkey, ' '), concat(' A', c_custkey), concat('none', c_custkey)) END) AS requested
          FROM {c}""",
        c=inputs.table("customer"),
    )
    return scope.resolve_product(requests, products)


def _scoped(inputs: Inputs, active: DataFrame, assets: DataFrame) -> DataFrame:
    members = scope.product_members(inputs.cat_tables, product(inputs).filter("id = 'dp-id'"))
    return scope.scope_tables(
        inputs.cat_tables, active, assets, members, SERVICE, DATABASE, SCHEMA
    )


@check(
    "scope_tables",
    with_views(f"""SELECT table_fqn FROM cat_tables WHERE data_product_id = 'dp-id'
      AND table_fqn IN (SELECT 'wh.dw.core.csd_t' || s_suppkey FROM ({_ACTIVE}) a)"""),
)
def scope_tables(inputs: Inputs) -> DataFrame:
    active = scope.scope_active(source_tables(inputs), active_tables(inputs), SERVICE, DATABASE, SCHEMA)
    return _scoped(inputs, active, product_assets(inputs))


@check("scope_tables_assets", f"SELECT DISTINCT table_fqn FROM ({_ASSETS}) a WHERE table_fqn LIKE 'wh.dw.core%'")
def scope_tables_assets(inputs: Inputs) -> DataFrame:
    nothing = inputs.cat_tables.select("table_fqn").filter("table_fqn = ''")
    return _scoped(inputs, nothing, product_assets(inputs))


@check("scope_tables_members", with_views("SELECT table_fqn FROM cat_tables WHERE data_product_id = 'dp-id'"))
def scope_tables_members(inputs: Inputs) -> DataFrame:
    """Every table has a twin in schema `core2` with the same product, which stays out."""
    nothing = inputs.cat_tables.select("table_fqn").filter("table_fqn = ''")
    twin = F.replace("table_fqn", F.lit(".core."), F.lit(".core2."))
    both = inputs.cat_tables.unionByName(inputs.cat_tables.withColumn("table_fqn", twin))
    members = scope.product_members(both, product(inputs).filter("id = 'dp-id'"))
    return scope.scope_tables(both, nothing, nothing, members, SERVICE, DATABASE, SCHEMA)


# Plan --------------------------------------------------------------------------------------


@check("plan_tables", over_plan("SELECT table_code, table_fqn, label, c_name AS catalog_name FROM matched"))
def plan_tables(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).matched.select("table_code", "table_fqn", "label", "catalog_name")


@check(
    "plan_columns",
    over_plan("""SELECT table_fqn, column_name, label, c_name AS catalog_name, c_display AS current_display_name,
      ordinal FROM columns_found"""),
)
def plan_columns(inputs: Inputs) -> DataFrame:
    return (
        build_plan(inputs)
        .columns.filter("catalog_name IS NOT NULL")
        .select("table_fqn", "column_name", "label", "catalog_name", "current_display_name", "ordinal")
    )


@check("unmatched_tables", over_plan("SELECT table_code FROM src_tables WHERE table_code NOT IN (SELECT table_code FROM matched)"))
def unmatched_tables(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).unmatched_tables


@check("unmatched_columns", over_plan("SELECT table_code || '.' || column_name AS column_ref FROM columns_seen WHERE c_name IS NULL"))
def unmatched_columns(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).unmatched_columns


@check(
    "tables_without_dictionary",
    over_plan("""SELECT table_fqn FROM cat_tables WHERE data_product_id = 'dp-id' AND NOT (table_fqn IN
      (SELECT 'wh.dw.core.csd_t' || 2 * n_nationkey FROM nation))"""),
)
def tables_without_dictionary(inputs: Inputs) -> DataFrame:
    """Only the tables whose number is twice a nation key are in the dictionary here."""
    few = scope.scope_include(
        source_tables(inputs),
        sql(inputs.spark, "SELECT concat('t', 2 * n_nationkey) AS table_code FROM {n}", n=inputs.table("nation")),
        PREFIX,
    )
    covered = product_scope(inputs)
    matched = reconcile.plan_tables(few, covered, inputs.cat_tables, OPTIONS)
    return reconcile.tables_without_dictionary(covered, matched)


@check(
    "tables_without_dictionary_whole",
    with_views("""SELECT table_fqn FROM cat_tables t WHERE data_product_id = 'dp-id' AND NOT EXISTS (
      SELECT 1 FROM dict_tables d WHERE 'wh.dw.core.csd_' || d.table_id = t.table_fqn AND substr(d.table_id, 2)::BIGINT % 5 <> 4)"""),
)
def tables_without_dictionary_whole(inputs: Inputs) -> DataFrame:
    """Against the whole dictionary, which lacks every fifth table."""
    known = source_tables(inputs).filter(F.substring("table_code", 2, 20).cast("bigint") % 5 != 4)
    covered = product_scope(inputs)
    matched = reconcile.plan_tables(known, covered, inputs.cat_tables, OPTIONS)
    return reconcile.tables_without_dictionary(covered, matched)


@check("display_action", over_plan("SELECT table_fqn, column_name, display_name_action, split_part(reason, '; ', 1) AS reason FROM plan"))
def display_action(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).rows.select(
        "table_fqn", "column_name", "display_name_action", F.split_part("reason", F.lit("; "), F.lit(1)).alias("reason")
    )


@check("description_action", over_plan("SELECT table_fqn, column_name, description_action, split_part(reason, '; ', 2) AS reason FROM plan"))
def description_action(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).rows.select(
        "table_fqn", "column_name", "description_action", F.split_part("reason", F.lit("; "), F.lit(2)).alias("reason")
    )


def _proposals(mode: str) -> str:
    return over_plan("SELECT table_fqn, column_name, proposed_description FROM plan", mode)


@check("proposed_description", _proposals(APPEND_WITH_MARKER))
def proposed_description(inputs: Inputs) -> DataFrame:
    return build_plan(inputs, options_with(description_mode=APPEND_WITH_MARKER)).rows.select(
        "table_fqn", "column_name", "proposed_description"
    )


@check("reconcile_plan", over_plan(f"SELECT {PLAN_COLUMNS} FROM plan"))
def reconcile_plan(inputs: Inputs) -> DataFrame:
    return build_plan(inputs).rows


@check("reconcile_plan_append", over_plan(f"SELECT {PLAN_COLUMNS} FROM plan", APPEND_WITH_MARKER))
def reconcile_plan_append(inputs: Inputs) -> DataFrame:
    return build_plan(inputs, options_with(description_mode=APPEND_WITH_MARKER)).rows


@check("reconcile_plan_overwrite", over_plan(f"SELECT {PLAN_COLUMNS} FROM plan", OVERWRITE, OVERWRITE))
def reconcile_plan_overwrite(inputs: Inputs) -> DataFrame:
    return build_plan(inputs, OVERWRITING).rows


_SUMMARY = """SELECT count(*) AS plan_rows,
  count(DISTINCT CASE WHEN display_name_action = 'write' OR description_action = 'write' THEN table_fqn END) AS tables_updated,
  CAST(sum((display_name_action = 'write')::INT + (description_action = 'write')::INT) AS BIGINT) AS metadata_writes,
  CAST(sum((display_name_action = 'skip_noop')::INT + (description_action = 'skip_noop')::INT) AS BIGINT) AS no_ops,
  CAST(sum((display_name_action = 'skip_conflict')::INT + (description_action = 'skip_conflict')::INT) AS BIGINT) AS conflicts_skipped,
  (SELECT count(*) FROM src_tables WHERE table_code NOT IN (SELECT table_code FROM matched)) AS unmatched_dictionary_tables,
  (SELECT count(*) FROM columns_seen WHERE c_name IS NULL) AS unmatched_dictionary_columns,
  (SELECT count(*) FROM cat_tables WHERE data_product_id = 'dp-id' AND table_fqn NOT IN (SELECT table_fqn FROM matched))
    AS tables_without_dictionary FROM plan"""


@check("plan_summary", over_plan(_SUMMARY))
def plan_summary(inputs: Inputs) -> DataFrame:
    return reconcile.plan_summary(build_plan(inputs))


@check(
    "write_preview",
    over_plan("""SELECT entity_type, table_fqn, coalesce(column_name, '') AS column_name, display_name_action,
      description_action FROM writes ORDER BY table_code, is_column, source_column LIMIT 20"""),
)
def write_preview(inputs: Inputs) -> DataFrame:
    return reconcile.write_preview(build_plan(inputs))


# Patches -----------------------------------------------------------------------------------


@check(
    "writes_by_table",
    over_plan("""SELECT table_fqn, count(*) FILTER (NOT is_column) AS table_rows, count(*) FILTER (is_column) AS column_rows,
      count(*) FILTER (display_name_action = 'write') AS display_name_writes,
      count(*) FILTER (description_action = 'write') AS description_writes FROM writes GROUP BY table_fqn"""),
)
def writes_by_table(inputs: Inputs) -> DataFrame:
    return patch.writes_by_table(build_plan(inputs).writes)


_PAYLOAD = """
SELECT table_fqn, 'displayName' AS member, CAST(NULL AS INT) AS ordinal, CAST(NULL AS VARCHAR) AS name,
  proposed_display_name AS display_name, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS data_type, CAST(NULL AS VARCHAR) AS tag
FROM writes WHERE NOT is_column AND display_name_action = 'write'
UNION ALL SELECT table_fqn, 'description', NULL, NULL, NULL, proposed_description, NULL, NULL
FROM writes WHERE NOT is_column AND description_action = 'write'
UNION ALL SELECT c.table_fqn, 'columns', c.ordinal, c.name,
  CASE WHEN w.display_name_action = 'write' THEN w.proposed_display_name ELSE c.display_name END,
  CASE WHEN w.description_action = 'write' THEN w.proposed_description ELSE c.description END, 'VARCHAR', 'PII.None'
FROM cat_columns c LEFT JOIN (SELECT * FROM writes WHERE is_column) w ON w.table_fqn = c.table_fqn AND w.column_name = c.name
WHERE c.table_fqn IN (SELECT table_fqn FROM writes WHERE is_column)"""


@check("patch_payload", over_plan(_PAYLOAD))
def patch_payload(inputs: Inputs) -> DataFrame:
    """Column objects are taken apart again, to see that foreign keys are still there."""
    rows = patch.patch_payload(stored_writes(inputs), inputs.cat_columns)
    value, member = F.col("value"), F.col("member")
    inside = lambda path: F.when(member == "columns", F.get_json_object(value, path))
    return rows.select(
        "table_fqn",
        "member",
        "ordinal",
        inside("$.name").alias("name"),
        F.when(member == "displayName", value).otherwise(inside("$.displayName")).alias("display_name"),
        F.when(member == "description", value).otherwise(inside("$.description")).alias("description"),
        inside("$.dataType").alias("data_type"),
        inside("$.tags[0].tagFQN").alias("tag"),
    )


def _ops(order: int, member: str, name: str) -> str:
    return f"""SELECT table_fqn, table_code, is_column, source_column, CAST({order} AS INT) AS field_order,
  CASE WHEN replaces_{'display' if order == 0 else 'description'} THEN 'replace' ELSE 'add' END AS op,
  CASE WHEN is_column THEN '/columns/' || ordinal ELSE '' END || '/{member}' AS path, proposed_{name} AS value
FROM writes WHERE {name}_action = 'write'"""


@check(
    "patch_ops",
    over_plan(_ops(0, "displayName", "display_name") + " UNION ALL " + _ops(1, "description", "description")),
)
def patch_ops(inputs: Inputs) -> DataFrame:
    return patch.patch_ops(build_plan(inputs).writes)


_WRITTEN = "(SELECT table_fqn FROM writes)"


@check("backup_tables", over_plan(f"SELECT table_fqn, name, display_name, description FROM cat_tables WHERE table_fqn IN {_WRITTEN}"))
def backup_tables(inputs: Inputs) -> DataFrame:
    tables, _ = patch.backup_tables(changed_tables(inputs), inputs.cat_tables, inputs.cat_columns)
    return tables.select("table_fqn", "name", "display_name", "description")


@check("backup_columns", over_plan(f"SELECT table_fqn, ordinal, name, display_name, description FROM cat_columns WHERE table_fqn IN {_WRITTEN}"))
def backup_columns(inputs: Inputs) -> DataFrame:
    _, columns = patch.backup_tables(changed_tables(inputs), inputs.cat_tables, inputs.cat_columns)
    return columns.select("table_fqn", "ordinal", "name", "display_name", "description")


_APPLIED = """
SELECT c.table_fqn, CAST(NULL AS INT) AS ordinal, c.name,
  CASE WHEN w.display_name_action = 'write' THEN w.proposed_display_name ELSE c.display_name END AS display_name,
  CASE WHEN w.description_action = 'write' THEN w.proposed_description ELSE c.description END AS description
FROM cat_tables c LEFT JOIN (SELECT * FROM writes WHERE NOT is_column) w ON w.table_fqn = c.table_fqn
UNION ALL SELECT c.table_fqn, c.ordinal, c.name,
  CASE WHEN w.display_name_action = 'write' THEN w.proposed_display_name ELSE c.display_name END,
  CASE WHEN w.description_action = 'write' THEN w.proposed_description ELSE c.description END
FROM cat_columns c LEFT JOIN (SELECT * FROM writes WHERE is_column) w ON w.table_fqn = c.table_fqn AND w.column_name = c.name"""


def _snapshot(tables: DataFrame, columns: DataFrame) -> DataFrame:
    names = ["table_fqn", "ordinal", "name", "display_name", "description"]
    whole = tables.withColumn("ordinal", F.lit(None).cast("int"))
    return whole.select(names).unionByName(columns.select(names))


@check("apply_patches", over_plan(_APPLIED))
def apply_patches(inputs: Inputs) -> DataFrame:
    writes = stored_writes(inputs)
    return _snapshot(*patch.apply_patches(writes, inputs.cat_tables, inputs.cat_columns))


def _broken(columns: DataFrame) -> DataFrame:
    number = F.regexp_extract("table_fqn", "([0-9]+)$", 1).cast("bigint")
    rich = F.concat(F.lit("<p>"), F.replace("description", F.lit("\n"), F.lit("<br/>")), F.lit(" &nbsp;</p>"))
    at = F.col("ordinal")
    late = number >= 20  # some tables come before the first failure
    return columns.filter(~(late & (number % 13 == 0) & (at == 1))).withColumns(
        {
            "display_name": F.when(late & (number % 11 == 0) & (at == 2), "wrong").otherwise(F.col("display_name")),
            "description": F.when((number % 7 == 0) & (at == 3), "wrong").otherwise(rich),
        }
    )


def _checked(inputs: Inputs, writes: DataFrame | None = None) -> DataFrame:
    """Verification against a state in which some values went wrong after the patch.

    Columns at place 2 of every eleventh table lose their display name, and at place 3 of every
    seventh their description; column 1 of every thirteenth table is gone. Other descriptions
    come back as rich text. `writes` are those of a plan that is stored already.
    """
    writes = writes or stored_writes(inputs)
    tables, columns = patch.apply_patches(writes, inputs.cat_tables, inputs.cat_columns)
    broken = _broken(columns)
    return stored(patch.verify_patches(writes, tables, broken), "checks")


_NUMBER = "CAST(regexp_extract(table_fqn, '([0-9]+)$', 1) AS BIGINT)"
_CHECKED = f"""
SELECT table_code, is_column, source_column, entity_type, table_fqn, column_name,
  gone OR display_name_action <> 'write' OR NOT wrong_name AS display_name_ok,
  gone OR description_action <> 'write' OR NOT wrong_text AS description_ok,
  CASE WHEN gone THEN table_fqn || '.' || column_name || ' was not found after patch'
    WHEN wrong_name AND display_name_action = 'write' THEN entity_type || ' displayName did not verify for ' || table_fqn
    WHEN wrong_text AND description_action = 'write' THEN entity_type || ' description did not verify for ' || table_fqn END AS error
FROM (SELECT *, is_column AND {_NUMBER} >= 20 AND {_NUMBER} % 13 = 0 AND ordinal = 1 AS gone,
  is_column AND {_NUMBER} >= 20 AND {_NUMBER} % 11 = 0 AND ordinal = 2 AS wrong_name,
  is_column AND {_NUMBER} % 7 = 0 AND ordinal = 3 AS wrong_text FROM writes) w"""


@check(
    "verify_patches",
    over_plan(f"SELECT table_fqn, column_name, entity_type, error FROM ({_CHECKED}) c"),
)
def verify_patches(inputs: Inputs) -> DataFrame:
    return _checked(inputs).select("table_fqn", "column_name", "entity_type", "error")


_RESULTS = f"""SELECT table_code, table_fqn, arg_min(error, coalesce(source_column, '')) FILTER (error IS NOT NULL) AS error
  FROM ({_CHECKED}) c GROUP BY table_code, table_fqn"""


@check(
    "apply_results",
    over_plan("""SELECT table_fqn, error IS NULL AS success, error IS NULL AS patched, error FROM results WHERE table_code <=
      coalesce((SELECT min(table_code) FROM results WHERE error IS NOT NULL), table_code)""", results=_RESULTS),
)
def apply_results(inputs: Inputs) -> DataFrame:
    return patch.apply_results(_checked(inputs))


_ATTEMPTED = """(SELECT * FROM writes WHERE table_fqn IN (SELECT table_fqn FROM results WHERE table_code <=
  coalesce((SELECT min(table_code) FROM results WHERE error IS NOT NULL), table_code)))"""


@check(
    "apply_state_stopped",
    over_plan(_APPLIED.replace("FROM writes", f"FROM {_ATTEMPTED} a"), results=_RESULTS),
)
def apply_state_stopped(inputs: Inputs) -> DataFrame:
    """The new state ends with the first table that fails; tables behind it stay as they were."""
    planned = stored_writes(inputs)
    results = patch.apply_results(_checked(inputs, planned))
    writes = patch.attempted_writes(planned, results)
    return _snapshot(*patch.apply_patches(writes, inputs.cat_tables, inputs.cat_columns))


def _catalog(inputs: Inputs) -> catalog_store.CatalogStore:
    path = new_path(inputs.spark, "catalog")
    return catalog_store.create(inputs.spark, path, inputs.cat_tables, inputs.cat_columns, 20_000)


@check("apply_versions", over_plan(_APPLIED))
def apply_versions(inputs: Inputs) -> DataFrame:
    """The patched catalogue as the next version of a store; tables and columns come in two applies."""
    store, writes = _catalog(inputs), stored_writes(inputs)
    for part in (writes.filter("is_column"), writes.filter("NOT is_column")):
        store = catalog_store.apply_to_store(store, part).store
    again = catalog_store.open_store(inputs.spark, store.path, store.version)
    return _snapshot(again.tables, again.columns)


@check("verify_versions", over_plan(f"SELECT table_fqn, column_name, entity_type, error FROM ({_CHECKED}) c"))
def verify_versions(inputs: Inputs) -> DataFrame:
    """Verification that reads the rewritten buckets only, some values of which went wrong."""
    store, writes = _catalog(inputs), stored_writes(inputs)
    patched = catalog_store.patch_buckets(store, writes)
    seen = patched.tables, _broken(patched.columns)
    found = catalog_store.apply_to_store(store, writes, True, seen, patched)
    return found.checks.select("table_fqn", "column_name", "entity_type", "error")


@check(
    "stopped_versions",
    over_plan(_APPLIED.replace("FROM writes", f"FROM {_ATTEMPTED} a"), results=_RESULTS),
)
def stopped_versions(inputs: Inputs) -> DataFrame:
    """A version whose manifest ends at the first table that fails."""
    store, writes = _catalog(inputs), stored_writes(inputs)
    patched = catalog_store.patch_buckets(store, writes)
    seen = patched.tables, _broken(patched.columns)
    stopped = catalog_store.apply_to_store(store, writes, False, seen, patched).store
    again = catalog_store.open_store(inputs.spark, stopped.path, stopped.version)
    return _snapshot(again.tables, again.columns)


@check(
    "plan_from_options",
    over_plan(f"""SELECT table_fqn, column_name, display_name_action, description_action, reason FROM plan
      WHERE table_fqn IN (SELECT 'wh.dw.core.csd_t' || s_suppkey FROM ({_ACTIVE}) a)"""),
)
def plan_job(inputs: Inputs) -> DataFrame:
    """Active lists narrow the sources, the product is asked for without its leading space."""
    products = product(inputs)
    requests = products.filter("id = 'dp-id'").select(F.trim("fullyQualifiedName").alias("requested"))
    nothing = inputs.spark.createDataFrame([], "product_id string, assets array<string>")
    plan = plan_from_options(
        source_tables(inputs), source_columns(inputs), inputs.cat_tables, inputs.cat_columns,
        products, nothing, requests, OPTIONS, active_configs(inputs),
    )
    return plan.rows.select(
        "table_fqn", "column_name", "display_name_action", "description_action", "reason"
    )


@check(
    "apply_results_continue",
    over_plan("SELECT table_fqn, error IS NULL AS success, error IS NULL AS patched, error FROM results", results=_RESULTS),
)
def apply_results_continue(inputs: Inputs) -> DataFrame:
    return patch.apply_results(_checked(inputs), continue_on_error=True)


@check(
    "description_matches",
    with_views(f"""SELECT table_id, field_name, coalesce({multiline('description')}, '') NOT LIKE 'Description: S%' AS equal
      FROM dict_fields"""),
)
def matches(inputs: Inputs) -> DataFrame:
    """Descriptions against a rich-text form; those that start with `Description: S` are changed."""
    text = F.col("description")
    rich = F.concat(
        F.lit("<p>"),
        F.replace(F.replace(text, F.lit("\n"), F.lit("</p> <p>")), F.lit("#"), F.lit("&#35;")),
        F.when(text.startswith("Description: S"), F.lit(" more")).otherwise(F.lit("")),
        F.lit("</p>"),
    )
    return inputs.dict_fields.select(
        "table_id", "field_name", description_matches(rich, text).alias("equal")
    )
