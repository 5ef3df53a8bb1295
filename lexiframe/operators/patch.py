"""From plan rows to patches, the patched snapshot, and its verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.constants import WRITE
from lexiframe.functions.richtext import description_matches
from lexiframe.operators.reconcile import PLAN_ORDER, column_lookup
from lexiframe.operators.skew import made_once, short_join, spread_join

#: Columns that a patch may change; `raw` only where the snapshot has it.
CHANGED = ["display_name", "description", "has_display_name", "has_description", "raw"]
#: Values to set, beside the row that they are for.
NEW = ["new_display_name", "new_description"]


def writes_by_table(writes: DataFrame) -> DataFrame:
    """Size of each table's patch."""
    return writes.groupBy("table_fqn").agg(
        F.count_if(~F.col("is_column")).alias("table_rows"),
        F.count_if("is_column").alias("column_rows"),
        F.count_if(F.col("display_name_action") == WRITE).alias("display_name_writes"),
        F.count_if(F.col("description_action") == WRITE).alias("description_writes"),
    )


def _new_values(writes: DataFrame) -> DataFrame:
    """One row per written entity with the value to set, or null where nothing is set."""
    return writes.withColumns(
        {
            "new_display_name": F.when(
                F.col("display_name_action") == WRITE, F.col("proposed_display_name")
            ),
            "new_description": F.when(
                F.col("description_action") == WRITE, F.col("proposed_description")
            ),
        }
    )


def _last_set(name: str, order: Column) -> Column:
    """Last value that is set; max_by passes over rows whose order is null."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), order))


def _table_writes(writes: DataFrame) -> DataFrame:
    """Of two source tables with one full name the later code wins, value by value."""
    order = F.col("table_code")
    return (
        _new_values(writes.filter(~F.col("is_column")))
        .groupBy("table_fqn")
        .agg(*[_last_set(name, order).alias(name) for name in NEW])
    )


def _column_writes(writes: DataFrame) -> DataFrame:
    order = F.struct("table_code", "source_column")
    return (
        _new_values(writes.filter("is_column"))
        .groupBy("table_fqn", F.lower("column_name").alias("folded"))
        .agg(
            *[_last_set(name, order).alias(name) for name in NEW],
            F.min("ordinal").alias("ordinal"),
        )
    )


def _merged_json(raw: Column, display_name: Column, description: Column) -> Column:
    """Column object with the new values set and every other key as it was."""
    kept = F.map_filter(
        F.from_json(raw, "map<string, variant>"),
        lambda key, _: ~(
            ((key == "displayName") & display_name.isNotNull())
            | ((key == "description") & description.isNotNull())
        ),
    )
    added = F.filter(
        F.array(
            F.struct(F.lit("displayName").alias("key"), display_name.alias("value")),
            F.struct(F.lit("description").alias("key"), description.alias("value")),
        ),
        lambda entry: entry["value"].isNotNull(),
    )
    fresh = F.map_from_entries(
        F.transform(
            added,
            lambda entry: F.struct(
                entry["key"].alias("key"), entry["value"].cast("variant").alias("value")
            ),
        )
    )
    return F.to_json(F.map_concat(kept, fresh))


def patch_payload(writes: DataFrame, cat_columns: DataFrame) -> DataFrame:
    """Merged payload as rows: changed table fields, then every column of a changed table.

    A column's value is its whole object, so keys this job knows nothing about stay. `cat_columns`
    needs `raw`. The list of a table stays as rows with `ordinal`; it is never gathered.
    """
    new = _table_writes(writes)
    fields = new.select(
        "table_fqn",
        F.explode(
            F.array(
                F.struct(F.lit("displayName").alias("member"), F.col("new_display_name").alias("value")),
                F.struct(F.lit("description").alias("member"), F.col("new_description").alias("value")),
            )
        ).alias("entry"),
    ).select(
        "table_fqn", "entry.member", F.lit(None).cast("int").alias("ordinal"), "entry.value"
    ).filter("value IS NOT NULL")
    changed = writes.filter("is_column").select("table_fqn").distinct()
    current = short_join(cat_columns, changed, ["table_fqn"], "left_semi", ["ordinal"]).withColumn(
        "folded", F.lower("name")
    )
    merged = current.join(
        _column_writes(writes).drop("ordinal"), ["table_fqn", "folded"], "left"
    ).select(
        "table_fqn",
        F.lit("columns").alias("member"),
        "ordinal",
        F.when(
            F.col("new_display_name").isNull() & F.col("new_description").isNull(), F.col("raw")
        )
        .otherwise(_merged_json(F.col("raw"), F.col("new_display_name"), F.col("new_description")))
        .alias("value"),
    )
    return fields.unionByName(merged)


def patch_ops(writes: DataFrame) -> DataFrame:
    """Patch operations straight from the plan rows: no further join.

    The order inside a table is `(is_column, source_column, field_order)`.
    """
    place = F.when(F.col("is_column"), F.concat(F.lit("/columns/"), "ordinal")).otherwise("")

    def operation(order: int, member: str, replaces: str, value: str, action: str) -> Column:
        return F.struct(
            F.lit(order).alias("field_order"),
            F.when(F.col(replaces), "replace").otherwise("add").alias("op"),
            F.concat(place, F.lit(f"/{member}")).alias("path"),
            F.col(value).alias("value"),
            (F.col(action) == WRITE).alias("wanted"),
        )

    both = F.array(
        operation(
            0, "displayName", "replaces_display_name", "proposed_display_name", "display_name_action"
        ),
        operation(
            1, "description", "replaces_description", "proposed_description", "description_action"
        ),
    )
    return writes.select(
        "table_fqn",
        "table_code",
        "is_column",
        "source_column",
        F.explode(F.filter(both, lambda entry: entry["wanted"])).alias("entry"),
    ).select(
        "table_fqn",
        "table_code",
        "is_column",
        "source_column",
        "entry.field_order",
        "entry.op",
        "entry.path",
        "entry.value",
    )


def backup_tables(
    writes: DataFrame, cat_tables: DataFrame, cat_columns: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows of every table that is about to change: tables and columns."""
    names = writes.select("table_fqn").distinct()
    return (
        cat_tables.join(names, "table_fqn", "left_semi"),
        spread_join(cat_columns, names, ["table_fqn"], "left_semi", ["ordinal"]),
    )


def _patched(frame: DataFrame, joined: DataFrame, of_columns: bool) -> DataFrame:
    """Rows of `frame` with the values set that `joined` has beside them."""
    changed = {
        "display_name": F.coalesce("new_display_name", "display_name"),
        "description": F.coalesce("new_description", "description"),
        "has_display_name": F.col("has_display_name") | F.col("new_display_name").isNotNull(),
        "has_description": F.col("has_description") | F.col("new_description").isNotNull(),
    }
    if of_columns and "raw" in frame.columns:
        changed["raw"] = F.when(
            F.col("new_display_name").isNull() & F.col("new_description").isNull(), F.col("raw")
        ).otherwise(_merged_json(F.col("raw"), F.col("new_display_name"), F.col("new_description")))
    if "_turn" not in joined.columns:
        return joined.withColumns(changed).select(frame.columns)
    kept = [name for name in CHANGED if name in frame.columns]
    after = joined.withColumn("_old", F.struct(*kept)).withColumns(changed)
    differs = ~F.equal_null(F.struct(*kept), F.col("_old"))
    marks = {name: F.when(differs, F.col(name)) for name in ("_turn", "_old")}
    return after.withColumns(marks).select(*frame.columns, *marks)


def apply_patches(
    writes: DataFrame, cat_tables: DataFrame, cat_columns: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New catalogue state. A column patch lands on the first column of its name."""
    new = _column_writes(writes).drop("folded")
    of_columns = cat_columns.join(new, ["table_fqn", "ordinal"], "left")
    of_tables = cat_tables.join(_table_writes(writes), "table_fqn", "left")
    return _patched(cat_tables, of_tables, False), _patched(cat_columns, of_columns, True)


def patch_turned_tables(writes: DataFrame, cat_tables: DataFrame, turns: DataFrame) -> DataFrame:
    """Patched tables. With each row that differs from before go, in `_turn`, the turn of its table
    in `turns(table_fqn, _turn)` and, in `_old`, the values before; other rows have nulls there."""
    new = _table_writes(writes).join(turns, "table_fqn", "left")
    return _patched(cat_tables, cat_tables.join(new, "table_fqn", "left"), False)


def patch_turned_columns(
    writes: DataFrame, cat_columns: DataFrame, turns: DataFrame, buckets: int, bucket: Column
) -> DataFrame:
    """Patched columns with `_turn` and `_old`, spread by their `_bucket` over `buckets` tasks.

    A bucket holds all columns of a name, so writes go to the `bucket` of their column's name, and
    rows meet them there. The rows travel once and arrive where they are to be written.
    """
    order = F.struct("table_code", "source_column")
    new = _new_values(short_join(writes.filter("is_column"), turns, ["table_fqn"], "left")).select(
        "table_fqn",
        F.col("column_name").alias("name"),
        bucket.alias("_bucket"),
        "new_display_name",
        "new_description",
        "_turn",
        F.col("ordinal").alias("_place"),
        order.alias("_order"),
    )
    beside = cat_columns.unionByName(new, allowMissingColumns=True).repartition(buckets, "_bucket")
    group = Window.partitionBy("_bucket", "table_fqn", F.lower("name"))
    values = {
        **{name: _last_set(name, F.col("_order")).over(group) for name in NEW},
        "_place": F.min("_place").over(group),
        "_turn": F.min("_turn").over(group),
    }
    met = beside.withColumn("_is_row", F.col("_order").isNull()).withColumns(values).filter("_is_row")
    here = F.col("ordinal") == F.col("_place")
    landed = met.withColumns({name: F.when(here, F.col(name)) for name in values})
    return _patched(cat_columns, landed, True)


def verify_patches(writes: DataFrame, new_tables: DataFrame, new_columns: DataFrame) -> DataFrame:
    """Each written entity against the new state; `error` is null where it holds.

    Of columns with one name the last one is looked at.
    """
    tables = new_tables.select(
        "table_fqn",
        F.col("display_name").alias("seen_display_name"),
        F.col("description").alias("seen_description"),
        F.lit(True).alias("seen"),
    )
    # Only columns of written names are looked at, and only those are put in order.
    written = writes.filter("is_column").select("table_fqn", F.lower("column_name").alias("_folded"))
    same = (new_columns["table_fqn"] == written["table_fqn"]) & (
        F.lower(new_columns["name"]) == written["_folded"]
    )
    columns = column_lookup(new_columns.join(written.distinct(), same, "left_semi")).select(
        "table_fqn",
        "folded",
        F.col("current_display_name").alias("seen_display_name"),
        F.col("current_description").alias("seen_description"),
        F.lit(True).alias("seen"),
    )
    kept = [
        *PLAN_ORDER, "entity_type", "table_fqn", "column_name", "display_name_action",
        "description_action", "proposed_display_name", "proposed_description",
    ]
    of_tables = writes.filter(~F.col("is_column")).select(kept).join(tables, "table_fqn", "left")
    of_columns = (
        writes.filter("is_column")
        .select(*kept, F.lower("column_name").alias("folded"))
        .join(columns, ["table_fqn", "folded"], "left")
        .drop("folded")
    )
    both = of_tables.unionByName(of_columns)
    display_ok = (F.col("display_name_action") != WRITE) | F.equal_null(
        F.col("seen_display_name"), F.col("proposed_display_name")
    )
    description_ok = (F.col("description_action") != WRITE) | description_matches(
        F.col("seen_description"), F.col("proposed_description")
    )
    # The error names both results again; a text is compared once.
    judged = {"display_name_ok": display_ok, "description_ok": description_ok}
    both = made_once(both.withColumns(judged), list(judged))
    error = (
        F.when(
            F.col("seen").isNull(),
            F.concat_ws(".", "table_fqn", F.concat("column_name", F.lit(" was not found after patch"))),
        )
        .when(
            ~F.col("display_name_ok"),
            F.concat("entity_type", F.lit(" displayName did not verify for "), "table_fqn"),
        )
        .when(
            ~F.col("description_ok"),
            F.concat("entity_type", F.lit(" description did not verify for "), "table_fqn"),
        )
    )
    return both.select(
        *PLAN_ORDER,
        "entity_type",
        "table_fqn",
        "column_name",
        "display_name_ok",
        "description_ok",
        error.alias("error"),
    )


def apply_results(checks: DataFrame, continue_on_error: bool = False) -> DataFrame:
    """One result per table in plan order; the first failure is the last result.

    The stop is one minimum over the failed tables, not a running window.
    """
    order = F.struct(F.col("is_column"), F.coalesce("source_column", F.lit("")))
    results = checks.groupBy("table_fqn").agg(
        F.min("table_code").alias("table_code"),
        F.min_by("error", F.when(F.col("error").isNotNull(), order)).alias("error"),
    )
    if not continue_on_error:
        stop = results.filter(F.col("error").isNotNull()).agg(F.min("table_code")).scalar()
        results = results.filter(stop.isNull() | (F.col("table_code") <= stop))
    failed = F.col("error").isNotNull()
    return results.select(
        "table_fqn", (~failed).alias("success"), (~failed).alias("patched"), "error"
    )


def attempted_writes(writes: DataFrame, results: DataFrame) -> DataFrame:
    """Writes of the tables that have a result: all up to the first failure, or all."""
    return short_join(writes, results.select("table_fqn").distinct(), ["table_fqn"], "left_semi")
