"""Comparison of the dictionary with a catalogue snapshot under fill, append and overwrite rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.constants import (
    APPEND_WITH_MARKER,
    DEFAULT_PREFIX,
    FILL_DEFAULT,
    FILL_EMPTY,
    MARKER_END,
    MARKER_START,
    OVERWRITE,
    OVERWRITE_PHRASE,
    SKIP_CONFLICT,
    SKIP_NO_SOURCE,
    SKIP_NOOP,
    WRITE,
)
from lexiframe.functions.names import (
    build_table_fqn,
    is_default_column_name,
    is_default_table_name,
    normalize_table_code,
)
from lexiframe.functions.text import clean_multiline_text, clean_text
from lexiframe.operators.skew import made_once, short_join
from lexiframe.schemas import IN_LOWER_CASE, PLAN_COLUMNS

PLAN_ORDER = ["table_code", "is_column", "source_column"]


@dataclass(frozen=True)
class PlanOptions:
    service: str
    database: str = "dw"
    schema: str = "core"
    source_prefix: str = DEFAULT_PREFIX
    description_mode: str = FILL_EMPTY
    display_name_mode: str = FILL_DEFAULT
    allow_overwrite_description: bool = False
    allow_overwrite_display_name: bool = False
    confirm_overwrite: str | None = None
    include_tables: tuple[str, ...] = ()
    limit: int = 0

    def __post_init__(self) -> None:
        if self.description_mode not in (FILL_EMPTY, APPEND_WITH_MARKER, OVERWRITE):
            raise ValueError(f"unknown description mode: {self.description_mode}")
        if self.display_name_mode not in (FILL_DEFAULT, OVERWRITE):
            raise ValueError(f"unknown display-name mode: {self.display_name_mode}")
        asks_name = self.display_name_mode == OVERWRITE
        asks_text = self.description_mode == OVERWRITE
        if asks_name and not self.allow_overwrite_display_name:
            raise ValueError("overwriting display names needs allow_overwrite_display_name")
        if asks_text and not self.allow_overwrite_description:
            raise ValueError("overwriting descriptions needs allow_overwrite_description")
        allowed = self.allow_overwrite_display_name or self.allow_overwrite_description
        if (asks_name or asks_text or allowed) and self.confirm_overwrite != OVERWRITE_PHRASE:
            raise ValueError(f'overwriting needs confirm_overwrite="{OVERWRITE_PHRASE}"')


def display_action(
    current: Column, proposed: Column, is_default: Column, mode: str = FILL_DEFAULT, allowed: bool = False
) -> Column:
    """Struct of action and reason; the first rule that fits decides."""
    return _display_rule(clean_text(current), clean_text(proposed), is_default, mode, allowed)


def _display_rule(now: Column, new: Column, is_default: Column, mode: str, allowed: bool) -> Column:
    if mode == OVERWRITE and allowed:
        last = _decision(WRITE, "overwrite displayName")
    elif mode == OVERWRITE:
        last = _decision(SKIP_CONFLICT, "displayName overwrite not allowed")
    else:
        last = F.when(is_default, _decision(WRITE, "displayName is blank/default")).otherwise(
            _decision(SKIP_CONFLICT, "current displayName is curated")
        )
    return (
        F.when(new.isNull(), _decision(SKIP_NO_SOURCE, "no source displayName"))
        .when(now == new, _decision(SKIP_NOOP, "displayName already matches"))
        .otherwise(last)
    )


def description_action(
    current: Column, proposed: Column, mode: str = FILL_EMPTY, allowed: bool = False
) -> Column:
    """Struct of action and reason; the first rule that fits decides."""
    return _description_rule(clean_text(current), clean_text(proposed), mode, allowed)


def _description_rule(now: Column, new: Column, mode: str, allowed: bool) -> Column:
    blank = F.when(now.isNull(), _decision(WRITE, "description is blank"))
    if mode == APPEND_WITH_MARKER:
        last = blank.when(
            F.contains(now, F.lit(MARKER_START)),
            _decision(SKIP_NOOP, "legacy marker already present"),
        ).otherwise(_decision(WRITE, "append legacy description marker"))
    elif mode == OVERWRITE and allowed:
        last = _decision(WRITE, "overwrite description")
    elif mode == OVERWRITE:
        last = _decision(SKIP_CONFLICT, "description overwrite not allowed")
    else:
        last = blank.otherwise(_decision(SKIP_CONFLICT, "current description is nonblank"))
    return (
        F.when(new.isNull(), _decision(SKIP_NO_SOURCE, "no source description"))
        .when(now == new, _decision(SKIP_NOOP, "description already matches"))
        .otherwise(last)
    )


def _decision(action: str, reason: str) -> Column:
    return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))


def proposed_description(current: Column, proposed: Column, mode: str = FILL_EMPTY) -> Column:
    new = clean_multiline_text(proposed)
    if mode != APPEND_WITH_MARKER:
        return new
    now = clean_multiline_text(current)
    marked = F.concat(now, F.lit(f"\n\n{MARKER_START}\n"), new, F.lit(f"\n{MARKER_END}"))
    return (
        F.when(new.isNull(), F.lit(None))
        .when(now.isNull(), new)
        .when(F.contains(now, F.lit(MARKER_START)), now)
        .otherwise(marked)
    )


def planned_tables(src_tables: DataFrame, options: PlanOptions) -> DataFrame:
    """Source tables the plan looks at, with full names: included ones, then the first `limit`."""
    wanted = src_tables
    if options.include_tables:
        spark = src_tables.sparkSession
        asked = spark.createDataFrame([(code,) for code in options.include_tables], "code string")
        codes = asked.select(
            normalize_table_code(F.col("code"), options.source_prefix).alias("table_code")
        )
        wanted = wanted.join(codes.distinct(), "table_code", "left_semi")
    if options.limit:
        wanted = wanted.orderBy("table_code").limit(options.limit)
    return wanted.withColumn(
        "table_fqn",
        build_table_fqn(
            F.lit(options.service),
            F.lit(options.database),
            F.lit(options.schema),
            F.col("warehouse_table_name"),
        ),
    )


def plan_tables(
    src_tables: DataFrame, scope: DataFrame, cat_tables: DataFrame, options: PlanOptions
) -> DataFrame:
    """Source tables with their scoped catalogue table."""
    scoped = cat_tables.join(scope.select("table_fqn").distinct(), "table_fqn", "left_semi")
    current = scoped.select(
        "table_fqn",
        F.nullif("name", F.lit("")).alias("catalog_name"),
        F.col("display_name").alias("current_display_name"),
        F.col("description").alias("current_description"),
        "has_display_name",
        "has_description",
    )
    return planned_tables(src_tables, options).join(current, "table_fqn")


def column_lookup(cat_columns: DataFrame) -> DataFrame:
    """Catalogue columns by folded name: values of the last of a name, place of the first.

    The key holds the column name, so a table with a third of all columns is still spread out.
    """
    return _lookup(cat_columns, ["table_fqn"])


def _lookup(cat_columns: DataFrame, keys: list[str]) -> DataFrame:
    last = F.struct(F.coalesce("name", F.lit("")).alias("name"), "display_name", "description")
    first = F.struct("ordinal", "has_display_name", "has_description")
    return (
        cat_columns.groupBy(*keys, _folded(cat_columns, "name").alias("folded"))
        .agg(F.max_by(last, "ordinal").alias("last"), F.min_by(first, "ordinal").alias("first"))
        .select(
            *keys,
            "folded",
            F.col("last.name").alias("catalog_name"),
            F.col("last.display_name").alias("current_display_name"),
            F.col("last.description").alias("current_description"),
            F.col("first.ordinal").alias("ordinal"),
            F.col("first.has_display_name").alias("column_has_display_name"),
            F.col("first.has_description").alias("column_has_description"),
        )
    )


def _folded(frame: DataFrame, name: str) -> Column:
    """Folded form of a column name: the name itself where its source says that it is in lower case."""
    known = frame.schema[name].metadata.items() >= IN_LOWER_CASE.items()
    return F.col(name) if known else F.lower(name)


def plan_columns(matched: DataFrame, src_columns: DataFrame, cat_columns: DataFrame) -> DataFrame:
    """Source columns of matched tables; `catalog_name` is null where the catalogue has none.

    Both sides meet by table code and column name, by which sources have chosen among their rows:
    the texts of a source column are not shuffled again.
    """
    tables = matched.select(
        "table_code",
        "table_fqn",
        "warehouse_table_name",
        F.col("has_display_name").alias("table_has_display_name"),
    )
    wanted = short_join(src_columns, tables, ["table_code"], spread=["column_name"])
    wanted = wanted.withColumn("folded", _folded(src_columns, "column_name"))
    # Only columns of matched tables are put in order; the rest of the catalogue is left alone.
    names = matched.select("table_fqn", F.col("table_code").alias("_code")).distinct()
    known = short_join(cat_columns, names, ["table_fqn"], spread=["ordinal"])
    lookup = _lookup(
        known.repartition("_code", _folded(cat_columns, "name")), ["_code", "table_fqn"]
    ).withColumnsRenamed({"table_fqn": "_fqn", "folded": "_folded"})
    # A code may stand for two full names. As a pair of bounds the name is no key of the join.
    one_name = (F.col("table_fqn") <= F.col("_fqn")) & (F.col("table_fqn") >= F.col("_fqn"))
    met = (F.col("table_code") == F.col("_code")) & (F.col("folded") == F.col("_folded")) & one_name
    return wanted.join(lookup, met, "left").drop("_code", "_fqn", "_folded")


def unmatched_tables(src_tables: DataFrame, matched: DataFrame, options: PlanOptions) -> DataFrame:
    planned = planned_tables(src_tables, options)
    return planned.join(matched.select("table_code"), "table_code", "left_anti").select("table_code")


def unmatched_columns(detail: DataFrame) -> DataFrame:
    """`code.column` of the rows of `plan_detail` that found no catalogue column."""
    return detail.filter(~F.col("is_matched")).select(
        F.concat_ws(".", "table_code", "source_column").alias("column_ref")
    )


def tables_without_dictionary(scope: DataFrame, matched: DataFrame) -> DataFrame:
    names = scope.select("table_fqn").distinct()
    return names.join(matched.select("table_fqn").distinct(), "table_fqn", "left_anti")


def _decided(frame: DataFrame, options: PlanOptions, is_default: Column, decide_on: str) -> DataFrame:
    """Add proposals, actions and reasons. Cleaned texts are made once."""
    formatted = proposed_description(
        F.col("current_description"), F.col("description"), options.description_mode
    )
    cleaned = frame.withColumn("proposed_description", formatted).withColumns(
        {
            "_name_now": clean_text(F.col("current_display_name")),
            "_name_new": clean_text(F.col("label")),
            "_text_now": clean_text(F.col("current_description")),
            "_text_formatted": clean_text(F.col("proposed_description")),
        }
    )
    made = ["proposed_description", "_name_now", "_name_new", "_text_now", "_text_formatted"]
    decided = "_text_formatted"
    if decide_on != "proposed_description":
        decided = "_text_new"
        cleaned = cleaned.withColumn(decided, clean_text(F.col(decide_on)))
        made.append(decided)
    cleaned = made_once(cleaned.withColumn("_is_default", is_default), [*made, "_is_default"])
    name_mode, text_mode = options.display_name_mode, options.description_mode
    ruled = cleaned.withColumns(
        {
            "_name": _display_rule(
                F.col("_name_now"),
                F.col("_name_new"),
                F.col("_is_default"),
                name_mode,
                options.allow_overwrite_display_name,
            ),
            "_text": _description_rule(
                F.col("_text_now"),
                F.col(decided),
                text_mode,
                options.allow_overwrite_description,
            ),
        }
    )
    state = (
        F.when(F.col("_text_now").isNull(), "blank")
        .when(F.col("_text_now") == F.col("_text_formatted"), "identical")
        .otherwise("differs")
    )
    return ruled.withColumns(
        {
            "proposed_display_name": F.col("label"),
            "display_name_action": F.col("_name.action"),
            "description_action": F.col("_text.action"),
            "current_description_state": state,
            "reason": F.concat_ws("; ", "_name.reason", "_text.reason"),
        }
    )


def plan_detail(matched: DataFrame, columns: DataFrame, options: PlanOptions) -> DataFrame:
    """Plan rows with the order, place and presence columns that patches need.

    Table rows decide on the source text, column rows on the formatted text. Source columns that
    found no catalogue column stay in, with `is_matched` false, so that one pass serves the plan
    and the list of unmatched columns.
    """
    return _table_detail(matched, options).unionByName(_column_detail(columns, options))


def _table_detail(matched: DataFrame, options: PlanOptions) -> DataFrame:
    physical = F.coalesce("catalog_name", "warehouse_table_name")
    return _decided(
        matched,
        options,
        is_default_table_name(F.col("_name_now"), physical, options.source_prefix),
        "description",
    ).select(
        F.lit("table").alias("entity_type"),
        "table_fqn",
        physical.alias("table_name"),
        F.lit(None).cast("string").alias("column_name"),
        *PLAN_COLUMNS[4:],
        "table_code",
        F.lit(False).alias("is_column"),
        F.lit(None).cast("string").alias("source_column"),
        F.lit(None).cast("int").alias("ordinal"),
        F.col("has_display_name").alias("replaces_display_name"),
        F.col("has_description").alias("replaces_description"),
        F.lit(True).alias("is_matched"),
    )


def _column_detail(columns: DataFrame, options: PlanOptions) -> DataFrame:
    found = columns.withColumnRenamed("column_name", "source_column")
    shown = F.coalesce(F.nullif("catalog_name", F.lit("")), F.col("source_column"))
    return _decided(
        found,
        options,
        is_default_column_name(F.col("_name_now"), shown),
        "proposed_description",
    ).select(
        F.lit("column").alias("entity_type"),
        "table_fqn",
        F.col("warehouse_table_name").alias("table_name"),
        shown.alias("column_name"),
        *PLAN_COLUMNS[4:],
        "table_code",
        F.lit(True).alias("is_column"),
        "source_column",
        "ordinal",
        (F.col("table_has_display_name") & F.col("column_has_display_name")).alias(
            "replaces_display_name"
        ),
        F.col("column_has_description").alias("replaces_description"),
        F.col("catalog_name").isNotNull().alias("is_matched"),
    )


@dataclass(frozen=True)
class Plan:
    """Lazy relations of one comparison. `everything` holds the rows of `plan_detail`."""

    matched: DataFrame
    columns: DataFrame
    everything: DataFrame
    unmatched_tables: DataFrame
    tables_without_dictionary: DataFrame

    @property
    def detail(self) -> DataFrame:
        return self.everything.filter("is_matched")

    @property
    def rows(self) -> DataFrame:
        return self.detail.select(PLAN_COLUMNS)

    @property
    def unmatched_columns(self) -> DataFrame:
        return unmatched_columns(self.everything)

    @property
    def writes(self) -> DataFrame:
        return self.detail.filter(will_write())


def reconcile_plan(
    src_tables: DataFrame,
    src_columns: DataFrame,
    scope: DataFrame,
    cat_tables: DataFrame,
    cat_columns: DataFrame,
    options: PlanOptions,
) -> Plan:
    matched = plan_tables(src_tables, scope, cat_tables, options)
    columns = plan_columns(matched, src_columns, cat_columns)
    return Plan(
        matched=matched,
        columns=columns,
        everything=plan_detail(matched, columns, options),
        unmatched_tables=unmatched_tables(src_tables, matched, options),
        tables_without_dictionary=tables_without_dictionary(scope, matched),
    )


def will_write() -> Column:
    return (F.col("display_name_action") == WRITE) | (F.col("description_action") == WRITE)


def changed_tables(
    src_tables: DataFrame,
    columns_of: Callable[[DataFrame], DataFrame],
    scope: DataFrame,
    cat_tables: DataFrame,
    cat_columns: DataFrame,
    options: PlanOptions,
) -> DataFrame:
    """Names of the tables that the plan writes to, each once, without making the whole plan.

    A table whose own row is written is changed whatever its columns are, so columns are compared
    for the other tables only: `columns_of` gives the source columns of some `src_tables`. The
    rules are those of the plan.
    """
    matched = plan_tables(src_tables, scope, cat_tables, options)

    def changed(detail: DataFrame) -> DataFrame:
        written = detail.filter(F.col("is_matched") & will_write())
        return written.select("table_fqn").distinct()

    by_table = changed(_table_detail(matched, options))
    open_tables = matched.join(by_table, "table_fqn", "left_anti")
    columns = plan_columns(open_tables, columns_of(open_tables), cat_columns)
    return by_table.unionByName(changed(_column_detail(columns, options)))


def plan_summary(plan: Plan) -> DataFrame:
    """Eight counters: one pass over the rows, and two counts of tables."""
    kept = F.col("is_matched")

    def actions(action: str) -> Column:
        hits = (F.col("display_name_action") == action).cast("int") + (
            F.col("description_action") == action
        ).cast("int")
        return F.coalesce(F.sum(F.when(kept, hits)), F.lit(0)).cast("bigint")

    def rows(frame: DataFrame) -> Column:
        return frame.agg(F.count(F.lit(1))).scalar()

    return plan.everything.agg(
        F.count_if(kept).alias("plan_rows"),
        F.count_distinct(F.when(kept & will_write(), F.col("table_fqn"))).alias("tables_updated"),
        actions(WRITE).alias("metadata_writes"),
        actions(SKIP_NOOP).alias("no_ops"),
        actions(SKIP_CONFLICT).alias("conflicts_skipped"),
        F.count_if(~kept).alias("unmatched_dictionary_columns"),
    ).select(
        "*",
        rows(plan.unmatched_tables).alias("unmatched_dictionary_tables"),
        rows(plan.tables_without_dictionary).alias("tables_without_dictionary"),
    )


def write_preview(plan: Plan, rows: int = 20) -> DataFrame:
    """First writable rows in plan order: table by table, the table itself first."""
    return (
        plan.writes.orderBy(*PLAN_ORDER)
        .limit(rows)
        .select(
            "entity_type",
            "table_fqn",
            F.coalesce("column_name", F.lit("")).alias("column_name"),
            "display_name_action",
            "description_action",
        )
    )
