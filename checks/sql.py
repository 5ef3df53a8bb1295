"""Pieces of oracle SQL. Inputs hold ASCII white space only, so `\\s` is the same set there."""

from __future__ import annotations

from checks.inputs import SQL_VIEWS

_ORDER = [
    "dict_modules",
    "dict_tables",
    "dict_fields",
    "dict_indexes",
    "dict_index_fields",
    "cat_tables",
    "cat_columns",
]


def with_views(select: str, **extra: str) -> str:
    """`select` behind the views it names, directly or through `extra`."""
    body = select + " ".join(extra.values())
    used = [f"{name} AS ({SQL_VIEWS[name]})" for name in _ORDER if name in body]
    used += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(used)} {select}" if used else select


def clean_text(x: str) -> str:
    return rf"nullif(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


def multiline(x: str) -> str:
    return (
        f"nullif(array_to_string(list_filter(list_transform(string_split({x}, chr(10)), "
        r"lambda z: trim(regexp_replace(z, '[ \t]+', ' ', 'g'))), lambda z: z <> ''), chr(10)), '')"
    )


def description(x: str) -> str:
    first = rf"trim(regexp_replace({clean_text(x)}, '^\s*description:\s*', '', 'i'))"
    return rf"nullif(trim(regexp_replace({first}, '^\s*content:\s*', '', 'i')), '')"


def section(x: str, label: str) -> str:
    return rf"nullif(trim(regexp_replace({multiline(x)}, '^\s*{label}:\s*', '', 'i')), '')"


def legacy(parts: list[tuple[str, str]]) -> str:
    body = ", ".join(
        f"'{label}:' || chr(10) || {section(x, label)}" for label, x in parts
    )
    return (
        "'Legacy Data Dictionary Entries:' || chr(10) || chr(10) || "
        f"nullif(concat_ws(chr(10) || chr(10), {body}), '')"
    )


def identifier(x: str) -> str:
    return (
        f"lower(trim(trim(trim(trim(trim(trim(coalesce({x}, '')), '\"'), chr(39)), '[]'), '`')))"
    )


def label_of(code: str, title: str) -> str:
    """Title without `CODE -`; codes here hold letters and digits only."""
    text = clean_text(title)
    pattern = rf"concat('(?i)^', {code}, '\s*[-:]\s*(.+)$')"
    return (
        f"CASE WHEN regexp_matches({text}, {pattern}) "
        f"THEN regexp_extract({text}, {pattern}, 1) ELSE {text} END"
    )


DESCRIPTIONS = legacy([("Description", "description"), ("Help", "help"), ("Content", "content")])

# Relational source columns: code, name, label, texts, provenance.
SRC_COLUMNS = f"""
SELECT table_id AS table_code, regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name,
  {clean_text('label')} AS label, {DESCRIPTIONS} AS description, {clean_text('help')} AS help,
  {description('content')} AS content, 'rel:fields:' || table_id || '.' || field_name AS source_ref
FROM dict_fields"""

_FIELD_TEXT = """
SELECT index_id, string_agg(field_name, ', ' ORDER BY field_sequence) AS names
FROM dict_index_fields GROUP BY index_id"""

TABLE_TEXTS = f"""
SELECT table_id AS table_code, 'Legacy Data Dictionary Entries:' || chr(10) || chr(10) ||
  concat_ws(chr(10) || chr(10), 'Primary Key:' || chr(10) || string_agg(CASE WHEN is_primary = 1 THEN
    lower(index_name) || ': ' || coalesce(names, 'unknown') END, chr(10) ORDER BY index_name),
  'Indexes:' || chr(10) || string_agg(lower(index_name) || CASE WHEN is_primary = 1 OR is_unique = 1 OR is_word = 1
    THEN ' (' || concat_ws(', ', CASE WHEN is_primary = 1 THEN 'primary' END, CASE WHEN is_unique = 1 THEN 'unique' END,
      CASE WHEN is_word = 1 THEN 'word' END) || ')' ELSE '' END || ': ' || coalesce(names, 'unknown'),
    chr(10) ORDER BY index_name)) AS description
FROM dict_indexes LEFT JOIN ({_FIELD_TEXT}) n ON index_id = id GROUP BY table_id"""

SRC_TABLES = f"""
SELECT table_id AS table_code, 'csd_' || table_id AS warehouse_table_name, {label_of('table_id', 'table_title')} AS label,
  x.description, 'rel:tables:' || table_id AS source_ref
FROM dict_tables LEFT JOIN ({TABLE_TEXTS}) x ON x.table_code = table_id"""

MARKER_START = "<!-- legacy-data-dictionary-import:start -->"
MARKER_END = "<!-- legacy-data-dictionary-import:end -->"


def _display(current: str, default: str, mode: str) -> list[tuple[str, str, str]]:
    rules = [
        ("label IS NULL", "skip_no_source", "no source displayName"),
        (f"{clean_text(current)} = label", "skip_noop", "displayName already matches"),
    ]
    if mode == "overwrite":
        return [*rules, ("true", "write", "overwrite displayName")]
    return [
        *rules,
        (default, "write", "displayName is blank/default"),
        ("true", "skip_conflict", "current displayName is curated"),
    ]


def _description(decide_on: str, mode: str) -> list[tuple[str, str, str]]:
    now, new = clean_text("c_description"), clean_text(decide_on)
    rules = [
        (f"{new} IS NULL", "skip_no_source", "no source description"),
        (f"{now} = {new}", "skip_noop", "description already matches"),
    ]
    if mode == "overwrite":
        return [*rules, ("true", "write", "overwrite description")]
    rules.append((f"{now} IS NULL", "write", "description is blank"))
    if mode == "append-with-marker":
        return [
            *rules,
            (f"contains({now}, '{MARKER_START}')", "skip_noop", "legacy marker already present"),
            ("true", "write", "append legacy description marker"),
        ]
    return [*rules, ("true", "skip_conflict", "current description is nonblank")]


def _case(rules: list[tuple[str, str, str]], at: int) -> str:
    return "CASE " + " ".join(f"WHEN {rule[0]} THEN '{rule[at]}'" for rule in rules) + " END"


def _proposed(mode: str) -> str:
    new, now = multiline("description"), multiline("c_description")
    if mode != "append-with-marker":
        return new
    return (
        f"CASE WHEN {new} IS NULL THEN NULL WHEN {now} IS NULL THEN {new} "
        f"WHEN contains({now}, '{MARKER_START}') THEN {now} ELSE {now} || chr(10) || chr(10) || "
        f"'{MARKER_START}' || chr(10) || {new} || chr(10) || '{MARKER_END}' END"
    )


def plan_views(text_mode: str = "fill-empty", name_mode: str = "fill-default") -> dict[str, str]:
    """Views `src_tables`, `src_columns`, `matched`, `found`, `plan` in dependency order."""
    fqn = "'wh.dw.core.' || warehouse_table_name"
    default_table = (
        "nullif(trim(c_display), '') IS NULL OR lower(c_display) IN (c_name, replace(c_name, '_', ' '), "
        "substr(c_name, 5), replace(substr(c_name, 5), '_', ' '))"
    )
    default_column = f"nullif(trim(c_display), '') IS NULL OR {identifier('c_display')} = {identifier('c_name')}"
    state = f"""CASE WHEN {clean_text('c_description')} IS NULL THEN 'blank'
      WHEN {clean_text('c_description')} = {clean_text('proposed')} THEN 'identical' ELSE 'differs' END"""

    def rows(source: str, entity: str, table: str, column: str, default: str, decide_on: str) -> str:
        names, texts = _display("c_display", default, name_mode), _description(decide_on, text_mode)
        return f"""
SELECT '{entity}' AS entity_type, table_fqn, {table} AS table_name, {column} AS column_name,
  c_display AS current_display_name, label AS proposed_display_name, {_case(names, 1)} AS display_name_action,
  {state} AS current_description_state, proposed AS proposed_description, {_case(texts, 1)} AS description_action,
  {_case(names, 2)} || '; ' || {_case(texts, 2)} AS reason, source_ref,
  table_code, {'true' if entity == 'column' else 'false'} AS is_column,
  {'column_name' if entity == 'column' else "CAST(NULL AS VARCHAR)"} AS source_column,
  {'ordinal' if entity == 'column' else 'CAST(NULL AS INT)'} AS ordinal,
  {'t_display IS NOT NULL AND c_display IS NOT NULL' if entity == 'column' else 'c_display IS NOT NULL'} AS replaces_display,
  c_description IS NOT NULL AS replaces_description
FROM (SELECT *, {_proposed(text_mode)} AS proposed FROM {source}) p"""

    return {
        "src_tables": SRC_TABLES,
        "src_columns": SRC_COLUMNS,
        "matched": f"""SELECT s.*, c.table_fqn, c.name AS c_name, c.display_name AS c_display, c.description AS c_description
          FROM src_tables s JOIN cat_tables c ON c.table_fqn = {fqn} WHERE c.data_product_id = 'dp-id'""",
        "columns_seen": """SELECT s.*, m.table_fqn, m.warehouse_table_name, m.c_display AS t_display, c.name AS c_name,
          c.display_name AS c_display, c.description AS c_description, c.ordinal
          FROM src_columns s JOIN matched m ON m.table_code = s.table_code
          LEFT JOIN cat_columns c ON c.table_fqn = m.table_fqn AND lower(c.name) = s.column_name""",
        "columns_found": "SELECT * FROM columns_seen WHERE c_name IS NOT NULL",
        "plan": rows("matched", "table", "c_name", "CAST(NULL AS VARCHAR)", default_table, "description")
        + " UNION ALL "
        + rows("columns_found", "column", "warehouse_table_name", "c_name", default_column, "proposed"),
        "writes": "SELECT * FROM plan WHERE display_name_action = 'write' OR description_action = 'write'",
    }


PLAN_COLUMNS = (
    "entity_type, table_fqn, table_name, column_name, current_display_name, proposed_display_name, "
    "display_name_action, current_description_state, proposed_description, description_action, reason, source_ref"
)


def over_plan(select: str, text_mode: str = "fill-empty", name_mode: str = "fill-default", **extra: str) -> str:
    return with_views(select, **plan_views(text_mode, name_mode), **extra)
