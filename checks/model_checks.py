"""Checks of the document sources, the relational views, the key report and the source model."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import PREFIX, Inputs, sql
from checks.plan_checks import source_columns, source_tables
from checks.registry import check
from checks.sql import (
    DESCRIPTIONS,
    SRC_COLUMNS,
    SRC_TABLES,
    TABLE_TEXTS,
    clean_text,
    description,
    identifier,
    label_of,
    multiline,
    section,
    with_views,
)
from lexiframe.functions import names, text
from lexiframe.operators import keys, relational, source_model
from lexiframe.plans.storage import stored
from lexiframe.sources import csv_blocks, documents, json_blocks

# Sources -----------------------------------------------------------------------------------


@check(
    "dict_json_flatten",
    """SELECT 'M' AS module_code, 'mod' AS module_title, 't' || s_suppkey || 'tbl' AS table_name, s_name AS title, CAST(0 AS INT) AS table_pos,
        CAST(NULL AS VARCHAR) AS error, field_pos, CASE field_pos WHEN 0 THEN 'c1.htm' ELSE 'c' || s_suppkey || '.htm' END AS filename,
        'help/' || CASE field_pos WHEN 0 THEN 'c1.htm' ELSE 'c' || s_suppkey || '.htm' END AS path
      FROM supplier, (SELECT CAST(unnest([0, 1]) AS INT) AS field_pos) f
      UNION ALL SELECT 'M', 'mod', 'u' || s_suppkey, NULL, CAST(1 AS INT), 'bad', NULL, NULL, NULL FROM supplier""",
)
def dict_json_flatten(inputs: Inputs) -> DataFrame:
    tables = documents.json_dictionary(inputs.dictionary_documents)
    return tables.select(
        "module_code", "module_title", "table_name", "title", "table_pos", "error",
        F.posexplode_outer("fields").alias("field_pos", "link"),
    ).select(
        "module_code", "module_title", "table_name", "title", "table_pos", "error", "field_pos", "link.*"
    )


def unified(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Source tables and columns as one relation."""
    nothing = F.lit(None).cast("string")
    wide = tables.select(
        "table_code", "warehouse_table_name", nothing.alias("column_name"), "label", "description",
        nothing.alias("help"), nothing.alias("content"), "source_ref",
    )
    return wide.unionByName(columns.withColumn("warehouse_table_name", nothing))


def _unified_sql(tables: str, columns: str) -> str:
    return f"""SELECT table_code, warehouse_table_name, CAST(NULL AS VARCHAR) AS column_name, label, description,
  CAST(NULL AS VARCHAR) AS help, CAST(NULL AS VARCHAR) AS content, source_ref FROM ({tables}) t
UNION ALL SELECT table_code, NULL, column_name, label, description, help, content, source_ref FROM ({columns}) c"""


@check("source_from_relational", with_views(_unified_sql(SRC_TABLES, SRC_COLUMNS)))
def source_from_relational(inputs: Inputs) -> DataFrame:
    return unified(source_tables(inputs), source_columns(inputs))


_BUCKET = "CAST(floor((id % 1000000) / 64) AS BIGINT)"
_DOC = "'doc/' || table_id || '-' || lpad(bucket::VARCHAR, 8, '0') || ':modules.' || module_code || '.' || table_id"
_JSON_TABLES = f"""
SELECT table_id AS table_code, 'csd_' || table_id AS warehouse_table_name, {label_of('table_id', 'table_title')} AS label,
  'Legacy Data Dictionary Entries:' || chr(10) || chr(10) || 'Primary Key:' || chr(10) || 'k-0: cono, x' || chr(10) || chr(10) ||
  'Indexes:' || chr(10) || 'k-0 (primary' || CASE WHEN bucket % 2 = 0 THEN ', unique' ELSE '' END || '): cono, x' || chr(10) ||
  'k-1: unknown' AS description, {_DOC} AS source_ref
FROM (SELECT t.table_id, t.module_code, t.table_title, min({_BUCKET}) AS bucket
  FROM dict_fields f JOIN dict_tables t ON f.table_id = t.table_id GROUP BY ALL) d"""
_JSON_TEXT = DESCRIPTIONS[: DESCRIPTIONS.rindex("), '')")]
_JSON_COLUMNS = f"""
SELECT table_id AS table_code, regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name,
  {clean_text('label')} AS label, {_JSON_TEXT}, 'Indexes:' || chr(10) || concat_ws(', ', {clean_text('label')}, 'k-1')), '') AS description,
  {clean_text('help')} AS help, {description('content')} AS content, {_DOC} || '.' || field_name AS source_ref
FROM (SELECT f.*, {_BUCKET} AS bucket, module_code FROM dict_fields f JOIN dict_tables t ON f.table_id = t.table_id) d"""


@check("source_from_json", with_views(_unified_sql(_JSON_TABLES, _JSON_COLUMNS)))
def source_from_json(inputs: Inputs) -> DataFrame:
    docs = inputs.annotation_documents
    return unified(
        source_model.annotation_tables(documents.json_tables(docs), PREFIX),
        source_model.annotation_columns(documents.json_fields(docs), PREFIX),
    )


_CSV_TITLE = "arg_min({0}, id) FILTER ({0} IS NOT NULL)"
_CSV_TABLES = f"""
SELECT table_id AS table_code, 'csd_' || table_id AS warehouse_table_name, {_CSV_TITLE.format('title')} AS label,
  {_CSV_TITLE.format('about')} AS description, 'dict.csv:' || (min(id) + 1) AS source_ref
FROM (SELECT f.id, t.table_id, CASE WHEN id % 2 = 0 THEN {clean_text('table_title')} END AS title,
    CASE WHEN id % 5 = 0 THEN {clean_text('table_title')} END AS about
  FROM dict_fields f JOIN dict_tables t ON f.table_id = t.table_id) d GROUP BY table_id"""
_CSV_COLUMNS = f"""
SELECT table_id AS table_code, regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name,
  {clean_text('label')} AS label, {description('description')} AS description, CAST(NULL AS VARCHAR) AS help,
  CAST(NULL AS VARCHAR) AS content, 'dict.csv:' || (id + 1) AS source_ref FROM dict_fields"""


@check("source_from_csv", with_views(_unified_sql(_CSV_TABLES, _CSV_COLUMNS)))
def source_from_csv(inputs: Inputs) -> DataFrame:
    records = documents.parse_csv_lines(inputs.csv_records)
    return unified(
        source_model.csv_tables(records, PREFIX), source_model.csv_columns(records, PREFIX)
    )


@contextmanager
def small_blocks(spark: SparkSession, size: int = 1 << 20) -> Iterator[None]:
    """Files are read in blocks of `size` bytes, so that those of the checks have several."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


_FILE_DOC = "'doc:modules.' || module_code || '.' || table_id"


@check(
    "source_from_json_files",
    with_views(
        _unified_sql(
            _JSON_TABLES.replace(_DOC, _FILE_DOC).replace("bucket % 2", "substr(table_id, 2)::BIGINT % 2"),
            _JSON_COLUMNS.replace(_DOC, _FILE_DOC),
        )
    ),
)
def source_from_json_files(inputs: Inputs) -> DataFrame:
    """Annotation files that several tasks read, with a text that looks like the end of an object."""
    with small_blocks(inputs.spark):
        members = json_blocks.read_members(inputs.spark, inputs.annotation_files(), "*.txt")
    members = members.withColumn("path", F.lit("doc"))
    return unified(
        source_model.annotation_tables(json_blocks.table_rows(members), PREFIX),
        source_model.annotation_columns(json_blocks.field_rows(members), PREFIX),
    )


_CSV_FILE = "(floor(id / 50000000)::BIGINT)"
_CSV_PLACES = f"(SELECT *, row_number() OVER (PARTITION BY {_CSV_FILE} ORDER BY id) + 1 AS line FROM dict_fields)"


@check(
    "source_from_csv_files",
    with_views(
        _unified_sql(
            _CSV_TABLES.replace("'dict.csv:' || (min(id) + 1)", "min(source)")
            .replace("SELECT f.id,", f"SELECT f.id, first_value({_CSV_FILE} || ':' || line) OVER (PARTITION BY t.table_id ORDER BY id) AS source,")
            .replace("FROM dict_fields f", f"FROM {_CSV_PLACES} f"),
            _CSV_COLUMNS.replace("'dict.csv:' || (id + 1)", f"{_CSV_FILE} || ':' || line").replace("FROM dict_fields", f"FROM {_CSV_PLACES} f"),
        )
    ),
)
def source_from_csv_files(inputs: Inputs) -> DataFrame:
    """CSV files of 80 columns and texts over several lines that several tasks read."""
    with small_blocks(inputs.spark):
        records = csv_blocks.read_csv(inputs.spark, inputs.csv_files(), "*.txt")
    records = records.withColumn("path", F.regexp_extract("path", "file=([^/]*)", 1))
    found = unified(
        source_model.csv_tables(records, PREFIX), source_model.csv_columns(records, PREFIX)
    )
    return found.withColumn("source_ref", F.regexp_replace("source_ref", "^0+(?=[0-9])", ""))


_INDEX_FIELDS = """(SELECT index_id, string_agg(field_name, ',' ORDER BY field_sequence) AS names FROM dict_index_fields GROUP BY index_id)"""


@check(
    "source_indexes",
    with_views(f"""SELECT table_id AS table_code, lower(index_name) AS index_name, is_primary = 1 AS is_primary, is_unique = 1 AS is_unique,
      is_word = 1 AS is_word, coalesce(names, '') AS fields FROM dict_indexes LEFT JOIN {_INDEX_FIELDS} n ON index_id = id"""),
)
def source_indexes(inputs: Inputs) -> DataFrame:
    """With an index of an unknown table, which must disappear."""
    strays = inputs.dict_indexes.withColumns({"table_id": F.lit("nowhere"), "id": -F.col("id")})
    found = source_model.source_indexes(
        inputs.dict_indexes.unionByName(strays), inputs.dict_index_fields, inputs.dict_tables, PREFIX
    )
    return found.select(
        "table_code", "index_name", "is_primary", "is_unique", "is_word",
        F.array_join("fields.field_name", ",").alias("fields"),
    )


_CATALOG = """
SELECT 'wh.dw.core.csd_t' || s_suppkey AS table_fqn, 'csd_t' || s_suppkey AS table_name,
  CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS table_display_name, true AS table_has_display_name,
  CASE WHEN s_suppkey % 3 <> 0 THEN 'd' END AS table_description, s_suppkey % 3 <> 0 AS table_has_description, 'dp-id| P,q' AS products,
  ordinal, CASE ordinal WHEN 0 THEN 'C' || s_suppkey ELSE 'b' END AS name, CASE ordinal WHEN 1 THEN 'x' END AS display_name,
  CAST(NULL AS VARCHAR) AS description, ordinal = 1 AS has_display_name, ordinal = 1 AS has_description,
  CASE ordinal WHEN 0 THEN 'a.b' END AS tag
FROM supplier, (SELECT CAST(unnest([0, 1]) AS INT) AS ordinal) o"""


@check("catalog_flatten", _CATALOG)
def catalog_flatten(inputs: Inputs) -> DataFrame:
    docs = inputs.catalog_documents
    refs = F.transform(
        "data_products", lambda p: F.concat_ws("|", p["id"], p["name"], p["fullyQualifiedName"])
    )
    tables = documents.catalog_tables(docs).select(
        "table_fqn",
        F.col("name").alias("table_name"),
        F.col("display_name").alias("table_display_name"),
        F.col("has_display_name").alias("table_has_display_name"),
        F.col("description").alias("table_description"),
        F.col("has_description").alias("table_has_description"),
        F.array_join(refs, ",").alias("products"),
    )
    columns = documents.catalog_columns(docs).withColumn(
        "tag", F.get_json_object("raw", "$.tags[0].tagFQN")
    )
    return tables.join(columns.drop("raw"), "table_fqn")


@check(
    "latest_snapshot",
    """SELECT event_type AS kind, 'f/' || arg_max(event_id, (ts, 'f/' || event_id)) AS path, max(ts) AS mtime,
      (SELECT max(ts) FROM events) - max(ts) < INTERVAL 1 DAY AS is_fresh FROM events GROUP BY event_type""",
)
def latest_snapshot(inputs: Inputs) -> DataFrame:
    events = inputs.table("events")
    files = events.select(
        F.col("event_type").alias("kind"),
        F.concat(F.lit("f/"), "event_id").alias("path"),
        F.col("ts").alias("mtime"),
    )
    return documents.latest_snapshot(files, events.agg(F.max("ts")).scalar())


# Relational views --------------------------------------------------------------------------

_FIELDS = "(SELECT f.*, t.module_code FROM dict_fields f JOIN dict_tables t ON f.table_id = t.table_id)"
_INDEXES = """(SELECT *, 'm' || id % 5 AS module_code, table_id || '_' || lower(index_name) || '.htm' AS source_file FROM dict_indexes)"""


@check(
    "field_details",
    with_views(f"""SELECT f.module_code, 'sxe.' || f.table_id AS table_name, field_name, label, help, description, content,
      CAST(NULL AS VARCHAR) AS field_type FROM {_FIELDS} f"""),
)
def field_details(inputs: Inputs) -> DataFrame:
    """Fields of an unknown module or table are added; the inner joins drop them."""
    stray = inputs.rel_fields.withColumn("module_code", F.lit("m9"))
    lost = inputs.rel_fields.withColumn("table_id", F.lit("nowhere"))
    fields = inputs.rel_fields.unionByName(stray).unionByName(lost)
    return relational.field_details(fields, inputs.rel_tables, inputs.dict_modules).select(
        "module_code", "table_name", "field_name", "label", "help", "description", "content", "field_type"
    )


_INDEX_DETAILS = f"""SELECT i.module_code, 'sxe.' || i.table_id AS table_name, index_name, is_primary, is_unique, is_word, source_file,
  field_sequence, field_name FROM {_INDEXES} i LEFT JOIN dict_index_fields ON index_id = id"""


def index_rows(inputs: Inputs) -> DataFrame:
    return relational.index_details(
        inputs.rel_indexes, inputs.dict_index_fields, inputs.rel_tables, inputs.dict_modules
    )


@check("index_details", with_views(_INDEX_DETAILS))
def index_details(inputs: Inputs) -> DataFrame:
    return index_rows(inputs).drop("field_order", "abbreviated")


@check(
    "rel_metadata",
    with_views("""SELECT 'source_file' AS key, 'a.json' AS value UNION ALL SELECT 'schema_prefix', 'sxe.'
      UNION ALL SELECT 'modules_count', (SELECT count(*) FROM dict_modules)::VARCHAR
      UNION ALL SELECT 'tables_count', (SELECT count(*) FROM dict_tables)::VARCHAR
      UNION ALL SELECT 'fields_count', (SELECT count(*) FROM dict_fields)::VARCHAR
      UNION ALL SELECT 'indexes_count', (SELECT count(*) FROM dict_indexes)::VARCHAR
      UNION ALL SELECT 'index_fields_count', (SELECT count(*) FROM dict_index_fields)::VARCHAR"""),
)
def rel_metadata(inputs: Inputs) -> DataFrame:
    return relational.rel_metadata(
        {
            "modules_count": inputs.dict_modules,
            "tables_count": inputs.dict_tables,
            "fields_count": inputs.dict_fields,
            "indexes_count": inputs.dict_indexes,
            "index_fields_count": inputs.dict_index_fields,
        },
        {"source_file": "a.json", "schema_prefix": "sxe."},
    )


@check(
    "rel_key_violations",
    with_views("""SELECT 'tables.table_id: repeated' AS violation, table_id AS key_value, CAST(2 AS BIGINT) AS rows
      FROM dict_tables WHERE module_code = 'm1'
      UNION ALL SELECT 'fields.table_id: no target', table_id || 'x', count(*) FROM dict_fields WHERE id % 7 = 0 GROUP BY table_id
      UNION ALL SELECT 'fields.module_code: no target', 'm9', count(*) FROM dict_fields WHERE id % 7 = 1 HAVING count(*) > 0
      UNION ALL SELECT 'table_index_fields.index_id: no target', index_id::VARCHAR, count(*) FROM dict_index_fields
        WHERE index_id % 6 = 0 GROUP BY index_id"""),
)
def rel_key_violations(inputs: Inputs) -> DataFrame:
    tables = inputs.dict_tables.unionByName(inputs.dict_tables.filter("module_code = 'm1'"))
    fields = inputs.rel_fields.withColumns(
        {
            "table_id": F.when(F.col("id") % 7 == 0, F.concat("table_id", F.lit("x"))).otherwise(F.col("table_id")),
            "module_code": F.when(F.col("id") % 7 == 1, "m9").otherwise(F.col("module_code")),
        }
    )
    indexes = inputs.rel_indexes.filter("id % 6 <> 0")
    return relational.rel_key_violations(
        inputs.dict_modules, tables, fields, indexes, inputs.dict_index_fields
    )


@check(
    "search_fields",
    with_views(f"""SELECT module_code, 'sxe.' || table_id AS table_name, field_name, label, description FROM {_FIELDS} f
      WHERE description ILIKE '%m%brand%2%'"""),
)
def search_fields(inputs: Inputs) -> DataFrame:
    return relational.search_fields(inputs.rel_fields, inputs.rel_tables, "%m%brand%2%")


# Key report --------------------------------------------------------------------------------

_UNIQUE = f"SELECT table_name, index_name, field_sequence, field_name AS column_name FROM ({_INDEX_DETAILS}) d WHERE is_primary = 1 AND is_unique = 1"
_PK = f"""SELECT table_name, field_sequence, column_name FROM ({_UNIQUE}) u
  WHERE index_name = (SELECT min(index_name) FROM ({_UNIQUE}) v WHERE v.table_name = u.table_name)"""
_TRANS = f"""SELECT table_name, column_name, min(id) AS first_id FROM (SELECT 'sxe.' || table_id AS table_name, id,
    regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name FROM dict_fields) c
  WHERE column_name LIKE 'trans%' GROUP BY ALL"""
_FLAGS = f"""SELECT 'sxe.' || table_id AS table_name, 'sxe.' || table_id IN (SELECT table_name FROM ({_UNIQUE}) u) AS has_primary_unique_key,
  'sxe.' || table_id IN (SELECT table_name FROM ({_TRANS}) x WHERE column_name = 'transdttmz') AS has_transdttmz FROM dict_tables"""


def _unique(inputs: Inputs) -> DataFrame:
    return keys.primary_unique_indexes(index_rows(inputs))


def _trans(inputs: Inputs) -> DataFrame:
    return keys.trans_columns(inputs.dict_fields, inputs.rel_tables)


def report_inputs(inputs: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables and the two lists, stored as the report job stores them."""
    return inputs.rel_tables, stored(_unique(inputs), "unique"), stored(_trans(inputs), "trans")


@check("table_list", with_views("SELECT 'sxe.' || table_id AS table_name FROM dict_tables"))
def table_list(inputs: Inputs) -> DataFrame:
    return keys.table_list(inputs.rel_tables)


@check("primary_unique_indexes", with_views(_UNIQUE))
def primary_unique_indexes(inputs: Inputs) -> DataFrame:
    return _unique(inputs)


@check("pk_columns", with_views(_PK))
def pk_columns(inputs: Inputs) -> DataFrame:
    return keys.pk_columns(_unique(inputs))


@check("trans_columns", with_views(_TRANS))
def trans_columns(inputs: Inputs) -> DataFrame:
    return _trans(inputs)


_STAMPED = _FLAGS.replace("column_name = 'transdttmz'", "regexp_matches(column_name, '^trans[0-9]*[05]$')")


@check("key_flags", with_views(_STAMPED))
def key_flags(inputs: Inputs) -> DataFrame:
    """Some of the `trans` columns get the name of the time stamp, so both flags vary."""
    named = F.regexp_replace("column_name", "^trans[0-9]*[05]$", "transdttmz")
    stamped = _trans(inputs).withColumn("column_name", named)
    return keys.key_flags(inputs.rel_tables, _unique(inputs), stamped)


def _list_sql(name: str, rows: str, index_name: str, position: str) -> str:
    return f"""SELECT '{name}' AS list_name, 'sxe.' || t.table_id AS table_name, {index_name} AS index_name,
  ({position})::VARCHAR AS position, column_name, r.table_name IS NULL AS is_empty
FROM dict_tables t LEFT JOIN ({rows}) r ON r.table_name = 'sxe.' || t.table_id"""


_NO_NAME = "CAST(NULL AS VARCHAR)"


@check(
    "key_report_simple",
    with_views(_list_sql("pk_columns", _PK, _NO_NAME, "field_sequence") + " UNION ALL "
      + _list_sql("transaction_columns", _TRANS, _NO_NAME, "first_id")),
)
def key_report_simple(inputs: Inputs) -> DataFrame:
    return keys.key_report_simple(*report_inputs(inputs))


@check(
    "key_report_full",
    with_views("SELECT l.*, has_primary_unique_key, has_transdttmz FROM ("
      + _list_sql("primary_unique_key_columns", _PK, _NO_NAME, "field_sequence") + " UNION ALL "
      + _list_sql("primary_unique_indexes", _UNIQUE, "index_name", "field_sequence") + " UNION ALL "
      + _list_sql("trans_columns", _TRANS, _NO_NAME, "first_id")
      + f") l JOIN ({_FLAGS}) f ON f.table_name = l.table_name"),
)
def key_report_full(inputs: Inputs) -> DataFrame:
    return keys.key_report_full(*report_inputs(inputs))


@check(
    "key_report_counts",
    with_views(f"""SELECT count(*) AS tables_count, (SELECT count(DISTINCT table_name) FROM ({_UNIQUE}) u) AS tables_with_primary_unique_key_count,
      (SELECT count(DISTINCT table_name) FROM ({_TRANS}) x) AS tables_with_trans_columns_count, 'trans%' AS trans_pattern FROM dict_tables"""),
)
def key_report_counts(inputs: Inputs) -> DataFrame:
    return keys.key_report_counts(*report_inputs(inputs))


# Source model ------------------------------------------------------------------------------


@check(
    "normalize_sources",
    with_views(f"""SELECT id, table_id AS table_code, 'csd_' || table_id AS warehouse_table_name,
      regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name FROM dict_fields"""),
)
def normalize_sources(inputs: Inputs) -> DataFrame:
    """Every second code is written with the prefix, in quotes and capitals."""
    raw = inputs.dict_fields.withColumn(
        "code",
        F.when(F.col("id") % 2 == 0, F.concat(F.lit('["CSD_'), F.upper("table_id"), F.lit('"] '))).otherwise(
            F.col("table_id")
        ),
    )
    # Brackets inside quotes are not stripped, so only the quoted form is used here.
    raw = raw.withColumn("code", F.replace(F.replace("code", F.lit("["), F.lit("")), F.lit("]"), F.lit("")))
    return source_model.normalize_sources(raw, "code", "field_name", PREFIX).select(
        "id", "table_code", "warehouse_table_name", "column_name"
    )


@check("table_labels", with_views(f"SELECT table_id, {label_of('table_id', 'table_title')} AS label FROM dict_tables"))
def table_labels(inputs: Inputs) -> DataFrame:
    return inputs.dict_tables.select(
        "table_id", names.clean_table_label(F.col("table_id"), F.col("table_title")).alias("label")
    )


@check("column_descriptions", with_views(f"SELECT id, {DESCRIPTIONS} AS legacy FROM dict_fields"))
def column_descriptions(inputs: Inputs) -> DataFrame:
    return source_model.with_legacy_description(inputs.dict_fields, "legacy").select("id", "legacy")


@check(
    "index_list_text",
    with_views("""SELECT id, CASE id % 4 WHEN 0 THEN nullif(concat_ws(', ', nullif(trim(label), ''), 'k'), '') WHEN 1 THEN 'plain'
      WHEN 2 THEN '[not json' ELSE NULL END AS listed FROM dict_fields"""),
)
def index_list_text(inputs: Inputs) -> DataFrame:
    value = (
        F.when(F.col("id") % 4 == 0, F.to_json(F.array("label", F.lit("  "), F.lit(" k "))))
        .when(F.col("id") % 4 == 1, " plain ")
        .when(F.col("id") % 4 == 2, "[not json")
        .otherwise("[]")
    )
    return inputs.dict_fields.select("id", text.index_list_text(value).alias("listed"))


@check("table_descriptions", with_views(f"SELECT table_code, description FROM ({TABLE_TEXTS}) t"))
def table_descriptions(inputs: Inputs) -> DataFrame:
    return source_model.table_descriptions(
        source_model.source_indexes(
            inputs.dict_indexes, inputs.dict_index_fields, inputs.dict_tables, PREFIX
        )
    )


@check(
    "json_indexes",
    """SELECT 'm/t' || s_suppkey AS table_id, k AS pos, CASE k WHEN 0 THEN 'k-0' ELSE 't' || s_suppkey || '_k-' || s_suppkey END AS index_name,
      CASE WHEN k = 0 THEN s_suppkey % 2 = 0 END AS is_primary, CASE WHEN k = 0 THEN 'cono,x' ELSE '' END AS fields
      FROM supplier, (SELECT CAST(unnest([0, 1]) AS INT) AS k) p""".replace("'m/t' ||", "'t' ||"),
)
def json_indexes(inputs: Inputs) -> DataFrame:
    """The link name starts with a capital prefix, which is not removed: links are cut before folding."""
    entries = sql(
        inputs.spark,
        """
SELECT concat('t', s_suppkey) AS table_id, array(
  concat('{"name":" \\\\"K-0\\\\" ","primary":', CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END,
    ',"fields":[{"sequence":1,"name":"CONO"},{"sequence":2},{"name":"x"}]}'),
  concat('["a/T', s_suppkey, '_K-', s_suppkey, '.htm","p"]'), '[]', '"text"') AS entries FROM {s}""",
        s=inputs.table("supplier"),
    )
    parsed = entries.select(
        "table_id",
        F.posexplode(source_model.json_indexes(F.col("entries"), F.col("table_id"))).alias("pos", "i"),
    )
    return parsed.select(
        "table_id", "pos", "i.index_name", "i.is_primary",
        F.array_join("i.fields.field_name", ",").alias("fields"),
    )


@check(
    "merge_sources",
    with_views(f"""SELECT table_code, column_name, id FROM (SELECT table_id AS table_code,
      regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name, max(id) + 1 AS id FROM dict_fields GROUP BY ALL) m"""),
)
def merge_sources(inputs: Inputs) -> DataFrame:
    """Every field twice, once under a prefixed table id; the later id of the larger table id wins."""
    fields = inputs.dict_fields.select("id", "table_id", "field_name", "label")
    tables = inputs.dict_tables.select("table_id")
    later = fields.withColumns(
        {"id": F.col("id") + 1, "field_name": F.concat("field_name", F.lit(".2"))}
    ).withColumn("field_name", F.when(F.col("field_name").contains('"'), F.concat(F.lit('"'), F.trim(F.regexp_replace("field_name", '[" ]|\\.2', "")), F.lit('".2'))).otherwise(F.col("field_name")))
    merged = source_model.relational_columns(fields.unionByName(later).withColumn("help", F.col("id").cast("string")), tables, PREFIX, "rel")
    return merged.select("table_code", "column_name", F.col("help").cast("bigint").alias("id"))


@check("source_refs", with_views(f"""SELECT source_ref FROM ({SRC_TABLES}) t UNION ALL SELECT source_ref FROM ({SRC_COLUMNS}) c"""))
def source_refs(inputs: Inputs) -> DataFrame:
    return unified(source_tables(inputs), source_columns(inputs)).select("source_ref")


# Scalar rules over whole tables ------------------------------------------------------------


@check(
    "scalar_suite",
    with_views(f"""SELECT id, {identifier('field_name')} AS identifier, 'csd_' || table_id AS warehouse_name, table_id AS code,
      regexp_replace({identifier('field_name')}, '^' || table_id || '_', '') AS column_name, 'wh.dw.core.csd_' || table_id AS fqn,
      {clean_text('label')} AS label, {multiline('description')} AS lines, {description('description')} AS described,
      {section('description', 'Description')} AS section, {clean_text('help')} IS NULL AS blank_help,
      CASE WHEN {clean_text('description')} IS NULL THEN 'blank' WHEN {clean_text('description')} = {clean_text('help')} THEN 'identical' ELSE 'differs' END AS state,
      lower({clean_text('label')}) IS NULL AS default_column, id % 5 < 4 AS default_table, 'k-' || id AS index_name,
      CASE id % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS flag FROM dict_fields"""),
)
def scalar_suite(inputs: Inputs) -> DataFrame:
    """N1-N16 on every field."""
    c = F.col
    number = c("id") % 5
    physical = F.concat(F.lit("csd_"), c("table_id"), F.lit("_x"))
    shown = (
        F.when(number == 0, F.lit("  "))
        .when(number == 1, F.upper(physical))
        .when(number == 2, F.replace(physical, F.lit("_"), F.lit(" ")))
        .when(number == 3, F.initcap(F.concat("table_id", F.lit(" x"))))
        .otherwise("curated")
    )
    flag = F.element_at(F.array(*[F.lit(v) for v in (" Yes", "1", "N", "false ", "maybe")]), (number + 1).cast("int"))
    name: Column = names.normalize_table_name(c("table_id"), PREFIX)
    return inputs.dict_fields.select(
        "id",
        names.clean_identifier(c("field_name")).alias("identifier"),
        name.alias("warehouse_name"),
        names.normalize_table_code(name, PREFIX).alias("code"),
        names.normalize_column_name(c("field_name"), c("table_id")).alias("column_name"),
        names.build_table_fqn(F.lit(" wh "), F.lit("dw"), F.lit("core "), name).alias("fqn"),
        text.clean_text(c("label")).alias("label"),
        text.clean_multiline_text(c("description")).alias("lines"),
        text.clean_description(c("description")).alias("described"),
        text.clean_legacy_section(c("description"), "Description").alias("section"),
        text.is_blank(c("help")).alias("blank_help"),
        text.description_state(c("description"), c("help")).alias("state"),
        names.is_default_column_display_name(c("label"), c("field_name")).alias("default_column"),
        names.is_default_table_display_name(shown, physical, PREFIX).alias("default_table"),
        names.clean_index_name(
            F.concat(F.lit("a/"), F.upper("table_id"), F.lit("_K-"), "id", F.lit(".htm")), c("table_id")
        ).alias("index_name"),
        names.parse_flag(flag).alias("flag"),
    )
