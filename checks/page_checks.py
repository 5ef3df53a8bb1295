"""Checks of page reading, extraction and the dictionary built from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.inputs import FOLDER, Inputs, sql
from checks.registry import check
from lexiframe.functions.text import collapse, tidy_lines
from lexiframe.functions.html import compose
from lexiframe.operators import dictionary, pages, relational
from lexiframe.plans.storage import stored
from lexiframe.sources.pages import decode_pages, module_pages, resolve_pages


def _joined(column: str) -> Column:
    return F.array_join(column, ",")


@check(
    "scan_pages",
    """SELECT 'docs/d' || doc_id || '.htm' AS path, 'd' || doc_id || '.htm' AS filename,
      regexp_replace(text, '\\r\\n?', chr(10), 'g') AS html, CAST(NULL AS VARCHAR) AS error FROM documents""",
)
def scan_pages(inputs: Inputs) -> DataFrame:
    return decode_pages(inputs.page_files)


@check(
    "module_pages",
    "SELECT DISTINCT 'Mod' || CAST(floor(s_suppkey / 50) AS BIGINT) || 'tbl.htm' AS filename FROM supplier",
)
def modules(inputs: Inputs) -> DataFrame:
    return module_pages(inputs.corpus).select("filename")


_LINKS = """SELECT * FROM (SELECT 'help/t' || s_suppkey || '_k-0.htm' AS path, 't' || s_suppkey || '_k-0.htm' AS filename,
    CASE WHEN s_suppkey % 5 <> 0 THEN 'help/t' || s_suppkey || '_k-0.htm' END AS resolved FROM supplier
  UNION ALL SELECT 'old/t' || s_suppkey || '_k-0.htm', 'old/t' || s_suppkey || '_k-0.htm',
    CASE WHEN s_suppkey % 5 <> 0 THEN 'help/t' || s_suppkey || '_k-0.htm' END FROM supplier
  UNION ALL SELECT NULL, 'c1.htm', 'help/c1.htm' FROM supplier) l"""


@check("resolve_pages", _LINKS)
def resolve(inputs: Inputs) -> DataFrame:
    """Links to the recorded place, to an old place, and many without a place to one page."""
    links = sql(
        inputs.spark,
        """
SELECT concat(f, '/t', s_suppkey, '_k-0.htm') AS path,
  concat(CASE WHEN f = 'old' THEN 'old/' ELSE '' END, 't', s_suppkey, '_k-0.htm') AS filename
FROM {s} LATERAL VIEW explode(array('help', 'old')) x AS f
UNION ALL SELECT NULL, 'c1.htm' FROM {s}""",
        s=inputs.table("supplier"),
    )
    return resolve_pages(links, inputs.corpus, FOLDER).select("path", "filename", "resolved")


@check(
    "page_rows",
    """
SELECT 't' || s_suppkey || 'tbl.htm' AS filename, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY k) - 1 AS INT) AS row_no,
  '0' AS in_table, text AS row_text, CAST(cells AS INT) AS cells, links
FROM (SELECT s_suppkey, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS k,
    unnest(['Indexes', 'k-0', ' ', 'Field', 'c1x', 'c2', '', 'Triggers:', 'Create p' || s_suppkey || '.p ']) AS text,
    unnest([1, 1, 1, 1, 2, 1, 1, 1, 3]) AS cells,
    unnest(['', 't' || s_suppkey || '_k-0.htm', '', '', 't' || s_suppkey || '_c1.htm,x.pdf', 't' || s_suppkey || '_c2.HTM', '', '', '']) AS links
  FROM supplier) r WHERE k <> 2 OR s_suppkey % 4 <> 0""",
)
def page_rows(inputs: Inputs) -> DataFrame:
    return pages.page_rows(pages.shred(inputs.table_pages)).select(
        "filename",
        "row_no",
        F.array_join(F.transform("in_table", lambda t: t.cast("string")), ",").alias("in_table"),
        "row_text",
        F.size("cells").alias("cells"),
        _joined("links").alias("links"),
    )


def _raw_pages(inputs: Inputs) -> DataFrame:
    return inputs.table("pages").select("page_id", "html")


@check(
    "page_titles",
    "SELECT page_id, replace(trim(regexp_extract(html, '<title>(.*?)</title>', 1)), '&amp;', '&') AS title FROM pages",
)
def page_titles(inputs: Inputs) -> DataFrame:
    return pages.page_titles(pages.shred(_raw_pages(inputs))).select("page_id", "title")


@check(
    "page_links",
    """
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INT) AS link_pos,
  regexp_extract(href, '([^/]*)$', 1) AS link_name, href AS link_path
FROM (SELECT page_id, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS k
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages) p) l
WHERE href LIKE '%.'""",
)
def page_links(inputs: Inputs) -> DataFrame:
    """The hrefs of these pages end in no file type, so a dot stands for one."""
    return pages.page_links(pages.shred(_raw_pages(inputs)), FOLDER, ".")


@check(
    "module_tables",
    """SELECT 'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) AS module_code,
      'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) || ' & more' AS module_title,
      CAST(row_number() OVER (PARTITION BY floor(s_suppkey / 50) ORDER BY s_suppkey) - 1 AS INT) AS table_pos,
      't' || s_suppkey || 'tbl.htm' AS filename, 'help/t' || s_suppkey || 'tbl.htm' AS path FROM supplier""",
)
def module_tables(inputs: Inputs) -> DataFrame:
    return dictionary.module_tables(inputs.corpus, FOLDER)


@check(
    "table_sections",
    """SELECT 't' || s_suppkey || 'tbl.htm' AS filename,
      CASE WHEN s_suppkey % 4 <> 0 THEN 't' || s_suppkey || '_k-0.htm' ELSE '' END AS index_hrefs,
      't' || s_suppkey || '_c1.htm,t' || s_suppkey || '_c2.HTM' AS field_hrefs FROM supplier""",
)
def table_sections(inputs: Inputs) -> DataFrame:
    return pages.table_sections(pages.shred(inputs.table_pages)).select(
        "filename", _joined("index_hrefs").alias("index_hrefs"), _joined("field_hrefs").alias("field_hrefs")
    )


@check(
    "table_triggers",
    "SELECT 't' || s_suppkey || 'tbl.htm' AS filename, 'Create,p' || s_suppkey || '.p' AS triggers FROM supplier",
)
def table_triggers(inputs: Inputs) -> DataFrame:
    found = pages.table_triggers(pages.shred(inputs.table_pages))
    lines = F.transform("triggers", lambda texts: F.array_join(texts, ","))
    return found.select("filename", F.array_join(lines, ";").alias("triggers"))


@check(
    "field_metadata",
    """SELECT 'c' || p_partkey || '.htm' AS filename, trim(p_name) AS label, trim(p_type) AS type, 'm' || p_size AS val_msg,
      '' AS val_exp, '' AS format, '' AS decimals, '' AS initial, '' AS extent, '' AS mandatory, '' AS help, '' AS trigger
      FROM part""",
)
def field_metadata(inputs: Inputs) -> DataFrame:
    return pages.field_metadata(pages.shred(inputs.field_pages)).drop("path", "html", "page", "error")


@check("field_indexes", "SELECT 'c' || p_partkey || '.htm' AS filename, 'k-' || p_size AS indexes FROM part")
def field_indexes(inputs: Inputs) -> DataFrame:
    return pages.field_indexes(pages.shred(inputs.field_pages)).select(
        "filename", _joined("indexes").alias("indexes")
    )


@check(
    "field_sections",
    """SELECT 'c' || p_partkey || '.htm' AS filename, trim(p_type) || chr(10) || trim(p_brand) AS description,
      CASE WHEN p_partkey % 3 = 0 THEN '1 = ' || trim(p_name) ELSE '' END AS content FROM part""",
)
def field_sections(inputs: Inputs) -> DataFrame:
    return pages.field_sections(pages.shred(inputs.field_pages)).select(
        "filename", "description", "content"
    )


@check(
    "index_pages",
    """SELECT 't' || s_suppkey || '_k-0.htm' AS filename, s_suppkey % 3 <> 1 AS is_primary, true AS is_unique,
      CAST(NULL AS BOOLEAN) AS is_word, field_sequence, CASE field_sequence WHEN 1 THEN 'cono' ELSE 'c' || s_suppkey END AS field_name,
      CASE field_sequence WHEN 1 THEN 'Ascending' ELSE 'Descending' END AS field_order, 'no' AS abbreviated
      FROM supplier, (SELECT CAST(unnest([1, 2]) AS BIGINT) AS field_sequence) f WHERE s_suppkey % 5 <> 0""",
)
def index_pages(inputs: Inputs) -> DataFrame:
    found = pages.index_pages(pages.shred(inputs.index_page_files))
    return found.select(
        "filename", "is_primary", "is_unique", "is_word", F.explode("fields").alias("f")
    ).select("filename", "is_primary", "is_unique", "is_word", "f.*")


@check(
    "clean_annotations",
    r"""SELECT doc_id, nfc_normalize(regexp_replace(text, '\s+', ' ', 'g')) AS collapsed,
      nfc_normalize(array_to_string(list_filter(list_transform(string_split_regex(text, '\r\n|\r|\n'),
        lambda z: trim(regexp_replace(z, '[ \t]+', ' ', 'g'))), lambda z: z <> ''), chr(10))) AS lines FROM documents""",
)
def clean_annotations(inputs: Inputs) -> DataFrame:
    """Whole documents in both ways of cleaning, in form NFC."""
    text = F.col("text")
    return (
        inputs.table("documents")
        .select("doc_id", compose(collapse(text), tidy_lines(text)).alias("v"))
        .select("doc_id", F.col("v")[0].alias("collapsed"), F.col("v")[1].alias("lines"))
    )


_FIELD_LINKS = """
SELECT s_suppkey, CAST(floor(s_suppkey / 50) AS BIGINT) AS b, k, s_suppkey * 20 - 19 + k AS p, (s_suppkey * 20 - 19 + k) % 10 <> 3 AS found
FROM supplier, (SELECT CAST(unnest(range(20)) AS INT) AS k) a WHERE s_suppkey % 13 <> 0"""


def _tables(inputs: Inputs) -> DataFrame:
    return dictionary.dictionary_tables(inputs.corpus, FOLDER)


@check(
    "dictionary",
    f"""SELECT 'MOD' || CAST(floor(s.s_suppkey / 50) AS BIGINT) AS module_code,
      'MOD' || CAST(floor(s.s_suppkey / 50) AS BIGINT) || ' & more' AS module_title, 't' || s.s_suppkey || 'tbl' AS table_name,
      't' || s.s_suppkey || 'tbl.htm' AS filename, CASE WHEN s.s_suppkey % 13 <> 0 THEN 'T' || s.s_suppkey || ' - ' || trim(s_name) END AS title,
      CASE WHEN s.s_suppkey % 13 <> 0 THEN CASE WHEN s.s_suppkey % 4 <> 0 THEN 'help/t' || s.s_suppkey || '_k-0.htm' ELSE '' END END AS indexes,
      fields, CAST(CASE WHEN s.s_suppkey % 13 <> 0 THEN 0 ELSE -1 END AS INT) AS triggers,
      CASE WHEN s.s_suppkey % 13 = 0 THEN 'page not found' END AS error
      FROM supplier s LEFT JOIN (SELECT s_suppkey, string_agg('help/' || CASE WHEN found THEN 'c' ELSE 'none' END || p || '.htm', ',' ORDER BY p) AS fields
        FROM ({_FIELD_LINKS}) l GROUP BY s_suppkey) f ON f.s_suppkey = s.s_suppkey""",
)
def dictionary_tables(inputs: Inputs) -> DataFrame:
    return flat_dictionary(_tables(inputs))


def flat_dictionary(tables: DataFrame) -> DataFrame:
    return tables.select(
        "module_code",
        "module_title",
        "table_name",
        "filename",
        "title",
        _joined("indexes.path").alias("indexes"),
        _joined("fields.path").alias("fields"),
        F.coalesce(F.size("triggers"), F.lit(-1)).alias("triggers"),
        "error",
    )


@check(
    "extract_audit",
    """SELECT count(DISTINCT floor(s_suppkey / 50)) AS total_modules, count(DISTINCT floor(s_suppkey / 50)) AS expected_modules,
      count(*) AS total_tables, count(*) FILTER (s_suppkey % 13 = 0) AS failed_tables FROM supplier""",
)
def extract_audit(inputs: Inputs) -> DataFrame:
    return dictionary.extract_audit(dictionary.dictionary_modules(inputs.corpus), _tables(inputs))


@check(
    "failed_tables",
    """SELECT 'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) AS module_code, 't' || s_suppkey || 'tbl' AS table_name,
      't' || s_suppkey || 'tbl.htm' AS filename, 'page not found' AS error FROM supplier WHERE s_suppkey % 13 = 0""",
)
def failed_tables(inputs: Inputs) -> DataFrame:
    return dictionary.failed_tables(_tables(inputs))


def _stored_tables(inputs: Inputs) -> DataFrame:
    """The dictionary as a stored table: annotation reads it several times."""
    return stored(_tables(inputs), "dictionary")


def _links(inputs: Inputs) -> DataFrame:
    return dictionary.annotation_links(_stored_tables(inputs), inputs.corpus)


_FIELDS = f"""
SELECT 'MOD' || b AS module_code, 't' || s_suppkey AS table_id, 'c' || p AS field_name, k AS field_pos, trim(p_name) AS label,
  trim(p_type) AS type, 'm' || p_size AS val_msg, 'k-' || p_size AS indexes, trim(p_type) || chr(10) || trim(p_brand) AS description,
  CASE WHEN p % 3 = 0 THEN '1 = ' || trim(p_name) ELSE '' END AS content
FROM ({_FIELD_LINKS}) l JOIN part ON p_partkey = p WHERE found"""


@check("annotate_fields", _FIELDS)
def annotate_fields(inputs: Inputs) -> DataFrame:
    return flat_fields(dictionary.annotate_fields(_links(inputs)))


def flat_fields(fields: DataFrame) -> DataFrame:
    return fields.select(
        "module_code", "table_id", "field_name", "field_pos", "label", "type", "val_msg",
        _joined("indexes").alias("indexes"), "description", "content",
    )


@check(
    "annotate_audit",
    f"""SELECT (SELECT count(DISTINCT floor(s_suppkey / 50)) FROM supplier) AS total_modules,
      (SELECT count(*) FROM supplier) AS total_tables, count(*) AS total_fields,
      count(*) FILTER (found) AS total_fields_processed, count(*) FILTER (NOT found) AS total_fields_failed
      FROM ({_FIELD_LINKS}) l""",
)
def annotate_audit(inputs: Inputs) -> DataFrame:
    tables = _stored_tables(inputs)
    links = dictionary.annotation_links(tables, inputs.corpus)
    return dictionary.annotate_audit(dictionary.dictionary_modules(inputs.corpus), tables, links)


# The relational model built from these pages ------------------------------------------------


@check(
    "rel_modules",
    """SELECT DISTINCT 'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) AS module_code,
      'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) || ' & more' AS module_title FROM supplier""",
)
def rel_modules(inputs: Inputs) -> DataFrame:
    return relational.rel_modules(dictionary.dictionary_modules(inputs.corpus))


@check(
    "rel_tables",
    """SELECT 't' || s_suppkey AS table_id, 'sxe.t' || s_suppkey AS table_name,
      'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) AS module_code,
      CASE WHEN s_suppkey % 13 <> 0 THEN 'T' || s_suppkey || ' - ' || trim(s_name) ELSE '' END AS table_title FROM supplier""",
)
def rel_tables(inputs: Inputs) -> DataFrame:
    return relational.rel_tables(dictionary.latest_tables(_tables(inputs)), "sxe")


@check(
    "rel_fields",
    f"""SELECT module_code || '/' || table_id || '/' || lpad(field_pos::VARCHAR, 10, '0') AS id, module_code, table_id, field_name,
      label, type AS field_type, '' AS format, '' AS decimals, '' AS initial, '' AS extent, '' AS mandatory, '' AS val_exp,
      val_msg, '' AS help, '' AS trigger, '["' || indexes || '"]' AS indexes, description, content FROM ({_FIELDS}) f""",
)
def rel_fields(inputs: Inputs) -> DataFrame:
    return relational.rel_fields(dictionary.annotate_fields(_links(inputs)))


def _index_entries(inputs: Inputs) -> DataFrame:
    links = relational.index_links(dictionary.latest_tables(_tables(inputs)))
    return relational.parsed_index_links(links, inputs.corpus, FOLDER)


_INDEX_ID = "'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) || '/t' || s_suppkey || '/0000000000'"
_WITH_INDEX = "s_suppkey % 13 <> 0 AND s_suppkey % 4 <> 0"


@check(
    "rel_indexes",
    f"""SELECT {_INDEX_ID} AS id, 'MOD' || CAST(floor(s_suppkey / 50) AS BIGINT) AS module_code, 't' || s_suppkey AS table_id,
      'k-0' AS index_name, CAST(CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN 0 ELSE 1 END AS INT) AS is_primary,
      CAST(CASE WHEN s_suppkey % 5 <> 0 THEN 1 END AS INT) AS is_unique, CAST(NULL AS INT) AS is_word,
      't' || s_suppkey || '_k-0.htm' AS source_file FROM supplier WHERE {_WITH_INDEX}""",
)
def rel_indexes(inputs: Inputs) -> DataFrame:
    return relational.rel_indexes(_index_entries(inputs))


@check(
    "rel_index_fields",
    f"""SELECT {_INDEX_ID} || '/' || lpad((field_sequence - 1)::VARCHAR, 10, '0') AS id, {_INDEX_ID} AS index_id, field_sequence,
      CASE field_sequence WHEN 1 THEN 'cono' ELSE 'c' || s_suppkey END AS field_name,
      CASE field_sequence WHEN 1 THEN 'Ascending' ELSE 'Descending' END AS field_order, 'no' AS abbreviated
      FROM supplier, (SELECT CAST(unnest([1, 2]) AS BIGINT) AS field_sequence) f WHERE {_WITH_INDEX} AND s_suppkey % 5 <> 0""",
)
def rel_index_fields(inputs: Inputs) -> DataFrame:
    return relational.rel_index_fields(_index_entries(inputs))
