"""The operators as queries over the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.llm import (
    decontaminate,
    exact_dedup,
    jaccard_join,
    language,
    lexical_search,
    license_scan,
    line_dedup,
    oracles,
    packing,
    spelling,
    substring_dedup,
    token_files,
    toxicity,
    warc,
)
from lexiframe.plans.storage import new_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    told = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.identify(told, model).drop("text")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-files")
    docs = table(spark, folder, "documents")
    token_files.write_tokens(docs, path, tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_files.token_digests(spark, path)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(~language.held_out())
    model = toxicity.fit(docs, labels)
    told = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return toxicity.toxicity(told, model).drop("text")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"), shingle=4, percent=85)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_warc(warc.page_records(table(spark, folder, "pages")), path)
    return warc.archived_pages(spark, path)


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return lexical_search.rank_documents(docs, items, k=50)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language": op1_language,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_files": op3_token_files,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_warc": op10_warc,
    "op11_license_scan": op11_license_scan,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
""",
    "op5_decontaminate": r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM fold, sizes WHERE len(w) >= n)
), found AS (SELECT doc_id, i, g.n, item FROM grams g JOIN windows v ON g.win = v.win AND g.n = v.n),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT f.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM fold f LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), firsts AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN firsts USING (key) GROUP BY doc_id
""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5) AS INT) >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
""",
    "op11_license_scan": oracles.LICENSE_SCAN,
    "op12_lexical_search": oracles.LEXICAL_SEARCH,
    "op13_spelling_variants": oracles.SPELLING,
}
