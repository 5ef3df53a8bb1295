from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import oracle_connection

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = [rows]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == corpus_pipeline.COLUMNS
        docs = corpus_pipeline.stored(out, "test")
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
        assert kept[-1].items() <= kept[-2].items()
    assert kept[1] == kept[0]  # all have letters of a known language
    texts = {t.lower() for t in kept[1].values()}
    assert len(kept[2]) == len({t.lower() for t in kept[2].values()}) == len(texts)

    from tests_llm_brute import near_least, contaminated

    assert set(kept[3]) == near_least(kept[2])
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(kept[4]) == {i for i, t in kept[3].items() if not contaminated(t, items)}
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == set(kept[4])


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n.startswith("op")])
def test_queries_agree_with_sql(spark, name):
    frame = queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = oracle_connection(FOLDER).execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == want


@pytest.mark.parametrize(
    "name", ["op1_language", "op3_token_files", "op4_substring_dedup", "op6_toxicity", "op8_packing", "op9_jaccard_join"]
)
def test_one_result_for_each_document(spark, name):
    ids = [r[0] for r in queries()[name](spark, FOLDER).select("doc_id").distinct().collect()]
    want = duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/documents.parquet'").fetchall()
    assert sorted(ids) == sorted(w[0] for w in want)
