"""Stages of the pipeline against the rules for stages, not against operators' defaults."""

from __future__ import annotations

import random
from fractions import Fraction

import corpus_pipeline
from tests_llm_brute import fold


def least_of_near(rows, words=5, similarity=Fraction(8, 10)):
    sets = {}
    for doc, text in rows:
        own = fold(text).split()
        sets[doc] = {tuple(own[i : i + words]) for i in range(max(len(own) - words + 1, 1))} if own else set()
    least = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                linked = sets[a] and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= similarity
                if linked and least[a] < least[b]:
                    least[b], changed = least[a], True
    return {d for d in sets if least[d] == d}


def test_near_copies_of_five_words_and_four_fifths(spark, docs):
    texts = []
    for case, (size, places) in enumerate([(100, [30, 70]), (420, range(20, 420, 45)), (100, [20, 50, 80])]):
        base = [f"w{case}x{i}" for i in range(size)]
        own = list(base)
        for at in places:
            own[at] = f"other{at}"
        texts += [base, own]
    for case, more in enumerate([36, 48, 49, 50, 60]):
        base = [f"a{case}x{i}" for i in range(200)]
        texts += [base, base + [f"b{i}" for i in range(more)]]
    rng = random.Random(1)
    for _ in range(20):
        base = [f"v{rng.randrange(300)}" for _ in range(90)]
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(90)] = "changed"
        texts += [base, own]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    kept = corpus_pipeline.drop_near_copies(spark, docs(rows), "")
    found = {r["doc_id"] for r in kept.collect()}
    assert found == least_of_near(rows)
    assert not found & {1, 3, 7, 9}
    assert {5, 15} <= found


def test_one_row_of_each_text_stays_where_ids_repeat(spark, docs):
    rows = [(1, "one"), (2, "ONE"), (2, "two"), (3, "two"), (3, "two"), (None, "q"), (None, "q"), (None, "two"), (4, "q1")]
    rows += [(5, None), (6, ""), (None, None)]
    frame = docs(rows)
    kept = corpus_pipeline.drop_exact_copies(spark, frame, "")
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(2, "ONE"), (3, "two"), (None, "q"), (4, "q1"), (6, "")], key=str)
    whole = corpus_pipeline.exact_dedup.drop_copies(frame, one_each=True)
    assert whole.schema == frame.schema


def test_near_copies_where_ids_repeat_or_are_null(spark, docs):
    base = [f"w{i}" for i in range(200)]
    near = " ".join(base[:199] + ["end"])
    text = " ".join(base)
    rows = [(None, text), (2, text), (1, near), (1, near), (None, "other text of its own here"), (None, None), (7, ""), (7, "")]
    rows += [(5, "other text of its own here"), (1, "words that nobody else has at all")]
    frame = docs(rows)
    kept = corpus_pipeline.jaccard_join.drop_near_copies(frame)
    assert kept.schema == frame.schema
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(1, near), (5, "other text of its own here"), (None, None), (7, ""), (7, ""), (1, "words that nobody else has at all")]
    assert found == sorted(want, key=str)
    only_null = docs([(None, text), (None, near)]).withColumnRenamed("_id", "_row")
    assert corpus_pipeline.jaccard_join.drop_near_copies(only_null).count() == 1
    assert corpus_pipeline.drop_near_copies(spark, docs([]), "").collect() == []
