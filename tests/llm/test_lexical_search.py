from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tests_llm_brute import fold

from lexiframe.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, items, k):
    docs = [(i, Counter(TERM.findall(fold(t)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, counts, n in docs:
            m = 100 - 50 + (50 * n * count) // length
            score = 0
            for term in set(TERM.findall(fold(text))):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[term] + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, at, doc, -score) for at, (score, _, doc) in enumerate(scored[:k], 1)]
    return found


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 7) for i, t in items], "item_id string, text string, doc_id long")


ROWS = [
    (9, "The cat SAT on the mat"), (4, "the cat sat on the mat"), (4, "the cat sat on the mat"), (None, "cat sat"),
    (None, "the cat sat on the mat"), (7, None), (8, ""), (1, "…!?"), (2, "ça ÇA 12 12x é"), (3, "dog " * 500 + "cat"),
    (5, "mat\0mat-mat"),
]
ITEMS = [("a", "cat mat"), ("b", "CAT, mat. cat"), ("b", "12 ça ÇA"), (None, "dog"), ("n", None), ("e", " "), ("u", "unknown zebra")]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_edges_agree_with_brute_force(spark, docs, k):
    got = lexical_search.rank_documents(docs(ROWS), items_table(spark, ITEMS), k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(ROWS, ITEMS, k), key=key)


def test_real_texts_in_several_blocks_and_tiles(spark, docs, sample, monkeypatch):
    for name, value in (("ITEM_TILE", 3), ("TERM_TILE", 16), ("TILE_CELLS", 200), ("CHUNK", 50)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(5)
    rows = sample[:60] + [(1000 + i, sample[i][1]) for i in range(8)]
    items = [(str(i), " ".join(rng.sample(sample[i][1].split(), 5))) for i in range(20) if len(sample[i][1].split()) > 5]
    got = lexical_search.rank_documents(docs(rows).repartition(5), items_table(spark, items), k=7, block_bytes=400)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, items, 7))


def test_empty_tables_give_no_rows(spark, docs):
    assert lexical_search.rank_documents(docs([]), items_table(spark, ITEMS)).collect() == []
    assert lexical_search.rank_documents(docs(ROWS), items_table(spark, [])).collect() == []


def test_sums_that_float64_cannot_hold_are_refused():
    assert lexical_search.TERM_TILE * lexical_search.weight(1, 10**12) * lexical_search.IMPACT_LIMIT < 1 << 53
    with pytest.raises(ArithmeticError):
        lexical_search.tiles([(0, [0])], np.array([1 << 40]))


def test_impacts_of_huge_documents_do_not_overflow():
    tf, n = np.array([3, 9_000_000_000]), np.array([2_000_000_000, 9_000_000_000])
    documents, length = 10**11, 10**14
    want = [10**9 * t // (1000 * t + 20 * (50 + 50 * s * documents // length)) for t, s in zip(tf.tolist(), n.tolist())]
    assert lexical_search.impacts(tf, n, documents, length).tolist() == want


def test_ties_at_the_last_place_are_settled_by_id():
    best = lexical_search.Best(2)
    none = np.zeros(3, bool)
    best.add(np.array([5, 5, 5]), np.array([9, 7, 8]), none)
    best.add(np.array([5, 5, 4]), np.array([1, 10, 0]), none)
    assert best.ids.tolist() == [1, 7]
    best.add(np.array([6, 5]), np.array([3, 2]), np.array([True, False]))
    assert (best.ids.tolist(), best.scores.tolist(), best.nameless.tolist()) == ([3, 1], [6, 5], [True, False])
