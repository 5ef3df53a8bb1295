from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from lexiframe.llm import substring_dedup as sd


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    places = defaultdict(list)
    for d, own in enumerate(words):
        for i in range(len(own) - window + 1):
            places[tuple(own[i : i + window])].append((d, i))
    gone = [set() for _ in rows]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d].update(range(i, i + window))
    out = []
    for (doc, _), own, cut in zip(rows, words, gone):
        out.append((doc, len(own), len(cut), " ".join(w for i, w in enumerate(own) if i not in cut)))
    return sorted(out, key=str)


def run(frame, window=35):
    rows = sd.substring_dedup(frame, window=window).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=str)


def test_whole_sample(docs, sample):
    assert run(docs(sample)) == brute(sample, 35)


@pytest.mark.parametrize("flush", [1, 48 << 20])
def test_shared_passages_of_all_shapes(docs, monkeypatch, flush):
    monkeypatch.setattr(sd, "FLUSH_BYTES", flush)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    rows = []
    for doc in range(60):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        if doc % 3 == 0:
            at, cut = rng.randrange(len(own) + 1), rng.randrange(20)
            own[at:at] = passage[cut : cut + rng.randrange(10, 50)]
        rows.append((doc, "\t".join(own[:20]) + "\n" + "  ".join(own[20:])))
    rows += [(100, " ".join(["a"] * 70)), (101, "a b " * 40), (102, rows[3][1]), (103, rows[3][1])]
    assert run(docs(rows), 12) == brute(rows, 12)


def test_edges(docs, spark):
    long = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (4, long), (None, long + " y"), (5, "é" * 300_000)]
    assert run(docs(rows)) == brute(rows, 35)
    assert run(docs([])) == []
