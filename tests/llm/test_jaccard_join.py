from __future__ import annotations

import random
import re

import pytest

from lexiframe.llm import jaccard_join as jj


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(len(words) - 3, 1)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def run(frame, **options):
    return sorted(map(tuple, jj.jaccard_components(frame, **options).collect()), key=str)


def near_rows(seed, groups=12, chain=6):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 40, 90, 200]))]
        for _ in range(chain):
            rows.append((len(rows), " ".join(base)))
            for _ in range(rng.randrange(0, 3)):
                base = list(base)
                base[rng.randrange(len(base))] = f"u{rng.randrange(400)}"
    return rows


def test_whole_sample(docs, sample):
    assert run(docs(sample)) == brute(sample)


@pytest.mark.parametrize("tokens", [None, 300, 1500])
def test_chains_and_blocks(docs, tokens):
    rows = near_rows(3)
    assert run(docs(rows), block_tokens=tokens) == brute(rows)


def test_one_large_group_and_small_flushes(docs, monkeypatch):
    monkeypatch.setattr(jj, "FLUSH_TOKENS", 50)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        rows.append((500 - i, " ".join(own)))
    assert run(docs(rows), block_tokens=4000) == brute(rows)


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (5, "a b"), (None, "a b"), (6, "a b c d e")]
    rows += [(7, "a"), (8, "x " * 50_000), (9, "x x x x"), (None, "only null"), (10, "a b c d e\tf")]
    assert run(docs(rows)) == brute(rows)
    assert run(docs([])) == []


def test_large_block_against_others_matches_small_ones(docs):
    rows = near_rows(11, groups=4, chain=25)
    assert run(docs(rows), block_tokens=500) == brute(rows)
