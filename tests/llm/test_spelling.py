from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests_llm_brute import fold

from lexiframe.llm import spelling


def words_of(rows, shortest=6, least=5, drop_every=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    forms, rows = {}, []
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(rows)


def result(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()))


ROWS = [
    (1, "Letters letters LETTERS, letters letters; " * 40), (2, "lettars lettars lettars lettars lettars letter " * 3),
    (None, "lettarz " * 6 + "aaaaaaa " * 5 + "aaaaaa " * 30), (None, "aaaaaaaa " * 150), (3, None), (4, ""), (4, "…1234"),
    (5, "école-école École fenêtre fenetre " * 9), (6, "x×÷yzab x×÷yza " * 5), (7, ("b" * 300 + " ") * 5 + ("b" * 299 + "c ") * 25),
    (8, "shorts short " * 7), (8, "shorts short " * 7), (9, "ÀÉÍÓÚÜß ÀÉÍÓÚÜ " * 5), (10, "ÿÿÿÿÿÿ ÿÿÿÿÿÿÿ " * 5 + "āletters " * 3),
]


def test_edges_agree_with_brute_force(spark, docs):
    want = brute(words_of(ROWS))
    assert {"lettars", "aaaaaaa", "b" * 300} <= {r[0] for r in want if r[1]}
    assert result(spelling.spelling_variants(docs(ROWS))) == want


def test_chains_of_forms_end_at_the_same_root(spark, docs):
    rows = [(1, "chains " * 5 + "chainz " * 25 + "chaznz " * 125 + "cqaznz " * 625)]
    got = {r[0]: r[2] for r in result(spelling.spelling_variants(docs(rows), drop_every=1 << 33))}
    assert got == dict.fromkeys(["chains", "chainz", "chaznz", "cqaznz"], "cqaznz")


def test_real_texts_with_small_filters_and_several_rounds(spark, docs, sample, monkeypatch):
    monkeypatch.setattr(spelling, "FILTER_WORDS", 40)
    monkeypatch.setattr(spelling, "STEP", 3000)
    rows = sample[:120]
    got = spelling.spelling_variants(docs(rows).repartition(3), drop_every=7, round_bytes=1500)
    assert result(got) == brute(words_of(rows, drop_every=7))


def test_an_empty_table_gives_no_rows(spark, docs):
    assert result(spelling.spelling_variants(docs([]))) == []
    assert result(spelling.spelling_variants(docs([(1, "rare words only")]))) == []


@pytest.mark.parametrize("length", [1, 2, 7, 40])
def test_hashed_edits_are_the_hashes_of_the_edited_words(length):
    """With filters that let everything pass, all edits come out, each once."""
    rng = random.Random(length)
    letters = "abcdeé"
    word = "".join(rng.choice(letters) for _ in range(length))
    full = np.full(64, (1 << 64) - 1, np.uint64)
    held = {spelling.length_class(n): (1, {0: full}) for n in (length - 1, length) if n}
    prober = spelling.Prober(held, letters.encode("latin-1"))
    codes = np.frombuffer(word.encode("latin-1"), np.uint8).reshape(1, -1)
    got = [e for _, e in prober.edits(codes)]
    fewer = {word[:i] + word[i + 1 :] for i in range(length)} - {""}
    changed = {word[:i] + c + word[i + 1 :] for i in range(length) for c in letters if c > word[i]}
    assert sorted(got) == sorted(fewer | changed)


def test_a_filter_lets_its_words_pass_and_few_others():
    rng = np.random.default_rng(1)
    own, others = rng.integers(0, 1 << 63, (2, 50_000), np.uint64)
    blocks = 50_000 * spelling.BITS_PER_WORD // 64
    bits = np.zeros(blocks, np.uint64)
    np.bitwise_or.at(bits, *spelling.filter_key(own, blocks))
    assert len(spelling.Prober._inside(own, bits)) == len(own)
    assert len(spelling.Prober._inside(others, bits)) < 0.02 * len(others)


def test_edits_that_only_the_filter_lets_pass_are_no_neighbours(spark, monkeypatch):
    """A filter of all ones passes every edit; the exact join removes the false ones."""
    monkeypatch.setattr(spelling.Prober, "_inside", staticmethod(lambda mixed, bits: np.arange(len(mixed))))
    words = spark.createDataFrame([("abcdef", 5), ("abcdeg", 6), ("abcde", 7), ("zzzzzz", 8)], "word string, n long")
    got = sorted(map(tuple, spelling.near_pairs(words).select("word", "other").collect()))
    want = [("abcdef", "abcdeg"), ("abcde", "abcdef"), ("abcde", "abcdeg")]
    assert got == sorted(want + [(b, a) for a, b in want])
