from __future__ import annotations

import re
from collections import defaultdict

import pytest
from tests_llm_brute import fold

from lexiframe.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    """(n_words, n_base, first, last, labels) by looking at every place."""
    words = WORD.findall(fold(text))
    places = []
    for label, phrase in license_scan.PHRASES:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def brute_labels(text, k=3):
    """(labels, score): diagonals of every template gathered, merged and measured in plain loops."""
    words, found = WORD.findall(fold(text)), []
    for label, phrase in license_scan.PHRASES:
        own = phrase.split()
        found += [(1.0, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    for label, notice in license_scan.TEMPLATES:
        own, diagonals = notice.split(), defaultdict(set)
        for t in range(len(own) - k + 1):
            for d in range(len(words) - k + 1):
                if words[d : d + k] == own[t : t + k]:
                    diagonals[d - t].add(t)
        chains, last = [], None
        for diagonal in sorted(diagonals):
            if last is None or diagonal - last > license_scan.DRIFT:
                chains.append([])
            chains[-1].append(diagonal)
            last = diagonal
        for chain in chains:
            low = min(d + t for d in chain for t in diagonals[d])
            high = max(d + t + k for d in chain for t in diagonals[d])
            whole = high - low <= license_scan.STRETCH * len(own)
            for part in [chain] if whole else [[d] for d in chain]:
                held = {t + i for d in part for t in diagonals[d] for i in range(k)}
                if len(held) / len(own) >= license_scan.COVERAGE:
                    found.append((len(held) / len(own), label))
    return ",".join(sorted({label for _, label in found})), max((s for s, _ in found), default=0.0)


def scanned(frame, text_col="text"):
    got = license_scan.license_scan(frame)
    return {r["doc_id"]: r for r in got.collect()}, got


NOTICE = dict((label, text) for label, text in license_scan.TEMPLATES)
MIT = NOTICE["mit"].split()
ROWS = {
    1: None,
    2: "",
    3: "Released under the MIT License.",
    4: "cc-by-nc CC BY NC cc by, nc; cc by-NC 4.0",
    5: "under the mit licence; under the mit",
    6: "Apache License, Version 2.0. Apache License Version 2 under the MIT license",
    7: " ".join(MIT),
    8: " ".join(MIT[:9] + ["really"] + MIT[9:20] + MIT[21:]),
    9: " ".join(MIT[: len(MIT) // 2]),
    10: "This work is licensed under the GNU General Public License, version 3.",
    11: "This fine work is licensed under the GNU General Public License, version 3 or later",
    12: "no licence at all, é ß ÀB 12",
    13: "x",
    14: "cc by nc " * 3000,
    15: " ".join((MIT + ["pause"] * 3) * 3),
    16: " ".join(reversed(MIT)),
}


def test_edges_agree_with_brute_force(docs):
    found, frame = scanned(docs(list(ROWS.items())))
    assert set(frame.columns) == {
        "doc_id", "lang", "source", "n_chars", "_id", "spans", "n_words", "n_base", "first_word", "last_word",
        "base_labels", "labels", "score",
    }
    for doc, text in ROWS.items():
        r = found[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text), doc
        assert (r.labels, r.score) == brute_labels(text), doc
        assert (r["_id"], r["spans"], r["source"]) == (1, "x", "s")
    assert found[4].n_base == 4 and found[14].last_word == 8997
    assert found[8].labels == "mit" and 0.7 < found[8].score < 1 and found[8].base_labels == ""
    assert found[9].labels == "" and found[16].labels == "" and found[11].labels == "gpl-3"


def test_real_texts_agree_with_brute_force(docs, sample):
    found, _ = scanned(docs(sample))
    assert any(r.n_base for r in found.values())
    for doc, text in sample:
        r = found[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert (r.labels, r.score) == brute_labels(text)


def test_repeated_rows_and_null_ids_are_judged_one_by_one(docs):
    rows = [(1, "under the mit license"), (1, "under the mit license"), (1, "cc by nc"), (None, None), (None, "cc by nc")]
    got = license_scan.license_scan(docs(rows)).select("doc_id", "n_words", "labels").collect()
    want = [(1, 4, "mit"), (1, 4, "mit"), (1, 3, "cc-by-nc"), (None, 0, ""), (None, 3, "cc-by-nc")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_templates_in_blocks_give_the_same_rows(docs, sample):
    frame = docs(sample[:80] + list(ROWS.items())[2:8])
    whole = license_scan.license_scan(frame).collect()
    assert sorted(map(str, license_scan.license_scan(frame, block_runs=20).collect())) == sorted(map(str, whole))


def test_an_empty_table_gives_no_rows_and_short_phrases_are_refused(docs):
    assert license_scan.license_scan(docs([])).collect() == []
    with pytest.raises(ValueError):
        license_scan.license_scan(docs([]), phrases=[("x", "two words")])


def test_no_templates_give_no_labels(docs):
    rows = license_scan.license_scan(docs([(3, "under the mit license")]), phrases=[], templates=[]).collect()
    assert [(r.n_words, r.n_base, r.labels, r.score) for r in rows] == [(4, 0, "", 0.0)]


def test_the_plan_has_no_python(docs):
    plan = license_scan.license_scan(docs([(3, "x")]))._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan
