from __future__ import annotations

import hashlib

from lexiframe.llm import exact_dedup, line_dedup

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\f\r"


def brute_groups(rows):
    out = []
    for doc, text in rows:
        own = (text or "").translate(FOLD)
        ids = [i for i, t in rows if (t or "").translate(FOLD) == own]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(own.encode()).hexdigest()
        out.append((doc, keep, len(ids), keep is None or doc == keep, digest))
    return sorted(out, key=str)


ROWS = [(1, None), (2, ""), (3, "Ab É"), (4, "aB É"), (5, "ab é"), (5, "ab é"), (None, "q"), (None, "q")]
ROWS += [(6, "q "), (None, "ab é"), (7, "x" * 2_000_000), (8, "X" * 2_000_000)]


def groups(frame):
    return sorted(map(tuple, exact_dedup.exact_dedup(frame).collect()), key=str)


def test_groups(docs, sample):
    assert groups(docs(ROWS)) == brute_groups(ROWS)
    assert groups(docs(sample)) == brute_groups(sample)
    assert groups(docs([])) == []


def test_a_hot_group_goes_by_broadcast(docs):
    rows = [(i, "same" if i % 3 else f"t{i % 700}") for i in range(4000)]
    assert groups(docs(rows)) == brute_groups(rows)


def test_weak_digests_do_not_merge_texts(docs, monkeypatch):
    real = exact_dedup.F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: exact_dedup.F.substring(real(c, n), 1, 1))
    got = [r[:4] for r in groups(docs(ROWS))]
    assert sorted(got, key=str) == sorted((r[:4] for r in brute_groups(ROWS)), key=str)


def test_dropping_keeps_other_columns(docs):
    frame = docs(ROWS)
    kept = exact_dedup.drop_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, -1, 2, 4, 5, 5, 6, 8]


def brute_lines(rows, least=10):
    first = {}
    keys = []
    for doc, text in rows:
        own = [line.strip(BLANKS).translate(FOLD) for line in (text or "").split("\n")]
        keys.append(own)
        for key in own:
            if doc is not None and len(key) >= least:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, text), own in zip(rows, keys):
        lines = (text or "").split("\n")
        kept = [x for x, k in zip(lines, own) if doc is None or len(k) < least or first[k] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def lines(frame):
    rows = line_dedup.line_dedup(frame)
    return sorted(map(tuple, rows.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def test_lines(docs, sample):
    rows = [(9, None), (8, ""), (7, "\n\n"), (6, "A long line here\nshort\n\ta LONG line here \nother long line")]
    rows += [(5, "a long line here\na long line here\n x"), (5, "other long line\nz"), (4, "é" * 10 + "\n" + "é" * 9)]
    rows += [(3, "é" * 10 + "\n" + "é" * 9 + "\r"), (None, "a long line here"), (2, "b\n" * 100_000)]
    rows += [(1, "end of the line\n"), (10, "end of the line"), (10, "end of the line")]
    assert lines(docs(rows)) == brute_lines(rows)
    assert lines(docs(sample)) == brute_lines(sample)
    assert lines(docs([])) == []


def test_bitmap_runs(docs):
    rows = [(1, "first long line\nthird long line\nfourth long line"), (2, "0\nfirst long line\n2\nthird long line\nfourth long line")]
    found = {r["doc_id"]: r["keep_bitmap"] for r in line_dedup.line_dedup(docs(rows)).collect()}
    assert found == {1: None, 2: [1, 1, 1, 2, 0]}
