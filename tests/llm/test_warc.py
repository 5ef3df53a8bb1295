from __future__ import annotations

import gzip
import io
import random

import pytest

from lexiframe.llm import warc


@pytest.fixture
def pages(spark):
    def make(rows):
        schema = "page_id long, url string, html string, record_type string, _id int"
        return spark.createDataFrame([(i, f"http://x/{i}\n", h, "z", 1) for i, h in rows], schema)

    return make


def brute(rows, least=0):
    out = []
    for page, html in rows:
        body = (html or "").encode()
        same = [i for i, h in rows if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        late = len(body) >= least and first is not None and page != first
        out.append((page, len(body), warc.digest(body), "revisit" if late else "response", first if late else None))
    return sorted(out, key=str)


def archived(spark, frame, path, least=0, **options):
    warc.write_warc(warc.page_records(frame, least=least), path, **options)
    return sorted(map(tuple, warc.archived_pages(spark, path).collect()), key=str)


ROWS = [(3, "a"), (1, "b\r\n\r\nWARC/1.1\r\n\r\n"), (2, "a"), (5, None), (4, ""), (6, "é" * 200_000), (9, "a")]
ROWS += [(10, "x"), (10, "x"), (None, "a"), (None, "only"), (11, "é" * 200_000)]


@pytest.mark.parametrize("least", [0, 2])
def test_pages_come_back(spark, pages, tmp_path, least):
    got = archived(spark, pages(ROWS), str(tmp_path / "w"), least, file_bytes="100")
    assert got == brute(ROWS, least)


def test_empty_table(spark, pages, tmp_path):
    assert archived(spark, pages([]), str(tmp_path / "w")) == []


def test_filters_reach_the_headers(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(warc.page_records(pages(ROWS)), path)
    found = warc.read_warc(spark, path)
    want = brute(ROWS)
    assert found.filter("record_type = 'revisit'").count() == sum(r[3] == "revisit" for r in want)
    assert found.filter("record_type IN ('response', 'metadata')").count() == sum(r[3] == "response" for r in want)
    assert found.filter("target_uri LIKE 'http://x/1%'").count() == 4
    assert found.filter("content_length > 100").count() == 1
    assert warc.read_warc(spark, path, payloads=False).filter("payload IS NOT NULL").count() == 0


def test_unwanted_payloads_are_not_inflated():
    made = [warc.member(warc.record({"WARC-Type": t}, b"x" * 5_000_000)) for t in ("a", "b", "a")]
    data = b"".join(made)

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            Counting.taken += len(got)
            return got

    calls = []
    real = warc.zlib.decompressobj

    class Spy:
        def __init__(self, bits):
            self.inner = real(bits)

        def decompress(self, source, most):
            got = self.inner.decompress(source, most)
            calls.append(len(got))
            return got

        def __getattr__(self, name):
            return getattr(self.inner, name)

    warc.zlib.decompressobj, kept = Spy, warc.zlib.decompressobj
    try:
        found = list(warc.records(Counting(data), len(data), lambda h: h["WARC-Type"] == "b", True))
    finally:
        warc.zlib.decompressobj = kept
    assert [(h["WARC-Type"], n, len(p)) for h, n, p in found] == [("b", 5_000_000, 5_000_000)]
    assert sum(calls) < 5_100_000


@pytest.mark.parametrize("form", ["plain", "members", "own", "stream", "triples"])
def test_archives_of_other_writers(form):
    rng = random.Random(2)
    bodies = [rng.randbytes(rng.choice([0, 3, 70_000, 200_000])) for _ in range(12)]
    made = [warc.record({"WARC-Type": "r", "X": str(i)}, b) for i, b in enumerate(bodies)]
    pack = {"plain": bytes, "members": gzip.compress, "own": warc.member}.get(form)
    if form == "stream":  # a whole archive as one gzip member
        data = gzip.compress(b"".join(made))
    elif form == "triples":
        data = b"".join(gzip.compress(b"".join(made[i : i + 3])) for i in range(0, 12, 3))
    else:
        data = b"".join(map(pack, made))
    for wanted in (lambda h: True, lambda h: int(h["X"]) % 3 == 0):
        for payloads in (True, False):
            got = list(warc.records(io.BytesIO(data), len(data), wanted, payloads))
            want = [i for i in range(12) if wanted({"X": str(i)})]
            assert [int(h["X"]) for h, _, _ in got] == want
            assert [p for _, _, p in got] == [bodies[i] if payloads else None for i in want]
            assert [n for _, n, _ in got] == [len(bodies[i]) for i in want]
