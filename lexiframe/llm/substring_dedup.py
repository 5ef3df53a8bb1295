"""Removal of passages that repeat anywhere, by super-k-mers.

Every window of `window` words has a minimiser: the word group with the smallest hash inside it.
Consecutive windows with the same minimiser travel as one packed string to the bucket of that hash;
windows that are equal have equal minimisers, so they meet in one bucket. There, strings that share
a minimiser are cut into windows and sorted, which counts windows by content, not by hash.

Skew: a task first puts its equal strings together, marks them itself, and sends one copy without
places, so a string that fills a third of the corpus arrives at most once for each flush of a task.
Word groups that are frequent everywhere get the last ranks as minimisers; passages around them are
spread by the rarer words of their windows.
"""

from __future__ import annotations

import hashlib
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm import shared, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words in the group that serves as minimiser.
GROUP = 4
#: A word group is frequent if it is more than this share of all; at most 1/SHARE groups are.
SHARE = 1 / 16384
#: Bytes of packed strings that a task gathers before it sends them.
FLUSH_BYTES = 48 << 20

_LAST = np.uint64(1 << 63)
_PACKED = "bucket int, packed binary, size long, keys binary, ids array<long>, rows array<long>, starts array<int>, stops array<int>"
_MARKS = "_id long, _row long, start int, stop int"


def _word_groups(batch: pa.RecordBatch):
    data, offsets = shared.text_bytes(batch.column("_text"))
    starts, ends, firsts = words.split(data, offsets)
    return data, starts, ends, firsts, words.grams(words.hashes(data, starts, ends), GROUP)


def frequent_groups(texts: DataFrame) -> np.ndarray:
    """Hashes of word groups with more than SHARE of all; they only change where windows travel.

    A block of text reports groups above that share of the block, so each frequent group is
    reported by the blocks that hold most of it. Sums below the share are discarded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.slices(batch, "_text"):
                values = np.sort(_word_groups(part)[-1])
                edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
                if not len(values):
                    continue
                sizes = np.diff(np.append(edges, len(values)))
                often = sizes > max(16, len(values) * SHARE)
                out = [np.append(values[edges[often]], 0), np.append(sizes[often], len(values))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0].view(np.int64)), pa.array(out[1])], ["gram", "n"]
                )

    sums = texts.select("_text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = sums.filter("gram = 0").first()
    if total is None:
        return np.empty(0, np.uint64)
    often = sums.filter((F.col("gram") != 0) & (F.col("n") > total["n"] * SHARE)).select("gram")
    return np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))


class _Packer:
    """Packed strings of one task, by bucket, until they are sent."""

    def __init__(self, window: int, buckets: int, frequent: np.ndarray):
        self.window, self.buckets, self.frequent = window, buckets, frequent
        self.clear()

    def clear(self) -> None:
        self.bytes = 0
        self.strings: dict[bytes, int] = {}
        self.keys: list[int] = []
        self.where: list[tuple[int, int, int]] = []
        self.marks: list[tuple[int, int, int, int]] = []
        self.again: set[int] = set()

    def add(self, batch: pa.RecordBatch) -> None:
        data, starts, ends, firsts, grams = _word_groups(batch)
        window, strings = self.window, self.strings
        if len(starts) < window:
            return
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
            grams = np.where(self.frequent[at] == grams, grams | _LAST, grams & ~_LAST)
        chosen = words.least(grams, window - GROUP + 1)
        # Windows lie within one text; runs of the same minimiser are one string.
        text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        valid = text_of[: len(chosen)] == text_of[window - 1 :]
        if not valid.any():
            return
        chosen = np.where(valid, chosen, -1)
        edges = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        lengths = np.diff(np.append(edges, len(chosen)))
        real = chosen[edges] >= 0
        edges, lengths = edges[real], lengths[real]
        packed, places = words.joined(data, starts, ends)
        texts = text_of[edges]
        columns = (
            places[edges].tolist(),
            (places[edges + lengths + window - 1] - 1).tolist(),
            grams[chosen[edges]].tolist(),
            batch.column("_id").take(pa.array(texts)).to_pylist(),
            batch.column("_row").take(pa.array(texts)).to_pylist(),
            (edges - firsts[texts]).tolist(),
            lengths.tolist(),
        )
        for a, b, key, doc, row, start, n in zip(*columns):
            string = packed[a:b]
            known = strings.get(string)
            if known is None:
                strings[string] = len(self.keys)
                self.keys.append(key)
                self.where.append((doc, row, start))
                self.bytes += b - a
                continue
            if known not in self.again:
                self.again.add(known)
                self.marks.append((*self.where[known], self.where[known][2] + n + window - 1))
            self.marks.append((doc, row, start, start + n + window - 1))

    def flush(self) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        for string, i in self.strings.items():
            found = by_bucket[(self.keys[i] >> 8) % self.buckets]
            found[0].append(string)
            found[1].append(i)
        places = np.array([0 if i in self.again else 1 for i in range(len(self.keys))], bool)
        for bucket, (strings, numbers) in by_bucket.items():
            raw = b"\n".join(strings)
            own = [self.where[i] for i in numbers]
            keys = np.array([self.keys[i] for i in numbers], np.uint64).astype(np.uint32)
            row = {
                "bucket": bucket,
                "packed": pa.compress(raw, "zstd", asbytes=True),
                "size": len(raw),
                "keys": keys.tobytes(),
                "ids": [x[0] for x in own],
                "rows": [x[1] for x in own],
                "starts": [x[2] for x in own],
                # -1: places of this string are marked already, it only stands for being there.
                "stops": [0 if places[i] else -1 for i in numbers],
            }
            yield pa.RecordBatch.from_pylist([row], _schema())
        for first in range(0, len(self.marks), 50_000):
            part = self.marks[first : first + 50_000]
            row = dict(zip(("ids", "rows", "starts", "stops"), map(list, zip(*part))))
            row["bucket"] = (part[0][1] + first) % self.buckets
            yield pa.RecordBatch.from_pylist([row], _schema())
        self.clear()


def _schema() -> pa.Schema:
    long, number = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema(
        [("bucket", pa.int32()), ("packed", pa.binary()), ("size", pa.int64()), ("keys", pa.binary())]
        + [("ids", long), ("rows", long), ("starts", number), ("stops", number)]
    )


def repeated_windows(strings: list[bytes], seen: list[bool], window: int) -> list[list[bool]]:
    """Which windows of each string occur elsewhere; a string in `seen` occurs more than once."""
    marked: list[list[bool]] = []
    rows: list[tuple[bytes, int, int]] = []
    for j, string in enumerate(strings):
        parts = string.split(b" ")
        ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
        begins = [0, *ends]
        n = len(parts) - window + 1
        marked.append([seen[j]] * n)
        rows += [(string[begins[i] : ends[i + window - 1] - 1], j, i) for i in range(n)]
    rows.sort()
    for (a, j, i), (b, k, m) in zip(rows, rows[1:]):
        if a == b:
            marked[j][i] = marked[k][m] = True
    return marked


def _count_bucket(rows: list[dict], window: int) -> Iterator[tuple[int, int, int, int]]:
    strings: list[bytes] = []
    keys, where = [], []
    for row in rows:
        if row["packed"] is None:
            yield from zip(row["ids"], row["rows"], row["starts"], row["stops"])
            continue
        strings += pa.decompress(row["packed"], row["size"], "zstd", asbytes=True).split(b"\n")
        keys.append(np.frombuffer(row["keys"], np.uint32))
        where += zip(row["ids"], row["rows"], row["starts"], row["stops"])
    if not strings:
        return
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1], [True])))
    for a, b in zip(edges[:-1], edges[1:]):
        group = order[a:b]
        if b - a == 1 and where[group[0]][3] == 0:
            continue  # a minimiser that stands in one place has no equal windows
        places: dict[bytes, list[tuple]] = defaultdict(list)
        for i in group:
            places[strings[i]].append(where[i])
        seen = [len(own) > 1 or own[0][3] < 0 for own in places.values()]
        found = repeated_windows(list(places), seen, window) if len(places) > 1 else None
        for j, own in enumerate(places.values()):
            own = [x for x in own if x[3] == 0]
            if not own:
                continue
            if found is None:
                if seen[j]:
                    n = next(iter(places)).count(b" ") + 1
                    yield from ((doc, row, start, start + n) for doc, row, start, _ in own)
                continue
            flags = np.concatenate(([False], found[j], [False]))
            changes = np.flatnonzero(flags[1:] != flags[:-1])
            for s, e in zip(changes[::2].tolist(), changes[1::2].tolist()):
                yield from ((doc, row, start + s, start + e + window - 1) for doc, row, start, _ in own)


def repeated_spans(texts: DataFrame, window: int) -> DataFrame:
    """(_id, _row, start, stop): word ranges of `texts` (_id, _row, _text) that repeated windows cover."""
    spark = texts.sparkSession
    frequent = frequent_groups(texts)
    parts = shared.shuffle_partitions(spark)
    buckets = parts * 4

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, buckets, frequent)
        for batch in batches:
            for part in shared.slices(batch, "_text"):
                packer.add(part)
                if packer.bytes > FLUSH_BYTES:
                    yield from packer.flush()
        yield from packer.flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables(marks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            rows = []
            for mark in marks:
                rows.append(mark)
                if len(rows) == 100_000:
                    yield as_batch(rows)
                    rows = []
            if rows:
                yield as_batch(rows)

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            ids, own, starts, stops = zip(*rows)
            columns = [pa.array(ids, pa.int64()), pa.array(own, pa.int64())]
            columns += [pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["_id", "_row", "start", "stop"])

        current, rows = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["bucket"] != current and rows:
                    yield from tables(_count_bucket(rows, window))
                    rows = []
                current = row["bucket"]
                rows.append(row)
        if rows:
            yield from tables(_count_bucket(rows, window))

    packed = texts.mapInArrow(pack, _PACKED)
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(count, _MARKS)


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35
) -> DataFrame:
    """(id, n_words, n_removed, kept_text, kept_sha256) of every row of `docs`.

    Words are runs of characters other than space, tab and line breaks, unchanged. Each word that
    is covered by a window of `window` words occurring at another place as well, in any document, is
    removed; the others are joined by one space. Windows are judged on the input. Null and empty
    texts have no words. Rows that repeat an id, and rows with a null id, are documents of their
    own, so equal rows remove each other's windows. Other columns are ignored.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(text_col).alias("_row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    marks = shared.stored(
        repeated_spans(texts, window)
        .groupBy("_id", "_row")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans")),
        "repeated-spans",
    ).select(F.col("_id").alias("_mark_id"), F.col("_row").alias("_mark_row"), "spans")
    same = (F.col("_row") == F.col("_mark_row")) & F.col("_id").eqNullSafe(F.col("_mark_id"))
    joined = texts.join(marks, same, "left").select("_id", "_text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.slices(batch, "_text"):
                out = [[], [], [], []]
                for text, spans in zip(part.column("_text"), part.column("spans").to_pylist()):
                    found = text.as_buffer().to_pybytes().split()
                    kept = found
                    if spans:
                        mask = np.ones(len(found), bool)
                        for span in spans:
                            mask[span["start"] : span["stop"]] = False
                        kept = [found[i] for i in np.flatnonzero(mask)]
                    whole = b" ".join(kept)
                    out[0].append(len(found))
                    out[1].append(len(found) - len(kept))
                    out[2].append(whole.decode())
                    out[3].append(hashlib.sha256(whole).hexdigest())
                types = (pa.int64(), pa.int64(), pa.string(), pa.string())
                columns = [part.column("_id"), *map(pa.array, out, types)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
                )

    kept = joined.mapInArrow(
        keep, "_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
    return kept.withColumnRenamed("_id", id_col)
