"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton is built once from the normalised items, whose number is bounded by the benchmark and
not by the corpus, and travels with the job. Documents stream through it; no document is shuffled
unless the benchmark needs several automata, whose hits are then joined to their documents.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.llm import shared
from lexiframe.llm.lexical_search import item_blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of items in one automaton, which takes about a hundred times as much memory. Larger benchmarks are cut
#: into several automata, through which the documents stream one after another.
BLOCK_BYTES = 2 << 20

# A-Z become a-z, other ASCII but digits and a-z separates words, all other bytes are letters.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences; states know the items that reach them.

    A word run matches as long as a transition exists; otherwise suffix links shorten it. `hits`
    names, for a state and a matched length, the windows that end there.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        full, whole = [], []
        for name, words in items:
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            last = 0
            for word in ids:
                last = self._extend(last, word)
            (full if len(words) >= window else whole).append((name, ids))
        self.shortest = min([window, *[len(ids) for _, ids in whole]])
        self._name_states(full, whole)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        new = self._state(length[last] + 1)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p == -1:
            link[new] = 0
        else:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _windows_at(self, state: int, size: int) -> int:
        """The state on the suffix path of `state` whose runs include the one of `size` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _name_states(self, full: list, whole: list) -> None:
        self.names: list[str] = []
        self.window_items: dict[int, set[int]] = {}
        self.short_items: dict[int, dict[int, set[int]]] = {}
        for name, ids in [*full, *whole]:
            number, state, size = len(self.names), 0, min(self.window, len(ids))
            self.names.append(name)
            for at, word in enumerate(ids, 1):
                state = self.next[state][word]
                if at < size:
                    continue
                if size == self.window:
                    found = self._windows_at(state, size)
                    self.window_items.setdefault(found, set()).add(number)
                elif at == size:
                    self.short_items.setdefault(state, {}).setdefault(size, set()).add(number)
        # Short items that end at a state lie on its suffix path; gathered once for all states.
        self.ends_here: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = self.short_items.get(state, {})
            above = self.ends_here[self.link[state]]
            self.ends_here[state] = tuple((n, frozenset(s)) for n, s in own.items()) + above

    def spans(self, ids: list[int], at: int) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word ranges that windows cover, moved by `at`, and the items that occur."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        state = size = 0
        for i, word in enumerate(ids):
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            longest = 0
            if size >= window:
                longest = window
                items |= self.window_items.get(self._windows_at(state, window), set())
            for n, own in self.ends_here[state]:
                if n <= size:
                    longest = max(longest, n)
                    items |= own
            if longest:
                start, end = at + i + 1 - longest, at + i + 1
                while found and found[-1][1] >= start:
                    start = min(start, found.pop()[0])
                found.append((start, end))
        return found, items

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Only runs of at least `shortest` words that the items know can hold a window."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        starts, ends = edges[::2], edges[1::2]
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        for a, b in zip(starts, ends):
            if b - a >= self.shortest:
                spans, own = self.spans(ids[a:b].tolist(), int(a))
                found += spans
                items |= own
        return found, items


def automata(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> Iterator[Automaton]:
    """One automaton for every block of items; at least one."""
    own = benchmark.select(F.col(item_col).cast("string").alias("_name"), F.col(text_col).alias("_text"))
    own = own.filter("_name IS NOT NULL")
    total = own.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    blocks = [own]
    if total > BLOCK_BYTES:
        numbered = shared.stored(own.withColumn("_item", F.monotonically_increasing_id()), "benchmark-items")
        blocks = item_blocks(numbered, BLOCK_BYTES)
    for block in blocks:
        rows = block.select("_name", "_text").collect()
        ordered = sorted(rows, key=lambda row: (row[0], row[1] or ""))
        yield Automaton([(name, words_of(text)) for name, text in ordered], window)


ADDED = ["n_words", "n_hit", "items", "spans"]

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", _SPAN),
]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """All columns of `docs` with `n_words`, `n_hit`, `items` and `spans` (word ranges).

    A window is `window` consecutive words of an item, or a shorter item as a whole; words are runs
    of digits, letters a-z (A-Z lower-cased) and all characters beyond ASCII. Null and empty texts
    have no words. Items without words or with a null id match nothing; items of equal id are
    named once. Rows that repeat an id are judged one by one. An empty benchmark hits nothing. The
    four result columns replace columns of the same names.
    """
    kept = docs.drop(*ADDED)
    machines = automata(benchmark, item_col, item_text_col, window)
    first, second = next(machines), next(machines, None)
    if second is None:
        schema = T.StructType([*kept.schema.fields, *_RESULT])
        return kept.mapInArrow(_judge(docs.sparkSession, first, text_col), schema)
    row = "_row"
    while row in {c.lower() for c in kept.columns}:
        row = f"_{row}"
    numbered = shared.stored(kept.withColumn(row, F.monotonically_increasing_id()), "numbered")
    narrow = numbered.select(row, F.col(f"`{text_col}`"))
    schema = T.StructType([*narrow.schema.fields, *_RESULT])
    found = None
    for machine in chain((first, second), machines):
        hits = narrow.mapInArrow(_judge(docs.sparkSession, machine, text_col), schema).filter("n_hit > 0")
        # Hits of a block are stored, so that only one automaton is in a worker's memory.
        hits = shared.stored(hits.select(row, "items", "spans"), "hits")
        found = hits if found is None else found.unionByName(hits)
    merged = found.groupBy(row).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    joined = numbered.join(merged, row, "left").drop(row)
    names = kept.columns

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.slices(batch, text_col):
                texts, items, spans = (part.column(c).to_pylist() for c in (text_col, "items", "spans"))
                whole = [merge([(s["start"], s["end"]) for s in own or ()]) for own in spans]
                counts = [len(words_of(t)) for t in texts]
                yield _with_result(part.select(names), counts, [i or [] for i in items], whole)

    return joined.mapInArrow(finish, T.StructType([*kept.schema.fields, *_RESULT]))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without those that overlap or touch."""
    found: list[tuple[int, int]] = []
    for start, end in spans:
        if found and found[-1][1] >= start:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def _with_result(
    part: pa.RecordBatch, n_words: list[int], items: list[list[str]], spans: list[list[tuple[int, int]]]
) -> pa.RecordBatch:
    columns = [
        pa.array(n_words, pa.int64()),
        pa.array([sum(b - a for a, b in own) for own in spans], pa.int64()),
        pa.array(items, pa.list_(pa.string())),
        pa.array([[{"start": a, "end": b} for a, b in own] for own in spans], _SPAN_TYPE),
    ]
    return pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *ADDED])


def _judge(spark: SparkSession, machine: Automaton, text_col: str):
    # Pickled with its class, so executors need no installed copy of this package.
    pickled = spark.sparkContext.broadcast(cloudpickle.dumps(machine))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(pickled.value)
        for batch in batches:
            for part in shared.slices(batch, text_col):
                words = [words_of(text) for text in part.column(text_col).to_pylist()]
                found = [own.scan(w) for w in words]
                items = [sorted({own.names[i] for i in known}) for _, known in found]
                yield _with_result(part, [len(w) for w in words], items, [spans for spans, _ in found])

    return judge


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = 10,
    max_span: int = 0,
    max_coverage: float = 0.0,
    **columns: str,
) -> DataFrame:
    """Rows of `docs` whose longest span has at most `max_span` words and whose hit words make up
    at most `max_coverage` of all words. Both at 0 keep only documents without any hit.

    Null and empty texts have no words and stay. Rows that repeat an id, or have none, are judged one by
    one; columns of any name come back as they were. An empty table gives no rows."""
    kept_as, moved = shared.set_aside(docs, ADDED)
    judged = contamination(kept_as, benchmark, text_col=text_col, window=window, **columns)
    longest = F.coalesce(F.array_max(F.transform("spans", lambda s: s["end"] - s["start"])), F.lit(0))
    share = F.when(F.col("n_words") > 0, F.col("n_hit") / F.col("n_words")).otherwise(0.0)
    kept = judged.filter((longest <= max_span) & (share <= max_coverage))
    return kept.select([F.col(f"`{c}`") for c in kept_as.columns]).withColumnsRenamed(moved)


def strip_spans(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", min_span: int = 1, **options
) -> DataFrame:
    """`docs` with every hit span of at least `min_span` words cut out of the text.

    Null texts stay null. Rows that repeat an id, or have none, are cut one by one; columns of any name
    come back as they were. An empty table gives no rows."""
    kept_as, moved = shared.set_aside(docs, ADDED)
    judged = contamination(kept_as, benchmark, text_col=text_col, **options)
    names = kept_as.columns
    schema = kept_as.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            texts = batch.column(text_col).to_pylist()
            done = [
                cut_words(t, [(s["start"], s["end"]) for s in own if s["end"] - s["start"] >= min_span])
                for t, own in zip(texts, spans)
            ]
            columns = [pa.array(done, pa.string()) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return judged.mapInArrow(cut, schema).withColumnsRenamed(moved)


def cut_words(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the ranges and what stands between them."""
    if not spans or text is None:
        return text
    data = text.encode()
    folded = np.frombuffer(data.translate(_FOLD), np.uint8) != 32
    padded = np.concatenate(([False], folded, [False]))
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*kept, data[at:]]).decode()


def items_digest(items: list[str] | None) -> str:
    return hashlib.sha256(",".join(items or []).encode()).hexdigest()
