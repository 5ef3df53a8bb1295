"""Ranked lexical search with dense blocks: item tiles times document tiles in float64.

Items are cut into tiles of a few dozen with a compact vocabulary each, documents into tiles of a
few hundred rows. The product of an item tile's weights and a document tile's impacts is one BLAS
call. All factors are whole numbers, and a vocabulary tile is short enough that no partial sum can
reach 2^53, so float64 is exact; sums over vocabulary tiles are 64-bit integers.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of item text worked on at once; more items are further blocks over all documents.
BLOCK_BYTES = 8 << 20
#: Items, terms and cells of a tile.
ITEM_TILE, TERM_TILE, TILE_CELLS = 64, 4096, 1 << 21
#: Bytes of one text that are split into terms at once.
CHUNK = 4 << 20
#: Groups that share the ranking of one item before it is settled.
SALTS = 64

#: Impacts stay below this, as 1e9 tf / (1000 tf + 20 m) does.
IMPACT_LIMIT = 10**6

# A-Z become a-z, other ASCII but digits and a-z separates terms, all bytes beyond ASCII are kept.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, as lists; a very long text gives several."""
    data = (text or "").encode().translate(_FOLD)
    first = 0
    while first < len(data):
        last = len(data)
        if last - first > CHUNK:
            last = data.find(b" ", first + CHUNK)
            last = len(data) if last < 0 else last
        yield data[first:last].split()
        first = last


def counted_terms(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """Number of terms with repeats, and how often each term of the vocabulary occurs."""
    total, counts = 0, Counter()
    for terms in terms_of(text):
        total += len(terms)
        counts.update(map(vocabulary.get, terms))
    counts.pop(None, None)
    return total, counts


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with at least one term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {term: i for i, term in enumerate(known.value)}
        for batch in batches:
            for part in shared.slices(batch, "text"):
                ids, sizes, ends, terms, tfs = [], [], [0], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    n, counts = counted_terms(text, places)
                    if n:
                        ids.append(doc)
                        sizes.append(n)
                        terms.extend(counts)
                        tfs.extend(counts.values())
                        ends.append(len(terms))
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tfs, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(1e9 tf) div (1000 tf + 20 m), where m = 50 + (50 n documents) div length."""
    if len(n) and int(n.max()) * 50 * documents >= 1 << 62:
        m = np.array([50 + 50 * int(x) * documents // length for x in n], np.int64)
    else:
        m = 50 + 50 * n * documents // max(length, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def tiles(items: list[tuple[int, list[int]]], weights: np.ndarray) -> list[dict]:
    """Tiles of items with their weights as a sparse matrix, term tile by term tile.

    Each has `items` (their numbers) and `parts`, a list of (terms, rows, columns, values): the
    compact vocabulary of the part, ascending, and its non-zero weights.
    """
    most = int(weights.max(initial=0))
    if TERM_TILE * most * IMPACT_LIMIT >= 1 << 53:
        raise ArithmeticError(f"weights up to {most} are too large for exact sums over {TERM_TILE} terms")
    found = []
    for first in range(0, len(items), ITEM_TILE):
        own = items[first : first + ITEM_TILE]
        terms = np.unique(np.array([t for _, ts in own for t in ts if weights[t] > 0], np.int64))
        pairs = np.array([(t, c) for c, (_, ts) in enumerate(own) for t in ts if weights[t] > 0], np.int64)
        pairs = pairs.reshape(-1, 2)
        rows = np.searchsorted(terms, pairs[:, 0])
        parts = []
        for low in range(0, len(terms), TERM_TILE):
            inside = (rows >= low) & (rows < low + TERM_TILE)
            cells = pairs[inside]
            parts.append((terms[low : low + TERM_TILE], rows[inside] - low, cells[:, 1], weights[cells[:, 0]]))
        found.append({"items": np.array([i for i, _ in own], np.int64), "parts": parts})
    return found


class Best:
    """The k best documents of one item so far: higher score, then smaller id, null ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        # Documents with the score of the last place may still win by their id.
        at = np.flatnonzero(scores >= self.least)
        if not len(at):
            return
        scores = np.concatenate((self.scores, scores[at]))
        ids = np.concatenate((self.ids, ids[at]))
        nameless = np.concatenate((self.nameless, nameless[at]))
        order = np.lexsort((ids, nameless, -scores))[: self.k]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def products(tile: dict, owner: np.ndarray, terms: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Scores of a document tile (rows) for an item tile (columns) as 64-bit integers."""
    width = len(tile["items"])
    total = np.zeros((rows, width), np.int64)
    for vocabulary, at, column, weights in tile["parts"]:
        matrix = np.zeros((len(vocabulary), width))
        matrix[at, column] = weights
        place = np.searchsorted(vocabulary, terms)
        place[place == len(vocabulary)] = 0
        known = vocabulary[place] == terms
        dense = np.zeros((rows, len(vocabulary)))
        dense[owner[known], place[known]] = values[known]
        total += (dense @ matrix).astype(np.int64)
    return total


def scored(rows: DataFrame, tiled: list[dict], documents: int, length: int, k: int) -> DataFrame:
    """(_item, doc_id, score): the best k documents of every task for each item."""
    shared_tiles = rows.sparkSession.sparkContext.broadcast(tiled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared_tiles.value
        widest = max((len(p[0]) for t in own for p in t["parts"]), default=1)
        step = max(1, min(1024, TILE_CELLS // max(widest, 1)))
        best = [[Best(k) for _ in t["items"]] for t in own]
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                column = part.column("doc_id")
                nameless = column.is_null().to_numpy(zero_copy_only=False)
                ids = column.fill_null(0).to_numpy()
                counts = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(part.num_rows), counts)
                terms = part.column("terms").flatten().to_numpy()
                tf = part.column("tfs").flatten().to_numpy().astype(np.int64)
                values = impacts(tf, part.column("n").to_numpy()[owner], documents, length)
                for tile, bests in zip(own, best):
                    scores = products(tile, owner, terms, values, part.num_rows)
                    for j, one in enumerate(bests):
                        one.add(scores[:, j], ids, nameless)
        for tile, bests in zip(own, best):
            sizes = [len(b.ids) for b in bests]
            ids = np.concatenate([b.ids for b in bests])
            columns = [
                pa.array(np.repeat(tile["items"], sizes)),
                pa.array(ids, pa.int64(), mask=np.concatenate([b.nameless for b in bests])),
                pa.array(np.concatenate([b.scores for b in bests])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_item", "doc_id", "score"])

    return rows.mapInArrow(run, "_item long, doc_id long, score long")


def item_blocks(items: DataFrame, most: int = BLOCK_BYTES) -> list[DataFrame]:
    """`items` in parts whose texts have at most `most` bytes, or that are a single row."""
    size = F.coalesce(F.octet_length("_text"), F.lit(0)) + 64
    blocks = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // most))
    while True:
        marked = items.withColumn("_block", F.pmod(F.xxhash64("_item"), F.lit(blocks)))
        sums = marked.groupBy("_block").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("c"))
        if blocks == 1 or sums.filter((F.col("b") > most) & (F.col("c") > 1)).isEmpty():
            return [marked.filter(F.col("_block") == b) for b in range(blocks)]
        blocks *= 2


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `k` best documents of each item, best first.

    Terms are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. Only scores
    above 0 count; equal scores rank by ascending id, null ids last. Null and empty texts have no
    terms: such documents count nowhere and such items have no rows. Every row of `docs` is a document and
    every row of `items` an item of its own, so repeated ids give repeated results. Other columns,
    whatever their names, are ignored; empty tables give no rows.
    """
    own = items.select(
        F.monotonically_increasing_id().alias("_item"),
        F.col(item_col).alias("item_id"),
        F.col(item_text_col).alias("_text"),
    )
    own = shared.stored(own, "search-items")
    found = None
    for block in item_blocks(own, block_bytes):
        rows = block.select("_item", "_text").collect()
        texts = [(i, sorted({t for terms in terms_of(text) for t in terms})) for i, text in sorted(rows)]
        vocabulary = sorted({t for _, terms in texts for t in terms})
        places = {t: i for i, t in enumerate(vocabulary)}
        sparse = shared.stored(postings(docs, vocabulary, id_col, text_col), "postings")
        documents, length = sparse.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = sparse.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in counted:
            weights[term] = weight(df, documents)
        tiled = tiles([(i, [places[t] for t in terms]) for i, terms in texts], weights)
        best = scored(sparse.filter(F.size("terms") > 0), tiled, documents, length, k)
        found = best if found is None else found.unionByName(best)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Many tasks name k documents for one item: they are ranked in salted groups first.
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    inner = Window.partitionBy("_item", "_salt").orderBy(*order)
    some = salted.withColumn("_r", F.row_number().over(inner)).filter(F.col("_r") <= k)
    outer = Window.partitionBy("_item").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(outer)).filter(F.col("rank") <= k)
    return ranked.join(own.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")
