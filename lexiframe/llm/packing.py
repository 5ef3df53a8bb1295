"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

Pieces and gaps are whole numbers of tokens up to the capacity, so range-sorting them leaves at
most `capacity` size classes on either side, and all members of a class are alike. A round takes
the largest class of pieces left, matches it with its successors among the gaps (the smallest gap
that is large enough first), settles conflicts by rank (piece number r of a class takes place number
r of the gaps), and updates the gaps. Rounds run over class counts, whose size is bounded by the
capacity and not by the data; ranks, and the places that follow from them, are found by Spark.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm import encode, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP_BYTES = 1 << 20
#: Buckets that split a size class while ranks are counted.
RANK_BUCKETS = 64

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Each document's ids with end_id, cut into pieces of `capacity`; the last may be shorter."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encode.encoder(tokenizer)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in shared.slices(batch, "text", STEP_BYTES):
                out: list[list] = [[], [], [], [], []]
                found = own.ids([t or "" for t in part.column("text").to_pylist()])
                for doc, ids in zip(part.column("doc_id").to_pylist(), found):
                    whole = np.concatenate((ids, end)).astype("<u4")
                    for piece, at in enumerate(range(0, len(whole), capacity)):
                        cut = whole[at : at + capacity]
                        row = (doc, piece, at, len(cut), zlib.crc32(cut))
                        for column, value in zip(out, row):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out, types)), names)

    return texts.mapInArrow(run, _PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for each size class: (length, first rank, first sequence, pieces a sequence, offset).

    Pieces of a class from `first rank` on fill sequences from `first sequence` on, so many in each,
    the first of them at `offset`; the next row of the class, if any, ends it. This is the result of
    best fit over all pieces in falling order. Sequences with the same gap are kept as runs of
    neighbouring numbers, and every round splits at most one run.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, how many)
    gaps: list[int] = []  # sizes of gaps that exist, ascending
    placed: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, number = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(at)
            else:
                gap, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            fit = gap // length
            taken = min(left, fit * number)
            placed.append((length, rank, first, fit, capacity - gap))
            full, rest = divmod(taken, fit)
            add(gap - fit * length, first, full)
            if rest:
                add(gap - rest * length, first + full, 1)
            used = full + (rest > 0)
            add(gap, first + used, number - used)
            left -= taken
            rank += taken
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Only documents longer than `capacity` are cut. Null and empty texts are end_id alone. Rows that
    repeat an id, or have none, are packed as documents of their own. Other columns are ignored; an
    empty table gives no pieces. Sequence numbers are consecutive from 0, offsets have no gaps.
    """
    cut = shared.stored(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    # A class may hold a third of all pieces; its ranks are counted bucket by bucket.
    bucket = F.pmod(F.xxhash64("doc_id", "ids_crc32"), F.lit(RANK_BUCKETS))
    rows = cut.withColumn("_bucket", bucket)
    sizes = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).collect()
    counts: dict[int, int] = defaultdict(int)
    ahead = []
    for length, own, n in sorted(map(tuple, sizes)):
        ahead.append((length, own, counts[length]))
        counts[length] += n
    spark = docs.sparkSession
    offsets = F.broadcast(spark.createDataFrame(ahead, "length long, _bucket long, _ahead long"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("_in", F.row_number().over(inside).cast("long") - 1)
    ranked = ranked.join(offsets, ["length", "_bucket"]).withColumn("_rank", F.col("_in") + F.col("_ahead"))
    table = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    # One sortable number for (length, rank); ranks stay below 2^48.
    steps = table[np.lexsort((table[:, 1], table[:, 0]))]
    keys = (steps[:, 0] << 48) + steps[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            step = steps[at]
            number = rank - step[:, 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            sequence = step[:, 2] + number // np.maximum(step[:, 3], 1)
            offset = step[:, 4] + number % np.maximum(step[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    packed = ranked.mapInArrow(place, _PIECES + ", sequence_id long, offset long")
    return packed
