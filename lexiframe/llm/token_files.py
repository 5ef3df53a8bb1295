"""Token ids in ORC files: run-length coded stripes, row indexes and Bloom filters on document ids.

Documents are range-partitioned by id and sorted, so files and stripes hold disjoint id ranges: a
reader prunes them by minimum and maximum, then by Bloom filter, and splits files by stripes.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.llm import encode, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text whose ids are held at once, and rows of a batch on the way to Spark.
STEP_BYTES = 1 << 20


def encode_documents(texts: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids, n_tokens, file_start) from (doc_id, text) rows in the order of the files.

    `ids` are signed 32-bit, ending with end_id; file_start counts the ids before them in the task,
    however many files it writes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encode.encoder(tokenizer)
        ahead = 0
        for batch in batches:
            for part in shared.slices(batch, "text", STEP_BYTES):
                found = list(own.ids([t or "" for t in part.column("text").to_pylist()]))
                offsets = np.cumsum([0, *[len(x) + 1 for x in found]])
                flat = np.full(offsets[-1], end_id, np.uint32)
                for at, ids in zip(offsets, found):
                    flat[at : at + len(ids)] = ids
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int32))
                )
                numbers = [pa.array(np.diff(offsets)), pa.array(ahead + offsets[:-1])]
                ahead += int(offsets[-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, *numbers],
                    ["doc_id", "ids", "n_tokens", "file_start"],
                )

    return texts.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, file_start long")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
    stripe_bytes: int = 16 << 20,
    mode: str = "errorifexists",
) -> None:
    """Write `ids` of every document in ascending id order; null ids come first, null texts are empty.

    Rows that repeat an id are written once each, next to one another. Other columns are ignored. An
    empty table makes files without rows.
    """
    files = files or shared.shuffle_partitions(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = texts.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    (
        encode_documents(ordered, tokenizer, end_id)
        .write.mode(mode)
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", 1000)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens); with `ids` only these documents, found through the files' metadata."""
    found = spark.read.schema("doc_id long, ids array<int>, n_tokens long").orc(path)
    return found if ids is None else found.filter(F.col("doc_id").isin(ids))


def _part() -> Column:
    """The number of the task that wrote a file; a task may write several, one after another."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("_part")


def part_bases(spark: SparkSession, path: str) -> DataFrame:
    """(_part, _base): ids in the files of all earlier tasks, one row a task. Only counts are read."""
    rows = spark.read.schema("n_tokens long").orc(path)
    totals = rows.select("n_tokens", _part()).groupBy("_part").agg(F.sum("n_tokens"))
    # Tasks are numbered in the order of their id ranges.
    ahead, bases = 0, []
    for part, n in sorted(map(tuple, totals.collect())):
        bases.append((part, ahead))
        ahead += n
    return spark.createDataFrame(bases, "_part long, _base long")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<i4")
            ends = lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            counts = np.diff(ends).astype(np.int64)
            columns = [batch.column(c) for c in ("doc_id", "_part", "file_start")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts), pa.array(crcs, pa.int64())],
                ["doc_id", "_part", "file_start", "n_tokens", "ids_crc32"],
            )

    rows = spark.read.schema("doc_id long, ids array<int>, file_start long").orc(path)
    rows = rows.select("*", _part())
    schema = "doc_id long, _part long, file_start long, n_tokens long, ids_crc32 long"
    return (
        rows.mapInArrow(digest, schema)
        .join(F.broadcast(part_bases(spark, path)), "_part")
        .select("doc_id", (F.col("_base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
    )
