"""What several operators need: stored steps, hot keys, state of a Python worker, row blocks."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Helpers travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "attach",
    "lower_ascii",
    "set_aside",
    "shuffle_partitions",
    "slices",
    "stored",
    "text_bytes",
    "worker_state",
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that one step of a NumPy helper works on; a longer text is a step of its own.
BLOCK_BYTES = 4 << 20


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts of one byte a character take Spark's faster path."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a step into the shared folder and read it back."""
    from lexiframe.plans import storage

    return storage.stored(frame, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, share: int = 64) -> DataFrame:
    """Left join of rows to the group of their key, where one group may hold most rows.

    `groups` has one row for each `key` and the number of its rows in `size`; it should be a stored
    table, as it is read several times. Groups with at least 1/`share` of all rows, of which there
    can be no more than `share`, reach their rows by broadcast; the others by a shuffle in which no
    key holds more than that share. Rows with a null key find no group.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(total / share, 1000)
    hot = F.broadcast(groups.filter(F.col(size) >= limit).limit(share))
    names = [c for c in groups.columns if c != key]
    prefixed = hot.select(F.col(key), *[F.col(c).alias(f"_hot_{c}") for c in names])
    marked = rows.join(prefixed, key, "left")
    is_hot = F.col(f"_hot_{size}").isNotNull()
    found = marked.filter(is_hot).select(
        *rows.columns, *[F.col(f"_hot_{c}").alias(c) for c in names]
    )
    others = marked.filter(~is_hot).select(*rows.columns)
    cold = groups.filter(F.col(size) < limit)
    return found.unionByName(others.join(cold, key, "left").select(*rows.columns, *names))


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` without columns of these names: such columns get free names, which are returned, so
    that a result can have them back."""
    taken = {c.lower() for c in docs.columns}
    clashing = {c for c in docs.columns if c.lower() in {n.lower() for n in names}}
    moved = {}
    for column in sorted(clashing):
        free = f"own_{column}"
        while free.lower() in taken:
            free = f"own_{free}"
        taken.add(free.lower())
        moved[free] = column
    return docs.withColumnsRenamed({column: free for free, column in moved.items()}), moved


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    name = "_lexiframe_worker_state"
    if name not in sys.modules:
        module = types.ModuleType(name)
        module.state = {}
        sys.modules[name] = module
    return sys.modules[name].state


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each begins and ends; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `most` bytes together."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last
