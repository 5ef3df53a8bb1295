"""Joins and ranks that stay spread out when one key holds many rows, and values made once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _salt(columns: list[str], salts: int) -> Column:
    # A hash of the row, not rand(): a task that runs again must choose the same salt.
    # A bit mask cannot be null, so the join adds no null test that hashes the row once more.
    if salts & (salts - 1):
        raise ValueError("the number of salts must be a power of two")
    return F.xxhash64(*[F.col(f"`{name}`") for name in columns]).bitwiseAND(F.lit(salts - 1))


def _copies(salts: int) -> Column:
    return F.array(*[F.lit(salt).cast("bigint") for salt in range(salts)])


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    salts: int = 16,
) -> DataFrame:
    """Join a long table to a short one.

    Every key of `fact` is split over `salts` partitions and `dim` is repeated that often.
    `spread` names the columns of `fact` that tell rows of one key apart. No broadcast is forced:
    Spark chooses one only below its own size threshold, so at most `salts` times that threshold
    is ever sent out. Beyond it both sides are shuffled; since the salt leaves with the join, no
    later step relies on this partitioning, and adaptive execution may split large partitions
    further, which it must not do where a grouping by the bare key reuses them.
    """
    salted = fact.withColumn("_salt", _salt(spread or fact.columns, salts))
    copies = dim.withColumn("_salt", F.explode(_copies(salts)))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


#: Bytes of a list that `short_join` sends to every task.
MOST_BROADCAST = 64 << 20


def short_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    most: int = MOST_BROADCAST,
) -> DataFrame:
    """Join a long table to a list of tables, which leaves the long table where it is.

    Spark's own threshold is far below such a list, and the rows of `fact` are shuffled, texts and
    all, where it does not broadcast. The list is measured first (one job over `dim`); one of more
    than `most` bytes goes to `spread_join`.
    """
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in dim.dtypes if kind == "string"]
    size = sum(texts, F.lit(100 + 8 * len(dim.columns)).cast("bigint"))
    if (dim.agg(F.sum(size)).first()[0] or 0) > most:
        return spread_join(fact, dim, on, how, spread)
    return fact.join(F.broadcast(dim), on, how)


def hot_key_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    spread: list[str] | None = None,
    share: float = 0.001,
    floor: int = 100_000,
    salts: int = 256,
) -> DataFrame:
    """Join two long tables; only keys with more than `share` of the rows are salted.

    At most `1 / share` keys can hold more than `share` of the rows each, which bounds the
    broadcast list of hot keys. Keys with up to `floor` rows are never hot.
    """
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg(
        F.greatest(F.coalesce(F.sum("_n"), F.lit(0)) * share, F.lit(float(floor))).alias("_limit")
    ).scalar()
    hot = counts.filter(F.col("_n") > limit).select(*on, F.lit(True).alias("_hot"))
    is_hot = F.coalesce("_hot", F.lit(False))
    cold = F.lit(0).cast("bigint")
    salted = (
        fact.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.when(is_hot, _salt(spread or fact.columns, salts)).otherwise(cold))
        .drop("_hot")
    )
    copies = (
        dim.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.when(is_hot, _copies(salts)).otherwise(F.array(cold))))
        .drop("_hot")
    )
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def made_once(frame: DataFrame, names: list[str]) -> DataFrame:
    """The frame with `names` as values that later filters and projections read, not repeat.

    Spark moves a filter below a projection by writing the projection's expressions into it, down
    to the condition of a join; it does not move one below a generator.
    """
    kept = [name for name in frame.columns if name not in names]
    return frame.select(*kept, F.inline(F.array(F.struct(*names))))
