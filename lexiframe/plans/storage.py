"""Stored tables: results as sinks, and steps that later steps read more than once.

A stored step is a Parquet table in the folder that `spark.checkpoint.dir` names, so losing an
executor costs no recomputation of the steps before it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets a temporary folder."""
    folder = spark.conf.get(FOLDER_SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {FOLDER_SETTING} to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set(FOLDER_SETTING, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: With it, Spark removes the shuffle files of a query when the query ends.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def own_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files.

    Otherwise they stay until the driver happens to collect its garbage, and a job of several steps
    holds those of all of its steps. What a step has written needs none of them.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def stored(frame: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a step as Parquet and read it back."""
    spark = frame.sparkSession
    path = path or new_path(spark, name)
    with own_shuffles_removed(spark):
        frame.write.parquet(path)
    return spark.read.parquet(path)


#: Rows of one JSON file. A compressed file is read by one task, so no file may hold a long share.
JSON_FILE_ROWS = 1_000_000


def write_json(frame: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line, null members written out, text not escaped to ASCII.

    Files are compressed: the members' names alone are over half of a plan row.
    """
    (
        frame.write.mode(mode)
        .option("ignoreNullFields", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", JSON_FILE_ROWS)
        .json(path)
    )


def write_relational(
    relations: dict[str, DataFrame], path: str, mode: str = "errorifexists"
) -> None:
    """The relational model as Parquet; `fields` is partitioned by module.

    The rebalance hint lets adaptive execution split a large module into several files and put
    small ones together, so neither one task nor a swarm of tiny files holds a module.
    """
    for name, frame in relations.items():
        if name == "fields":
            frame = frame.hint("rebalance", "module_code")
            frame.write.mode(mode).partitionBy("module_code").parquet(f"{path}/{name}")
        else:
            frame.write.mode(mode).parquet(f"{path}/{name}")


def read_relational(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
