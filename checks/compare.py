"""Run one check on both engines and compare all rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.registry import ORACLES, QUERIES
from checks.inputs import Inputs


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(name: str, spark: SparkSession, folder: str, limit: int = 3) -> list[str]:
    """Empty if both engines give the same columns and the same rows."""
    frame = QUERIES[name](Inputs(spark, folder))
    columns = sorted(frame.columns)
    got = Counter(tuple(row[c] for c in columns) for row in frame.select(columns).collect())
    cursor = oracle_connection(folder).execute(ORACLES[name])
    names = [item[0] for item in cursor.description]
    if sorted(names) != columns:
        return [f"columns: spark {columns}, oracle {sorted(names)}"]
    order = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    if got == want:
        return [] if got else ["no rows at all"]
    return [
        f"rows: spark {sum(got.values())}, oracle {sum(want.values())}; columns {columns}",
        *[f"only spark:  {row}" for row in list((got - want).elements())[:limit]],
        *[f"only oracle: {row}" for row in list((want - got).elements())[:limit]],
    ]
