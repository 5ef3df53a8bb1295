"""Values that later filters read, and files of the JSON sinks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lexiframe.operators import source_model
from lexiframe.plans import storage
from lexiframe.sources import documents

LINES = [
    ("a.csv", 0, 't1,"T, 1",, C1 ,Label  1,Description: x'),
    ("a.csv", 1, "T1,,about,c1,later,"),
    ("a.csv", 2, "t1,,,,no name,"),
    ("a.csv", 3, ",none,,c2,no table,"),
    ("a.csv", 4, None),
    (None, None, "t2,two,,c2,l,"),
]


def test_a_csv_line_is_read_once_however_many_filters_follow(spark):
    lines = spark.createDataFrame(LINES, "path string, record_no long, line string")
    records = documents.parse_csv_lines(lines.repartition(2))
    columns = source_model.csv_columns(records, "csd_")
    plan = columns._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    rows = {tuple(r) for r in columns.select("table_code", "column_name", "label", "source_ref").collect()}
    assert rows == {("t1", "c1", "later", "a.csv:2"), ("t2", "c2", "l", None)}
    tables = source_model.csv_tables(records, "csd_")
    found = {tuple(r) for r in tables.select("table_code", "label", "description", "source_ref").collect()}
    assert found == {("t1", "T, 1", "about", "a.csv:1"), ("t2", "two", None, None)}


def test_json_sinks_are_compressed_and_no_file_is_long(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "JSON_FILE_ROWS", 40)
    path = str(tmp_path / "out")
    frame = spark.range(100).select("id", F.lit(None).cast("string").alias("gone"), F.lit("é").alias("text"))
    storage.write_json(frame.coalesce(1), path)
    files = [name for name in os.listdir(path) if name.startswith("part-")]
    assert len(files) == 3 and all(name.endswith(".json.gz") for name in files)
    assert spark.read.text(path).filter(F.contains("value", F.lit('"gone":null'))).count() == 100
    back = spark.read.schema(frame.schema).json(path)
    assert back.exceptAll(frame).isEmpty() and back.count() == 100
