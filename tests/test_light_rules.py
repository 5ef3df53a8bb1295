"""Rules that stay light for each row."""

from __future__ import annotations

import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from checks.model_checks import scalar_suite
from lexiframe.functions import names

FIELDS = "id long, table_id string, field_name string, label string, description string, help string"


def test_rules_of_a_row_are_code_that_java_compiles(spark):
    rows = [(1, "t1", ' "t1_C1" ', " a  b ", "Description:\n x  y", None)]
    fields = spark.createDataFrame(rows, FIELDS)
    frame = scalar_suite(SimpleNamespace(dict_fields=fields))
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = debug.codegenStringSeq(frame._jdf.queryExecution().executedPlan())
    sizes = [parts.apply(at)._3().maxMethodCodeSize() for at in range(parts.size())]
    assert sizes and max(sizes) <= 8000  # longer methods are never compiled
    row = frame.collect()[0]
    assert (row.identifier, row.column_name, row.label, row.lines) == ("t1_c1", "c1", "a b", "Description:\nx y")
    assert (row.described, row.section, row.state) == ("x y", "x y", "differs")


def test_quotes_inside_quotes_and_long_runs(spark):
    chance = random.Random(3)
    values = ["".join(chance.choices(" \t \"'[]`aB", k=chance.randint(0, 12))) for _ in range(4000)]
    values += ["a" + " " * 20000 + "b", "`" * 20000 + "a", " " * 20000, "İ", "[İ]"]

    def plain(value):
        for marks in (" \t ", '"', "'", "[]", "`", " \t "):
            value = value.strip(marks)
        return value.lower()

    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = frame.select("v", names.clean_identifier(F.col("v")), F.upper(names.clean_identifier(F.col("v"))))
    for value, name, upper in found.collect():
        assert (name, upper) == (plain(value), plain(value).upper())
