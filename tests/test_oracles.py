"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from checks import ORACLES, QUERIES
from checks.compare import differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, name):
    if name in ORACLES:
        assert differences(name, spark, FOLDER) == []
    else:
        assert queries()[name](spark, FOLDER).count() > 0


def test_entry_has_the_plan_columns(spark):
    assert entry(spark).columns[:3] == ["entity_type", "table_fqn", "table_name"]


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
