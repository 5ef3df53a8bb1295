"""Table of checks: name to Spark query and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.inputs import Inputs

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, oracle: str | None = None):
    def register(query: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two checks named {name}")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return register
