"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from checks import model_checks, page_checks, plan_checks, sink_checks  # noqa: F401
from checks.inputs import Inputs
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "Inputs"]
