"""Every operator as a named query over the given tables, with its SQL check."""

from gradeflow.catalog import forecasts, rows, storage, streams, students  # noqa: F401
from gradeflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
