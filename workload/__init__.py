"""Registered queries: the operators run on whole benchmark tables, each beside its SQL."""

from workload import aggregates, columns, composites, filters, joins, scalars, scans, sorts, splits  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
