"""Everything registered."""

from workload import analytics, jobs, rows, sources  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
