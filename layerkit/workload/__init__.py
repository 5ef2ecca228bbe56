"""Every operator as a query over the given tables."""

from layerkit.workload import checks, merges, rows, runs  # noqa: F401
from layerkit.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
