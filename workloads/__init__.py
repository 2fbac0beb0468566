"""Queries over the given tables, one per operator, with the SQL that checks them."""

from workloads import cleaning, deletes, merges, scans, selects  # noqa: F401
from workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
