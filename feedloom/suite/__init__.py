"""The operators as named queries over the sample tables, each with SQL for the same result."""

from feedloom.suite import chain, changes, control, files, store
from feedloom.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "chain", "changes", "control", "files", "store"]
