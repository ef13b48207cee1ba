"""Comparisons chosen by name, either once for a job or per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted comparator names.
COMPARATORS = {
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "eq": lambda a, b: a == b,
}
SYMBOLS = {">": "gt", ">=": "ge", "<": "lt", "<=": "le", "==": "eq"}


def holds(left: Column, right: Column, comparator: str = "ge") -> Column:
    """``left <comparator> right`` for one comparator, known when the job is built."""
    name = SYMBOLS.get(comparator, comparator)
    if name not in COMPARATORS:
        raise ValueError(f"unknown comparator {comparator!r}")
    return COMPARATORS[name](left, right)


def holds_by(comparator: Column, left: Column, right: Column) -> Column:
    """As :func:`holds`, with the comparator read from a column. An unknown one fails the job."""
    branch = None
    for name, test in COMPARATORS.items():
        accepted = [name] + [s for s, n in SYMBOLS.items() if n == name]
        hit = comparator.isin(*accepted)
        branch = F.when(hit, test(left, right)) if branch is None else branch.when(hit, test(left, right))
    unknown = F.raise_error(F.concat(F.lit("unknown comparator "), F.coalesce(comparator, F.lit("NULL"))))
    return branch.otherwise(unknown.cast("boolean"))
