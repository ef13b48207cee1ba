"""Versioned rows: dropping those another version dominates, and update-from-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled, unique_by


def group_floor(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key group with the least value; NULL keys form groups, NULL values do not count."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def group_range(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key group with the least and the greatest value (``__least``, ``__most``)."""
    return df.groupBy(*keys).agg(F.min(value).alias("__least"), F.max(value).alias("__most"))


def drop_dominated(
    df: DataFrame, keys: Sequence[str], value: str, settle: bool = False, groups: DataFrame | None = None
) -> DataFrame:
    """Delete each row for which a row with equal keys and a lesser value exists.

    Ties stay, and so do rows with a NULL key or a NULL value, which compare with
    nothing. Only groups that hold two different values can lose rows, so these alone
    reach the join: their least values, one row per group, against which the rows
    are anti-joined. No two rows of a group are ever paired with each other.

    ``settle`` writes those groups out first (see :func:`joins.settled`): where they are few, the rows
    are then read a second time but never shuffled. ``groups`` gives what :func:`group_range` gives, where that is at hand.
    """
    least = "__least"
    groups = group_range(df, keys, value) if groups is None else groups
    mixed = groups.where(F.col(least) < F.col("__most")).drop("__most").dropna(subset=list(keys))
    if settle:
        mixed = settled(mixed, "mixed-groups")
    return lookup(df, mixed, list(keys), "left_anti", extra=F.col(value) > F.col(least))


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str],
    assign: Mapping[str, Column],
    when: Column,
    grouped: bool = False,
) -> DataFrame:
    """Set target columns from the matching source row where a condition holds.

    ``on`` maps target to source keys. ``assign`` and ``when`` may name the columns of both
    sides; those of the source must not be named as ones of the target. All target
    rows stay. A source with two rows for one key would multiply target rows, so it
    fails the job; pass ``grouped`` if the source is grouped by its keys, which saves the check.
    """
    if not grouped:
        source = unique_by(source, list(on.values()))
    joined = lookup(target, source, on)
    hit = F.coalesce(when, F.lit(False))
    new = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in assign.items()}
    return joined.withColumns(new).select(*target.columns)
