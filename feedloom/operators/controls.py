"""Sequence numbers and system keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import zero_padded
from feedloom.operators.joins import lookup


def next_sequence(feeds: DataFrame, history: DataFrame) -> DataFrame:
    """Next file sequence of each feed: one past its greatest SUCCEEDED one, 1 if it has none."""
    done = (
        history.where(F.col("job_status") == "SUCCEEDED")
        .groupBy("feed_id")
        .agg(F.max(F.col("file_sequence_no").cast("long")).alias("__last"))
    )
    out = lookup(feeds, done, ["feed_id"])
    return out.withColumn("sequence_no", F.coalesce("__last", F.lit(0)) + 1).drop("__last")


def next_system_key(
    names: DataFrame, keys: DataFrame, step: int = 1, width: int | None = None, given: Column | None = None
) -> DataFrame:
    """Next system key of each name as text: the one given, else the greatest plus a step, else 0.

    Values are compared as numbers, also where the table holds them as text.
    """
    last = keys.groupBy("key_name").agg(F.max(F.col("last_val").cast("long")).alias("__last"))
    choice = [F.col("__last") + step, F.lit(0)]
    if given is not None:
        choice.insert(0, given.cast("long"))
    text = F.coalesce(*choice).cast("string")
    text = text if width is None else zero_padded(text, width)
    return lookup(names, last, ["key_name"]).withColumn("sys_key_val", text).drop("__last")
