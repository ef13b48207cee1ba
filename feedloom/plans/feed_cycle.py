"""One cycle of all feeds: which may run, for which dates, and the record of having run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.feeds import LOAD, dependencies, max_feed_date, next_feed_dates, ready_loads, run_dates
from feedloom.operators.joins import lookup, settled
from feedloom.operators.tables import delete_by_keys


def plan_cycle(
    loads: DataFrame,
    run_control: DataFrame,
    catchup: DataFrame,
    edges: DataFrame,
    today: date | str,
    step: str | Column = "1_day",
    month_end: bool = False,
) -> DataFrame:
    """Run date, next feed date and readiness of each load, and the reason if it is not ready.

    A load without dependencies is ready. The latest feed dates, which several steps look
    up, are worked out once, right away.
    """
    feeds = settled(max_feed_date(run_control), "latest-feeds")
    dated = next_feed_dates(run_dates(loads, catchup, today), feeds, step, month_end)
    out = lookup(dated, ready_loads(dependencies(edges, feeds)), LOAD)
    ready = F.coalesce(F.col("ready"), F.lit(True))
    reason = F.when(ready, F.lit("ok")).otherwise(F.lit("dependency not met"))
    return out.withColumn("ready", ready).withColumn("reason", reason)


def record_cycle(
    run_control: DataFrame, catchup: DataFrame, finished: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """The run-control table with a row per finished load added, and the catch-up table without their rows.

    ``finished`` has the load, ``run_date`` and ``feed_date``.
    """
    rows = finished.select(*LOAD, "run_date", "feed_date", now.alias("insert_timestamp"))
    return run_control.unionByName(rows), delete_by_keys(catchup, finished, [*LOAD, "run_date"])
