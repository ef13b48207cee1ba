"""Closing paths whose legs have ended.

Five steps over three tables, each seeing the result of the one before: drop dominated
legs, close open legs from the flight schedule, find each open path's first end, close
those paths, list them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.operators.versions import drop_dominated, group_floor, group_range, update_from
from feedloom.sinks.publish import publish
from feedloom.sinks.releases import Releases

# Fixed value: the end date of what has not ended.
OPEN = "3001-01-01"

# Leg columns and the schedule columns they are matched with.
LEG_TO_SCHEDULE = {
    "flt_id": "flt_id",
    "sch_leg_active_dt": "sch_leg_active_dt",
    "sch_leg_eff_dt": "sch_leg_eff_dt",
    "sch_leg_disc_dt": "sch_leg_disc_dt",
    "sch_leg_orig_cd": "sch_leg_orig_cd",
    "sch_leg_dest_cd": "sch_leg_dest_cd",
    "leg_freq_bitmask": "sch_leg_freq_bitmask",
}
LEG_KEY = ["path_id", *LEG_TO_SCHEDULE]
END = "sch_leg_inactive_dt"


def _open():
    return F.lit(OPEN).cast("date")


def schedule_ends(schedules: DataFrame, feed_date: date | str) -> DataFrame:
    """Last end of each scheduled leg that is active by the day after the feed date.

    One that becomes active on that very day counts as open.
    """
    next_day = F.date_add(F.lit(str(feed_date)).cast("date"), 1)
    active = F.col("sch_leg_active_dt")
    end = F.when(active == next_day, _open()).otherwise(F.col(END))
    return schedules.where(active <= next_day).groupBy(*LEG_TO_SCHEDULE.values()).agg(F.max(end).alias("last_end"))


def current_legs(legs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Step 1: legs that no other with the same key ends before."""
    return drop_dominated(legs, LEG_KEY, END, settle=True, groups=groups)


def close_legs(legs: DataFrame, ends: DataFrame) -> DataFrame:
    """Step 2: open legs get the end of their schedule, if that has one."""
    ended = (F.col("last_end") < F.col(END)) & (F.col(END) == _open())
    return update_from(legs, ends, LEG_TO_SCHEDULE, {END: F.col("last_end")}, ended, grouped=True)


def path_ends(legs: DataFrame, ends: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Steps 1 and 2 as far as the first end of each path goes.

    Dropping dominated legs leaves one end date per leg key, the least, so legs are reduced to that
    before anything is joined: in each task first, so that a path or flight with a large share
    of the legs sends few rows. Where a key column is NULL all dates of the key stay, but no
    schedule matches, so the least is again all that counts.
    """
    floors = group_floor(legs, LEG_KEY, END) if groups is None else groups.drop("__most").withColumnRenamed("__least", END)
    closed = close_legs(floors, ends)
    return closed.where(F.col("path_id").isNotNull()).groupBy("path_id").agg(F.min(END).alias("minina"))


def closing_paths(paths: DataFrame, ends_by_path: DataFrame) -> DataFrame:
    """Open paths with the end they get (``minina``). ``path_id`` is the key of paths."""
    is_open = paths.where(F.col("path_inactive_dt") == _open())
    return lookup(is_open, ends_by_path, ["path_id"], "inner", extra=F.col("minina") < F.col("path_inactive_dt"))


def path_end_rows(paths: DataFrame, ends_by_path: DataFrame) -> DataFrame:
    """Step 3: identifier and end of each path to close."""
    return closing_paths(paths, ends_by_path).select("path_id", "minina")


def close_paths(paths: DataFrame, ends_by_path: DataFrame) -> DataFrame:
    """Step 4: all paths, with their new end where they are to close."""
    ended = (F.col("path_inactive_dt") == _open()) & (F.col("minina") < F.col("path_inactive_dt"))
    on = {"path_id": "path_id"}
    return update_from(paths, ends_by_path, on, {"path_inactive_dt": F.col("minina")}, ended, grouped=True)


def inactivated_paths(paths: DataFrame, ends_by_path: DataFrame) -> DataFrame:
    """Step 5: identifier and description of each path that closes."""
    return closing_paths(paths, ends_by_path).select("path_id", "path_dscr")


@dataclass(frozen=True)
class Inactivation:
    """The outputs, all of one input state."""

    legs: DataFrame
    paths: DataFrame
    path_ends: DataFrame
    inactivated: DataFrame


def inactivate(legs: DataFrame, schedules: DataFrame, paths: DataFrame, feed_date: date | str) -> Inactivation:
    """All steps. What several of them read is worked out once, right away: schedule ends, the ends of each leg key,
    and path ends."""
    ends = settled(schedule_ends(schedules, feed_date), "schedule-ends")
    groups = settled(group_range(legs, LEG_KEY, END), "leg-ends")
    by_path = settled(path_ends(legs, ends, groups), "path-ends")
    return Inactivation(
        legs=close_legs(current_legs(legs, groups), ends),
        paths=close_paths(paths, by_path),
        path_ends=path_end_rows(paths, by_path),
        inactivated=inactivated_paths(paths, by_path),
    )


def inactivated(legs: DataFrame, schedules: DataFrame, paths: DataFrame, feed_date: date | str) -> DataFrame:
    """Step 5 alone, where the changed tables are not asked for."""
    ends = settled(schedule_ends(schedules, feed_date), "schedule-ends")
    return inactivated_paths(paths, path_ends(legs, ends))


def run(
    spark: SparkSession,
    legs_path: str,
    schedules_path: str,
    paths_path: str,
    path_ends_path: str,
    inactivated_path: str,
    feed_date: date | str,
) -> None:
    """Run the chain over stored tables: legs and paths are replaced, the two lists written anew."""
    read = spark.read.parquet
    out = inactivate(read(legs_path), read(schedules_path), read(paths_path), feed_date)
    publish(
        spark,
        {
            legs_path: out.legs,
            paths_path: out.paths,
            path_ends_path: out.path_ends,
            inactivated_path: out.inactivated,
        },
    )


def release(releases: Releases, feed_date: date | str) -> int:
    """Run the chain over the tables ``legs``, ``schedules`` and ``paths`` of the current release. Both changed tables and both lists
    (``path_ends``, ``inactivated``) become current in one step."""
    now = releases.read_all()
    out = inactivate(now["legs"], now["schedules"], now["paths"], feed_date)
    tables = {"legs": out.legs, "paths": out.paths, "path_ends": out.path_ends, "inactivated": out.inactivated}
    return releases.publish(tables)
