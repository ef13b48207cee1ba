"""Feed dates, run dates and dependencies between loads, for all loads at once.

Control tables grow by appending, so each is reduced to one row per load first and
only then joined.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.compare import holds, holds_by
from feedloom.functions.dates import day_gap, step_date
from feedloom.operators.joins import lookup, settled

LOAD = ["domainname", "loadname"]


def load_key(name: str) -> Column:
    """Names of domains and loads are matched without case and outer blanks."""
    return F.lower(F.trim(F.col(name))).alias(name)


def with_load_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({c: load_key(c) for c in LOAD})


def max_feed_date(run_control: DataFrame) -> DataFrame:
    """Latest feed date of each load."""
    return run_control.groupBy(*[load_key(c) for c in LOAD]).agg(F.max("feed_date").alias("feed_date"))


def max_control_value(control: DataFrame, column: str) -> DataFrame:
    """Latest value of a column of the job control table, per load."""
    column = column.strip().lower()
    if column not in {c.lower() for c in control.columns} - set(LOAD):
        raise ValueError(f"no control column {column!r}")
    return control.groupBy(*[load_key(c) for c in LOAD]).agg(F.max(column).alias(column))


def run_dates(loads: DataFrame, catchup: DataFrame, today: date | str, given: Column | None = None) -> DataFrame:
    """Run date of each load: the one given, else its earliest one to catch up, else today."""
    pending = catchup.groupBy(*[load_key(c) for c in LOAD]).agg(F.min("run_date").alias("__pending"))
    choice = [F.col("__pending"), F.lit(str(today)).cast("date")]
    if given is not None:
        choice.insert(0, given.cast("date"))
    return lookup(with_load_keys(loads), pending, LOAD).withColumn("run_date", F.coalesce(*choice)).drop("__pending")


def next_feed_dates(
    loads: DataFrame,
    feeds: DataFrame,
    step: str | Column,
    month_end: bool = False,
    given: Column | None = None,
) -> DataFrame:
    """Next feed date of each load: the one given, else its latest stepped on, else its run date.

    ``loads`` has ``run_date`` (see :func:`run_dates`), ``feeds`` comes from :func:`max_feed_date`.
    The step ``current`` passes over the latest feed date.
    """
    how = F.lit(step) if isinstance(step, str) else step
    latest = feeds.withColumnRenamed("feed_date", "__latest")
    stepped = F.when(F.lower(how) != "current", step_date(F.col("__latest"), how, month_end))
    choice = [stepped, F.col("run_date")]
    if given is not None:
        choice.insert(0, given.cast("date"))
    return lookup(with_load_keys(loads), latest, LOAD).withColumn("feed_date", F.coalesce(*choice)).drop("__latest")


def feed_date_gaps(
    pairs: DataFrame, feeds: DataFrame, days: int, comparator: str = "ge", today: date | str | None = None
) -> DataFrame:
    """Days between the latest feed dates of two loads, and whether the gap is as asked.

    ``pairs`` names both loads (``from_domain``, ``from_load``, ``to_domain``, ``to_load``). With
    ``today`` the gap runs up to that day instead of the second load's date. A missing
    date makes a gap of 0.
    """
    start = feeds.withColumnRenamed("feed_date", "from_date")
    out = lookup(pairs, start, {"from_domain": "domainname", "from_load": "loadname"})
    if today is None:
        end = feeds.withColumnRenamed("feed_date", "to_date")
        out = lookup(out, end, {"to_domain": "domainname", "to_load": "loadname"})
    else:
        out = out.withColumn("to_date", F.lit(str(today)).cast("date"))
    gap = day_gap(F.col("from_date"), F.col("to_date"))
    return out.withColumn("gap_days", gap).withColumn("met", holds(gap, F.lit(days), comparator))


def dependencies(edges: DataFrame, feeds: DataFrame, given: Column | None = None) -> DataFrame:
    """For each dependency of a load, how far the other load is ahead and whether that suffices.

    ``edges`` has the load, ``dependent_domainname``, ``dependent_loadname``, ``operator``, ``offset`` and
    ``check_self_dependency``. A self check (``y``) sets the given feed date against the load's own
    latest one, if a feed date is given. A missing date makes a difference of 0.
    """
    own = feeds.withColumnRenamed("feed_date", "own_date")
    other = feeds.withColumnRenamed("feed_date", "other_date")
    out = lookup(with_load_keys(edges), own, LOAD)
    # A dependency may name its load in any case; the table keys are in lower case.
    other_keys = {"dependent_domainname": "domainname", "dependent_loadname": "loadname"}
    out = lookup(out.withColumns({c: load_key(c) for c in other_keys}), other, other_keys)
    if given is not None:
        itself = F.coalesce(F.lower("check_self_dependency") == "y", F.lit(False))
        out = out.withColumn("other_date", F.when(itself, given.cast("date")).otherwise(F.col("other_date")))
    gap = day_gap(F.col("own_date"), F.col("other_date"))
    offset = F.coalesce(F.col("offset"), F.raise_error(F.lit("dependency without an offset")).cast("int"))
    return out.withColumn("diff_days", gap).withColumn("met", holds_by(F.col("operator"), gap, offset))


def ready_loads(checked: DataFrame) -> DataFrame:
    """Loads all of whose dependencies are met; takes the output of :func:`dependencies`."""
    return checked.groupBy(*LOAD).agg(F.min("met").alias("ready"))


def next_file(audit: DataFrame, sequence: DataFrame, requests: DataFrame) -> DataFrame:
    """Next file in the sequence of each requested load.

    ``requests`` names ``domain_name``, ``load_name``, ``feed_date``, ``dag_name`` and ``default_file``. The
    latest completed run is sought among audit rows of the domain and feed date whose
    load name starts with the requested one. Of that run, the row of the request's own
    DAG which ended last (a missing end time counts as last) names the current file,
    after ``::``; the sequence gives its successor. No such row gives the default; a row
    without a successor gives NULL.
    """
    ask = ["domain_name", "load_name", "feed_date", "dag_name"]
    runs = (
        audit.where(F.col("status") == "completed")
        .groupBy("domainname", "feeddate", "loadname")
        .agg(F.max("run_id").alias("run_id"))
    )
    asked_feeds = requests.select("domain_name", "feed_date", "load_name").distinct()
    # Names are cut to the lengths asked for (no more of these than letters in a name), so that starting with a name
    # is being equal to it.
    lengths = [r.n for r in requests.where("load_name is not null").select(F.length("load_name").alias("n")).distinct().collect()]
    cut = F.filter(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda n: n <= F.length("loadname"))
    starts = (
        runs.select("domainname", "feeddate", "run_id", "loadname", F.explode(cut).alias("__n"))
        .groupBy("domainname", "feeddate", F.left("loadname", F.col("__n")).alias("__start"))
        .agg(F.max("run_id").alias("run_id"))
    )
    # One row per feed and load name again, so a DAG's requests share it.
    latest = lookup(asked_feeds, starts, {"domain_name": "domainname", "feed_date": "feeddate", "load_name": "__start"}, "inner")
    # The few runs looked for are settled, so that the long audit table is cut down to them as it is read.
    latest = settled(latest, "latest-runs")
    wanted = latest.select(F.col("run_id").alias("__run")).distinct()
    ends = F.struct(F.col("end_time").isNull(), F.col("end_time"), F.col("loadname"))
    rows = (
        lookup(audit, wanted, {"run_id": "__run"}, "left_semi")
        .groupBy(F.col("run_id").alias("__run"), F.lower("dag_name").alias("__dag"))
        .agg(F.max_by(F.struct(F.col("loadname")), ends).alias("__last"))
    )
    asked = requests.withColumn("__want", F.lower("dag_name"))
    found = lookup(asked, latest, ["domain_name", "feed_date", "load_name"])
    found = lookup(found, rows, {"run_id": "__run", "__want": "__dag"})
    found = found.withColumn("__file", F.substring_index(F.col("__last.loadname"), "::", -1))
    steps = sequence.select("domain_name", "load_name", "current", F.col("next").alias("__next"))
    keys = {"domain_name": "domain_name", "load_name": "load_name", "__file": "current"}
    out = lookup(found, steps, keys)
    choice = F.when(F.col("__last").isNull(), F.col("default_file")).otherwise(F.col("__next"))
    return out.select(*ask, choice.alias("next_file"))
