"""Gates: what to run next, decided from counts, dates and statuses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.functions.compare import holds
from feedloom.operators.joins import lookup, unique_by
from feedloom.sinks.publish import put_in_place, stage

_LOAD = ["domainname", "loadname"]


def branch(test: Column, yes: str, no: str) -> Column:
    """A branch name; an unknown test counts as false."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def require(df: DataFrame, test: Column, message: str) -> DataFrame:
    """The same rows; the job fails at one for which the test is not true."""
    wrong = F.raise_error(F.concat(F.lit(message + ": "), F.to_json(F.struct(*df.columns)))).cast("boolean")
    return df.where(F.when(test, F.lit(True)).otherwise(wrong))


def branch_by(value: Column, branches: Mapping[str, str]) -> Column:
    """The branch of a value, compared as text. A NULL or unmapped value fails the job."""
    if not branches:
        raise ValueError("no branches given")
    text = value.cast("string")
    table = F.create_map(*[F.lit(x) for pair in branches.items() for x in pair])
    wrong = F.raise_error(F.concat(F.lit("no branch for "), F.coalesce(text, F.lit("NULL")))).cast("string")
    return F.coalesce(F.try_element_at(table, text), wrong)


@dataclass(frozen=True)
class Branches:
    """Rows with their branch, and what has been seen of those without one."""

    rows: DataFrame
    seen: Observation

    def check(self) -> None:
        """Fail if any row had none, saying how many and naming some. To be called when the rows have been written."""
        lost = self.seen.get
        if lost["lost"]:
            raise ValueError(f"no branch for {lost['lost']} rows, values from {lost['least']!r} to {lost['most']!r}")


def branch_from(df: DataFrame, value: str, branches: DataFrame, name: str = "value", to: str = "branch") -> Branches:
    """The branch of each row from a table of branches (``name``, ``to``; unique names), compared as text.

    For maps too large to be written down. Rows without a branch, and those with a NULL, go on with NULL and are counted in the pass that writes, so all
    of them are known at the end and no second job looks for them: write ``rows``, then call ``check``, then put what was written in place.
    """
    known = branches.select(F.col(name).cast("string").alias("__value"), F.col(to).alias("branch"))
    found = lookup(df.withColumn("__text", F.col(value).cast("string")), unique_by(known, ["__value"]), {"__text": "__value"})
    lost = F.when(F.col("branch").isNull(), F.coalesce("__text", F.lit("NULL")))
    seen = Observation()
    measured = found.observe(seen, F.count(lost).alias("lost"), F.min(lost).alias("least"), F.max(lost).alias("most"))
    return Branches(measured.drop("__text"), seen)


def write_branches(df: DataFrame, value: str, branches: DataFrame, target: str, name: str = "value", to: str = "branch") -> None:
    """Write rows with their branch, a folder per branch. The dataset is put in place only if every row has one."""
    spark = df.sparkSession
    found = branch_from(df, value, branches, name, to)
    staged = stage({target: found.rows}, layout={target: ["branch"]})
    found.check()
    put_in_place(spark, staged)


def branch_of_result(result: DataFrame, branches: Mapping[str, str]) -> DataFrame:
    """The branch of the first cell of a query's result, as one row. No row or a NULL fails the job.

    A result is one row by nature; of several any may be taken, so order the query if it matters.
    """
    cell = result.limit(1).select(F.col(result.columns[0]).cast("string").alias("v")).agg(F.first("v").alias("v"))
    return cell.select(branch_by(F.col("v"), branches).alias("branch"))


def history_branch(argument: Column, history: str, incremental: str) -> Column:
    """Whether a run is asked to load history (``y``); without the argument it is incremental."""
    return branch(F.lower(F.trim(argument)) == "y", history, incremental)


def date_gate(feed_date: Column, run_date: Column, yes: str, no: str) -> Column:
    """Whether the feed has come up to the run date."""
    return branch(feed_date.cast("date") >= run_date.cast("date"), yes, no)


def json_count_gate(document: Column, yes: str, no: str, path: str = "$.count") -> Column:
    """Whether a status document counts at least one new row. One without a count fails the job."""
    count = F.get_json_object(document, path).cast("long")
    missing = F.raise_error(F.lit(f"no {path} in the status document")).cast("long")
    return branch(F.coalesce(count, missing) >= 1, yes, no)


def count_gate(requests: DataFrame, audit: DataFrame, yes: str, no: str, comparator: str = "eq") -> DataFrame:
    """Whether the completed runs of a load's feed date are as many as expected.

    ``requests`` has the load, ``feed_date`` and ``expected_count``.
    """
    done = (
        audit.where(F.col("status") == "completed")
        .groupBy(*_LOAD, F.col("feeddate").alias("feed_date"))
        .agg(F.count("*").alias("__n"))
    )
    out = lookup(requests, done, [*_LOAD, "feed_date"]).withColumn("completed", F.coalesce("__n", F.lit(0)))
    test = holds(F.col("completed"), F.col("expected_count"), comparator)
    return out.drop("__n").withColumn("branch", branch(test, yes, no))


def _run_counts(audit: DataFrame, keys: Sequence[str], statuses: Sequence[str], last_run: bool) -> DataFrame:
    hit = F.count_if(F.col("status").isin(*statuses))
    if not last_run:
        return audit.groupBy(*keys).agg(hit.alias("__n"))
    runs = audit.groupBy(*keys, "run_id").agg(hit.alias("__n"))
    return runs.groupBy(*keys).agg(F.max_by("__n", "run_id").alias("__n"))


def status_gate(
    loads: DataFrame,
    audit: DataFrame,
    busy: str,
    free: str,
    statuses: Sequence[str] = ("started",),
    last_run: bool = False,
) -> DataFrame:
    """Whether a load has runs in one of the statuses, over all runs or in its last run only."""
    counts = _run_counts(audit, _LOAD, statuses, last_run)
    out = lookup(loads, counts, _LOAD)
    return out.withColumn("branch", branch(F.col("__n") > 0, busy, free)).drop("__n")


def status_gate_like(
    domains: DataFrame,
    audit: DataFrame,
    names: Sequence[str],
    busy: str,
    free: str,
    statuses: Sequence[str] = ("started",),
    last_run: bool = False,
) -> DataFrame:
    """As :func:`status_gate`, for load names that *contain* one of a few given texts.

    Gives a row per domain asked about (``domainname``) and text; one that no load matches is free. Each audit row is tested
    against the texts where it lies, and only counts are joined.
    """
    texts = F.array(*[F.lit(n) for n in names])
    hits = F.filter(texts, lambda t: F.contains(F.col("loadname"), t))
    matched = audit.select("domainname", "run_id", "status", F.explode(hits).alias("load_text"))
    counts = _run_counts(matched, ["domainname", "load_text"], statuses, last_run)
    asked = domains.select("domainname", F.explode(texts).alias("load_text"))
    out = lookup(asked, counts, ["domainname", "load_text"])
    return out.withColumn("branch", branch(F.col("__n") > 0, busy, free)).drop("__n")


def equality_gate(left: Column, right: Column, yes: str, no: str) -> Column:
    """Whether two values are the same, such as the next file and the file that moves the feed date. NULL equals nothing."""
    return branch(left == right, yes, no)
