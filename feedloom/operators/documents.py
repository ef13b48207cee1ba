"""Rows gathered into texts.

A list of all values of a group grows with the group, so lists are cut into parts of a
bounded size. ``part`` is an expression that gives few rows of a group the same value,
such as ``id div 500``. All parts together hold every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import local_text, run_id


def joined_list(
    df: DataFrame, group: Sequence[str], value: str, part: Column, alias: str = "values", separator: str = ","
) -> DataFrame:
    """Values of each group as text lists in order, such as the recipients of one message."""
    items = F.array_sort(F.collect_list(F.col(value).cast("string")))
    return df.groupBy(*group, part.alias("part")).agg(F.array_join(items, separator).alias(alias))


def json_arrays(
    df: DataFrame, group: Sequence[str], fields: Sequence[str | Column], part: Column, alias: str = "records"
) -> DataFrame:
    """Rows of each group as JSON arrays of objects, ordered by their fields."""
    items = F.array_sort(F.collect_list(F.struct(*fields)))
    return df.groupBy(*group, part.alias("part")).agg(F.to_json(items, {"ignoreNullFields": "false"}).alias(alias))


def finished_tasks(tasks: DataFrame) -> DataFrame:
    """Task rows that were scheduled and have a state: the ones an audit record takes up."""
    return tasks.where(F.col("job_id").isNotNull() & F.col("state").isNotNull())


def audit_records(tasks: DataFrame, part: Column) -> DataFrame:
    """JSON audit arrays per DAG run of its finished tasks, with times in the local zone."""
    fields = [
        F.col("dag_id"),
        F.col("operator"),
        F.col("task_id"),
        local_text(F.col("start_date")).alias("start_date"),
        local_text(F.col("end_date")).alias("end_date"),
        F.col("job_id"),
        F.col("try_number"),
        F.col("duration"),
        F.col("state"),
        run_id(F.col("execution_date")).alias("dag_run_id"),
        local_text(F.col("execution_date")).alias("execution_date"),
    ]
    return json_arrays(finished_tasks(tasks), ["dag_id"], fields, part)
