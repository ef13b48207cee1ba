"""Alert suppression from a configuration table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.gates import branch
from feedloom.operators.joins import lookup
from feedloom.operators.requests import containing


def suppressed_by_config(failures: DataFrame, config: DataFrame) -> DataFrame:
    """Failures (``dag_id``, ``task_id``) that a configuration row tells to pass over.

    A row does if it is for the DAG, its task list contains the task id, and its flag
    is ``Y``. Names are matched without case. Task lists are found by parts of the task ids, so the rules and tasks of one DAG are not
    all held against each other.
    """
    rules = config.where(F.upper("skip_alert") == "Y").select(
        F.lower("dag_id").alias("rule_dag"), F.lower("task_id_list").alias("rule_tasks")
    )
    asked = failures.select(F.lower("dag_id").alias("asked_dag"), F.lower("task_id").alias("asked_task")).distinct()
    met = containing(rules.distinct(), "rule_tasks", asked, "asked_task", {"rule_dag": "asked_dag"})
    hits = met.select("asked_dag", "asked_task").distinct()
    lowered = failures.withColumns({"__d": F.lower("dag_id"), "__t": F.lower("task_id")})
    return lookup(lowered, hits, {"__d": "asked_dag", "__t": "asked_task"}, "left_semi").drop("__d", "__t")


def count_matching(df: DataFrame, column: str, text: str, alias: str = "n") -> DataFrame:
    """How many rows contain a text, without case."""
    return df.agg(F.count_if(F.contains(F.lower(column), F.lit(text.lower()))).alias(alias))


def alert_branch(failures: DataFrame, config: DataFrame) -> DataFrame:
    """Every failure with ``skip`` or ``send``. Each distinct DAG and task is tested against the rules once."""
    lowered = failures.withColumns({"__d": F.lower("dag_id"), "__t": F.lower("task_id")})
    names = lowered.select(F.col("__d").alias("dag_id"), F.col("__t").alias("task_id")).distinct()
    hits = suppressed_by_config(names, config).withColumn("__hit", F.lit(True))
    out = lookup(lowered, hits, {"__d": "dag_id", "__t": "task_id"})
    return out.withColumn("alert", branch(F.col("__hit"), "skip", "send")).drop("__d", "__t", "__hit")
