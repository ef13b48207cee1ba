"""Replacing tables that are read by the job that replaces them.

Overwriting a path that is being read destroys it. So a job writes all its outputs to new
folders first and puts them in place after the last one is complete. Each table is
swapped by renames; the swap of several tables is not one atomic step, but nothing is
touched before all outputs exist.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def stage(
    tables: Mapping[str, DataFrame], file_format: str = "parquet", layout: Mapping[str, Sequence[str]] | None = None
) -> dict[str, str]:
    """Write each table next to its target path and give the staging path of each.

    ``layout`` names the partition columns of the targets that have any.
    """
    run = uuid.uuid4().hex
    staged = {}
    for target, df in tables.items():
        staged[target] = f"{target.rstrip('/')}__staged_{run}"
        by = (layout or {}).get(target, ())
        df.write.mode("errorifexists").format(file_format).partitionBy(*by).save(staged[target])
    return staged


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    file_format: str = "parquet",
    layout: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Replace the datasets at the given paths, all of them computed from the state before."""
    put_in_place(spark, stage(tables, file_format, layout))


def put_in_place(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Move staged datasets to their targets. What was there before is deleted after the move."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for target, source in staged.items():
        new, there = path_of(source), path_of(target)
        old = path_of(source.replace("__staged_", "__replaced_"))
        files = there.getFileSystem(conf)
        had_one = files.exists(there)
        if had_one and not files.rename(there, old):
            raise OSError(f"cannot move {target} away")
        if not files.rename(new, there):
            if had_one:
                files.rename(old, there)
            raise OSError(f"cannot move {source} to {target}")
        if had_one:
            files.delete(old, True)
