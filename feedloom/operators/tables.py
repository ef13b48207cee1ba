"""Row changes of control tables as DataFrames: append, delete by key, upsert.

Each gives the whole new table; ``sinks.publish`` puts it in place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from feedloom.operators.joins import lookup, settled


# What an upsert of the job control table replaces, and what makes a file record fit to be kept.
JOB_CONTROL_UPDATES = ("start_timestamp", "run_date", "feed_date")
FILE_AUDIT_REQUIRED = ("file_name", "file_path", "file_mod_time")


def complete_rows(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that have a value in every required column: the ones fit to be appended."""
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def append_rows(table: DataFrame, rows: DataFrame, required: Sequence[str]) -> DataFrame:
    return table.unionByName(complete_rows(rows, required), allowMissingColumns=True)


def delete_by_keys(table: DataFrame, keys: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The table without the rows whose key is listed. Listed keys may repeat; NULL matches nothing."""
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    listed = keys.select(*pairs.values()).dropna().distinct()
    return lookup(table, listed, pairs, "left_anti")


def upsert(
    table: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    now: Column,
    order_by: str,
) -> DataFrame:
    """Insert rows whose key is new and update the ``update`` columns of the others.

    Of several rows for one key the last by ``order_by`` counts, as if they had come one after the other; one without
    an order comes first. An inserted row gets ``insert_timestamp``, an updated one keeps its own and gets
    ``update_timestamp``. Keys are the primary key of the table: unique there, never NULL.

    The last rows are settled first (see :func:`joins.settled`). The table is joined to them from
    the left, and new rows are found among the keys it shares with them, so while they are
    small enough for Spark to broadcast, the table is not shuffled however large it is.
    """
    values = [c for c in rows.columns if c not in keys]
    place = F.struct(F.col(order_by).isNotNull(), F.col(order_by))
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), place).alias("__new"))
    last = settled(last, "upserts")
    hit = F.col("__new").isNotNull()

    def after_update(field: StructField) -> Column:
        old = F.col(field.name)
        if field.name == "update_timestamp":
            return F.when(hit, now).otherwise(old).cast(field.dataType).alias(field.name)
        if field.name in update:
            return F.when(hit, F.col(f"__new.{field.name}")).otherwise(old).alias(field.name)
        return old

    def inserted(field: StructField) -> Column:
        if field.name in keys:
            return F.col(field.name)
        if field.name == "insert_timestamp":
            new = now
        elif field.name in values and field.name != "update_timestamp":
            new = F.col(f"__new.{field.name}")
        else:
            new = F.lit(None)
        return new.cast(field.dataType).alias(field.name)

    kept = lookup(table, last, keys).select(*[after_update(f) for f in table.schema.fields])
    shared = lookup(table.select(*keys), last.select(*keys), keys, "left_semi")
    new = lookup(last, shared, keys, "left_anti").select(*[inserted(f) for f in table.schema.fields])
    return kept.unionByName(new)


def upsert_watermarks(control: DataFrame, marks: DataFrame, now: Column) -> DataFrame:
    """The job control table with new watermarks (the load, ``run_date``, ``feed_date``, ``start_timestamp``).

    A load that brought no rows has none, and its control row stays. Of several for one load the latest counts.
    """
    known = complete_rows(marks, ["start_timestamp"]).withColumn("__order", F.col("start_timestamp"))
    return upsert(control, known, ["domainname", "loadname"], JOB_CONTROL_UPDATES, now, "__order")
