"""Running high watermarks of a stream, kept in a control table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.sinks import store
from feedloom.sinks.rewrite import recover, replace_parts

#: Parts of a control table. A batch writes those anew that hold a source with news.
PARTS = 64
_PART = "part"
_PERIOD = "period"


def watermark_stream(stream: DataFrame, source: str, time: str, lateness: str | None = None) -> DataFrame:
    """Row count and greatest time of each source so far.

    Without ``lateness`` the state is one row per source for ever, and no row is too late to count. With it (as ``2 days``) rows are summed per source and day of
    their time, and days that lie further back than that behind the latest time seen leave the state. A row for such a day no longer counts;
    :func:`keep_watermarks` says how many there were. A row without a time then has no day and does not count.
    """
    at = F.col(time).cast("timestamp")
    sums = [F.max("__at").alias("start_timestamp"), F.count("*").alias("n")]
    rows = stream.withColumn("__at", at)
    if lateness is None:
        return rows.groupBy(source).agg(*sums)
    days = rows.withWatermark("__at", lateness).groupBy(source, F.window("__at", "1 day").alias("w")).agg(*sums)
    return days.select(source, F.col("w.start").alias(_PERIOD), "start_timestamp", "n")


@dataclass(frozen=True)
class Kept:
    """Batches of a call, how many parts of the table they wrote anew, and how many rows came too late to count."""

    batches: int
    parts: int
    late_rows: int


def _merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    greatest = F.struct(F.col("start_timestamp").isNotNull().alias("known"), "start_timestamp", "n")
    both = old.unionByName(new).groupBy(*keys, _PART).agg(F.max(greatest).alias("r"))
    return both.select(*keys, "r.start_timestamp", "r.n", _PART)


def keep_watermarks(stream: DataFrame, table_path: str, checkpoint: str, source: str, parts: int = PARTS) -> Kept:
    """Bring what has changed since the last call into the control table at a path, and return.

    The table has one row per source (and day, if the stream has a lateness). A batch is merged into it, and of each the row with the greatest time (of
    equal ones, the greatest count) stays; so a batch that runs again changes nothing, nor does a new checkpoint that
    starts over with old files. Sources are dealt to parts by their hash. Only parts that hold a source whose row changes are read as a whole and written anew,
    as one journaled change (:mod:`feedloom.sinks.rewrite`); a batch without news writes nothing.
    """
    keys = [source, *([_PERIOD] if _PERIOD in stream.columns else [])]
    written = [0, 0]

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(source), F.lit(parts)).cast("int").alias(_PART)
        new = settled(batch.select(*keys, "start_timestamp", "n", part), "batch-watermarks")
        written[0] += 1
        if store.exists(spark, table_path):
            recover(spark, table_path)
            held = spark.read.parquet(table_path)
            news = _news(new, held, keys)
            changed = lookup(held, news.select(_PART).distinct(), [_PART], "left_semi")
            new = _merged(changed, news, keys)
        written[1] += len({f.split("/")[0] for f in replace_parts(spark, table_path, new, _PART).added})

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    late = sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
    return Kept(*written, late)


def _news(new: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are not beaten by what the table holds for their key. A NULL source is a source like any other."""
    old = held.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(_PART).alias("__part"), F.struct("start_timestamp", "n").alias("__old"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col(_PART) == F.col("__part"))
    return new.join(old, same & (F.col("__old") >= F.struct("start_timestamp", "n")), "left_anti")


def read_watermarks(spark: SparkSession, table_path: str, source: str) -> DataFrame:
    """The current watermark of each source."""
    table = spark.read.parquet(table_path)
    if _PERIOD in table.columns:
        return table.groupBy(source).agg(F.max("start_timestamp").alias("start_timestamp"), F.sum("n").alias("n"))
    return table.select(source, "start_timestamp", "n")
