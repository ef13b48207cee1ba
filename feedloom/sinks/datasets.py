"""Writing extracts, their watermark and their load manifest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.files import WATERMARK

RECORDS_PER_FILE = 500_000


@dataclass(frozen=True)
class Written:
    """What a write put out: where, how many rows, and the greatest watermark value among them."""

    location: str
    record_count: int
    watermark: Any = None


def dated_target(location: str, run_date: date | str | None = None) -> str:
    """The target folder, with a subfolder for the run date if one is given."""
    return location if run_date is None else f"{location.rstrip('/')}/{run_date}"


def write_dataset(
    df: DataFrame,
    location: str,
    file_format: str = "parquet",
    mode: str = "append",
    records_per_file: int | None = RECORDS_PER_FILE,
    watermark: str | None = None,
    watermark_type: str = "timestamp",
    partition_by: Sequence[str] = (),
    **options: str,
) -> Written:
    """Write a dataset; count it and take its watermark in the same pass.

    The source is read once, so data, count and watermark always agree. The watermark is
    cast before the maximum is taken, so numbers and dates held as text compare rightly.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    if watermark is not None:
        measures.append(F.max(F.col(watermark).cast(watermark_type)).cast("string").alias("top"))
    seen = Observation()
    writer = df.observe(seen, *measures).write.mode(mode).format(file_format).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.save(location)
    return Written(location, seen.get["rows"], seen.get.get("top"))


def max_watermark(df: DataFrame, column: str, data_type: str = "timestamp", alias: str = WATERMARK) -> DataFrame:
    """The greatest value of a column after a cast, as one row."""
    return df.agg(F.max(F.col(column).cast(data_type)).alias(alias))


def write_watermark(
    spark: SparkSession,
    written: Written,
    location: str,
    alias: str = WATERMARK,
    data_type: str = "timestamp",
    mode: str = "overwrite",
    file_format: str = "csv",
) -> bool:
    """Store the watermark of a write as one file, CSV with a header unless told otherwise; nothing if no rows were
    written."""
    if not written.record_count or written.watermark is None:
        return False
    row = spark.createDataFrame([(written.watermark,)], "v string").select(F.col("v").cast(data_type).alias(alias))
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    writer = row.coalesce(1).write.mode(mode).format(file_format).option("header", "true")
    writer.option("timestampFormat", pattern).option("timestampNTZFormat", pattern).save(location)
    return True


def load_manifest(
    spark: SparkSession,
    written: Written,
    location: str,
    feed_id: str,
    feed_version: str = "1",
    file_format: str = "parquet",
    header: bool = False,
    delimiter: str = ",",
    run_id: str = "na",
) -> DataFrame:
    """Write one JSON document that describes a load, and give it as a row."""
    if not feed_id:
        raise ValueError("a load manifest needs a feed id")
    row = spark.createDataFrame(
        [(feed_id, feed_version, run_id, written.location, written.record_count, file_format, header, delimiter)],
        "feed_id string, feed_version string, run_id string, location string, record_count long, "
        "file_format string, is_header boolean, delimiter string",
    )
    row.coalesce(1).write.mode("overwrite").json(location)
    return row
