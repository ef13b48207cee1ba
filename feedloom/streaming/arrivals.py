"""Files as they arrive, each processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedloom.sources.files import file_path


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    newest_first: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder, oldest first unless told otherwise.

    Newest first changes the order only: older files are still read, later. The
    path of the file each row is from comes as ``file_path``.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("latestFirst", str(newest_first).lower())
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).withColumn("file_path", file_path())


def process_new_files(stream: DataFrame, target: str, checkpoint: str, file_format: str = "parquet") -> None:
    """Append what has arrived since the last call to a dataset, and return.

    The checkpoint remembers the files read; the sink's log makes each batch count once
    even if it is run again after a failure.
    """
    query = (
        stream.writeStream.format(file_format)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
