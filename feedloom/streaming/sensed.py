"""Files as they arrive, each batch with the audit rows that say what was taken.

A batch is written to a folder of its own, named after the stream and the batch, and so are its audit rows; the audit rows
come last and are what makes the data count. A batch that runs again after a failure writes both anew in the same place, and one whose
audit rows are there is passed over, so neither is ever there twice or without the other. Which files a load takes is decided from the audit table, so a
new checkpoint that lists old files again takes none of them a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.filesets import FIRST_TIME, SELECTIONS, last_processed
from feedloom.operators.joins import lookup, settled
from feedloom.sinks import store

#: Columns of the audit table besides ``stream`` and ``batch``, which its folders name.
AUDIT = "domain_name string, load_name string, feed_date date, file_path string, file_name string, file_mod_time timestamp, rows long, is_sensed boolean"
_META = {"file_path": "_metadata.file_path", "file_name": "_metadata.file_name", "file_mod_time": "_metadata.file_modification_time"}


def sensed_stream(
    spark: SparkSession, path: str, schema: str, file_format: str = "parquet", files_per_batch: int | None = None, pattern: str | None = None
) -> DataFrame:
    """A stream over the files of a folder, each row with ``file_path``, ``file_name`` and ``file_mod_time``."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).withColumns({c: F.col(m) for c, m in _META.items()})


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """All audit rows, of every stream and batch."""
    schema = f"{AUDIT}, stream string, batch long"
    if not store.exists(spark, audit_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(audit_path)


def read_arrived(spark: SparkSession, data_path: str, audit_path: str) -> DataFrame:
    """The rows of all batches that have audit rows. What a failed batch has left does not count."""
    committed = settled(read_audit(spark, audit_path).select("stream", "batch").distinct(), "committed-batches")
    if committed.isEmpty():
        raise FileNotFoundError(f"no batch has been committed to {data_path}")
    data = spark.read.parquet(data_path)
    return data.join(committed, ["stream", "batch"], "left_semi")


def take_new(files: DataFrame, audit: DataFrame, loads: Sequence[str], selection: str) -> DataFrame:
    """Files (one row each) that a load takes: those newer than the last it has taken.

    ``NEWER_OLDEST`` takes them all, one after the other in order of time; ``NEWER_LATEST`` takes the latest only and passes over the others for
    good. Of files of one time the last by name is the latest, and files of the last time taken are not newer.
    """
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}")
    last = last_processed(audit).select(*loads, "last_time")
    since = F.coalesce(F.col("last_time"), F.lit(FIRST_TIME).cast("timestamp"))
    newer = lookup(files, last, loads).where(F.col("file_mod_time") > since).drop("last_time")
    if selection == "NEWER_OLDEST":
        return newer
    latest = newer.groupBy(*loads).agg(F.max_by("file_path", F.struct("file_mod_time", "file_name")).alias("__latest"))
    return lookup(newer, latest, loads, "inner", extra=F.col("file_path") == F.col("__latest")).drop("__latest")


def process_sensed(
    stream: DataFrame,
    data_path: str,
    audit_path: str,
    checkpoint: str,
    name: str,
    domain_name: str,
    load_name: str,
    feed_date: str,
    selection: str = "NEWER_OLDEST",
) -> None:
    """Take what has arrived for a load since the last call, and return.

    Data goes to ``<data_path>/stream=<name>/batch=<number>`` and audit rows to the same folders below ``audit_path``. The number goes on from those
    in the audit table where a new checkpoint starts over. Read both with :func:`read_arrived` and :func:`read_audit`. One job at a time may run for a name.

    With ``NEWER_OLDEST`` files of one time that come in different batches would be lost to the later one, so files of a time already
    taken count as new if their path was not taken.
    """
    spark = stream.sparkSession
    before = read_audit(spark, audit_path).where(F.col("stream") == name)
    offset = _offset(spark, checkpoint, before)
    load = {"domain_name": F.lit(domain_name), "load_name": F.lit(load_name)}

    def put(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        place = f"stream={name}/batch={offset + number}"
        audit, data = f"{audit_path.rstrip('/')}/{place}", f"{data_path.rstrip('/')}/{place}"
        if store.exists(session, f"{audit}/_SUCCESS"):
            return
        taken = read_audit(session, audit_path).where((F.col("stream") == name) & (F.col("batch") < offset + number))
        files = batch.groupBy(*_META).agg(F.count("*").alias("rows")).withColumns(load)
        files = settled(files, "batch-files")
        keys = ["domain_name", "load_name"]
        chosen = take_new(files, taken, keys, selection)
        if selection == "NEWER_OLDEST":
            same_time = lookup(files, last_processed(taken).select(*keys, "last_time"), keys, "inner").where("file_mod_time = last_time")
            known = taken.select("file_path", *keys).distinct()
            chosen = chosen.unionByName(lookup(same_time, known, ["file_path", *keys], "left_anti").drop("last_time"))
        chosen = settled(chosen, "batch-chosen")
        rows = lookup(batch, chosen.select("file_path"), ["file_path"], "left_semi")
        rows.write.mode("overwrite").parquet(data)
        record = chosen.withColumns({"feed_date": F.lit(feed_date).cast("date"), "is_sensed": F.lit(True)})
        names = [c.split()[0] for c in AUDIT.split(", ")]
        record.select(*names).write.mode("overwrite").parquet(audit)

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _offset(spark: SparkSession, checkpoint: str, before: DataFrame) -> int:
    """Where the batches of a checkpoint start in the audit table's numbers; fixed by the checkpoint's first run."""
    mark = f"{checkpoint.rstrip('/')}/audit-offset"
    if store.exists(spark, mark):
        return int(store.text_of(spark, mark))
    last = before.agg(F.max("batch")).first()[0]
    offset = 0 if last is None else last + 1
    store.put_text(spark, mark, str(offset))
    return offset
