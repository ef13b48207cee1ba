"""Files: manifests, text lines, watermarks and status documents."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import partial, reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.joins import settled

# Tasks get the functions they run by value, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WATERMARK = "max_start_timestamp"
BATCH_ROWS = 8192


# Hadoop's S3 settings, and what Arrow's file system calls them.
_S3 = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}


def store_options(spark: SparkSession) -> dict[str, str]:
    """Settings of the cluster's object store that file access inside tasks has to share."""
    conf = spark._jsc.hadoopConfiguration()
    return {name: conf.get(key) for key, name in _S3.items() if conf.get(key)}


def filesystem_of(uri: str, options: Mapping[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """A file system for use inside tasks, and the path there: local paths, ``file``, ``hdfs``, ``gs``, ``abfs`` and
    ``s3`` (``s3a``, ``s3n``).

    ``options`` are those of :func:`store_options`, for S3. Other settings of Hadoop do not reach Arrow.
    """
    # Hadoop writes local paths as file:/a/b, and has several names for S3.
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    scheme, mark, rest = uri.partition("://")
    if scheme in ("s3a", "s3n", "s3"):
        if options:
            return fs.S3FileSystem(**options), rest
        uri = f"s3{mark}{rest}"
    return fs.FileSystem.from_uri(quote(uri, safe=":/") if mark else uri)


def spread(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Rows that each stand for much work, such as files to open, over a fixed number of tasks.

    By default as many as there are shuffle partitions. Without a number Spark would merge the
    partitions, since the rows themselves are small.
    """
    return df.repartition(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and host that the cluster's settings give it, as manifests have it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


_LISTED = "path string, modificationTime timestamp, length long, is_folder boolean"
# So many folders are enough to spread over the tasks; each is then walked by one.
_FOLDERS_PER_TASK = 4


def _list(batches: Iterator[pa.RecordBatch], deep: bool, options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder; with ``deep`` also below it, folder after folder."""
    for batch in batches:
        for root in batch.column("path").to_pylist():
            filesystem, base = filesystem_of(root, options)
            root, cut = root.rstrip("/"), len(base.rstrip("/"))
            todo = [base]
            while todo:
                found = filesystem.get_file_info(fs.FileSelector(todo.pop()))
                if deep:
                    todo += [i.path for i in found if not i.is_file]
                    found = [i for i in found if i.is_file]
                for start in range(0, len(found), BATCH_ROWS):
                    part = found[start : start + BATCH_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([root + i.path[cut:] for i in part], pa.string()),
                            pa.array([i.mtime for i in part], pa.timestamp("us", "UTC")),
                            pa.array([i.size if i.is_file else None for i in part], pa.int64()),
                            pa.array([not i.is_file for i in part], pa.bool_()),
                        ],
                        names=["path", "modificationTime", "length", "is_folder"],
                    )


def manifest(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """One row per file: ``path``, ``modificationTime`` and ``length``. Empty files and those named ``_*`` or ``.*``
    are listed too.

    Folders are listed level by level until there are several for each task, which then walk what is below
    them. A task holds one folder's entries at a time; the driver holds none. Listings are settled, so that later steps see
    one state of the store.
    """
    paths = [path] if isinstance(path, str) else list(path)
    options = store_options(spark)
    folders = spark.createDataFrame([(qualified(spark, p),) for p in paths], "path string")
    enough = _FOLDERS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed: list[DataFrame] = []
    while True:
        level = settled(spread(folders, ["path"]).mapInArrow(partial(_list, deep=False, options=options), _LISTED), "listing")
        listed.append(level.where("not is_folder"))
        folders = level.where("is_folder").select("path")
        count = folders.count() if recursive else 0
        if count == 0:
            break
        if count >= enough:
            below = spread(folders, ["path"]).mapInArrow(partial(_list, deep=True, options=options), _LISTED)
            listed.append(settled(below, "listing"))
            break
    return reduce(DataFrame.union, listed).drop("is_folder")


def file_path() -> Column:
    """Path of the file a row is from, spelled as in a manifest.

    Spark's metadata column has it URL-encoded, except for the plus sign, which decoding would turn into a blank.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """Lines of text files as ``path`` and ``value``. ``.gz`` files are unpacked on reading, each by one task."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    return reader.text(paths).select(file_path().alias("path"), "value")


def data_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not blank."""
    return lines.where(F.col("value").rlike(r"\S"))


def read_watermark(spark: SparkSession, path: str, column: str = WATERMARK, data_type: str = "timestamp") -> DataFrame:
    """The watermark stored under a path, as one row.

    Several files, as a broken-off run may leave, give the greatest value; none with data gives NULL.
    """
    stored = spark.read.schema(f"`{column}` {data_type}").option("header", "true").csv(path)
    return stored.agg(F.max(column).alias(column))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Status documents, one JSON object per file, as ``path`` and ``count``."""
    documents = spark.read.schema("count long").option("multiLine", "true").json(path)
    return documents.select(file_path().alias("path"), "count")
