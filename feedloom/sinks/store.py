"""A few acts on the file system of a path, through Hadoop, so that every store Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def path_of(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def system_of(spark: SparkSession, path: str):
    return path_of(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, without a slash at the end."""
    return system_of(spark, path).makeQualified(path_of(spark, path)).toString()


def decoded(spark: SparkSession, uri: str) -> str:
    """A path out of a URI as ``_metadata.file_path`` gives it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return system_of(spark, path).exists(path_of(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in system_of(spark, path).listStatus(path_of(spark, path)))


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder, relative to it."""
    base, found = qualified(spark, path), []
    walk = system_of(spark, path).listFiles(path_of(spark, path), True)
    while walk.hasNext():
        found.append(walk.next().getPath().toString()[len(base) + 1 :])
    return sorted(found)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, making the target's folder where it is missing."""
    files = system_of(spark, target)
    files.mkdirs(path_of(spark, target).getParent())
    if not files.rename(path_of(spark, source), path_of(spark, target)):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it; nothing if it is not there."""
    system_of(spark, path).delete(path_of(spark, path), True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file with this text that is there as a whole or not at all; an error if there is one already."""
    if exists(spark, path):
        raise FileExistsError(path)
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    out = system_of(spark, path).create(path_of(spark, draft), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, draft, path)


def text_of(spark: SparkSession, path: str) -> str:
    stream = system_of(spark, path).open(path_of(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
