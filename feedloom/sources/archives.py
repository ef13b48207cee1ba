"""Zip archives: listing and reading.

An archive is opened where the task runs and read through in small batches, so neither
an archive nor a member has to fit in memory. Members are listed first and then spread
over tasks, so one large archive keeps many tasks busy. ``.gz`` files need none of this:
Spark's text and CSV readers unpack them.
"""

from __future__ import annotations

import io
import itertools
import sys
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import ExitStack, contextmanager
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.files import BATCH_ROWS, filesystem_of, manifest, spread, store_options

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 8 << 20


class _Seekable(io.RawIOBase):
    """An Arrow file that refuses a bad position the way Python files do, which short archives rely on."""

    def __init__(self, file):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        base = {io.SEEK_SET: 0, io.SEEK_CUR: self._file.tell(), io.SEEK_END: self._file.size()}[whence]
        if base + offset < 0:
            raise OSError(f"negative position {base + offset}")
        return self._file.seek(base + offset)

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


@contextmanager
def _open_zip(uri: str, options: Mapping[str, str]) -> Iterator[zipfile.ZipFile]:
    filesystem, path = filesystem_of(uri, options)
    with io.BufferedReader(_Seekable(filesystem.open_input_file(path)), 1 << 20) as file:
        with zipfile.ZipFile(file) as archive:
            yield archive


class _Rows:
    """Collects rows of some columns and hands them on as Arrow batches of a bounded size."""

    def __init__(self, schema: pa.Schema):
        self._schema = schema
        self._held: list[tuple] = []
        self._bytes = 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self._held.append(row)
        self._bytes += size
        if len(self._held) == BATCH_ROWS or self._bytes >= BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._held:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self._held, strict=True), self._schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self._schema)
        self._held, self._bytes = [], 0


def _list_members(batches: Iterator[pa.RecordBatch], options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    rows = _Rows(pa.schema([("path", pa.string()), ("member", pa.string()), ("length", pa.int64())]))
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            with _open_zip(uri, options) as archive:
                for info in archive.infolist():
                    if not info.is_dir():
                        yield from rows.add((uri, info.filename, info.file_size))
    yield from rows.rest()


def _read_members(batches: Iterator[pa.RecordBatch], options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("line", pa.int64()), ("value", pa.string())])
    rows = _Rows(schema)
    # Members come sorted by archive, and an archive stays open from one batch to the next: its listing, which grows with it, is read once a task.
    with ExitStack() as opened:
        held, archive = None, None
        for batch in batches:
            for uri, member in zip(batch.column("path").to_pylist(), batch.column("member").to_pylist(), strict=True):
                if uri != held:
                    opened.close()
                    held, archive = uri, opened.enter_context(_open_zip(uri, options))
                with io.TextIOWrapper(archive.open(member), "utf-8") as lines:
                    for number, line in enumerate(lines):
                        yield from rows.add((uri, member, number, line.rstrip("\n")), len(line))
    yield from rows.rest()


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """One row per file in the zip archives below a path: ``path``, ``member``, ``length``."""
    archives = manifest(spark, path).where(F.endswith(F.lower("path"), F.lit(".zip"))).select("path")
    return spread(archives, ["path"]).mapInArrow(partial(_list_members, options=store_options(spark)), "path string, member string, length long")


def read_zip_lines(members: DataFrame, tasks: int | None = None) -> DataFrame:
    """Lines of archive members: ``path``, ``member``, ``line`` (from 0), ``value``. Takes rows of :func:`zip_members`."""
    keys = ["path", "member"]
    work = spread(members.select(*keys), keys, tasks).sortWithinPartitions(*keys)
    return work.mapInArrow(partial(_read_members, options=store_options(members.sparkSession)), "path string, member string, line long, value string")
