"""Files that queries need to find: zip archives, empty and hidden files."""

from __future__ import annotations

import itertools
import sys
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.files import filesystem_of, qualified, store_options

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def put_file(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """A file of some bytes, in a folder that exists."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = path_of.getFileSystem(spark._jsc.hadoopConfiguration()).create(path_of)
    out.write(bytearray(content))
    out.close()


def write_zip(df: DataFrame, target: str, member: str, content: str) -> DataFrame:
    """Write text rows as members of zip archives, one archive per non-empty partition; gives one row per archive.

    An archive is written under a name of its own and then moved to its final one, so a task
    that is run again replaces what it wrote before. Run the result through an action once.
    """

    target, options = qualified(df.sparkSession, target), store_options(df.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        filesystem, base = filesystem_of(target, options)
        filesystem.create_dir(base, recursive=True)
        draft = f"{base}/_draft-{uuid.uuid4().hex}"
        count = 0
        with filesystem.open_output_stream(draft) as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for batch in itertools.chain([first], batches):
                    members, texts = (batch.column(c).to_pylist() for c in ("member", "content"))
                    for name, text in zip(members, texts, strict=True):
                        archive.writestr(name, text if text is not None else "")
                        count += 1
        final = f"{base}/part-{number:05d}.zip"
        filesystem.move(draft, final)
        yield pa.RecordBatch.from_pydict({"path": [final], "members": [count]})

    rows = df.select(F.col(member).alias("member"), F.col(content).alias("content"))
    return rows.mapInArrow(write, "path string, members long")
