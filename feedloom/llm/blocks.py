"""Exchange of packed number columns between tasks.

Positions in text outnumber documents by orders of magnitude. As rows of their own they would
cost far more than the text. Here a task packs what it has for one bucket into a few byte strings, one row
per about a million entries and bucket. Spark deals these rows out, and the bucket's task unpacks and works on arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at a time; a longer document is taken by itself.
SLICE_BYTES = 2 << 20
#: Bytes of rows that Spark hands to Python at a time. Whole texts make rows of some kB, and pairs of texts twice that; Spark's own bound
#: of 64 MB is held several times over in the JVM and in each Python process.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> None:
    """Bound the Arrow batches of the session of ``df`` by bytes, unless something other than Spark's default is set. A single larger row is a batch."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) == "67108864b":
        conf.set(key, str(BATCH_BYTES))


def buckets_of(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed_schema(names: list[str]) -> str:
    """DDL of packed rows with these columns."""
    return ", ".join(["bucket int", *(f"{n} binary" for n in names)])


def _pack(values: np.ndarray) -> bytes:
    """Bytes in planes, so that equal high bytes lie together and shuffles compress them."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _unpack(data: bytes, dtype: np.dtype) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _pack_runs(values: np.ndarray) -> bytes:
    """Each value once for as long as it repeats, after how many runs there are and how long each is."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    lengths = np.diff(np.r_[first, len(values)]).astype("<u4")
    return len(first).to_bytes(4, "little") + _pack(lengths) + _pack(np.ascontiguousarray(values[first]))


def _unpack_runs(data: bytes, dtype: np.dtype) -> np.ndarray:
    cut = 4 + 4 * int.from_bytes(data[:4], "little")
    return np.repeat(_unpack(data[cut:], dtype), _unpack(data[4:cut], np.dtype("<u4")))


def _repeats(name: str) -> bool:
    """Whether a column holds documents' keys, which many entries in a row share."""
    return name.endswith(("id", "tag"))


def packed(columns: dict[str, np.ndarray], bucket: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per bucket that has entries, with nulls for names without a column; entries keep their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(sorted_bucket)) + 1
    keys = sorted_bucket[np.r_[0, cuts]].astype(np.int32)
    parts = {n: [(_pack_runs if _repeats(n) else _pack)(x) for x in np.split(np.ascontiguousarray(v)[order], cuts)] for n, v in columns.items()}
    arrays = [pa.array(parts.get(n, [None] * len(keys)), pa.binary()) for n in names]
    yield pa.RecordBatch.from_arrays([pa.array(keys), *arrays], names=["bucket", *names])


def unpacked(batches: Iterator[pa.RecordBatch], dtypes: dict[str, str]) -> dict[str, np.ndarray]:
    """All entries a bucket's task was given."""
    parts: dict[str, list[np.ndarray]] = {n: [] for n in dtypes}
    for batch in batches:
        for n, kind in dtypes.items():
            parts[n] += [(_unpack_runs if _repeats(n) else _unpack)(x, np.dtype(kind)) for x in batch.column(n).drop_null().to_pylist()]
    return {n: np.concatenate(p) if p else np.empty(0, dtypes[n]) for n, p in parts.items()}


def dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Packed rows at the tasks of their buckets."""
    return rows.repartitionById(buckets, "bucket")


#: Entries a task gathers before it packs them: enough to fill many buckets, and some tens of MB.
ENTRIES = 1 << 20

Entries = tuple[dict[str, np.ndarray], np.ndarray]
Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _gathered(entries: Iterator[Entries], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Entries of many slices packed together, those with the same columns to one row per bucket."""
    held: dict[tuple[str, ...], list[Entries]] = {}
    count = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for columns, parts in held.items():
            joined = {n: np.concatenate([p[n] for p, _ in parts]) for n in columns}
            yield from packed(joined, np.concatenate([b for _, b in parts]), names)
        held.clear()

    for columns, bucket in entries:
        held.setdefault(tuple(columns), []).append((columns, bucket))
        count += len(bucket)
        if count >= ENTRIES:
            yield from rows()
            count = 0
    yield from rows()


def exchange(
    rows: DataFrame, emit: Callable[[pa.RecordBatch], Iterator[Entries]], names: list[str], work: Work, schema: str, buckets: int
) -> DataFrame:
    """``emit`` gives what a batch of rows has, as columns with the bucket of each entry; ``work`` answers for all
    entries of a bucket."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered((e for batch in batches if batch.num_rows for e in emit(batch)), names)

    return dealt(rows.mapInArrow(emitted, packed_schema(names)), buckets).mapInArrow(work, schema)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts add up to about the limit."""
    offsets = text_offsets(texts)[1]
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def text_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column, and where each row starts; nulls are empty."""
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return held[first : int(offsets[-1]) if len(offsets) else 0], offsets.astype(np.int64) - first


def list_array(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Lists cut out of consecutive values; ``starts`` has one more entry than there are lists."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))


def homes(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket at which all that concerns a document is brought together."""
    spread = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((spread >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def record_batches(columns: list[pa.Array], names: list[str], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, whole.num_rows, rows):
        yield whole.slice(at, rows)
