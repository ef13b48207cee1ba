"""Global sorts, and numbering and running totals within groups of any size.

A window over a group runs in one task. Where one group may hold a large share of all
rows, the group is cut into chunks along the order: rows are numbered or summed inside
their chunk, and what the chunks before hold is added. A chunk expression must never
fall as the order rises (``id div 4096``, the day of a time, the first letters of a name).
Results do not depend on how it cuts; only the size of the largest task does. What the chunks
before hold is itself worked out range by range, so the one step that takes a group
as a whole has a row per range of it, of which there are as many as partitions. Numbering
needs no chunks: without an expression the rows are cut into ranges themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from feedloom.operators.joins import settled

_CHUNK = "__chunk"
_RANGE = "__range"


def global_sort(df: DataFrame, order: Sequence[str | Column], ties: Sequence[str] = ()) -> DataFrame:
    """Sort all rows. ``ties`` break equal order values, so that a frequent one still spreads over partitions."""
    return df.orderBy(*order, *ties)


def sorted_runs(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sort inside each partition only, without a shuffle."""
    return df.sortWithinPartitions(*order)


#: Where a row of a Parquet file lies: columns that :func:`with_place` adds.
PLACE = ["__file", "__row"]


def with_place(table: DataFrame) -> DataFrame:
    """Rows of a Parquet table with their place in it: the file's number in the order of paths and the row's number there.

    A row carries a number, not its file's path, which would make each row that is sorted by its place several times wider.
    The paths are numbered in a table of a row per file, written first so that Spark knows it is small.
    """
    path = "__path"
    rows = table.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(PLACE[1]))
    files = settled(rows.select(path).distinct(), "files")
    numbered = files.select(path, F.row_number().over(W.orderBy(path)).alias(PLACE[0]))
    return rows.join(numbered, path).select(*table.columns, *PLACE)


def stable_sort(table: DataFrame, order: Sequence[str | Column], place: Sequence[str] = ()) -> DataFrame:
    """Sort all rows, equal ones in the order they have in the table.

    ``table`` is read from Parquet files, whose paths and row numbers give that order, unless ``place`` names columns that do. The place also breaks ties
    between partitions, so one frequent value spreads.
    """
    if place:
        return table.orderBy(*order, *place)
    return with_place(table).orderBy(*order, *PLACE).drop(*PLACE)


def write_sorted_runs(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> None:
    """A catalog table of one file per bucket of the keys, sorted by them and then by ``order``. One shuffle.

    Tables written so with equally many buckets are joined and merged by these keys without shuffle or sort; see :func:`read_sorted_runs`.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys, *order).format("parquet").option("path", path).saveAsTable(name)


def read_sorted_runs(spark: SparkSession, name: str) -> DataFrame:
    """A table of sorted runs, whose order Spark is told to rely on. The setting holds for the session."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return spark.table(name)


def range_chunks(
    df: DataFrame, group: Sequence[str], order: Sequence[str], chunks: int | None = None, alias: str = "chunk"
) -> DataFrame:
    """The same rows with a chunk column that cuts groups evenly, however their order values lie.

    Rows are range-partitioned by group and order, and the partition number is the chunk. Where the
    ranges end is sampled anew each time they are worked out, so the rows are settled with it.
    """
    by = [*group, *order]
    ranged = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    return settled(ranged.withColumn(alias, F.spark_partition_id()), "range-chunks")


def _with_marks(df: DataFrame, marks: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows with the marks of their group and range; a NULL in the group is a value like any other."""
    names = {g: f"__of_{i}" for i, g in enumerate([*group, _RANGE])}
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]
    return df.join(marks.withColumnsRenamed(names), reduce(lambda a, b: a & b, same)).drop(*names.values())


def _before(df: DataFrame, group: Sequence[str], totals: dict[str, Column], whole: dict[str, str]) -> DataFrame:
    """Per group and chunk, each total over the chunks before it, and over the whole group where asked."""
    chunks = df.groupBy(*group, _CHUNK).agg(*[t.alias(a) for a, t in totals.items()])
    cut = range_chunks(chunks, group, [_CHUNK], alias=_RANGE)
    ranges = cut.groupBy(*group, _RANGE).agg(*[F.sum(a).alias(a) for a in totals])
    earlier = W.partitionBy(*group).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    marks = {f"{a}_earlier": F.coalesce(F.sum(a).over(earlier), F.lit(0)) for a in totals}
    marks |= {name: F.sum(a).over(W.partitionBy(*group)) for a, name in whole.items()}
    marked = _with_marks(cut, ranges.select(*group, _RANGE, *[c.alias(n) for n, c in marks.items()]), group)
    inside = W.partitionBy(*group, _RANGE).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    out = {f"{a}_before": F.col(f"{a}_earlier") + F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in totals}
    return marked.select(*group, _CHUNK, *[c.alias(n) for n, c in out.items()], *whole.values())


def _numbered_by_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], alias: str, total: str | None) -> DataFrame:
    """Rows are shuffled once, to ranges of group and order, and settled there with their place.

    A table of a row per group and range then says where each range's numbers start.
    """
    by = [*group, *order]
    place = {_RANGE: F.spark_partition_id(), "__place": F.monotonically_increasing_id()}
    rows = settled(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(place), "ranges")
    parts = rows.groupBy(*group, _RANGE).agg(F.min("__place").alias("__first"), F.count("*").alias("__rows"))
    earlier = W.partitionBy(*group).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first") + 1
    whole = F.sum("__rows").over(W.partitionBy(*group))
    marks = settled(parts.select(*group, _RANGE, start.alias("__start"), whole.alias("__whole")), "range-marks")
    new = [(F.col("__start") + F.col("__place")).alias(alias), *([F.col("__whole").alias(total)] if total else [])]
    return _with_marks(rows, marks, group).select(*df.columns, *new)


def _inside(
    df: DataFrame, group: Sequence[str], order: Sequence[str], marks: DataFrame
) -> tuple[DataFrame, WindowSpec]:
    """Rows and the marks of their chunks together, with a window over a chunk that has its mark first.

    The mark brings the totals before the chunk into the window, so that nothing has
    to be joined: one shuffle by group and chunk serves both.
    """
    rows = df.unionByName(marks.withColumn("__mark", F.lit(True)), allowMissingColumns=True)
    return rows, W.partitionBy(*group, _CHUNK).orderBy(F.col("__mark").isNull(), *order)


def numbered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    alias: str = "n",
    total: str | None = None,
) -> DataFrame:
    """Number the rows of each group from 1. The order must be total; ``total`` also adds the group's size."""
    if chunk is None:
        return _numbered_by_ranges(df, group, order, alias, total)
    df = df.withColumn(_CHUNK, chunk)
    marks = _before(df, group, {"__rows": F.count("*")}, {"__rows": "__whole"} if total else {})
    rows, inside = _inside(df, group, order, marks)
    frame = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    new = {alias: F.max("__rows_before").over(frame) + F.row_number().over(inside) - 1}
    if total:
        new[total] = F.max("__whole").over(frame)
    rows = rows.withColumns(new)
    keep = [*[c for c in df.columns if c != _CHUNK], alias, *([total] if total else [])]
    return rows.where(F.col("__mark").isNull()).select(*keep)


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, chunk: Column, alias: str = "running"
) -> DataFrame:
    """Sum of ``value`` up to and with each row of its group. The order must be total."""
    df = df.withColumn(_CHUNK, chunk)
    marks = _before(df, group, {"__sum": F.sum(value)}, {})
    rows, inside = _inside(df, group, order, marks)
    frame = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    here = F.coalesce(F.sum(value).over(frame), F.lit(0))
    rows = rows.withColumn(alias, F.max("__sum_before").over(frame) + here)
    return rows.where(F.col("__mark").isNull()).select(*[c for c in df.columns if c != _CHUNK], alias)


def over_cap(
    df: DataFrame, group: Sequence[str], order: Sequence[str], size: str, cap: int, chunk: Column
) -> DataFrame:
    """Running size within each group, and whether it has passed the cap there."""
    out = running_total(df, group, order, size, chunk, "running_size")
    return out.withColumn("over_cap", F.col("running_size") > cap)
