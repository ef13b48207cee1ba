"""Joins against a side whose keys are unique."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch

_ROUTE = "__route"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words of 64 bits by which rows are sifted, at most: a row of two numbers each, sent to all tasks. Keys that share a word
#: make it let more rows pass, and with more than so many to a word, sifting is not worth it.
SIFT_WORDS = 1 << 20
_SIFT_KEYS = 32
_SIFT_TYPES = {"string", "binary", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp"}


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared scratch folder and go on from there.

    For a reduced side of a join with a much larger one. Spark knows the size of a written
    table when it plans: a small one is broadcast and the large side is not shuffled at all,
    a large one is not. For a grouped table it has an upper bound only, and finds out the real size
    when it has already shuffled both sides. The table also serves several readers. Once it is written, the
    shuffle files behind it are removed.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with _freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bits(keys: Sequence[Column], words: int) -> tuple[Column, Column]:
    """The word of a key and four of its 64 bits."""
    spread = F.xxhash64(*keys)
    again = F.xxhash64(spread, F.lit(1))
    one = F.lit(1).cast("bigint")
    spots = [F.shiftrightunsigned(again, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    return F.pmod(spread, F.lit(words)), reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, at) for at in spots])


def parted(rows: DataFrame, keys: DataFrame, on: Sequence[str] | Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those that may have an equal in ``keys``, and those that for sure have none. Nothing is shuffled for it.

    All rows that have one are in the first, and a few others. What is sent to all tasks is a table of hashed bits (a Bloom filter by
    words) of a bounded size; where there are too many keys for it, all rows are in the first. Columns whose types differ or are not
    plain are passed over. ``keys`` is read twice: a settled table.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    left, right = dict(rows.dtypes), dict(keys.dtypes)
    pairs = {a: b for a, b in pairs.items() if left[a] == right[b] and left[a] in _SIFT_TYPES}
    count = keys.count()
    if not pairs or count > SIFT_WORDS * _SIFT_KEYS:
        return rows, rows.limit(0)
    words = max(1, min(SIFT_WORDS, count // 4))
    word, bits = _bits([F.col(b) for b in pairs.values()], words)
    table = keys.select(word.alias("__word"), bits.alias("__bits")).groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    word, bits = _bits([F.col(a) for a in pairs], words)
    test = (word == F.col("__word")) & (bits.bitwiseAND(F.col("__bits")) == bits)
    return rows.join(F.broadcast(table), test, "left_semi"), rows.join(F.broadcast(table), test, "left_anti")


def sifted(rows: DataFrame, keys: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """``rows`` without most of those that have no equal in ``keys``, before they are shuffled to be joined to it, which still has to
    follow. See :func:`parted`."""
    return parted(rows, keys, on)[0]


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing the job if two of them share a key. Rows with a NULL key, which match nothing, are left out."""
    df = df.dropna(subset=list(keys))
    clash = F.raise_error(F.concat_ws(" ", F.lit("several source rows for key"), *[F.col(k).cast("string") for k in keys]))
    merged = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(*df.columns)).alias("__row"))
    checked = F.when(F.col("__n") == 1, F.col("__row")).otherwise(clash)
    return merged.select(checked.alias("__row")).select("__row.*")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    how: str = "left",
    extra: Column | None = None,
    route: bool = True,
) -> DataFrame:
    """Join ``left`` to a ``right`` side with at most one row per key.

    The right side is mostly a grouped table. Grouping leaves it partitioned by the
    join keys, so Spark would join without shuffling it again; but adaptive execution
    splits a hot partition only where *both* sides are shuffled for the join. A hash
    of the keys as one more equality brings that about. It costs one more shuffle of
    the (pre-aggregated) right side, and lets the rows of a hot key on the left be
    spread over many tasks, since each needs only the one right row. A NULL key
    matches nothing. Small right sides are broadcast by Spark itself, by their size; where the
    left side is large, see :func:`settled`.

    ``how`` is one of ``left``, ``inner``, ``left_semi`` and ``left_anti``; key columns of the
    right side are dropped from the result. ``extra`` is a further condition, whose
    column names must be found on one side only. Without ``route`` the hash is left out: for tables that are
    bucketed by the keys, which then join without a shuffle.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    left_types = {f.name: f.dataType for f in left.schema.fields}
    right_types = {f.name: f.dataType for f in right.schema.fields}
    for lk, rk in pairs.items():
        if left_types[lk] != right_types[rk]:
            raise TypeError(f"join keys differ in type: {lk} {left_types[lk]}, {rk} {right_types[rk]}")
    names = {rk: f"__right_{i}" for i, rk in enumerate(pairs.values())}
    tests = []
    if route:
        right = right.withColumn(_ROUTE + "_r", F.xxhash64(*pairs.values()))
        left = left.withColumn(_ROUTE, F.xxhash64(*pairs.keys()))
        tests.append(F.col(_ROUTE) == F.col(_ROUTE + "_r"))
    right = right.withColumnsRenamed(names)
    tests += [F.col(lk) == F.col(names[rk]) for lk, rk in pairs.items()]
    if extra is not None:
        tests.append(extra)
    joined = left.join(right, reduce(lambda a, b: a & b, tests), how)
    return joined.drop(_ROUTE, _ROUTE + "_r", *names.values())
