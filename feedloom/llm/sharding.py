"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

In a uniform random order cut into shards, how many rows of each part of the input come to each shard is a matrix with fixed
sums of rows (the parts) and columns (the shards). It is drawn first, exactly, from two-way splits: of all that a
set of parts holds, each half gets a multivariate hypergeometric share of every shard. Then each part orders its rows by a random
key and deals them out by its row of the matrix, the rows are exchanged, and each shard orders what it was sent by a second
key. Every order of the rows over the shards' places is equally likely, and each shard has its size to the row.

Parts are cells of a hash of the row itself, so results depend neither on how files were split nor on lost tasks. A shard is ordered in
cells too: where each starts is a running sum over counts, so no task holds a shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.operators.joins import settled
from feedloom.operators.ordering import numbered, running_total

#: Rows in a cell, on average.
CELL_ROWS = 8192
#: Cells whose rows of the matrix one task draws; the driver holds one count for each so many cells.
GROUP_BITS = 10


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``good`` are among ``draws`` of ``good + bad``, by inversion of the distribution function.

    Numbers may be of any size: probabilities are multiplied up from the mode over 12 deviations to each side, beyond which lies less
    than a double's rounding.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    share = draws / total
    width = int(12 * math.sqrt(max(good * share * (bad / total) * (1 - share) * total / max(total - 1, 1), 0.0))) + 40
    at = np.arange(max(low, mode - width), min(high, mode + width) + 1, dtype=np.float64)
    up = np.log(good - at[:-1]) + np.log(draws - at[:-1]) - np.log(at[1:]) - np.log(bad - draws + at[1:])
    weight = np.r_[0.0, np.cumsum(up)]
    mass = np.cumsum(np.exp(weight - weight.max()))
    return int(at[min(int(np.searchsorted(mass, rng.random() * mass[-1], "right")), len(at) - 1)])


def shares(rng: np.random.Generator, capacities: Sequence[int], draws: int) -> list[int]:
    """A multivariate hypergeometric draw: how many of ``draws`` come to each shard's free places."""
    left, out = sum(capacities), []
    for capacity in capacities:
        left -= capacity
        got = hypergeometric(rng, capacity, left, draws)
        out.append(got)
        draws -= got
    return out


def matrix(seed: int, parts: Sequence[tuple[int, int]], capacities: Sequence[int]) -> list[list[int]]:
    """Rows of the matrix for parts given as (name, size) whose sizes add up to the capacities'.

    The names of the parts on both sides of a split say which random numbers it takes.
    """
    sums = np.r_[0, np.cumsum([size for _, size in parts], dtype=np.int64)]
    out: list[list[int]] = [[] for _ in parts]
    todo = [(0, len(parts), list(capacities))] if parts else []
    while todo:
        start, stop, free = todo.pop()
        if stop - start == 1:
            out[start] = free
            continue
        middle = (start + stop) // 2
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, parts[start][0], parts[middle][0], parts[stop - 1][0]])))
        here = shares(rng, free, int(sums[middle] - sums[start]))
        todo += [(start, middle, here), (middle, stop, [a - b for a, b in zip(free, here, strict=True)])]
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts at most one apart."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def _cell(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def _bits(rows: int) -> int:
    return max(0, math.ceil(math.log2(max(rows, 1) / CELL_ROWS)))


def _bounds(cells: DataFrame, seed: int, capacities: list[int]) -> DataFrame:
    """Per cell, up to which place of its own order rows go to each shard: ``cell``, ``ends``."""
    spark = cells.sparkSession
    groups = cells.groupBy(F.shiftright("cell", GROUP_BITS).alias("group"))
    sizes = sorted((r["group"], r["n"]) for r in groups.agg(F.sum("n").alias("n")).collect())
    top = list(zip([g for g, _ in sizes], matrix(seed, sizes, capacities), strict=True))
    free = spark.createDataFrame(top, "group long, free array<long>")
    lists = groups.agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells")).join(free, "group")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = [(c["cell"], c["n"]) for c in row["cells"]]
                drawn = matrix(seed + 1, parts, row["free"])
                ends = pa.array([np.cumsum(r).tolist() for r in drawn], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in parts], pa.int64()), ends], names=["cell", "ends"])

    return lists.select("cells", "free").mapInArrow(draw, "cell long, ends array<long>")


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 12, keep: Sequence[str] = ()) -> DataFrame:
    """All documents in uniform random order over ``shards`` shards of as many rows, at most one apart.

    Takes ``doc_id``, ``text`` and the columns to ``keep``; others are ignored. Returns those to keep with ``doc_id``, ``size`` (UTF-8 bytes
    of the text and one), ``text_crc32``, ``shard`` and ``slot``, the place in the shard from 0 without gaps.

    The order depends on the seed and the rows alone. Rows that are equal in all of these columns each have a place of their own, and a group of them,
    however large, is spread like other rows. A null text has no bytes; a null ``doc_id`` is a value like any other. With fewer rows than
    shards, some stay empty; an empty table gives no rows.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", (F.length(body) + F.lit(1).cast("long")).alias("size"), F.crc32(body).alias("text_crc32"), *keep)
    columns = rows.columns
    same = F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32", *keep)
    rows = rows.withColumns({"__same": same, "__any": F.monotonically_increasing_id()})
    rows = numbered(rows, ["__same"], ["__any"], alias="__copy").drop("__any")
    keys = {f"__key{i}": F.xxhash64(F.lit(seed), F.lit(i), "__same", "__copy") for i in (1, 2)}
    rows = settled(rows.withColumns(keys), "shard-rows")

    total = rows.count()
    bits = _bits(total)
    rows = rows.withColumn("__cell", _cell("__key1", bits))
    bounds = _bounds(rows.groupBy(F.col("__cell").alias("cell")).agg(F.count("*").alias("n")), seed, shard_sizes(total, shards))
    local = W.partitionBy("__cell").orderBy("__key1", "__same", "__copy")
    dealt = rows.withColumn("__place", F.row_number().over(local) - 1).join(bounds.withColumnRenamed("cell", "__cell"), "__cell")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("__place"))).cast("int")
    dealt = dealt.withColumn("shard", shard).withColumn("__sub", _cell("__key2", _bits(total // shards)))
    dealt = settled(dealt.select(*columns, "shard", "__sub", "__key2", "__same", "__copy"), "shard-dealt")

    counts = dealt.groupBy("shard", "__sub").agg(F.count("*").alias("__n"))
    starts = running_total(counts, ["shard"], ["__sub"], "__n", F.expr(f"__sub div {1 << GROUP_BITS}"), "__upto")
    starts = starts.select("shard", "__sub", (F.col("__upto") - F.col("__n")).alias("__start"))
    again = W.partitionBy("shard", "__sub").orderBy("__key2", "__same", "__copy")
    placed = dealt.withColumn("__place", F.row_number().over(again) - 1).join(starts, ["shard", "__sub"])
    return placed.select(*columns, "shard", (F.col("__start") + F.col("__place")).cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """A folder per shard, its files in the order of the shard's places."""
    by = ["shard", "slot"]
    placed.repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy("shard").parquet(path)
