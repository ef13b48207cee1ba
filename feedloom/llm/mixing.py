"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.joins import settled

WORD = r"[^\x20\x09-\x0D]+"
#: Documents to a cell of the ranking; a cell is what one task orders.
CELL_ROWS = 2_000


def uniform(seed: str) -> Column:
    """A number in (0, 1) that depends on ``doc_id`` and seed only: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sources: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """Words wanted of each source (``source``, ``source_size``, ``n``): adds ``target``.

    Sources in order of their names, null last, get the weights in turn. ``share`` times all words are dealt out by
    weight; no source gets more than ``cap`` times its size, and what that leaves over goes to the others by weight.
    In ascending order of cap per weight, the sources up to some point are at their caps, and the rest share what is
    left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight).withColumn("cap", cap * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0))
    level = ranked.withColumn("level", left / F.sum("weight").over(ahead)).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    order = F.struct(F.col("cap") / F.col("weight"), "rank")
    shared = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), order)).over(everything)
    wanted = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * shared, F.col("cap").cast("double")))
    return level.select("source", "source_size", "n", wanted.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "mix", weight: str | None = None
) -> DataFrame:
    """How often to take each document so that sources come near their targets in words.

    Of every source, ``floor(target / size)`` copies of each document are certain. The words then missing are drawn by
    Pareto order sampling: a document's inclusion probability is the missing share of the source (times ``weight``, a
    column of positive numbers, relative to its mean by words), and documents are taken in ascending order of their
    random odds over their inclusion odds until the words are reached, the last one if that comes nearer. So each
    source is off by half a document at most, and reruns agree.

    The order is worked out in cells of about ``CELL_ROWS`` documents, of which only those at the point where a source
    is full are sorted.

    Needs ``doc_id``, ``text``, ``source``. Result: ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target``, ``copies``, ``taken`` (words with repeats). Null, empty and blank texts have size 0 and take 0 words.
    A null source is a source, the last one. Rows with the same ``doc_id`` have the same random number; ties go by
    ``doc_id`` and size. A null ``doc_id`` is drawn like any other. A table without words has targets of 0, an empty
    one no rows. Other columns are ignored.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    pull = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    sized = settled(docs.select(F.col("doc_id"), F.col("source"), size.alias("size"), pull.alias("pull")), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("pull")).alias("pulled"), F.count("*").alias("n"))
    wanted = targets(sums.select("source", "source_size", "n"), weights, share, cap)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    plan = wanted.join(sums.select(F.col("source").alias("s"), "pulled"), F.col("source").eqNullSafe(F.col("s"))).withColumn("whole", whole)
    plan = plan.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = settled(plan.select("s", "source_size", "pulled", "n", "target", "whole", "missing"), "targets")

    chance = F.try_divide(F.col("missing") * F.col("pull"), "pulled")
    odds = F.col("u") / (1 - F.col("u"))
    key = F.when(chance >= 1, 0.0).when(chance > 0, odds / (chance / (1 - chance)))
    drawn = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("u", uniform(seed)).withColumn("key", key)
    cell = F.floor(F.col("key") / (1 + F.col("key")) * F.ceil(F.col("n") / CELL_ROWS)).cast("long")
    drawn = drawn.withColumn("cell", cell)
    cells = drawn.where("key is not null").groupBy(F.col("source").alias("s"), F.col("cell").alias("c")).agg(F.sum("size").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("before", before)
    same_cell = F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))
    drawn = drawn.join(cells, same_cell, "left").drop("s", "c")
    inside = F.col("before") + F.col("held") <= F.col("missing")
    beyond = F.col("key").isNull() | (F.col("before") > F.col("missing"))
    settled_cells = drawn.where(inside | beyond).withColumn("extra", F.when(inside & ~beyond, 1).otherwise(0))
    order = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size")
    running = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at_end = drawn.where(~(inside | beyond)).withColumn("extra", F.when(2 * running - F.col("size") <= 2 * F.col("missing"), 1).otherwise(0))
    copies = F.col("whole") + F.col("extra")
    return settled_cells.unionByName(at_end).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix_sql(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of :func:`mix` with its defaults: ``doc_id``, ``size``, ``source_size``, ``target``,
    ``taken``."""
    return f"""
    with sized as (
      select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
        (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
      from {documents}
    ), sums as (
      select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank from sized group by source
    ), weighed as (
      select *, [3, 1, 2][((rank - 1) % 3 + 1)::int] as weight, 2 * source_size as cap from sums
    ), levels as (
      select *, (1.5::double * sum(source_size) over ()
          - coalesce(sum(cap) over (order by cap::double / weight, rank rows between unbounded preceding and 1 preceding), 0)::double)
        / sum(weight) over (order by cap::double / weight, rank rows between current row and unbounded following) as level
      from weighed
    ), shared as (
      select arg_min(level, (cap::double / weight, rank)) as level from levels where not cap <= weight * level
    ), plan as (
      select l.source, l.source_size, least(l.cap::double, coalesce(l.weight * s.level, l.cap::double)) as target
      from levels l cross join shared s
    ), missing as (
      select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as whole,
        target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size as missing from plan
    ), keyed as (
      select d.doc_id, d.size, d.source, m.source_size, m.target, m.whole, m.missing, case when missing / source_size >= 1 then 0.0::double
        when missing / source_size > 0 then (u / (1 - u)) / ((missing / source_size) / (1 - missing / source_size)) end as key
      from sized d join missing m on d.source is not distinct from m.source
    ), running as (
      select *, sum(size) over (partition by source order by key nulls last, doc_id, size rows between unbounded preceding and current row) as upto from keyed
    )
    select doc_id, size, source_size, target,
      ((whole + case when key is not null and 2 * upto - size <= 2 * missing then 1 else 0 end) * size)::bigint as taken from running"""
