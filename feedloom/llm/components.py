"""Connected components of link tables, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import settled as _kept

#: Each round at least halves the distance to a component's smallest node; no graph of 2**64 nodes needs more.
ROUNDS = 200


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to the smallest of them and itself: the larger neighbours, or the smaller ones."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    # Links go from the larger node u to the smaller v in a small star.
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))
    tied = both.join(smallest, F.col("u") == F.col("hub"))
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select(F.col("hub").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Every node of a link table (``a``, ``b``: long) with the smallest node that it is linked to over any number of
    links: ``node``, ``component``.

    Large and small stars (each node's neighbours tied to its smallest one) alternate until nothing changes. A round
    is a few joins of link-sized tables, written to the shared scratch folder; links and nodes never reach the driver.
    Links of a node to itself and nulls are passed over; repeated links are one. No links give no rows.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    links = links.where("a is not null and b is not null and a <> b").select(larger.alias("u"), smaller.alias("v")).distinct()
    links = _kept(links, "links")
    seen = None
    for _ in range(ROUNDS):
        links = _kept(_star(_star(links, True), False), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
