"""Stored tables changed in place: only the files that must be, and several tables in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.plans import inactivation
from feedloom.session import scratch
from feedloom.sinks import Releases
from feedloom.sinks.rewrite import delete_from, upsert_into
from feedloom.suite import chain
from feedloom.suite.registry import ORACLES, Tables, query


def _files(t: Tables, path: str) -> DataFrame:
    """Name and time of each file of a table."""
    meta = [F.col("_metadata.file_name").alias("__name"), F.col("_metadata.file_modification_time").alias("__time")]
    return t.spark.read.parquet(path).select(*meta).distinct()


def _rewritten(t: Tables, path: str, before: DataFrame) -> DataFrame:
    """Rows of a table, each with whether its file is another than before."""
    meta = [F.col("_metadata.file_name").alias("__name"), F.col("_metadata.file_modification_time").alias("__time")]
    same = lookup(t.spark.read.parquet(path).select("*", *meta), before.withColumn("__same", F.lit(True)), ["__name", "__time"])
    return same.withColumn("rewritten", F.col("__same").isNull()).drop("__name", "__time", "__same")


@query(
    """with k as (select l_orderkey from lineitem where l_quantity >= 49 and l_shipdate < timestamp '1997-01-01'),
    o as (select o_orderkey, cast(year(o_orderdate) as int) as year, o_orderkey in (select l_orderkey from k) as listed from orders)
    select o_orderkey, year, year in (select year from o where listed) as rewritten from o where not listed"""
)
def delete_touched(t: Tables) -> DataFrame:
    """Orders without those with large early items, in files by year: files of years without any are left alone."""
    path = scratch(t.spark, "orders")
    t.orders.withColumn("year", F.year("o_orderdate")).repartition("year").write.partitionBy("year").parquet(path)
    before = settled(_files(t, path), "files")
    large = t.lineitem.where((F.col("l_quantity") >= 49) & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")))
    delete_from(t.spark, path, large.select("l_orderkey"), {"o_orderkey": "l_orderkey"}, layout=["year"])
    return _rewritten(t, path, before).select("o_orderkey", "year", "rewritten")


@query(
    """with c as (select c_custkey as load_id, c_mktsegment as domain, c_acctbal as balance,
      c_mktsegment = 'BUILDING' and c_acctbal < 0 as hit from customer)
    select load_id, domain, case when hit then -balance else balance end as balance, hit as updated,
      domain in (select domain from c where hit) as rewritten from c
    union all select 1000000000 + s_suppkey, 'SUPPLIER', s_acctbal, false, true from supplier"""
)
def upsert_touched(t: Tables) -> DataFrame:
    """Balances by segment; those of one segment change and suppliers come in, the other segments' files are left alone."""
    path = scratch(t.spark, "balances")
    none = F.lit(None).cast("timestamp")
    held = t.customer.select(F.col("c_custkey").alias("load_id"), F.col("c_mktsegment").alias("domain"), F.col("c_acctbal").alias("balance"))
    held = held.withColumns({"insert_timestamp": none, "update_timestamp": none})
    held.repartition("domain").write.partitionBy("domain").parquet(path)
    before = settled(_files(t, path), "files")
    change = held.where("domain = 'BUILDING' and balance < 0").withColumn("balance", -F.col("balance"))
    new = t.supplier.select((F.col("s_suppkey") + 1_000_000_000).alias("load_id"), F.lit("SUPPLIER").alias("domain"), F.col("s_acctbal").alias("balance"))
    rows = change.select("load_id", "domain", "balance").unionByName(new).withColumn("at", F.lit(0))
    now = F.lit("2024-01-01").cast("timestamp")
    upsert_into(t.spark, path, rows, ["load_id"], ["balance"], now, "at", layout=["domain"])
    out = _rewritten(t, path, before).withColumn("updated", F.col("update_timestamp").isNotNull())
    return out.select("load_id", "domain", "balance", "updated", "rewritten")


@query(ORACLES["scd_published"])
def scd_released(t: Tables) -> DataFrame:
    """The chain as a release: legs, paths and both lists become current in one step."""
    releases = Releases(t.spark, scratch(t.spark, "releases"))
    releases.publish({"legs": chain.legs(t), "schedules": chain.schedules(t), "paths": chain.paths(t)})
    inactivation.release(releases, chain.FEED_DATE)
    now = releases.read_all()
    return chain.all_of(now["legs"], now["paths"], now["path_ends"], now["inactivated"])
