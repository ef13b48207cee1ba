"""Times the chosen form of some operators against the plain one, on even and on hot keys.

The hot tables are the sample tables many times over, with a third of all rows on one key.
BENCH_COPIES sets how many times (20 unless set), BENCH_SKIP_PLAIN_HOT leaves out plain forms there.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.dates import spark_pattern
from feedloom.operators.ordering import numbered
from feedloom.operators.versions import drop_dominated
from feedloom.plans import inactivation
from feedloom.session import local_session, scratch
from feedloom.sinks import write_dataset
from feedloom.suite import chain
from feedloom.suite.registry import Tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


class Hot(Tables):
    """Copies of lineitem, part and documents; a third of the legs have one path, a third of the documents one source."""

    def __init__(self, t: Tables):
        super().__init__(t.spark, t.dir)
        self.dir = scratch(t.spark, "hot")
        copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
        hot = F.col("copy") < COPIES / 3

        def put(name, df):
            df.drop("copy").write.parquet(self.path(name))

        part = F.col("l_partkey") + F.col("copy") * 1_000_000
        legs = t.lineitem.repartition(32).withColumn("copy", copies)
        put("lineitem", legs.withColumn("l_partkey", F.when(hot, F.lit(7)).otherwise(part)))
        part = F.col("p_partkey") + F.col("copy") * 1_000_000
        put("part", t.part.withColumn("copy", copies).withColumn("p_partkey", part))
        docs = t.documents.select("doc_id", "source", "n_chars").repartition(32).withColumn("copy", copies)
        docs = docs.withColumn("doc_id", F.col("doc_id") + F.col("copy") * 1_000_000)
        put("documents", docs.withColumn("source", F.when(hot, F.lit("src0")).otherwise(F.col("source"))))


def not_exists(t: Tables):
    legs = chain.legs(t)
    same = [F.col(f"a.{k}") == F.col(f"o.{k}") for k in inactivation.LEG_KEY]
    lesser = F.col(f"o.{inactivation.END}") > F.col(f"a.{inactivation.END}")
    return legs.alias("o").join(legs.alias("a"), [*same, lesser], "left_anti")


def path_ends(t: Tables, reduced: bool):
    ends = inactivation.schedule_ends(chain.schedules(t), chain.FEED_DATE)
    if reduced:
        return inactivation.path_ends(chain.legs(t), ends)
    closed = inactivation.close_legs(inactivation.current_legs(chain.legs(t)), ends)
    return closed.groupBy("path_id").agg(F.min(inactivation.END).alias("minina"))


def numbered_by_window(t: Tables):
    return t.documents.withColumn("n", F.row_number().over(W.partitionBy("source").orderBy("doc_id")))


def numbered_by_chunk(t: Tables):
    return numbered(t.documents.select("doc_id", "source", "n_chars"), ["source"], ["doc_id"], F.floor(F.col("doc_id") / 4096))


def extract_in_actions(t: Tables):
    df, out = t.lineitem.persist(), scratch(t.spark, "extract")
    df.count()
    df.write.parquet(f"{out}/data")
    df.agg(F.max("l_shipdate")).coalesce(1).write.option("timestampFormat", spark_pattern("%Y-%m-%d %H:%M:%S")).csv(f"{out}/mark")
    df.unpersist(blocking=True)


def extract_in_one(t: Tables):
    write_dataset(t.lineitem, scratch(t.spark, "extract"), watermark="l_shipdate")


FORMS = {
    "drop dominated rows": {
        "not exists": not_exists,
        "mixed groups": lambda t: drop_dominated(chain.legs(t), inactivation.LEG_KEY, inactivation.END),
        "mixed groups, settled": lambda t: inactivation.current_legs(chain.legs(t)),
    },
    "path ends": {"full steps": lambda t: path_ends(t, False), "reduced legs": lambda t: path_ends(t, True)},
    "numbering": {"one window": numbered_by_window, "chunks": numbered_by_chunk},
    "extract": {"persist, 3 actions": extract_in_actions, "one observed write": extract_in_one},
}


def main() -> None:
    spark = local_session("feedloom-forms", cores=CPUS, shuffle_partitions=64)
    even = Tables(spark, SF_DIR)

    def timed(form, t) -> float:
        start = time.perf_counter()
        out = form(t)
        if out is not None:
            out.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    result = {}
    for label, t in {"even": even, "hot": Hot(even)}.items():
        for work, forms in FORMS.items():
            for name, form in forms.items():
                if label == "hot" and name == "not exists" and os.environ.get("BENCH_SKIP_PLAIN_HOT"):
                    continue
                times = [timed(form, t) for _ in range(RUNS + 1)][1:]
                result[f"{label}: {work}: {name}"] = round(statistics.median(times), 2)
                print(f"{label}: {work}: {name}: {result[f'{label}: {work}: {name}']}", flush=True)
    print(json.dumps({"sf": SF_DIR, "copies": COPIES, "cpus": CPUS, "seconds": result}))


if __name__ == "__main__":
    main()
