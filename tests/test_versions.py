"""Joins, version chains and their equivalent forms."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.operators import joins
from feedloom.operators.joins import lookup, unique_by
from feedloom.operators.versions import drop_dominated, update_from
from feedloom.plans import inactivation
from feedloom.suite import chain
from feedloom.suite.registry import Tables

OPEN = date(3001, 1, 1)
LEG = (
    "rid string, path_id long, flt_id int, sch_leg_active_dt date, sch_leg_eff_dt date, sch_leg_disc_dt date, "
    "sch_leg_orig_cd string, sch_leg_dest_cd string, leg_freq_bitmask int, sch_leg_inactive_dt date"
)
SCH = (
    "flt_id int, sch_leg_active_dt date, sch_leg_eff_dt date, sch_leg_disc_dt date, sch_leg_orig_cd string, "
    "sch_leg_dest_cd string, sch_leg_freq_bitmask int, sch_leg_inactive_dt date"
)
FEED = "2023-07-14"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def leg_key(name, active):
    """The schedule part of a leg key: a letter stands for the flight, NULL for none."""
    flight = None if name is None else ord(name)
    return (flight, active, date(2023, 1, 1), date(2023, 12, 31), "ORD", "SFO", 127)


@pytest.fixture(scope="module")
def golden(spark):
    d = date
    legs = [
        ("a", 1, *leg_key("A", d(2023, 1, 1)), OPEN),
        ("b", 1, *leg_key("A", d(2023, 1, 1)), d(2023, 6, 1)),
        ("c", 2, *leg_key("B", d(2023, 2, 1)), OPEN),
        ("d", 3, *leg_key("B", d(2023, 2, 1)), OPEN),
        ("e", 4, *leg_key("C", d(2023, 7, 15)), OPEN),
        ("f", 4, *leg_key("D", d(2023, 7, 16)), OPEN),
        ("g", 2, *leg_key(None, d(2023, 2, 1)), OPEN),
        ("h", 2, *leg_key(None, d(2023, 2, 1)), d(2023, 12, 1)),
    ]
    schedules = [
        (*leg_key("B", d(2023, 2, 1)), d(2023, 5, 1)),
        (*leg_key("B", d(2023, 2, 1)), d(2023, 6, 15)),
        (*leg_key("C", d(2023, 7, 15)), d(2023, 7, 20)),
        (*leg_key("D", d(2023, 7, 16)), d(2023, 7, 18)),
    ]
    paths = [(1, "P1", OPEN), (2, "P2", OPEN), (3, "P3", d(2023, 1, 1)), (4, "P4", OPEN)]
    return (
        spark.createDataFrame(legs, LEG),
        spark.createDataFrame(schedules, SCH),
        spark.createDataFrame(paths, "path_id long, path_dscr string, path_inactive_dt date"),
    )


def test_golden_chain(golden):
    legs, schedules, paths = golden
    assert rows(inactivation.current_legs(legs), "rid") == [(x,) for x in "bcdefgh"]
    out = inactivation.inactivate(legs, schedules, paths, FEED)
    june = date(2023, 6, 15)
    ends = [date(2023, 6, 1), june, june, OPEN, OPEN, OPEN, date(2023, 12, 1)]
    assert rows(out.legs, "rid", "sch_leg_inactive_dt") == list(zip("bcdefgh", ends, strict=True))
    assert rows(out.path_ends, "path_id", "minina") == [(1, date(2023, 6, 1)), (2, june)]
    assert rows(out.paths, "path_id", "path_inactive_dt") == [
        (1, date(2023, 6, 1)),
        (2, june),
        (3, date(2023, 1, 1)),
        (4, OPEN),
    ]
    assert rows(out.inactivated, "path_id", "path_dscr") == [(1, "P1"), (2, "P2")]


def test_chain_over_stored_tables_replaces_them(spark, golden, tmp_path):
    names = ["legs", "schedules", "paths", "path_ends", "inactivated"]
    at = {n: str(tmp_path / n) for n in names}
    for df, name in zip(golden, names, strict=False):
        df.write.parquet(at[name])
    inactivation.run(spark, *[at[n] for n in names], FEED)
    read = spark.read.parquet
    assert rows(read(at["inactivated"]), "path_id") == [(1,), (2,)]
    assert read(at["legs"]).count() == 7
    assert rows(read(at["paths"]).where(F.col("path_inactive_dt") < F.lit("3001-01-01").cast("date")), "path_id") == [(1,), (2,), (3,)]
    # Run again: everything that could close has.
    inactivation.run(spark, *[at[n] for n in names], FEED)
    assert read(at["inactivated"]).count() == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(names)


def test_reduced_legs_give_the_same_ends_as_the_full_steps(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    legs, ends = chain.legs(t), inactivation.schedule_ends(chain.schedules(t), chain.FEED_DATE)
    full = inactivation.close_legs(inactivation.current_legs(legs), ends)
    by_path = full.groupBy("path_id").agg(F.min("sch_leg_inactive_dt").alias("minina"))
    assert rows(by_path, "path_id", "minina") == rows(inactivation.path_ends(legs, ends), "path_id", "minina")


def test_drop_dominated_against_brute_force(spark):
    import itertools
    import random

    rnd = random.Random(7)
    data = [
        (i, rnd.choice([1, 2, None]), rnd.choice(["x", "y", None]), rnd.choice([1, 2, 3, None])) for i in range(400)
    ]
    df = spark.createDataFrame(data, "id int, k long, s string, v int")
    gone = {
        a[0]
        for a, b in itertools.product(data, data)
        if None not in (*a[1:], *b[1:]) and a[1:3] == b[1:3] and a[3] > b[3]
    }
    kept = drop_dominated(df, ["k", "s"], "v")
    assert {r.id for r in kept.collect()} == {r[0] for r in data} - gone
    kept = drop_dominated(df, ["k", "s"], "v", settle=True)
    assert {r.id for r in kept.collect()} == {r[0] for r in data} - gone
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.columns == df.columns


def test_update_from(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 30), (4, 40)], "k long, v int")
    source = spark.createDataFrame([(1, 5), (2, 50), (None, 1), (9, 9)], "sk long, n int")
    out = update_from(target, source, {"k": "sk"}, {"v": F.col("n")}, F.col("n") < F.col("v"))
    assert {tuple(r) for r in out.collect()} == {(1, 5), (2, 20), (None, 30), (4, 40)}
    with pytest.raises(PySparkException, match="several source rows"):
        update_from(target, source.union(source.where("sk = 1")), {"k": "sk"}, {"v": F.col("n")}, F.lit(True)).collect()


def test_unique_by_passes_unique_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert {tuple(r) for r in unique_by(df, ["k"]).collect()} == {(1, "a"), (2, None)}
    assert {tuple(r) for r in unique_by(df.select("k"), ["k"]).collect()} == {(1,), (2,)}


def test_unique_by_passes_null_keys_over(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    assert {tuple(r) for r in unique_by(df, ["k"]).collect()} == {(1, "c")}
    target = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    source = spark.createDataFrame([(None, 5), (None, 6), (1, 7)], "sk int, n int")
    out = update_from(target, source, {"k": "sk"}, {"v": F.col("n")}, F.col("n") > 0)
    assert {tuple(r) for r in out.collect()} == {(None, 1), (1, 7)}


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("left_side", "right_side"):
        spark.range(100).withColumn(name[0], F.col("id")).write.bucketBy(4, "id").mode("overwrite").saveAsTable(name)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lookup(spark.table("left_side"), spark.table("right_side"), ["id"], route=False)
        assert out.where("l = r").count() == 100
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table left_side")
        spark.sql("drop table right_side")


def test_lookup_refuses_keys_of_two_types(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2)], "k long, v int")
    with pytest.raises(TypeError, match="differ in type"):
        lookup(left, right, ["k"])


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_spreads_a_hot_key(spark, how):
    """Half of all rows share a key; adaptive execution splits its partition, and the result is right."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        i = F.col("id")
        key = F.when(i % 2 == 0, F.lit(7)).otherwise(i % 50021)
        left = spark.range(0, 200_000, 1, 8).select(key.alias("k"), i.alias("v"), F.md5(i.cast("string")).alias("pad"))
        right = spark.range(0, 200_000, 1, 8).select((i % 40009).alias("k"), (i % 13).alias("w"))
        right = right.groupBy("k").agg(F.max("w").alias("w"))
        aggs = [F.count("*").alias("n"), F.max("v"), F.max("pad")]
        if how in ("left", "inner"):
            aggs += [F.sum("w"), F.count("w")]
        got = lookup(left, right, ["k"], how).agg(*aggs)
        want = left.join(right, "k", how).agg(*aggs)
        assert got.collect() == want.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_settled_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in disk.getAllFiles().mkString(" ").split() if "shuffle_" in f and f.endswith(".data")}
    before = held()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    out = joins.settled(spark.range(1000).groupBy("id").count(), "grouped")
    assert not held() - before
    assert spark.conf.get(key) == was
    assert out.count() == 1000


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
def test_parted_keeps_every_row_with_a_key(spark, monkeypatch, words):
    monkeypatch.setattr(joins, "SIFT_WORDS", words)
    rows = spark.range(4000).selectExpr("if(id % 50 = 0, null, id) as a", "concat('t', id) as b", "cast(id as int) as c")
    keys = joins.settled(spark.range(0, 4000, 9).selectExpr("id as k", "concat('t', id) as t", "id as wide"), "keys")
    likely, others = joins.parted(rows, keys, {"a": "k", "b": "t", "c": "wide"})
    assert likely.exceptAll(rows).count() == others.exceptAll(rows).count() == 0
    got, rest = {r.b for r in likely.collect()}, {r.b for r in others.collect()}
    assert not got & rest and len(got | rest) == 4000
    wanted = {f"t{i}" for i in range(0, 4000, 9) if i % 50}
    assert wanted <= got
    if words > 64:
        assert len(got) < 1.2 * len(wanted)
    nothing = joins.sifted(rows, joins.settled(keys.limit(0), "none"), {"a": "k"})
    assert nothing.count() == 0
    assert joins.sifted(rows, keys, {"c": "wide"}).count() == 4000
