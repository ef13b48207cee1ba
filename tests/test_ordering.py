"""Numbering, running totals and sorts, also where one group holds most rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import filesets, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    ids = rnd.sample(range(5000), 600)
    data = [(rnd.choice(["hot"] * 8 + ["b", None]), i, rnd.choice([None, 1, 5, 9])) for i in ids]
    return data, spark.createDataFrame(data, "g string, id long, v long").repartition(8)


def by_group(data):
    order = sorted(data, key=lambda r: (str(r[0]), r[1]))
    return [list(rows) for _, rows in itertools.groupby(order, key=lambda r: r[0])]


@pytest.mark.parametrize("width", [None, 1, 7, 100, 100_000])
def test_numbered(skewed, width):
    data, df = skewed
    out = ordering.numbered(df, ["g"], ["id"], width and F.floor(F.col("id") / width), total="size")
    assert out.columns == ["g", "id", "v", "n", "size"]
    want = {(r[0], r[1], i, len(rows)) for rows in by_group(data) for i, r in enumerate(rows, 1)}
    assert {(r.g, r.id, r.n, r["size"]) for r in out.collect()} == want


@pytest.mark.parametrize("width", [1, 7, 100_000])
def test_running_total(skewed, width):
    data, df = skewed
    out = ordering.over_cap(df, ["g"], ["id"], "v", 40, F.floor(F.col("id") / width))
    want = set()
    for rows in by_group(data):
        sums = itertools.accumulate(r[2] or 0 for r in rows)
        want |= {(r[0], r[1], s, s > 40) for r, s in zip(rows, sums, strict=True)}
    assert {(r.g, r.id, r.running_size, r.over_cap) for r in out.collect()} == want


@pytest.mark.parametrize("chunks", [None, 5])
def test_range_chunks(skewed, chunks):
    data, df = skewed
    cut = ordering.range_chunks(df, ["g"], ["id"], chunks)
    out = ordering.numbered(cut, ["g"], ["id"], F.col("chunk"))
    want = {(r[0], r[1], i) for rows in by_group(data) for i, r in enumerate(rows, 1)}
    assert {(r.g, r.id, r.n) for r in out.collect()} == want
    if chunks:
        sizes = [r["count"] for r in cut.groupBy("chunk").count().collect()]
        assert len(sizes) == chunks and max(sizes) < len(data) / 2


def test_a_group_is_cut_into_several_tasks(skewed):
    _, df = skewed
    out = ordering.numbered(df, ["g"], ["id"], F.floor(F.col("id") / 100))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g#" in plan and "__chunk#" in plan


def test_a_hot_group_is_numbered_over_many_ranges(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("g"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = ordering.numbered(df, ["g"], ["id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.where("n <> id + 1").count() == 0
    ranges = out.inputFiles()
    assert len([f for f in ranges if "ranges-" in f]) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan  # rows are not shuffled again


def test_global_sort(spark):
    rnd = random.Random(3)
    values = [12, 11, 13, 5, 6, 7] + [rnd.choice([7, 7, 7, 64, 25]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(8)
    out = [(r.v, r.id) for r in ordering.global_sort(df, ["v"], ["id"]).collect()]
    assert out == sorted((v, i) for i, v in enumerate(values))
    runs = ordering.sorted_runs(df, ["v"]).withColumn("p", F.spark_partition_id()).collect()
    for _, part in itertools.groupby(runs, key=lambda r: r.p):
        part = [r.v for r in part]
        assert part == sorted(part)


def manifest(spark, *paths):
    return spark.createDataFrame([(p, 1) for p in paths], "path string, length long")


def folder():
    return F.regexp_extract("path", "^(.*/)", 1)


def test_keep_latest(spark):
    files = manifest(spark, "d/x_1", "d/x_2", "d/y_2", "e/x_5")
    gone = filesets.superseded(files, folder(), F.substring_index("path", "_", -1))
    assert [r.path for r in gone.collect()] == ["d/x_1"]
    last = filesets.latest(files, folder(), F.substring_index("path", "_", -1))
    assert sorted(r.path for r in last.collect()) == ["d/y_2", "e/x_5"]


def test_nth_file(spark):
    files = manifest(spark, *[f"d/{i:05d}" for i in range(1500)], "e/only")
    assert [r.path for r in filesets.nth_file(files, folder(), 2).collect()] == ["d/00002"]
    late = filesets.nth_file(files, folder(), 1200)
    assert [r.path for r in late.collect()] == ["d/01200"]
    assert [r.path for r in filesets.nth_file(files, folder(), 999).collect()] == ["d/00999"]
    assert filesets.nth_file(files, folder(), 1500).collect() == []


def test_numbered_names(spark):
    files = manifest(spark, "d/a", "d/b", "e/only")
    out = filesets.numbered_names(files, folder(), ["path"], "exp_", F.lit("2024"), "txt")
    assert sorted((r.path, r.new_name) for r in out.collect()) == [
        ("d/a", "exp_2024_1.txt"),
        ("d/b", "exp_2024_2.txt"),
        ("e/only", "exp_2024.txt"),
    ]
    last_second = F.lit("2024-12-31 23:59:58").cast("timestamp")
    out = filesets.numbered_names(files, folder(), ["path"], "exp", last_second, "txt", clock=True)
    assert sorted((r.path, r.new_name) for r in out.collect()) == [
        ("d/a", "exp_20241231235959.txt"),
        ("d/b", "exp_20250101000000.txt"),
        ("e/only", "exp_20241231235959.txt"),
    ]


def test_select_files(spark):
    files = manifest(spark, "in/", "in/2024-01-01/a.csv", "in/2024-01-01/b.dat", "in/metadata/2024-01-01/c.csv", "out/2024-01-01/d.csv")
    names = lambda **kw: sorted(r.path for r in filesets.select_files(files, **kw).collect())
    assert names(prefix="in/", suffix=".csv", excludes="metadata") == ["in/2024-01-01/a.csv"]
    assert names(run_date="2024-01-01", pattern=r"[bd]\.") == ["in/2024-01-01/b.dat", "out/2024-01-01/d.csv"]
    assert names(prefix="in/", contains="/c") == ["in/metadata/2024-01-01/c.csv"]
    assert "in/" not in names(non_empty=True)


def test_counts_and_presence(spark):
    files = manifest(spark, "d/", "d/a", "d/b", "e/a")
    asked = spark.createDataFrame([("d/",), ("e/",), ("none/",)], "folder string")
    counts = {r.folder: (r.n, r.too_many) for r in filesets.object_counts(asked, files, folder()).collect()}
    assert counts == {"d/": (2, True), "e/": (1, False), "none/": (0, False)}
    asked = spark.createDataFrame([("d/",), ("none/",)], "folder string")
    out = filesets.presence_gate(asked, files, folder(), "yes", "no").collect()
    assert {r.folder: r.branch for r in out} == {"d/": "yes", "none/": "no"}


def test_stable_files(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "path string, modificationTime int")
    after = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 1)], "path string, modificationTime int")
    assert [r.path for r in filesets.stable_files(before, after).collect()] == ["a"]
