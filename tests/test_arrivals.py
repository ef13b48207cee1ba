"""Streams of files with audit rows, watermarks in parts, stability over listings, sorted runs and tables of branches."""

import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom.operators import filesets, gates, ordering
from feedloom.sinks import store
from feedloom.streaming import file_stream, keep_watermarks, process_sensed, read_arrived, read_audit, read_watermarks, sensed_stream, watermark_stream
from feedloom.streaming import sensed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Landing:
    """A folder in which files land, and what a load has taken of them."""

    def __init__(self, spark, root, selection="NEWER_OLDEST"):
        self.spark, self.root, self.selection, self.check = spark, root, selection, "check"

    def land(self, name, minute, *values):
        folder = self.root / "in"
        folder.mkdir(exist_ok=True)
        path = folder / name
        path.write_text("".join(f"{v}\n" for v in values))
        at = datetime(2024, 1, 1).timestamp() + 60 * minute
        os.utime(path, (at, at))

    def take(self, files_per_batch=1):
        stream = sensed_stream(self.spark, f"{self.root}/in", "v long", "csv", files_per_batch)
        process_sensed(stream, f"{self.root}/data", f"{self.root}/audit", f"{self.root}/{self.check}", "s", "dom", "load", "2024-01-01", self.selection)

    def arrived(self):
        return sorted(r.v for r in read_arrived(self.spark, f"{self.root}/data", f"{self.root}/audit").collect())

    def audit(self):
        return sorted((r.file_name, r.rows) for r in read_audit(self.spark, f"{self.root}/audit").collect())


def test_oldest_first_takes_every_newer_file_once(spark, tmp_path):
    load = Landing(spark, tmp_path)
    load.land("b", 2, 20, 21)
    load.land("a", 1, 10)
    load.land("same", 2, 22)
    load.take()
    assert load.arrived() == [10, 20, 21, 22] and load.audit() == [("a", 1), ("b", 2), ("same", 1)]
    load.land("old", 0, 0)
    load.land("c", 3, 30)
    load.take()
    # A file that is older than what was taken is passed over.
    assert load.arrived() == [10, 20, 21, 22, 30]
    row = read_audit(spark, f"{tmp_path}/audit").where("file_name = 'c'").first()
    assert (row.domain_name, row.load_name, row.is_sensed, row.stream, str(row.feed_date)) == ("dom", "load", True, "s", "2024-01-01")
    # A new checkpoint lists all files again and takes none.
    load.check = "another"
    load.take()
    assert load.arrived() == [10, 20, 21, 22, 30]


def test_latest_passes_over_the_others_for_good(spark, tmp_path):
    load = Landing(spark, tmp_path, "NEWER_LATEST")
    for i in range(3):
        load.land(f"f{i}", i, i)
    load.take(files_per_batch=100)
    assert load.arrived() == [2] and load.audit() == [("f2", 1)]
    load.land("f3", 3, 3)
    load.take(files_per_batch=100)
    assert load.arrived() == [2, 3]


@pytest.mark.parametrize("where", ["audit", "data"])
def test_a_batch_that_fails_and_runs_again_counts_once(spark, tmp_path, monkeypatch, where):
    load = Landing(spark, tmp_path)
    load.land("a", 1, 10)
    load.take()
    load.land("b", 2, 20, 21)
    real, failed = sensed.lookup, []

    def failing(left, right, on, how="left", **more):
        # The batch's rows are cut down just before they are written; the load fails before or after that.
        if how == "left_semi" and not failed:
            failed.append(True)
            if where == "audit":
                real(left, right, on, how, **more).write.mode("overwrite").parquet(f"{tmp_path}/data/stream=s/batch=1")
            raise RuntimeError("lost")
        return real(left, right, on, how, **more)

    monkeypatch.setattr(sensed, "lookup", failing)
    with pytest.raises(Exception, match="lost"):
        load.take()
    # What the failed batch wrote does not count, since it has no audit rows.
    assert load.arrived() == [10] and load.audit() == [("a", 1)]
    load.take()
    assert load.arrived() == [10, 20, 21] and load.audit() == [("a", 1), ("b", 2)]
    load.take()
    assert load.arrived() == [10, 20, 21]


def test_selection_is_checked(spark):
    none = spark.createDataFrame([], sensed.AUDIT)
    with pytest.raises(ValueError):
        sensed.take_new(none, none, ["domain_name"], "OLDEST")


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if "_rewrite" not in str(f)}


def test_watermarks_write_only_parts_with_news(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    day = lambda d: datetime(2024, 1, d)

    def arrive(check, *rows):
        if rows:
            spark.createDataFrame(list(rows), "s string, ts timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = watermark_stream(file_stream(spark, source, "s string, ts timestamp"), "s", "ts")
        return keep_watermarks(stream, table, str(tmp_path / check), "s", parts=8)

    sources = [f"s{i}" for i in range(20)] + [None]
    first = arrive("one", *[(s, day(1)) for s in sources])
    assert first.batches == 1 and first.parts == len({p.split("/")[0] for p in files_of(table)}) > 3
    before = files_of(table)
    done = arrive("one", ("s3", day(2)))
    after = files_of(table)
    assert done.parts == 1 and len(set(before) - set(after)) == 1 and all(after[f] == before[f] for f in set(before) & set(after))
    assert {r.s: (r.start_timestamp.day, r.n) for r in read_watermarks(spark, table, "s").collect()} == {s: (2, 2) if s == "s3" else (1, 1) for s in sources}
    # The same files through a new checkpoint are no news.
    again = arrive("two")
    assert (again.parts, files_of(table)) == (0, after)


def test_watermarks_with_a_lateness_forget_and_count(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    day = lambda d: datetime(2024, 1, d, 12)

    def arrive(*rows):
        spark.createDataFrame(list(rows), "s string, ts timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = watermark_stream(file_stream(spark, source, "s string, ts timestamp", files_per_batch=1), "s", "ts", "2 days")
        kept = keep_watermarks(stream, table, check, "s")
        return kept.late_rows, {r.s: (r.start_timestamp.day, r.n) for r in read_watermarks(spark, table, "s").collect()}

    assert arrive(("a", day(1)), ("b", day(1))) == (0, {"a": (1, 1), "b": (1, 1)})
    assert arrive(("a", day(10)), ("a", day(9))) == (0, {"a": (10, 3), "b": (1, 1)})
    # Day 9 is still held; day 1 left the state, so its row is counted as late.
    assert arrive(("a", day(9)), ("b", day(1))) == (1, {"a": (10, 4), "b": (1, 1)})


def test_runs_of_listings(spark):
    rng = random.Random(7)
    start, rows, expected = datetime(2024, 1, 1), [], []
    for f in range(30):
        marks = []
        mark = 0
        for k in range(40):
            mark += rng.random() < 0.2
            marks.append(None if rng.random() < 0.15 else ("x", mark if mark % 5 else None))
        rows += [(f"f{f}", m[1], start + timedelta(minutes=k)) for k, m in enumerate(marks) if m]
        runs = []
        for k, m in enumerate(marks):
            if m and runs and runs[-1][0] == m and runs[-1][2] == k - 1:
                runs[-1][2] = k
            elif m:
                runs.append([m, k, k])
        expected += [(f"f{f}", m[1], start + timedelta(minutes=a), start + timedelta(minutes=b), b - a + 1, b == 39) for m, a, b in runs]
    df = spark.createDataFrame(rows, "path string, modificationTime int, listed_at timestamp")
    for chunk in (4, 1024):
        assert sorted(map(str, (tuple(r) for r in filesets.unchanged_runs(df, chunk=chunk).collect()))) == sorted(map(str, expected))
    now = {(e[0], e[4], (e[3] - e[2]).seconds) for e in expected if e[5]}
    assert {r.path for r in filesets.settled_files(df, for_listings=3).collect()} == {p for p, n, _ in now if n >= 3}
    assert {r.path for r in filesets.settled_files(df, for_seconds=240, for_listings=2).collect()} == {p for p, n, s in now if s >= 240 and n >= 2}
    with pytest.raises(ValueError):
        filesets.settled_files(df)


def test_equal_values_keep_their_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(4), i) for i in range(3000)]
    spark.createDataFrame(rows, "v int, i int").repartition(3).sortWithinPartitions("i").write.option("maxRecordsPerFile", 200).parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    place = {tuple(r)[:2]: tuple(r)[2:] for r in ordering.with_place(table).collect()}
    got = [tuple(r) for r in ordering.stable_sort(table, ["v"]).collect()]
    assert got == sorted(place, key=lambda r: (r[0], place[r]))
    # With columns that say the place.
    got = [tuple(r) for r in ordering.stable_sort(table, [F.col("v").desc()], ["i"]).collect()]
    assert got == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_sorted_runs_are_joined_without_sort_or_shuffle(spark, tmp_path):
    names = ("runs_test_a", "runs_test_b")
    frames = [spark.range(500).selectExpr("id % 100 as k", "id as v"), spark.range(100).selectExpr("id as k", "id * 2 as w")]
    try:
        for name, df in zip(names, frames, strict=True):
            ordering.write_sorted_runs(df, name, str(tmp_path / name), ["k"], 4)
        a, b = (ordering.read_sorted_runs(spark, n) for n in names)
        joined = a.hint("merge").join(b, "k").groupBy("k").agg(F.sum("v").alias("v"))
        text = plan(joined)
        assert "SortMergeJoin" in text and "Sort [" not in text and "Exchange" not in text
        assert {r.k: r.v for r in joined.collect()} == {k: 5 * k + 1000 for k in range(100)}
        assert len([f for f in (tmp_path / names[0]).glob("*.parquet")]) == 4
    finally:
        for name in names:
            spark.sql(f"drop table if exists {name}")


def test_table_of_branches(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "nowhere"), (5, "elsewhere")], "i int, v string")
    many = spark.range(20_000).selectExpr("concat('k', id) as value", "'rest' as branch")
    known = many.union(spark.createDataFrame([("a", "left"), ("b", "right")], "value string, branch string"))
    target = str(tmp_path / "out")
    with pytest.raises(ValueError, match="no branch for 3 rows, values from 'NULL' to 'nowhere'"):
        gates.write_branches(rows, "v", known, target)
    assert not store.exists(spark, target)
    gates.write_branches(rows.where("i < 3"), "v", known, target)
    assert {(r.i, r.branch) for r in spark.read.parquet(target).collect()} == {(1, "left"), (2, "right")}
    twice = known.union(spark.createDataFrame([("a", "other")], "value string, branch string"))
    with pytest.raises(Exception, match="several source rows"):
        gates.branch_from(rows, "v", twice).rows.collect()


def test_place_is_a_file_number_not_a_path(spark, tmp_path):
    rows = [(i % 5, i) for i in range(400)]
    spark.createDataFrame(rows, "v int, i int").repartition(4).write.option("maxRecordsPerFile", 60).parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    placed = ordering.with_place(table)
    # A number per file, in the order of the paths, so that a sort by place carries no path.
    assert dict(placed.dtypes)[ordering.PLACE[0]] == "int"
    paths = sorted({r[0] for r in table.select(F.col("_metadata.file_path")).collect()})
    by_path = {r[1]: r[0] for r in table.select(F.col("_metadata.file_path"), "i").collect()}
    got = {r["i"]: r[ordering.PLACE[0]] for r in placed.collect()}
    assert got == {i: paths.index(p) + 1 for i, p in by_path.items()}
