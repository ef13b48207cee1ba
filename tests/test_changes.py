"""Changes of stored tables: which files are written, and what readers and crashed jobs see."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom.sinks import Releases, rewrite, store
from feedloom.sinks.rewrite import delete_from, recover, upsert_into

def now():
    return F.lit("2024-05-01").cast("timestamp")

CONTROL = "k long, v string, p string, insert_timestamp timestamp, update_timestamp timestamp"


def state(path) -> dict[str, tuple]:
    """Data files of a table with their time and bytes."""
    return {str(f.relative_to(path)): (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path).rglob("*.parquet") if "_rewrite" not in str(f)}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    """400 keys in order over 8 files."""
    path = str(tmp_path / "table")
    spark.range(400).withColumn("v", F.concat(F.lit("v"), "id")).repartitionByRange(8, "id").write.parquet(path)
    return path


def test_delete_writes_touched_files_only(spark, table):
    before = state(table)
    assert len(before) == 8
    keys = spark.createDataFrame([(3,), (3,), (7,), (60,), (None,), (9999,)], "id long")
    done = delete_from(spark, table, keys, ["id"])
    after = state(table)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == sorted(set(range(400)) - {3, 7, 60})
    kept = set(before) & set(after)
    assert len(done.removed) == 2 and set(before) - set(after) == set(done.removed) and set(after) - set(before) == set(done.added)
    assert len(kept) == 6 and all(before[f] == after[f] for f in kept)
    assert not [f for f in Path(table).iterdir() if f.name.startswith("_rewrite")]


def test_keys_in_no_file_write_nothing(spark, table):
    before = state(table)
    for keys in ([(1000,)], [(None,)], []):
        assert delete_from(spark, table, spark.createDataFrame(keys, "x long"), {"id": "x"}) == rewrite.Rewrite()
    assert state(table) == before


def test_files_are_found_by_a_scan_of_keys_in_range(spark, table):
    listed = spark.createDataFrame([(3,), (60,)], "id long")
    text = plan(rewrite.touched_rows(spark, table, listed, {"id": "id"}))
    assert "GreaterThanOrEqual(id,3)" in text and "LessThanOrEqual(id,60)" in text
    assert "ReadSchema: struct<id:bigint>" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_upsert_writes_touched_files_and_new_keys(spark, tmp_path):
    path = str(tmp_path / "control")
    rows = [(k, f"old{k}", f"p{k // 10}", datetime(2020, 1, 1), None) for k in range(40)]
    spark.createDataFrame(rows, CONTROL).repartition("p").write.partitionBy("p").parquet(path)
    before = state(path)
    new = [(3, "first", "p0", 1), (3, "last", "p0", 2), (25, "x", "p2", 1), (77, "new", "p9", 1)]
    done = upsert_into(spark, path, spark.createDataFrame(new, "k long, v string, p string, n int"), ["k"], ["v"], now(), "n", ["p"])
    after = state(path)
    assert {f.split("/")[0] for f in done.removed} == {"p=p0", "p=p2"}
    assert {f.split("/")[0] for f in done.added} == {"p=p0", "p=p2", "p=p9"}
    assert all(after[f] == before[f] for f in before if f.startswith(("p=p1", "p=p3")))
    got = {r.k: (r.v, r.p, r.insert_timestamp.year, r.update_timestamp and r.update_timestamp.month) for r in spark.read.parquet(path).collect()}
    expected = {k: (f"old{k}", f"p{k // 10}", 2020, None) for k in range(40)}
    assert got == expected | {3: ("last", "p0", 2020, 5), 25: ("x", "p2", 2020, 5), 77: ("new", "p9", 2024, None)}


def test_changes_agree_with_a_model(spark, tmp_path):
    rng, path, model = random.Random(5), str(tmp_path / "model"), {}
    spark.createDataFrame([], CONTROL).write.parquet(path)
    for step in range(5):
        keys = rng.sample(range(30), 8)
        if step % 3 == 2:
            delete_from(spark, path, spark.createDataFrame([(k,) for k in keys], "k long"), ["k"])
            model = {k: v for k, v in model.items() if k not in keys}
        else:
            upsert_into(spark, path, spark.createDataFrame([(k, f"s{step}", "p", 0) for k in keys], "k long, v string, p string, n int"), ["k"], ["v"], now(), "n")
            model |= {k: f"s{step}" for k in keys}
        assert {r.k: r.v for r in spark.read.parquet(path).collect()} == model


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_crash_while_the_journal_is_carried_out(spark, table, monkeypatch, moves):
    """After any number of steps the change is either not there or can be finished."""
    keys = spark.createDataFrame([(3,), (60,), (399,)], "id long")
    real_move, real_remove, left = store.move, store.remove, [moves]

    def failing(act):
        def step(spark, *args):
            if ".draft" not in args[0]:
                if not left[0]:
                    raise OSError("lost")
                left[0] -= 1
            act(spark, *args)

        return step

    monkeypatch.setattr(store, "move", failing(real_move))
    monkeypatch.setattr(store, "remove", failing(real_remove))
    with pytest.raises(OSError, match="lost"):
        delete_from(spark, table, keys, ["id"])
    monkeypatch.undo()
    assert {r.id for r in spark.read.parquet(table).collect()} >= set(range(400)) - {3, 60, 399}
    recover(spark, table)
    recover(spark, table)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == sorted(set(range(400)) - {3, 60, 399})


def test_crash_before_the_journal_changes_nothing(spark, table, monkeypatch):
    before = state(table)
    monkeypatch.setattr(store, "put_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        delete_from(spark, table, spark.createDataFrame([(3,)], "id long"), ["id"])
    assert state(table) == before
    recover(spark, table)
    assert state(table) == before and not [f for f in Path(table).iterdir() if f.name.startswith("_rewrite")]


def values(df):
    return sorted(r.v for r in df.collect())


def one(spark, *v):
    return spark.createDataFrame([(x,) for x in v], "v long")


def test_release_is_one_step_for_all_tables(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "r"))
    assert releases.tables() == {} and releases.numbers() == []
    assert releases.publish({"a": one(spark, 1), "b": one(spark, 2)}) == 1
    old = releases.read_all()
    # A new version may be made of the current one, and tables that are not named stay.
    releases.publish({"a": releases.read("a").union(releases.read("b"))})
    assert values(releases.read("a")) == [1, 2] and values(releases.read("b")) == [2]
    # What was read before is still whole.
    assert values(old["a"]) == [1]
    assert values(releases.read("a", 1)) == [1]
    with pytest.raises(KeyError):
        releases.read("c")


def test_release_changes_nothing_if_a_table_fails(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "r"))
    releases.publish({"a": one(spark, 1), "b": one(spark, 2)})
    broken = spark.range(1).select(F.raise_error(F.lit("no output")).cast("long").alias("v"))
    with pytest.raises(Exception, match="no output"):
        releases.publish({"a": one(spark, 7), "b": broken})
    assert {n: values(df) for n, df in releases.read_all().items()} == {"a": [1], "b": [2]}


def test_release_read_while_it_is_published(spark, tmp_path, monkeypatch):
    releases = Releases(spark, str(tmp_path / "r"))
    releases.publish({"a": one(spark, 1), "b": one(spark, 1)})
    seen, put = [], store.put_text

    def look(*args):
        seen.append({n: values(df) for n, df in releases.read_all().items()})
        put(*args)
        seen.append({n: values(df) for n, df in releases.read_all().items()})

    monkeypatch.setattr(store, "put_text", look)
    releases.publish({"a": one(spark, 2), "b": one(spark, 2)})
    assert seen == [{"a": [1], "b": [1]}, {"a": [2], "b": [2]}]


def test_two_publishers_of_one_release(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "r"))
    other = Releases(spark, str(tmp_path / "r"))
    releases.publish({"a": one(spark, 1)})

    class Late:
        """A table during whose writing another job publishes."""

        @property
        def write(self):
            other.publish({"a": one(spark, 5)})
            return one(spark, 6).write

    with pytest.raises(RuntimeError, match="meanwhile"):
        releases.publish({"a": Late()})
    assert values(releases.read("a")) == [5]


def test_views_follow_and_recover(spark, tmp_path, monkeypatch):
    releases = Releases(spark, str(tmp_path / "r"))
    spark.sql("create database if not exists follow_test")
    try:
        releases.publish({"a": one(spark, 1), "b": one(spark, 1)})
        assert releases.follow("follow_test") == ["follow_test.a", "follow_test.b"]
        releases.publish({"a": one(spark, 2).withColumn("more", F.lit("m")), "b": one(spark, 2)})
        show, left = Releases._show, [1]

        def failing(self, view, folder):
            if not left[0]:
                raise OSError("lost")
            left[0] -= 1
            show(self, view, folder)

        monkeypatch.setattr(Releases, "_show", failing)
        with pytest.raises(OSError, match="lost"):
            releases.follow("follow_test")
        # Between two switches no table is missing, and each is of one version.
        assert values(spark.table("follow_test.a")) == [2] and values(spark.table("follow_test.b")) == [1]
        monkeypatch.undo()
        releases.follow("follow_test")
        assert values(spark.table("follow_test.b")) == [2] and spark.table("follow_test.a").columns == ["v", "more"]
    finally:
        spark.sql("drop database follow_test cascade")


def test_old_releases_expire(spark, tmp_path):
    releases = Releases(spark, str(tmp_path / "r"))
    for v in range(4):
        releases.publish({"a": one(spark, v)} | ({"b": one(spark, v)} if v == 0 else {}))
    assert len(releases.expire(keep=2)) == 2
    assert releases.numbers() == [3, 4]
    assert values(releases.read("a", 3)) == [2] and values(releases.read("b")) == [0]
    with pytest.raises(ValueError):
        releases.expire(keep=0)
