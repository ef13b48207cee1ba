"""Sources, sinks and streams on temporary files."""

import gzip
import json
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.operators import filesets
from feedloom.plans import bulk_load, extract
from feedloom.session import scratch
from feedloom.sinks import publish, write_dataset, write_watermark
from feedloom.sources import archives, files, jdbc
from feedloom.streaming import file_stream, keep_watermarks, process_new_files, read_watermarks, watermark_stream
from feedloom.suite.fixtures import write_zip


def test_jdbc_options():
    base = dict(database_type="Postgres", url="jdbc:x", query="select 1")
    plain = jdbc.jdbc_options(**base, user="u", password="p")
    assert plain["driver"] == "org.postgresql.Driver" and plain["query"] == "select 1" and plain["user"] == "u"
    sliced = jdbc.jdbc_options(**base, slices=jdbc.Slices("id", 0, 100, 4))
    assert sliced["dbtable"] == "(select 1) extract" and "query" not in sliced
    assert (sliced["partitionColumn"], sliced["lowerBound"], sliced["upperBound"], sliced["numPartitions"]) == ("id", "0", "100", "4")
    tls = {"location": "/s", "password": "w"}
    assert "sslConnection" not in jdbc.jdbc_options(**base, tls=tls)
    assert jdbc.jdbc_options("DB2", "jdbc:x", "q", tls=tls)["sslTrustStoreLocation"] == "/s"
    with pytest.raises(ValueError, match="unsupported database"):
        jdbc.driver_class("sqlite")
    assert {jdbc.driver_class(d) for d in "mysql MSSQL oracle teradata postgres db2".split()} == set(jdbc.DRIVERS.values())


def test_sliced_read_asks_for_the_bounds_first(spark, monkeypatch):
    calls = []

    def read(spark, **options):
        calls.append(options)
        return spark.createDataFrame([(3, 9) if len(calls) == 1 else (None, None)], "a int, b int")

    monkeypatch.setattr(jdbc, "read_jdbc", read)
    jdbc.read_sliced(spark, "id", 4, database_type="db2", url="u", query="select 1")
    assert calls[0]["query"] == "select min(id) as lower_bound, max(id) as upper_bound from (select 1) bounds"
    assert calls[1]["slices"] == jdbc.Slices("id", 3, 9, 4) and calls[1]["query"] == "select 1"
    jdbc.read_sliced(spark, "id", 4, database_type="db2", url="u", query="select 1")
    assert "slices" not in calls[3]


def test_extract_query():
    q = jdbc.extract_query
    assert q("d", "t", history=True) == "select * from d.t"
    assert q("d", "t", history=True, complete_query="c", condition="x > 1") == "c"
    assert q("d", "t", complete_query="c", condition="x > 1") == "select * from d.t where x > 1"
    assert q("d", "t", complete_query="c") == "c"
    with pytest.raises(ValueError, match="condition"):
        q("d", "t")


def test_extract_rows_pushes_the_condition_down(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    some = jdbc.extract_rows(orders, condition="o_orderkey > 1400")
    assert "GreaterThan(o_orderkey,1400)" in some._jdf.queryExecution().executedPlan().toString()
    assert jdbc.extract_rows(orders, history=True).count() == orders.count() > some.count()
    with pytest.raises(ValueError, match="condition"):
        jdbc.extract_rows(orders)


def test_extract_job(spark, tmp_path):
    df = spark.range(2500).select("id", F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").cast("string").alias("text")).coalesce(1)
    job = extract.ExtractJob(
        f"{tmp_path}/out",
        records_per_file=1000,
        run_date="2024-01-02",
        incremental=True,
        watermark_column="ts",
        watermark_location=f"{tmp_path}/mark",
        manifest_location=f"{tmp_path}/manifest",
        feed_id="f1",
    )
    written = extract.run(spark, df, job)
    assert written.record_count == 2500 and written.location == f"{tmp_path}/out/2024-01-02"
    assert len(list((tmp_path / "out" / "2024-01-02").glob("*.parquet"))) == 3
    assert files.read_watermark(spark, f"{tmp_path}/mark").first()[0] == datetime(1970, 1, 1, 0, 41, 39)
    document = json.loads(next((tmp_path / "manifest").glob("*.json")).read_text())
    assert (document["feed_id"], document["record_count"], document["file_format"]) == ("f1", 2500, "parquet")
    for bad in (dict(incremental=True), dict(manifest_location="x")):
        with pytest.raises(ValueError):
            extract.ExtractJob("out", **bad)


def test_extract_from_arguments():
    args = {"TABLE_NAME": "t", "DATABASE_NAME": "d", "OUTPUT_LOCATION": "out", "FILTER_CONDITION": "x > 1"}
    query, job = extract.from_arguments(args, "2024-01-02")
    assert query == "select * from d.t where x > 1"
    assert job == extract.ExtractJob("out")
    more = {
        "HISTORY_LOAD": "Y",
        "APPEND_CURRENT_DATE": "Y",
        "MAX_RECORDS_PER_FILE": "10",
        "IS_INCREMENTAL": "y",
        "INCREMENTAL_COL_NAME": "ts",
        "INCREMENTAL_VALUE_OUTPUT_LOC": "mark",
        "POPULATE_META_FILE": "true",
        "META_FILE_LOCATION": "meta/",
        "AUDIT_FEED_ID": "7",
        "DAG_RUN_ID": "r",
    }
    query, job = extract.from_arguments(args | more, "2024-01-02")
    assert query == "select * from d.t"
    assert (job.run_date, job.records_per_file, job.watermark_column) == ("2024-01-02", 10, "ts")
    assert (job.manifest_location, job.feed_id, job.run_id) == ("meta/t_20240102", "7", "r")
    assert extract.from_arguments(args | {"HISTORY_LOAD": "N"}, "2024-01-02")[0] == "select * from d.t where x > 1"


def test_watermark_of_text_is_taken_after_the_cast(spark, tmp_path):
    df = spark.createDataFrame([("9",), ("10",), (None,)], "v string")
    written = write_dataset(df, f"{tmp_path}/d", watermark="v", watermark_type="long")
    assert written.watermark == "10"
    assert write_watermark(spark, written, f"{tmp_path}/w", "top", "long")
    assert files.read_watermark(spark, f"{tmp_path}/w", "top", "long").first()[0] == 10
    for i, none in enumerate((spark.createDataFrame([], "v string"), df.where("1 = 0"))):
        assert write_dataset(none, f"{tmp_path}/none{i}", watermark="v").record_count == 0
    nothing = write_dataset(df.limit(0), f"{tmp_path}/e", watermark="v", watermark_type="long")
    assert not write_watermark(spark, nothing, f"{tmp_path}/none", "top", "long")
    assert not (tmp_path / "none").exists()


def test_watermark_keeps_microseconds(spark, tmp_path):
    at = datetime(2024, 1, 1, 2, 3, 4, 567891)
    written = write_dataset(spark.createDataFrame([(at,)], "ts timestamp"), f"{tmp_path}/d", watermark="ts")
    write_watermark(spark, written, f"{tmp_path}/w")
    assert files.read_watermark(spark, f"{tmp_path}/w").first()[0] == at


@pytest.fixture
def landing(tmp_path):
    for name, content in {
        "good/a b+c%20.txt": "h\n\nr\n",
        "blank/x.txt": "\n\n",
        "blank/y.txt": "h\n",
        "mixed/e.csv": "",
        "mixed/f.DAT": "r",
        "empty/e.csv": "",
    }.items():
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    return str(tmp_path / "landing")


def test_manifest_and_lines_agree_on_paths(spark, landing):
    listed = files.manifest(spark, landing)
    assert listed.columns == ["path", "modificationTime", "length"]
    lines = files.data_lines(files.read_lines(spark, landing)).groupBy("path").count()
    got = {r.path.split("/landing/")[1]: r["count"] for r in listed.join(lines, "path").collect()}
    assert got == {"good/a b+c%20.txt": 2, "blank/y.txt": 1, "mixed/f.DAT": 1}


def test_listing_has_empty_files_and_the_same_paths(spark, landing):
    (Path(landing) / "top.txt").write_text("x")
    (Path(landing) / "empty" / "_hidden").write_text("abc")
    listed = files.manifest(spark, landing)
    got = {r.path: (r.modificationTime, r.length) for r in listed.collect()}
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    known = {r.path: (r.modificationTime, r.length) for r in reader.select("path", "modificationTime", "length").collect()}
    assert {p.rpartition("/")[2] for p in set(got) - set(known)} == {p.rpartition("/")[2] for p in got if got[p][1] == 0} | {"_hidden"}
    assert len(got) == 8 and len(known) == 5
    for path, (time, length) in known.items():
        assert got[path][1] == length and abs((got[path][0] - time).total_seconds()) < 1
    flat = {r.path.rpartition("/")[2] for r in files.manifest(spark, landing, recursive=False).collect()}
    assert flat == {"top.txt"}
    folder = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    asked = spark.createDataFrame([(f,) for f in ("good", "blank", "mixed", "empty", "landing", "none")], "folder string")
    counts = filesets.object_counts(asked, listed, folder, limit=1).collect()
    assert {r.folder: r.n for r in counts} == {"good": 1, "blank": 2, "mixed": 2, "empty": 2, "landing": 1, "none": 0}


def test_listing_walks_deep_folders(spark, tmp_path):
    for i in range(40):
        for j in range(3):
            folder = tmp_path / f"a{i}" / "b" / f"c{j}"
            folder.mkdir(parents=True)
            (folder / "f").write_text("x" * i)
    listed = files.manifest(spark, str(tmp_path)).collect()
    assert sorted(r.length for r in listed) == sorted([*range(40)] * 3)
    assert len({r.path for r in listed}) == 120


def test_data_gate(spark, landing):
    folder = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    listed, lines = files.manifest(spark, landing), files.read_lines(spark, landing)
    asked = spark.createDataFrame([(f,) for f in ("good", "blank", "mixed", "empty", "none")], "folder string")
    out = filesets.data_gate(asked, listed, lines, folder)
    assert {r.folder: r.has_data for r in out.collect()} == {
        "good": True,
        "blank": False,
        "mixed": True,
        "empty": False,
        "none": False,
    }
    headed = {r.folder: r.has_data for r in filesets.data_gate(asked, listed, lines, folder, header=0).collect()}
    assert headed == {"good": True, "blank": False, "mixed": False, "empty": False, "none": False}
    with pytest.raises(PySparkException, match="extension not allowed"):
        filesets.data_gate(asked, listed, lines, folder, extensions=("txt", "csv")).collect()
    assert filesets.data_gate(asked, listed, lines, folder, extensions=None).count() == 5


def test_zip_round_trip(spark, tmp_path):
    target = f"{tmp_path}/zips in"
    df = spark.createDataFrame([(f"m{i}.txt", f"line {i}\r\n\nend") for i in range(50)] + [("none.txt", None)], "m string, t string")
    made = write_zip(df.repartition(3), target, "m", "t").collect()
    assert sum(r.members for r in made) == 51
    members = archives.zip_members(spark, target)
    assert members.count() == 51
    lines = archives.read_zip_lines(members, 4).collect()
    assert sorted((r.member, r.line, r.value) for r in lines) == sorted(
        (f"m{i}.txt", n, v) for i in range(50) for n, v in enumerate([f"line {i}", "", "end"])
    )


def test_zip_with_folders_and_many_lines(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.ZIP", "w") as z:
        z.writestr("d/", "")
        z.writestr("d/long.txt", "\n".join(str(i) for i in range(20_000)))
    with zipfile.ZipFile(tmp_path / "two.zip", "w"):
        pass
    members = archives.zip_members(spark, str(tmp_path))
    assert [(r.member) for r in members.collect()] == ["d/long.txt"]
    lines = archives.read_zip_lines(members).collect()
    assert [int(r.value) for r in sorted(lines, key=lambda r: r.line)] == list(range(20_000))


def test_zip_is_opened_once_a_task(tmp_path, monkeypatch):
    """Members come in many small batches; each archive's listing, which grows with it, is read once, not once a batch."""
    import pyarrow as pa

    paths = []
    for a in range(2):
        paths.append(str(tmp_path / f"a{a}.zip"))
        with zipfile.ZipFile(paths[-1], "w") as z:
            for i in range(30):
                z.writestr(f"m{i:02d}.txt", f"{a} {i}\nend")
    opened = []
    real = archives._open_zip
    monkeypatch.setattr(archives, "_open_zip", lambda uri, options: opened.append(uri) or real(uri, options))
    pairs = sorted((p, f"m{i:02d}.txt") for p in paths for i in range(30))
    batches = [pa.RecordBatch.from_pydict({"path": [p for p, _ in pairs[k : k + 7]], "member": [m for _, m in pairs[k : k + 7]]}) for k in range(0, 60, 7)]
    got = pa.Table.from_batches(list(archives._read_members(iter(batches), {}))).to_pylist()
    assert opened == paths
    assert sorted((r["path"], r["member"], r["line"], r["value"]) for r in got) == sorted(
        (p, f"m{i:02d}.txt", n, v) for a, p in enumerate(paths) for i in range(30) for n, v in enumerate([f"{a} {i}", "end"])
    )


def test_gzip_lines(spark, tmp_path):
    with gzip.open(tmp_path / "a.gz", "wt") as out:
        out.write("x\n\ny\n")
    assert [r.value for r in files.read_lines(spark, str(tmp_path)).collect()] == ["x", "", "y"]


def test_status_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text('{\n"count": 3\n}')
    assert [r["count"] for r in files.read_status(spark, str(tmp_path)).collect()] == [3]


def test_publish_replaces_what_it_reads(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    spark.range(3).write.parquet(a)
    old = spark.read.parquet(a)
    publish(spark, {a: old.where("id > 0"), b: old})
    assert sorted(r.id for r in spark.read.parquet(a).collect()) == [1, 2]
    assert spark.read.parquet(b).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_publish_touches_nothing_if_an_output_fails(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    spark.range(3).write.parquet(a)
    broken = spark.range(1).select(F.raise_error(F.lit("no output")).cast("int").alias("v"))
    with pytest.raises(PySparkException, match="no output"):
        publish(spark, {a: spark.range(9), b: broken})
    assert spark.read.parquet(a).count() == 3
    assert not (tmp_path / "b").exists()


def test_bulk_load(spark, tmp_path):
    columns = bulk_load.NOTIFICATION_COLUMNS
    assert len(columns) == 31 and len(bulk_load.NOTIFICATION_CASTS) == 6
    row = {c: "2024-01-02 03:04:05" if k == "timestamp" else "2024-01-02" for c, k in bulk_load.NOTIFICATION_CASTS.items()}
    staged = spark.createDataFrame([tuple(row.get(c, c) for c in columns)], ", ".join(f"{c} string" for c in columns))
    staged.withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/staged")
    bulk_load.load(spark, f"{tmp_path}/staged", f"{tmp_path}/target")
    out = spark.read.parquet(f"{tmp_path}/target")
    assert out.columns == list(columns)
    assert out.first().notif_dtm == datetime(2024, 1, 2, 3, 4, 5)
    bad = staged.withColumn("load_dtm", F.lit("soon"))
    assert bulk_load.typed(bad, permissive=True).first().load_dtm is None
    with pytest.raises(PySparkException):
        bulk_load.typed(bad).collect()


def test_bulk_load_target_spreads_one_row_group(spark, tmp_path, monkeypatch):
    from feedloom.suite import QUERIES, chain

    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    monkeypatch.setattr(chain, "scratch", lambda _spark, name: f"{tmp_path}/{name}")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = QUERIES["bulk_load_target"](spark, f"{tmp_path}/in")
        want = QUERIES["bulk_load_typed"](spark, f"{tmp_path}/in")
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # One file of one row group is one task; the prefix is written by several.
    assert len(list((tmp_path / "bulk-load" / "prefix").glob("*.parquet"))) > 1


def test_insert_is_by_position(spark, tmp_path):
    spark.sql(f"create table by_position (a int, b date) using parquet location '{tmp_path}/t'")
    try:
        df = spark.createDataFrame([("2024-01-02", 1)], "b string, a int").select("a", F.col("b").cast("date").alias("other"))
        bulk_load.insert_into(spark, df, "by_position")
        assert [tuple(r) for r in spark.table("by_position").collect()] == [(1, datetime(2024, 1, 2).date())]
    finally:
        spark.sql("drop table by_position")


def test_arrivals_are_processed_once(spark, tmp_path):
    source, target, check = (f"{tmp_path}/{n}" for n in ("in", "out", "check"))
    spark.range(0, 5).coalesce(1).write.mode("append").parquet(source)
    go = lambda: process_new_files(file_stream(spark, source, "id long", files_per_batch=1), target, check)
    go()
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(source)
    go()
    go()
    out = spark.read.parquet(target)
    assert sorted(r.id for r in out.collect()) == list(range(8))
    assert out.select("file_path").distinct().count() == 2


def test_watermarks_grow_over_calls(spark, tmp_path):
    source, table, check = (f"{tmp_path}/{n}" for n in ("in", "table", "check"))

    def arrive(*rows):
        spark.createDataFrame(rows, "s string, ts timestamp").coalesce(1).write.mode("append").parquet(source)
        keep_watermarks(watermark_stream(file_stream(spark, source, "s string, ts timestamp"), "s", "ts"), table, check, "s")
        return {r.s: (r.start_timestamp.day, r.n) for r in read_watermarks(spark, table, "s").collect()}

    day = lambda d: datetime(2024, 1, d)
    assert arrive(("a", day(5)), ("b", day(1))) == {"a": (5, 1), "b": (1, 1)}
    # A late row counts, and does not move the watermark back.
    assert arrive(("a", day(2)), ("c", day(9))) == {"a": (5, 2), "b": (1, 1), "c": (9, 1)}
    # With a new checkpoint batches are numbered from 0 again; a later time still wins.
    check = f"{tmp_path}/another"
    assert arrive(("a", day(20))) == {"a": (20, 3), "b": (1, 1), "c": (9, 1)}


def test_publish_keeps_the_layout(spark, tmp_path):
    target = f"{tmp_path}/table"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    df.write.partitionBy("k").parquet(target)
    publish(spark, {target: spark.read.parquet(target).withColumn("v", F.col("v") + 1)}, layout={target: ["k"]})
    assert sorted(p.name for p in Path(target).iterdir() if p.is_dir()) == ["k=a", "k=b"]
    assert sorted((r.v, r.k) for r in spark.read.parquet(target).collect()) == [(2, "a"), (3, "b")]


def test_blank_lines_of_all_kinds(spark):
    df = spark.createDataFrame([("a\r\n\r\n\t\nb",), (" \t ",), ("\r\n",), ("x\ry",), (None,)], "t string")
    assert [r[0] for r in df.select(filesets.non_blank_lines(F.col("t"))).collect()] == [2, 0, 0, 2, None]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="share"):
        scratch(Session(), "x")


def test_scratch_without_a_set_folder(spark, monkeypatch):
    class Context:
        master = "local[2]"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    one, two = scratch(Session(), "x"), scratch(Session(), "x")
    assert one != two and Path(one).parent == Path(two).parent and Path(one).parent.is_dir()


def test_scratch_is_new_each_time(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one != two
    assert base is None or one.startswith(base)
