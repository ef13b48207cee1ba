"""Control-table operators on small cases."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.operators import alerts, controls, documents, feeds, filesets, gates, tables
from feedloom.plans import feed_cycle


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple(str(x) for x in r))


@pytest.fixture(scope="module")
def latest(spark):
    data = [("Own ", "A", date(2023, 7, 10)), ("own", "a", date(2023, 7, 1)), ("other", "b", date(2023, 7, 12))]
    control = spark.createDataFrame(data, "domainname string, loadname string, feed_date date")
    return feeds.max_feed_date(control)


def edges(spark, *data):
    schema = (
        "domainname string, loadname string, dependent_domainname string, dependent_loadname string, "
        "operator string, offset int, check_self_dependency string"
    )
    return spark.createDataFrame(list(data), schema)


def test_max_feed_date_ignores_case_and_blanks(latest):
    assert rows(latest, "domainname", "loadname", "feed_date") == [
        ("other", "b", date(2023, 7, 12)),
        ("own", "a", date(2023, 7, 10)),
    ]


def test_dependencies(spark, latest):
    e = edges(
        spark,
        ("own", "A", "OTHER", "B", ">=", 2, None),
        ("own", "a", "none", "x", ">=", 0, "n"),
        ("own", "a", "none", "x", ">", 0, None),
        ("other", "b", None, None, "==", 3, "Y"),
    )
    out = feeds.dependencies(e, latest, given=F.lit("2023-07-15"))
    assert rows(out, "domainname", "operator", "diff_days", "met") == [
        ("other", "==", 3, True),
        ("own", ">", 0, False),
        ("own", ">=", 0, True),
        ("own", ">=", 2, True),
    ]
    assert rows(feeds.ready_loads(out), "domainname", "ready") == [("other", True), ("own", False)]


def test_unknown_operator_fails(spark, latest):
    with pytest.raises(PySparkException, match="unknown comparator"):
        feeds.dependencies(edges(spark, ("own", "a", "other", "b", "!=", 2, None)), latest).collect()


def test_missing_offset_fails(spark, latest):
    with pytest.raises(PySparkException, match="without an offset"):
        feeds.dependencies(edges(spark, ("own", "a", "other", "b", ">=", None, None)), latest).collect()


def test_require(spark, latest):
    assert gates.require(latest, F.col("feed_date").isNotNull(), "no date").count() == 2
    with pytest.raises(PySparkException, match='too old: {"domainname":"own"'):
        gates.require(latest, F.col("feed_date") > F.lit("2023-07-11").cast("date"), "too old").collect()


def test_feed_date_gaps(spark, latest):
    pairs = spark.createDataFrame([("own", "a", "other", "b")], "from_domain string, from_load string, to_domain string, to_load string")
    assert rows(feeds.feed_date_gaps(pairs, latest, 2), "gap_days", "met") == [(2, True)]
    assert rows(feeds.feed_date_gaps(pairs, latest, 3, "lt", today="2023-07-13"), "gap_days", "met") == [(3, False)]


def test_dates_take_what_is_given_first(spark, latest):
    loads = spark.createDataFrame([("own", "a", "2020-02-02"), ("new", "z", None)], "domainname string, loadname string, arg string")
    catchup = spark.createDataFrame([("own", "a", date(2023, 1, 5)), ("new", "z", date(2023, 1, 6))], "domainname string, loadname string, run_date date")
    dated = feeds.run_dates(loads, catchup, "2024-01-01", given=F.col("arg"))
    assert rows(dated, "domainname", "run_date") == [("new", date(2023, 1, 6)), ("own", date(2020, 2, 2))]
    out = feeds.next_feed_dates(dated, latest, "1_day")
    assert rows(out, "domainname", "feed_date") == [("new", date(2023, 1, 6)), ("own", date(2023, 7, 11))]
    out = feeds.next_feed_dates(dated, latest, "Current", given=F.col("arg"))
    assert rows(out, "domainname", "feed_date") == [("new", date(2023, 1, 6)), ("own", date(2020, 2, 2))]


def test_max_control_value_takes_known_columns_only(spark):
    control = spark.createDataFrame([("d", "l", 3)], "domainname string, loadname string, start_timestamp int")
    assert rows(feeds.max_control_value(control, " START_timestamp "), "start_timestamp") == [(3,)]
    with pytest.raises(ValueError, match="no control column"):
        feeds.max_control_value(control, "1) from x --")


def audit(spark, *data):
    schema = "run_id long, dag_name string, domainname string, loadname string, feeddate date, status string, end_time timestamp"
    return spark.createDataFrame(list(data), schema)


def test_next_file(spark):
    d, t = date(2024, 1, 1), datetime
    a = audit(
        spark,
        (5, "DAG1", "dom", "load::f1", d, "completed", t(2024, 1, 1, 5)),
        (5, "dag1", "dom", "load::f2", d, "failed", None),
        (5, "dag2", "dom", "load::f9", d, "completed", t(2024, 1, 1, 9)),
        (9, "dag1", "dom", "load::f3", d, "started", t(2024, 1, 1, 9)),
        (9, "dag1", "dom", "zzz::f3", d, "completed", t(2024, 1, 1, 9)),
    )
    seq = spark.createDataFrame(
        [("dom", "load", "f1", "f2"), ("dom", "load", "f2", "f3")], "domain_name string, load_name string, current string, next string"
    )
    asked = spark.createDataFrame(
        [("dom", "load", d, "Dag1", "def"), ("dom", "load", d, "dag2", "def"), ("dom", "load", d, "dag3", "def"), ("x", "load", d, "dag1", "def")],
        "domain_name string, load_name string, feed_date date, dag_name string, default_file string",
    )
    # Run 9 has no completed row of the load; in run 5 the row without an end time is the last.
    assert rows(feeds.next_file(a, seq, asked), "domain_name", "dag_name", "next_file") == [
        ("dom", "Dag1", "f3"),
        ("dom", "dag2", None),
        ("dom", "dag3", "def"),
        ("x", "dag1", "def"),
    ]


def test_status_and_count_gates(spark):
    d = date(2024, 1, 1)
    a = audit(
        spark,
        (1, "x", "dom", "load", d, "started", None),
        (2, "x", "dom", "load", d, "completed", None),
        (2, "x", "dom", "load", d, "completed", None),
        (3, "x", "dom", "load_b", d, "failed", None),
    )
    loads = spark.createDataFrame([("dom", "load"), ("dom", "none")], "domainname string, loadname string")
    assert rows(gates.status_gate(loads, a, "skip", "next"), "loadname", "branch") == [("load", "skip"), ("none", "next")]
    assert rows(gates.status_gate(loads, a, "skip", "next", last_run=True), "loadname", "branch") == [("load", "next"), ("none", "next")]
    domains = loads.select("domainname").distinct()
    like = gates.status_gate_like(domains, a, ["load", "b", "zzz"], "skip", "next", ["failed"], last_run=True)
    assert rows(like, "load_text", "branch") == [("b", "skip"), ("load", "skip"), ("zzz", "next")]
    asked = loads.withColumn("feed_date", F.lit("2024-01-01").cast("date")).withColumn("expected_count", F.lit(2))
    out = gates.count_gate(asked, a, "next", "skip")
    assert rows(out, "loadname", "completed", "branch") == [("load", 2, "next"), ("none", 0, "skip")]


def test_branches_fail_on_the_unknown(spark):
    df = spark.createDataFrame([("true",)], "v string")
    assert df.select(gates.branch_by(F.col("v"), {"true": "run"})).first()[0] == "run"
    for bad in (F.lit("other"), F.lit(None)):
        with pytest.raises(PySparkException, match="no branch for"):
            df.select(gates.branch_by(bad, {"true": "run"})).collect()
    assert gates.branch_of_result(df, {"true": "run"}).first()[0] == "run"
    with pytest.raises(PySparkException, match="no branch for NULL"):
        gates.branch_of_result(df.limit(0), {"true": "run"}).collect()
    flags = [df.select(gates.history_branch(F.lit(v).cast("string"), "h", "i")).first()[0] for v in (" Y", "n", None)]
    assert flags == ["h", "i", "i"]
    with pytest.raises(PySparkException, match="no .* in the status document"):
        df.select(gates.json_count_gate(F.lit("{}"), "a", "b")).collect()
    assert df.select(gates.json_count_gate(F.lit('{"count": "2"}'), "a", "b")).first()[0] == "a"


def test_sequences_and_system_keys(spark):
    names = spark.createDataFrame([("n",), ("none",)], "key_name string")
    keys = spark.createDataFrame([("n", "9"), ("n", "41"), ("n", None)], "key_name string, last_val string")
    assert rows(controls.next_system_key(names, keys, 1, 6), "sys_key_val") == [("000000",), ("000042",)]
    assert rows(controls.next_system_key(names, keys, given=F.lit("07")), "sys_key_val") == [("7",), ("7",)]
    feeds_ = spark.createDataFrame([("f",), ("g",)], "feed_id string")
    history = spark.createDataFrame(
        [("f", "9", "SUCCEEDED"), ("f", "10", "SUCCEEDED"), ("f", "99", "FAILED"), ("g", "5", "FAILED")],
        "feed_id string, file_sequence_no string, job_status string",
    )
    assert rows(controls.next_sequence(feeds_, history), "feed_id", "sequence_no") == [("f", 11), ("g", 1)]


def test_upsert_keeps_the_insert_time_and_can_be_repeated(spark):
    schema = "domainname string, loadname string, feed_date date, insert_timestamp string, update_timestamp string, note string"
    old = [("d", "a", date(2023, 1, 1), "t0", None, "n1"), ("d", "b", date(2023, 1, 1), "t0", None, "n2")]
    table = spark.createDataFrame(old, schema)
    new = spark.createDataFrame(
        [("d", "a", date(2023, 1, 2), 1), ("d", "a", date(2023, 1, 3), 2), ("d", "c", date(2023, 1, 4), 1)],
        "domainname string, loadname string, feed_date date, at int",
    )
    keys = ["domainname", "loadname"]
    once = tables.upsert(table, new, keys, ["feed_date"], F.lit("t1"), "at")
    expected = [
        ("d", "a", date(2023, 1, 3), "t0", "t1", "n1"),
        ("d", "b", date(2023, 1, 1), "t0", None, "n2"),
        ("d", "c", date(2023, 1, 4), "t1", None, None),
    ]
    assert rows(once, "*") == expected
    twice = tables.upsert(once, new, keys, ["feed_date"], F.lit("t1"), "at")
    assert rows(twice, *keys, "feed_date", "insert_timestamp") == rows(once, *keys, "feed_date", "insert_timestamp")


def test_upsert_does_not_shuffle_the_table_for_a_few_rows(spark):
    table = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    new = spark.createDataFrame([(5, 50, 1), (2000, 7, 1)], "k long, v long, at int")
    out = tables.upsert(table, new, ["k"], ["v"], F.lit("now"), "at")
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == 1001 and got[5] == 50 and got[2000] == 7 and got[6] == 6
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in plan


def test_upsert_takes_rows_without_an_order(spark):
    table = spark.createDataFrame([(1, 10, "t0")], "k long, v long, insert_timestamp string")
    new = spark.createDataFrame([(1, 11, None), (2, 20, None), (3, 30, None), (3, 31, 1)], "k long, v long, at int")
    out = tables.upsert(table, new, ["k"], ["v"], F.lit("now"), "at")
    assert rows(out, "*") == [(1, 11, "t0"), (2, 20, "now"), (3, 31, "now")]


def test_append_and_delete(spark):
    table = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    added = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    assert rows(tables.append_rows(table, added, ["k", "v"]), "*") == [(1, "a"), (2, "c"), (None, "b")]
    listed = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    assert rows(tables.delete_by_keys(table, listed, {"k": "x"}), "*") == [(None, "b")]


def test_record_cycle(spark):
    control = spark.createDataFrame([], "domainname string, loadname string, run_date date, feed_date date, insert_timestamp timestamp")
    catchup = spark.createDataFrame([("d", "a", date(2023, 1, 1)), ("d", "a", date(2023, 1, 2))], "domainname string, loadname string, run_date date")
    done = spark.createDataFrame([("d", "a", date(2023, 1, 1), date(2023, 1, 9))], "domainname string, loadname string, run_date date, feed_date date")
    control, catchup = feed_cycle.record_cycle(control, catchup, done, F.lit("2024-01-01").cast("timestamp"))
    assert rows(control, "loadname", "feed_date") == [("a", date(2023, 1, 9))]
    assert rows(catchup, "run_date") == [(date(2023, 1, 2),)]


@pytest.mark.parametrize(
    ("selection", "validation", "files", "expected"),
    [
        ("NEWER_OLDEST", "FILEMODTIME", {"a": 0, "b": 5, "c": 5}, "b"),
        ("NEWER_LATEST", "FILEMODTIME", {"a": 0, "b": 5, "c": 5}, "c"),
        ("NEWER_OLDEST", "FILENAME", {"a": 5}, None),
        ("NEWER_OLDEST", "FILEMODTIME", {"a": 5}, "a"),
    ],
)
def test_pick_newer(spark, selection, validation, files, expected):
    schema = "domain_name string, load_name string, file_name string, file_mod_time timestamp"
    df = spark.createDataFrame([("d", "l", n, datetime(2024, 1, 1, 10, m)) for n, m in files.items()], schema)
    sensed = spark.createDataFrame(
        [("d", "l", "a", datetime(2024, 1, 1, 10), True), ("d", "l", "z", datetime(2025, 1, 1), False)], schema + ", is_sensed boolean"
    )
    out = filesets.pick_newer(df, filesets.last_processed(sensed), ["domain_name", "load_name"], selection, validation)
    assert [r.file_name for r in out.collect()] == ([expected] if expected else [])


def test_pick_newer_starts_early_without_a_known_time(spark):
    schema = "domain_name string, load_name string, file_name string, file_mod_time timestamp"
    df = spark.createDataFrame([("d", "l", "a", datetime(2024, 1, 1)), ("e", "l", "b", datetime(2024, 1, 1))], schema)
    sensed = spark.createDataFrame(
        [("d", "l", "x", None, True), ("d", "l", "y", datetime(2025, 1, 1), True)], schema + ", is_sensed boolean"
    )
    out = filesets.pick_newer(df, filesets.last_processed(sensed), ["domain_name", "load_name"])
    assert rows(out, "file_name") == [("a",), ("b",)]
    with pytest.raises(ValueError, match="selection"):
        filesets.pick_newer(df, sensed, ["domain_name"], "NEWEST")
    with pytest.raises(ValueError, match="validation"):
        filesets.pick_newer(df, sensed, ["domain_name"], validation="NAME")


def test_alerts(spark):
    config = spark.createDataFrame(
        [("Dag", "Task_One,task_two", "y"), ("dag", "task_three", "N")], "dag_id string, task_id_list string, skip_alert string"
    )
    failures = spark.createDataFrame(
        [("DAG", "TASK_ONE"), ("dag", "two"), ("dag", "task_three"), ("other", "two"), (None, "two")], "dag_id string, task_id string"
    )
    assert rows(alerts.suppressed_by_config(failures, config), "task_id") == [("TASK_ONE",), ("two",)]
    assert rows(alerts.alert_branch(failures, config), "dag_id", "task_id", "alert") == [
        ("DAG", "TASK_ONE", "skip"),
        (None, "two", "send"),
        ("dag", "task_three", "send"),
        ("dag", "two", "skip"),
        ("other", "two", "send"),
    ]


def test_lists_in_parts_hold_every_row(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    out = documents.joined_list(df, ["g"], "v", F.floor(F.col("v") / 100), "vals").collect()
    assert sorted(int(x) for r in out for x in r.vals.split(",")) == list(range(1000))
    assert max(len(r.vals.split(",")) for r in out) == 50


def test_audit_records(spark):
    import json

    schema = (
        "dag_id string, operator string, task_id string, start_date timestamp, end_date timestamp, job_id long, "
        "try_number int, duration double, state string, execution_date timestamp"
    )
    start = datetime(2024, 7, 1, 12)
    data = [("d", "op", "t1", start, None, 1, 1, None, "ok", start), ("d", "op", "t2", start, start, None, 1, 2.5, "ok", start)]
    out = documents.audit_records(spark.createDataFrame(data, schema), F.lit(0)).collect()
    assert json.loads(out[0].records) == [
        {
            "dag_id": "d",
            "operator": "op",
            "task_id": "t1",
            "start_date": "2024-07-01 07:00:00",
            "end_date": "0001-01-01 00:00:00",
            "job_id": 1,
            "try_number": 1,
            "duration": None,
            "state": "ok",
            "dag_run_id": "1719835200000",
            "execution_date": "2024-07-01 07:00:00",
        }
    ]
