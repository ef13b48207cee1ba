"""Column functions on hand-computed cases."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.functions import compare, dates, names, text


@pytest.fixture(scope="module")
def value(spark):
    return lambda col: spark.range(1).select(col).first()[0]


def day(s):
    return F.lit(s).cast("date")


@pytest.mark.parametrize(
    ("start", "step", "expected"),
    [
        ("2023-01-31", "1_month", date(2023, 2, 28)),
        ("2023-02-28", "1_month", date(2023, 3, 28)),
        ("2023-12-31", "1_day", date(2024, 1, 1)),
        ("2023-01-31", "x_day", date(2023, 1, 31)),
        ("2023-01-31", "1_day_2", date(2023, 1, 31)),
        ("2023-01-31", "2_year", date(2023, 1, 31)),
        ("2024-01-31", "13_month", date(2025, 2, 28)),
    ],
)
def test_step_date(value, start, step, expected):
    assert value(dates.step_date(day(start), step)) == expected
    assert value(dates.step_date(day(start), F.lit(step))) == expected


def test_step_date_month_end(value):
    assert value(dates.step_date(day("2023-02-28"), "1_month", month_end=True)) == date(2023, 3, 31)
    assert value(dates.step_date(day("2023-02-27"), "1_day", month_end=True)) == date(2023, 2, 28)
    assert value(dates.step_date(F.lit(None).cast("date"), "1_month", month_end=True)) is None
    with pytest.raises(PySparkException, match="not the last day"):
        value(dates.step_date(day("2023-02-27"), "1_month", month_end=True))


def test_day_30_branch(value):
    for s, expected in [("2023-04-30", "run"), ("2023-03-01", "run"), ("2023-04-01", "skip"), ("2023-03-30", "run")]:
        assert value(dates.day_30_branch(day(s), "run", "skip")) == expected
    with pytest.raises(PySparkException, match="not a scheduled day"):
        value(dates.day_30_branch(day("2023-04-15"), "run", "skip"))


def test_day_gap_of_missing_dates_is_zero(value):
    assert value(dates.day_gap(day("2023-07-10"), day("2023-07-12"))) == 2
    assert value(dates.day_gap(F.lit(None).cast("date"), day("2023-07-12"))) == 0


def test_local_time_over_the_clock_change(value):
    at = lambda s: value(dates.local_text(F.lit(s).cast("timestamp")))
    assert at("2024-03-10 07:59:59") == "2024-03-10 01:59:59"
    assert at("2024-03-10 08:00:00") == "2024-03-10 03:00:00"
    assert value(dates.local_text(F.lit(None).cast("timestamp"))) == "0001-01-01 00:00:00"
    assert value(dates.local_text(F.lit(None).cast("timestamp"), "%Y-%m-%d", dates.NO_DATE)) == "0001-01-01"


def test_run_id_truncates(value):
    assert value(dates.run_id(F.lit("2024-01-01 00:00:00.0019").cast("timestamp"))) == "1704067200001"


def test_watermark_text(value):
    none = F.lit(None).cast("timestamp")
    assert value(dates.watermark_text(F.lit("2024-01-01 01:02:03").cast("timestamp"))) == "2024-01-01T01:02:03.000000Z"
    assert value(dates.watermark_text(none, F.lit("start"))) == "start"
    with pytest.raises(PySparkException, match="no watermark"):
        value(dates.watermark_text(none))


def test_spark_pattern():
    assert dates.spark_pattern("%Y%m%d_at_%H") == "yyyyMMdd_'at'_HH"
    with pytest.raises(ValueError, match="unsupported"):
        dates.spark_pattern("%U")


def test_comparators(value):
    seven, three = F.lit(7), F.lit(3)
    assert value(compare.holds(seven, three))
    assert not value(compare.holds(seven, three, "<="))
    assert value(compare.holds_by(F.lit("=="), seven, seven))
    with pytest.raises(ValueError, match="unknown comparator"):
        compare.holds(seven, three, "nothing")
    with pytest.raises(PySparkException, match="unknown comparator"):
        value(compare.holds_by(F.lit("!="), seven, three))


def test_folder_and_uri_parts(value):
    assert value(names.folder(F.lit("/a/b"))) == "a/b/"
    assert value(names.folder(F.lit("a/b/"))) == "a/b/"
    uri = F.lit("s3://buck/in/2023/file.tar.gz")
    assert value(names.bucket(uri)) == "buck"
    assert value(names.key(uri)) == "in/2023/file.tar.gz"
    assert value(names.base_name(uri)) == "file"
    assert value(names.relocated(F.lit("in/2023/x"), "in/", "out/")) == "out/2023/x"
    assert value(names.after_load(F.lit("in/load7/d/x"), "load7", "out/")) == "out/d/x"
    assert value(names.unpacked_folder("/out", uri, own_folder=True)) == "out/file/"
    assert value(names.unpacked_folder("/out", uri, own_folder=False)) == "out/"


def test_date_in_name(value):
    path = F.lit("in/feed_20230715.dat")
    assert value(names.date_in_name(path, "feed_")) == date(2023, 7, 15)
    assert value(names.date_in_name(path, "feed_*.dat")) == date(2023, 7, 15)
    assert value(names.date_in_name(path, "other_")) is None
    bad = F.lit("in/feed_2023x715.dat")
    assert value(names.date_in_name(bad, "feed_", strict=False)) is None
    with pytest.raises(PySparkException):
        value(names.date_in_name(bad, "feed_"))
    for name, fmt in (("feed_15Jul2023x.dat", "%d%b%Y"), ("feed_20231961.dat", "%Y%j"), ("feed_15-July-2023-2.dat", "%d-%B-%Y"), ("feed_230715_9", "%y%m%d")):
        assert value(names.date_in_name(F.lit(name), "feed_", fmt)) == date(2023, 7, 15)


def test_file_names(value):
    assert value(names.dated_name(day("2023-07-15"), "%d%b%Y", "Exp_", "u")) == "EXP_15JUL2023"
    assert value(names.dated_name(day("2023-07-15"), "%d%b%Y", "Exp_", "l")) == "exp_15jul2023"
    now = F.lit("2024-02-28 13:00:00").cast("timestamp")
    assert value(names.stamp(now, "%Y%m%d%H", ranged=True)) == "2024022813-2024030101"
    assert value(names.fill(F.lit("A_X_Y"), {"X": "Y", "Y": F.lit("z")})) == "A_z_z"
    assert value(names.cleaned(F.lit("a#b?c"), "[#?]")) == "a b c"


@pytest.mark.parametrize(
    ("descriptor", "expected"),
    [("p|d|l|j", ("d", "j")), ("p|d|l", ("d", "NA")), ("p|d", ("NA", "NA")), ("", ("NA", "NA")), (None, ("NA", "NA"))],
)
def test_descriptor_parts(value, descriptor, expected):
    domain, project = text.descriptor_parts(F.lit(descriptor).cast("string"))
    assert (value(domain), value(project)) == expected


def test_ids_and_texts(value):
    correlation = text.correlation_id(F.lit(None), F.lit("dag"), F.lit("run~1"))
    assert value(correlation) == "0~dag~run~1"
    assert value(text.lineage_id(correlation)) == "dag_run_1"
    assert value(text.zero_padded(F.lit("42"), 6)) == "000042"
    assert value(text.zero_padded(F.lit("12345"), 3)) == "12345"
    assert value(text.subject(F.lit("x" * 60), F.lit("y" * 60))) == ("X" * 60 + " | " + "Y" * 60)[:100]
    assert value(text.with_environment(F.lit("s"), "stg")) == "s (STG)"
    assert value(text.with_environment(F.lit("s"), "Prod")) == "s"
    assert value(dates.file_time(F.lit(19000530095943))) == datetime(1900, 5, 30, 9, 59, 43)
    assert value(text.last_part(F.lit("a::b::c"), "::")) == "c"


def test_suppressed_alert(value):
    rule = lambda *a: value(text.suppressed_alert(*[F.lit(x).cast("string") for x in a], domain="sales"))
    assert rule("d_Sales_1", "x_eSFTP_to_s3", "op", "got AirflowSensorTimeout")
    assert rule("d_sales", "t", "S3KeySensor", "got AirflowSensorTimeout")
    assert rule("d_sales", "check_load_ready_to_start", "op", "any")
    assert not rule("d_sales", "x_esftp_to_s3", "op", "other")
    assert not rule("d_other", "check_load_ready_to_start", "op", "any")
    assert not rule(None, "check_load_ready_to_start", "op", "any")


def test_stamp_of_naive_time(value):
    assert value(names.stamp(F.lit(datetime(2024, 1, 1)), "%Y%m%d")) == "20240101"
