"""Feed-date arithmetic and clock formatting as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The local zone of the feeds, and the text shown for a missing time.
LOCAL_ZONE = "America/Chicago"
NO_TIME = "0001-01-01 00:00:00"
NO_DATE = "0001-01-01"

# Strftime directives and the Spark pattern letters they stand for.
DIRECTIVES = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%j": "DDD",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
}


# What each directive matches in a text. Numbers have all their digits.
_LETTERS = r"\p{L}"
MATCHES = {d: rf"\d{{{len(p)}}}" for d, p in DIRECTIVES.items() if d in ("%Y", "%y", "%m", "%d", "%H", "%I", "%M", "%S", "%f", "%j")}
MATCHES |= {"%p": "[AaPp][Mm]", "%b": _LETTERS + "{3}", "%a": _LETTERS + "{3}", "%B": _LETTERS + "+", "%A": _LETTERS + "+"}


def date_regex(fmt: str) -> str:
    """A regular expression for the text of a date in a strftime format."""

    def one(match: re.Match) -> str:
        token = match.group(0)
        if token == "%%":
            return "%"
        if token.startswith("%"):
            if token not in MATCHES:
                raise ValueError(f"unsupported date directive {token!r}")
            return MATCHES[token]
        return re.sub(r"([^\w\s])", r"\\\1", token)

    return re.sub(r"%.|[^%]+", one, fmt)


def spark_pattern(fmt: str) -> str:
    """A Spark datetime pattern for a strftime format; letters outside directives are quoted."""

    def one(match: re.Match) -> str:
        token = match.group(0)
        if token == "%%":
            return "%"
        if token.startswith("%"):
            if token not in DIRECTIVES:
                raise ValueError(f"unsupported date directive {token!r}")
            return DIRECTIVES[token]
        return f"'{token}'"

    return re.sub(r"%.|[A-Za-z]+", one, fmt)


def local_text(ts: Column, fmt: str = "%Y-%m-%d %H:%M:%S", missing: str = NO_TIME) -> Column:
    """A UTC instant as text in the local zone; a missing one as ``missing``."""
    local = F.from_utc_timestamp(ts.cast("timestamp"), LOCAL_ZONE)
    return F.coalesce(F.date_format(local, spark_pattern(fmt)), F.lit(missing))


def run_id(ts: Column) -> Column:
    """Run id: whole milliseconds since the epoch, as text."""
    return F.unix_millis(ts.cast("timestamp")).cast("string")


def watermark_text(ts: Column, start: Column | None = None) -> Column:
    """ISO text with microseconds and ``Z``; a missing watermark falls back to ``start``, else fails."""
    iso = F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fallback = F.raise_error(F.lit("no watermark and no start given")).cast("string")
    return F.coalesce(iso, fallback) if start is None else F.coalesce(iso, start, fallback)


def file_time(text: Column) -> Column:
    """A file time written as 14 digits, such as 20240131235959."""
    return F.to_timestamp(text.cast("string"), "yyyyMMddHHmmss")


def is_month_end(day: Column) -> Column:
    return F.last_day(day) == day


def day_gap(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``; 0 where either is missing."""
    return F.coalesce(F.datediff(end, start), F.lit(0))


def step_date(day: Column, step: str | Column, month_end: bool = False) -> Column:
    """Move a date by a step such as ``1_day`` or ``3_month``; any other text leaves it alone.

    A month step clamps to the length of the target month. With ``month_end`` a month
    step needs a month end to start from (else the job fails) and gives a month end.
    """
    step = F.lit(step) if isinstance(step, str) else step
    shape = r"^([0-9]+)_(day|month)$"
    count = F.nullif(F.regexp_extract(step, shape, 1), F.lit("")).cast("int")
    unit = F.regexp_extract(step, shape, 2)
    by_month = F.add_months(day, count)
    if month_end:
        wrong = F.raise_error(F.concat(day.cast("string"), F.lit(" is not the last day of its month"))).cast("date")
        by_month = F.when(is_month_end(day), F.last_day(by_month)).when(day.isNull(), F.lit(None)).otherwise(wrong)
    return F.when(unit == "day", F.date_add(day, count)).when(unit == "month", by_month).otherwise(day)


def day_30_branch(day: Column, run: str, skip: str, invalid: str | None = None) -> Column:
    """Branch of a load scheduled for day 30 of each month, and 1 March in place of February's.

    Day 30 runs; so does 1 March; the first of any other month skips. Other days are
    not valid: they give ``invalid``, or fail the job if none is named.
    """
    dom, month = F.dayofmonth(day), F.month(day)
    if invalid is None:
        other = F.raise_error(F.concat(F.lit("not a scheduled day: "), day.cast("string"))).cast("string")
    else:
        other = F.lit(invalid)
    return (
        F.when((dom == 30) & (month != 2), F.lit(run))
        .when((dom == 1) & (month == 3), F.lit(run))
        .when(dom == 1, F.lit(skip))
        .otherwise(other)
    )
