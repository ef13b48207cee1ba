"""Paths, file names and the dates inside them, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.dates import date_regex, spark_pattern


def folder(path: Column) -> Column:
    """A folder prefix: one leading slash off, a trailing slash on."""
    closed = F.when(F.endswith(path, F.lit("/")), path).otherwise(F.concat(path, F.lit("/")))
    return F.regexp_replace(closed, "^/", "")


def bucket(uri: Column) -> Column:
    """The authority part of ``scheme://bucket/key``."""
    return F.regexp_extract(uri, r"^[^/]*//([^/]*)", 1)


def key(uri: Column) -> Column:
    """All after the bucket of ``scheme://bucket/key``."""
    return F.regexp_extract(uri, r"^[^/]*//[^/]*/(.*)$", 1)


def base_name(path: Column) -> Column:
    """Last path part, cut at its first dot."""
    return F.split_part(F.substring_index(path, "/", -1), F.lit("."), F.lit(1))


def relocated(path: Column, source: str, target: str) -> Column:
    """The target path of a file: what follows the source base, under the target base."""
    return F.concat(F.lit(target), F.split_part(path, F.lit(source), F.lit(2)))


def after_load(path: Column, load: str, target: str) -> Column:
    """The target path of a file: what follows ``/<load>/``, under the target base."""
    return F.concat(F.lit(target), F.substring_index(path, f"/{load}/", -1))


def unpacked_folder(target: str, archive: Column, own_folder: bool) -> Column:
    """Where an archive is unpacked to: the target, or a folder there named after the archive."""
    base = folder(F.lit(target))
    return folder(F.concat(base, base_name(archive))) if own_folder else base


def cleaned(path: Column, pattern: str) -> Column:
    """A path with every match of the pattern turned into a blank."""
    return F.regexp_replace(path, pattern, " ")


def fill(template: Column, values: Mapping[str, Column | str]) -> Column:
    """Replace tokens in a template, in the order given."""
    for token, value in values.items():
        template = F.replace(template, F.lit(token), value if isinstance(value, Column) else F.lit(value))
    return template


def parse_date(text: Column, fmt: str = "%Y%m%d", strict: bool = True) -> Column:
    """Text to a date. Text that does not fit fails the job, or gives NULL if not strict."""
    convert = F.to_date if strict else F.try_to_date
    return convert(text, spark_pattern(fmt))


def date_in_name(path: Column, prefix: str, fmt: str = "%Y%m%d", strict: bool = True) -> Column:
    """The date that follows a literal prefix in a file name; NULL if the prefix is absent.

    The prefix may be given as a glob, of which the part before the first ``*`` counts.
    """
    rest = F.nullif(F.split_part(path, F.lit(prefix.split("*")[0]), F.lit(2)), F.lit(""))
    # Where the date ends is what its directives match; text they do not match is left to fail as a date.
    found = F.nullif(F.regexp_extract(rest, f"^({date_regex(fmt)})", 1), F.lit(""))
    return parse_date(F.coalesce(found, rest), fmt, strict)


def cased(text: Column, mode: str | None) -> Column:
    """Upper case for mode ``u``, lower case for any other, as it is for none."""
    if mode is None:
        return text
    return F.upper(text) if mode.lower() == "u" else F.lower(text)


def dated_name(day: Column, fmt: str, prefix: str = "", case: str | None = None) -> Column:
    """A file name from a feed date: prefix, formatted date, case."""
    return cased(F.concat(F.lit(prefix), F.date_format(day, spark_pattern(fmt))), case)


def stamp(now: Column, fmt: str, ranged: bool = False) -> Column:
    """A file stamp for the given time, or for the range from it to 36 hours later."""
    pattern = spark_pattern(fmt)
    one = F.date_format(now, pattern)
    if not ranged:
        return one
    return F.concat(one, F.lit("-"), F.date_format(now + F.expr("interval 36 hours"), pattern))
