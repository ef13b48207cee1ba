"""Descriptors, ids and message texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def descriptor_parts(descriptor: Column) -> tuple[Column, Column]:
    """Domain and project of a ``portfolio|domain|load|project`` descriptor.

    A project needs four parts, a domain three; what is missing is ``NA``.
    """
    parts = F.split(F.coalesce(descriptor, F.lit("")), r"\|")
    count = F.size(parts)
    domain = F.when(count > 2, F.get(parts, 1)).otherwise(F.lit("NA"))
    project = F.when(count > 3, F.get(parts, 3)).otherwise(F.lit("NA"))
    return domain, project


def correlation_id(*parts: Column) -> Column:
    """Parts joined by ``~``; the first defaults to 0, the others to nothing."""
    first, *rest = parts
    filled = [F.coalesce(first.cast("string"), F.lit("0"))] + [F.coalesce(p.cast("string"), F.lit("")) for p in rest]
    return F.concat_ws("~", *filled)


def lineage_id(correlation: Column) -> Column:
    """A correlation id without its first part, joined by ``_``."""
    parts = F.split(correlation, "~")
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "_")


def subject(*parts: Column, width: int = 100) -> Column:
    """Message subject: upper-cased parts joined by `` | ``, cut to a width."""
    return F.left(F.upper(F.concat_ws(" | ", *[p.cast("string") for p in parts])), F.lit(width))


def with_environment(text: Column, environment: str) -> Column:
    """A subject marked with its environment, unless that is production."""
    name = environment.upper()
    return text if name in ("PRD", "PROD") else F.concat(text, F.lit(f" ({name})"))


def zero_padded(text: Column, width: int) -> Column:
    """Zeros on the left up to a width; longer text is never cut."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def last_part(text: Column, separator: str) -> Column:
    """All after the last separator; the whole text if there is none."""
    return F.substring_index(text, separator, -1)


def suppressed_alert(dag: Column, task: Column, operator: Column, error: Column, domain: str) -> Column:
    """Whether a failure of a domain's job raises no alert.

    That is so for a readiness check, and for a sensor that ran into its time limit.
    """
    low = F.lower
    # The task, operator and error texts that mark such failures.
    sensor = F.contains(low(task), F.lit("esftp_to_s3")) | F.contains(low(operator), F.lit("s3keysensor"))
    timeout = F.contains(error, F.lit("AirflowSensorTimeout"))
    ready_check = F.contains(low(task), F.lit("check_load_ready_to_start"))
    return F.coalesce(F.contains(low(dag), F.lit(domain)) & ((sensor & timeout) | ready_check), F.lit(False))
