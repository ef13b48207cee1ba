"""Documents keyed for exchanges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NO_ID = -(1 << 63)
KEY = ["id", "tag"]


def keyed(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``id``, ``tag`` and ``text`` as bytes.

    A null ``doc_id`` counts as the smallest id, a null text as empty. Rows with one ``doc_id`` and different texts
    are told apart by ``tag``, 32 bits of the text's hash; rows equal in both are one document to all that follows,
    and each of them gets the same answer. Columns to ``keep`` travel with the text, in a struct whose first field is
    the text.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.shiftright(F.xxhash64("text"), 32).cast("int").alias("tag"),
        F.struct(text, *keep).alias("text") if keep else text,
    )


def doc_id() -> Column:
    """The id as it was."""
    return F.nullif("id", F.lit(_NO_ID)).alias("doc_id")


def per_document(rows: DataFrame, lists: list[str]) -> DataFrame:
    """The lists of all rows of a document, each column's joined to one, and in the same order."""
    grouped = rows.groupBy(*KEY).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in lists])
    # Few bytes per document: hashing this side spares sorting the texts it is joined to.
    return grouped.hint("shuffle_hash")
