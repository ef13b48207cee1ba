"""Deletes and upserts that write only the files of a table which hold a listed key.

All other files keep their name, their time and every byte. Files are found by one scan of the key columns, cut down by the
range of the listed keys, which Parquet's statistics answer for most files without reading them where the table is
ordered by key. Rows of the files found are changed and written next to the table; then a journal says which files come and
which go, and is carried out. A job that ends before the journal has changed nothing, and one that ends after it is
finished by :func:`recover`, which every later change does first. One job at a time may change a table.

While the journal is carried out, new files come before old ones go, so a reader in that moment can see rows twice, never too few. Where that
matters, publish whole tables as a release (:mod:`feedloom.sinks.releases`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.operators.tables import delete_by_keys, upsert
from feedloom.sinks import store

_WORK = "_rewrite-"
_JOURNAL = "journal.json"


@dataclass(frozen=True)
class Rewrite:
    """Files, relative to the table, that a change took away and that it put there."""

    removed: tuple[str, ...] = ()
    added: tuple[str, ...] = ()


def _within(table: DataFrame, listed: DataFrame, pairs: Mapping[str, str]) -> Column | None:
    """A test that all listed keys pass, of bounds that the scan can hold against each file's statistics."""
    ends = [f(k).alias(f"{n}{i}") for i, k in enumerate(pairs.values()) for n, f in (("low", F.min), ("high", F.max))]
    row = listed.agg(*ends).first()
    if row["low0"] is None:
        return None
    types = {f.name: f.dataType for f in table.schema.fields}
    tests = [F.col(k).between(*[F.lit(row[f"{n}{i}"]).cast(types[k]) for n in ("low", "high")]) for i, k in enumerate(pairs)]
    return reduce(lambda a, b: a & b, tests)


def touched_rows(spark: SparkSession, path: str, listed: DataFrame, pairs: Mapping[str, str]) -> DataFrame | None:
    """A row for each row of the table whose key is listed: the ``file`` that holds it. None if no key is listed.

    Listed keys are unique. Reads the key columns of the files whose range of keys meets that of the listed ones.
    """
    table = spark.read.parquet(path)
    within = _within(table, listed, pairs)
    if within is None:
        return None
    keys = table.where(within).select(*pairs, F.col("_metadata.file_path").alias("__file"))
    return lookup(keys, listed, pairs, "left_semi").select(F.col("__file").alias("file"))


def _touched(spark: SparkSession, path: str, listed: DataFrame, pairs: Mapping[str, str]) -> list[str]:
    """Names of the files, on the driver, as Spark's own listing of a table is."""
    rows = touched_rows(spark, path, listed, pairs)
    return [] if rows is None else sorted(store.decoded(spark, r.file) for r in rows.distinct().collect())


def _swap(spark: SparkSession, path: str, new: DataFrame, old: Sequence[str], layout: Sequence[str]) -> Rewrite:
    base = store.qualified(spark, path)
    work = f"{base}/{_WORK}{uuid.uuid4().hex}"
    new.write.partitionBy(*layout).parquet(f"{work}/rows")
    added = [f for f in store.files_below(spark, f"{work}/rows") if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
    removed = [f[len(base) + 1 :] for f in old]
    store.put_text(spark, f"{work}/{_JOURNAL}", json.dumps({"add": added, "remove": removed}))
    _carry_out(spark, base, work)
    return Rewrite(tuple(removed), tuple(added))


def _carry_out(spark: SparkSession, base: str, work: str) -> None:
    """Do what a journal says; what was done before is passed over."""
    journal = json.loads(store.text_of(spark, f"{work}/{_JOURNAL}"))
    for name in journal["add"]:
        if store.exists(spark, f"{work}/rows/{name}"):
            store.move(spark, f"{work}/rows/{name}", f"{base}/{name}")
    for name in journal["remove"]:
        store.remove(spark, f"{base}/{name}")
    store.remove(spark, work)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a change that was decided and drop what one that was not left behind."""
    base = store.qualified(spark, path)
    for name in store.children(spark, base):
        if name.startswith(_WORK):
            work = f"{base}/{name}"
            if store.exists(spark, f"{work}/{_JOURNAL}"):
                _carry_out(spark, base, work)
            else:
                store.remove(spark, work)


def _read(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    table = spark.read.parquet(path)
    if not files:
        return table.limit(0)
    return spark.read.schema(table.schema).option("basePath", store.qualified(spark, path)).parquet(*files)


def delete_from(
    spark: SparkSession, path: str, keys: DataFrame, on: Sequence[str] | Mapping[str, str], layout: Sequence[str] = ()
) -> Rewrite:
    """Delete the rows of a stored table whose key is listed. Listed keys may repeat; NULL matches nothing.

    ``layout`` names the table's partition columns. A table of which no file holds a listed key is not written at all.
    """
    recover(spark, path)
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    listed = settled(keys.select(*pairs.values()).dropna().distinct(), "listed-keys")
    files = _touched(spark, path, listed, pairs)
    if not files:
        return Rewrite()
    return _swap(spark, path, delete_by_keys(_read(spark, path, files), listed, pairs), files, layout)


def upsert_into(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    now: Column,
    order_by: str,
    layout: Sequence[str] = (),
) -> Rewrite:
    """Upsert into a stored table, as :func:`operators.tables.upsert` does it: files with a key that has rows are written anew, new keys
    come in files of their own."""
    recover(spark, path)
    rows = settled(rows, "upsert-rows")
    listed = settled(rows.select(*keys).dropna().distinct(), "listed-keys")
    files = _touched(spark, path, listed, {k: k for k in keys})
    changed = upsert(_read(spark, path, files), rows, keys, update, now, order_by)
    if not files and rows.isEmpty():
        return Rewrite()
    return _swap(spark, path, changed, files, layout)


def replace_parts(spark: SparkSession, path: str, rows: DataFrame, part: str) -> Rewrite:
    """Put new rows in the place of all rows of the parts (values of the partition column ``part``) that they are of.

    The new rows may be made of the old ones. Files of other parts are left alone. The table is made if it is not there.
    """
    recover(spark, path)
    rows = settled(rows, "part-rows")
    parts = [r[0] for r in rows.select(part).distinct().collect()]
    if not parts:
        return Rewrite()
    old = []
    if [f for f in store.children(spark, path) if not f.startswith(("_", "."))]:
        held = spark.read.parquet(path).where(F.col(part).isin(parts)).select(F.col("_metadata.file_path").alias("f"))
        old = sorted(store.decoded(spark, r.f) for r in held.distinct().collect())
    return _swap(spark, path, rows.repartition(part), old, [part])
