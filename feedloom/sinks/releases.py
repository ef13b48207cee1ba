"""Several tables replaced in one step.

Each table is a folder of its own for every version. A release names the version of every table, in one small file that is
there as a whole or not at all. The greatest release counts: the moment its file appears, all its tables are the current ones
together, and a reader that asks for the release once reads them all of one state. Views in the catalog follow; if a job ends between two of them,
each still shows a whole version, and :meth:`Releases.follow` brings the rest into line. No table is ever absent, and versions stay until
:meth:`Releases.expire` drops them, so jobs that read an old one end in peace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from feedloom.sinks import store

_RECORDS = "_releases"


class Releases:
    """The tables below a folder. One job at a time may publish; a second one that starts from the same release fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = store.qualified(spark, root)

    def numbers(self) -> list[int]:
        """Numbers of all releases, rising."""
        return [int(n) for n in store.children(self.spark, f"{self.root}/{_RECORDS}") if n.isdigit()]

    def tables(self, number: int | None = None) -> dict[str, str]:
        """The folder of each table in a release, the current one unless a number is given; none before the first."""
        if number is None:
            number = max(self.numbers(), default=None)
        if number is None:
            return {}
        named = json.loads(store.text_of(self.spark, self._record(number)))
        return {name: f"{self.root}/{folder}" for name, folder in named.items()}

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """A table of a release."""
        found = self.tables(number)
        if name not in found:
            raise KeyError(f"no table {name} in the release")
        return self.spark.read.parquet(found[name])

    def read_all(self) -> dict[str, DataFrame]:
        """All tables of the current release, of one state."""
        return {name: self.spark.read.parquet(folder) for name, folder in self.tables().items()}

    def publish(self, tables: Mapping[str, DataFrame], layout: Mapping[str, Sequence[str]] | None = None) -> int:
        """Write new versions of these tables, which may be made of the current ones, and make them current together.

        Other tables stay as they are. ``layout`` names partition columns. Gives the release's number; if any table cannot be
        written, nothing has changed.
        """
        last = max(self.numbers(), default=0)
        version = uuid.uuid4().hex
        now = {name: folder.removeprefix(f"{self.root}/") for name, folder in self.tables().items()}
        for name, df in tables.items():
            now[name] = f"{name}/{version}"
            df.write.partitionBy(*(layout or {}).get(name, ())).parquet(f"{self.root}/{now[name]}")
        if max(self.numbers(), default=0) != last:
            raise RuntimeError("another job has published meanwhile")
        store.put_text(self.spark, self._record(last + 1), json.dumps(now))
        return last + 1

    def _record(self, number: int) -> str:
        return f"{self.root}/{_RECORDS}/{number:012d}"

    def follow(self, database: str) -> list[str]:
        """Let a view for each table in a database of the catalog show the current release; gives their names.

        Views are replaced in place, one after the other. Run it again after a failure.
        """
        done = []
        for name, folder in sorted(self.tables().items()):
            self._show(f"`{database}`.`{name}`", folder)
            done.append(f"{database}.{name}")
        return done

    def _show(self, view: str, folder: str) -> None:
        self.spark.sql(f"create or replace view {view} as select * from parquet.`{folder}`")

    def expire(self, keep: int = 2) -> list[str]:
        """Drop all releases but the last few, and the versions that none of those names."""
        if keep < 1:
            raise ValueError("the current release cannot go")
        numbers = self.numbers()
        held = {folder for n in numbers[-keep:] for folder in self.tables(n).values()}
        names = {name for n in numbers for name in self.tables(n)}
        for number in numbers[:-keep]:
            store.remove(self.spark, self._record(number))
        gone = [f"{self.root}/{n}/{v}" for n in sorted(names) for v in store.children(self.spark, f"{self.root}/{n}")]
        gone = [folder for folder in gone if folder not in held]
        for folder in gone:
            store.remove(self.spark, folder)
        return gone
