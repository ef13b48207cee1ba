"""Runs a query and its SQL side by side and compares rows without regard to order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def sql_session(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(arrow_type) -> str:
    name = str(arrow_type)
    return {"large_string": "string"}.get(name, name.split("[")[0] if name.startswith("timestamp") else name)


def bag(table) -> tuple[list[tuple[str, str]], Counter]:
    cols = sorted(table.column_names)
    kinds = [(c, _kind(table.schema.field(c).type)) for c in cols]
    rows = zip(*[table.column(c).to_pylist() for c in cols], strict=True) if cols else []
    return kinds, Counter(tuple(_plain(v) for v in row) for row in rows)


def compare(spark_df, con, sql: str):
    return bag(spark_df.toArrow()), bag(con.sql(sql).to_arrow_table())
