"""Small tables with every odd case, and plain Python to hold results against."""

from __future__ import annotations

import random
import re
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sample(rng: random.Random, n: int, stems: int = 40) -> str:
    words = [f"w{rng.randrange(stems)}{'é' if rng.random() < 0.1 else ''}" for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\t "]) for w in words)


def odd_documents(rng: random.Random) -> list[tuple]:
    """Shared passages, copies, nulls in any column, empty, blank and very long texts, repeated rows and ids."""
    passage = sample(rng, 60)
    texts: list[str | None] = [None, "", " \n\t", "x", "one two", "é" * 150, "ab" * 400, passage]
    for i in range(30):
        a, b = sample(rng, rng.randrange(1, 80)), sample(rng, rng.randrange(1, 80))
        cut = rng.randrange(len(passage))
        texts += [a, a + passage + b, passage[cut:] + a, a] if i % 5 == 0 else [a + passage[:cut] + b]
    texts += [sample(rng, 4000, 3), sample(rng, 6000, 2000) + passage]
    rows = [(i * 3 % 101, t, "en" if i % 3 else None, None if i % 7 == 0 else f"s{i % 4}", None) for i, t in enumerate(texts)]
    rows = list({r[0]: r for r in rows}.values())
    return [*rows, rows[5], rows[9], (None, passage + "tail", "fr", "s1", 3), (None, passage + "tail", "fr", "s1", 3)]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A table with further columns whose names operators use inside."""
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    clash = ["id", "tag", "start", "end", "count", "bucket", "node", "key", "cell", "u", "size", "kept", "removed", "score", "fp", "s", "c", "name"]
    return df.selectExpr("*", *(f"'{c}' as `{c}`" for c in clash))


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, []).limit(0)


def order(row: tuple) -> tuple:
    """Place of a document: by id, null first."""
    return (row[0] is not None, row[0] or 0)


def duck(sql: str, sf: str = SF):
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con.sql(sql).to_arrow_table()
