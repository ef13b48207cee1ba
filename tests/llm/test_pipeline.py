"""The pipeline's stages on planted cases, and what they hand on."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm.queries import table
from tests.llm.helpers import SF, documents, odd_documents

SIX = [name for name, _ in corpus_pipeline.STAGES]


def planted(spark):
    """Clean documents of the sample with copies, near-copies, repeats, benchmark items and texts without letters added."""
    rng = random.Random(1)
    clean = [tuple(r) for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()]
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    words = [w for r in clean for w in (r[1] or "").split()]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = make(300), make(60)
    near = base.split()
    near[150] = "changed"
    rows = [(10_000, base), (10_001, base), (10_002, " ".join(near)), (10_010, f"{make(80)} {passage} {make(80)}"), (10_011, f"{make(90)} {passage} {make(90)}")]
    rows += [(10_020, f"{make(40)} {items[0]} {make(40)}"), (10_030, "1234 5678 !!"), (10_031, None), (10_032, "")]
    return [*clean, *((i, t, "en", "src1", len(t or "")) for i, t in rows)], passage


def test_stages_in_order():
    assert SIX == ["language", "near_duplicates", "repeats", "benchmarks", "mixing"]


def test_planted_cases(spark):
    rows, passage = planted(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus_pipeline.COLUMNS
        held = docs.collect()
        seen.append({r.doc_id: r for r in held})
        docs = spark.createDataFrame(held, docs.schema)
    language, near, repeats, benchmarks = seen
    assert {10_030, 10_031, 10_032}.isdisjoint(language) and len(language) == len(rows) - 3
    assert 10_000 in near and 10_001 not in near and 10_002 not in near
    assert passage in repeats[10_010].text and passage not in repeats[10_011].text
    assert 10_011 in benchmarks and 10_020 not in benchmarks
    mixed = {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert mixed == set(benchmarks)


def test_odd_rows(spark):
    rows = odd_documents(random.Random(2))
    docs = documents(spark, rows)
    model_rows = table(spark, SF, "documents").withColumn("doc_id", F.col("doc_id") + 5000)
    docs = docs.select(*corpus_pipeline.COLUMNS).union(model_rows.select(*corpus_pipeline.COLUMNS))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        held = docs.collect()
        docs = spark.createDataFrame(held, docs.schema)
    assert len(held) > 50
    for _, stage in corpus_pipeline.STAGES:
        nothing = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
        assert stage(spark, nothing, SF).collect() == []


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "taken"} <= set(out.columns)
    assert out.count() > 100
