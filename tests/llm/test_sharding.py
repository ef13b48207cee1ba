"""The uniform shuffle into shards: exact sizes, whole rows, and the distribution of what is drawn."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest

from feedloom.llm import sharding
from feedloom.llm.queries import QUERIES
from feedloom.llm.sharding import hypergeometric, matrix, shard_sizes, shuffle_into_shards, write_shards
from tests.llm.helpers import SF, documents, duck, empty, odd_documents


@pytest.mark.parametrize("good, bad, draws", [(5, 7, 6), (1, 9, 3), (30, 3, 20), (4, 4, 8), (0, 5, 2)])
def test_draws_have_the_distribution(good, bad, draws):
    rng, n = np.random.default_rng(1), 20_000
    seen = Counter(hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(max(0, draws - bad), min(good, draws) + 1):
        p = comb(good, k) * comb(bad, draws - k) / comb(good + bad, draws)
        assert abs(seen[k] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-9
    assert sum(seen.values()) == n and all(max(0, draws - bad) <= k <= min(good, draws) for k in seen)


def test_draws_of_large_numbers_have_mean_and_spread():
    rng, good, bad, draws = np.random.default_rng(2), 10**12, 7 * 10**12, 4 * 10**12
    values = np.array([hypergeometric(rng, good, bad, draws) for _ in range(60)], float)
    deviation = (draws * (1 / 8) * (7 / 8) * 0.5) ** 0.5
    assert abs(values.mean() - draws / 8) < 5 * deviation / 60**0.5
    assert 0.6 < values.std() / deviation < 1.5


def test_matrix_has_both_sums_and_joint_distribution():
    parts = [(0, 3), (4, 1), (9, 2)]
    seen = Counter()
    for seed in range(4000):
        drawn = matrix(seed, parts, [2, 3, 1])
        assert [sum(r) for r in drawn] == [3, 1, 2]
        assert [sum(c) for c in zip(*drawn, strict=True)] == [2, 3, 1]
        seen[tuple(map(tuple, drawn))] += 1
    # Against all orders of six rows over six places.
    rng, orders = random.Random(3), Counter()
    owner, shard = [0, 0, 0, 1, 2, 2], [0, 0, 1, 1, 1, 2]
    for _ in range(40_000):
        rng.shuffle(owner)
        orders[tuple(tuple(sum(o == i and s == j for o, s in zip(owner, shard, strict=True)) for j in range(3)) for i in range(3))] += 1
    for key in seen | orders:
        assert abs(seen[key] / 4000 - orders[key] / 40_000) < 0.03


def check(placed, rows, shards):
    got = placed.select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    body = [(r[0], (r[1] or "").encode()) for r in rows]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len(b) + 1, zlib.crc32(b)) for d, b in body)
    counts = Counter(r.shard for r in got)
    assert sorted((counts[j] for j in range(shards)), reverse=True) == shard_sizes(len(rows), shards)
    for j in range(shards):
        assert sorted(r.slot for r in got if r.shard == j) == list(range(counts[j]))
    return Counter(tuple(r) for r in got)


@pytest.mark.parametrize("cell_rows, shards", [(8192, 8), (2, 8), (3, 5), (1, 100)])
def test_exact_sizes_whatever_the_cells(spark, monkeypatch, cell_rows, shards):
    rows = odd_documents(random.Random(12))
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(sharding, "GROUP_BITS", 2)
    once = check(shuffle_into_shards(documents(spark, rows), shards), rows, shards)
    again = check(shuffle_into_shards(documents(spark, rows[::-1]).repartition(7), shards), rows, shards)
    assert once == again


def test_hot_group_of_equal_rows_is_spread(spark):
    rows = [(5, "same", "en", "s", 4)] * 3000 + [(i, f"t{i}", "en", "s", 4) for i in range(3000)]
    placed = shuffle_into_shards(documents(spark, rows), 8)
    check(placed, rows, 8)
    hot = [r["count"] for r in placed.where("doc_id = 5 and size = 5").groupBy("shard").count().collect()]
    assert len(hot) == 8 and all(375 - 100 < n < 375 + 100 for n in hot)


def test_nothing_and_kept_columns_and_files(spark, tmp_path):
    assert shuffle_into_shards(empty(spark)).count() == 0
    rows = odd_documents(random.Random(4))
    placed = shuffle_into_shards(documents(spark, rows), 4, keep=["text", "source"])
    assert placed.columns == ["doc_id", "size", "text_crc32", "text", "source", "shard", "slot"]
    write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r[0], r[1]) for r in back.select("doc_id", "text").collect()) == Counter((r[0], r[1]) for r in rows)


def test_query(spark):
    rows = duck("select doc_id, text from documents").to_pylist()
    out = QUERIES["op12_sharding"](spark, SF)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]
    check(out, [(r["doc_id"], r["text"]) for r in rows], 8)
