"""Repeated strings, word windows, fingerprints and near-copies against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

from feedloom.llm import blocks, near_copies, simhash, suffix_dedup
from feedloom.llm.components import components
from feedloom.llm.queries import ORACLES, QUERIES
from feedloom.llm.rolling import Rolling, leftmost_minima, mixed
from feedloom.llm.substring_dedup import remove_repeated_windows
from feedloom.llm.suffix_dedup import remove_repeats
from tests.llm.helpers import LOWER, SF, WORD, documents, duck, empty, odd_documents, order


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def cut_strings(rows, width):
    """Kept bytes, removed bytes and runs of each distinct document; copies of a row are that row."""
    seen, out = set(), {}
    for row in sorted(set(r[:2] for r in rows), key=order):
        text = (row[1] or "").encode()
        gone, new = np.zeros(len(text), bool), []
        for p in range(len(text) - width + 1):
            window = text[p : p + width]
            if window in seen:
                gone[p : p + width] = True
            else:
                seen.add(window)
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(text) else 0
        out[row] = (len(text), int(gone.sum()), runs, sha(bytes(np.frombuffer(text, np.uint8)[~gone])))
    return out


def cut_windows(rows, size):
    seen, out = set(), {}
    for row in sorted(set(r[:2] for r in rows), key=order):
        words = WORD.findall(row[1] or "")
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            window = tuple(words[p : p + size])
            if window in seen:
                gone[p : p + size] = [True] * size
            else:
                seen.add(window)
        out[row] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def answers(rows, expected):
    return collections.Counter((r[0], *expected[r[:2]]) for r in rows)


@pytest.mark.parametrize(("seed", "width"), [(1, 100), (2, 100), (3, 61), (4, 40)])
def test_remove_repeats(spark, seed, width):
    rows = odd_documents(random.Random(seed))
    out = remove_repeats(documents(spark, rows), width).collect()
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), sha(bytes(r.kept))) for r in out)
    assert got == answers(rows, cut_strings(rows, width))


def test_hot_grams_are_cut_alike(spark, monkeypatch):
    """Many surroundings of one passage, with any number of them hot."""
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    pieces = ["".join(rng.choice("xyzuvw ") for _ in range(n)) for n in (3, 5, 40, 120)]
    texts = [rng.choice(pieces) + rng.choice(pieces) + passage[rng.choice([0, 0, 2, 9]) :] + rng.choice(pieces) + "".join(rng.choice("mnop") for _ in range(30)) for _ in range(120)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    expected = answers(rows, cut_strings(rows, 100))
    for hot in (1, 2, 5, 16, 1000):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        out = remove_repeats(documents(spark, rows), 100).collect()
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), sha(bytes(r.kept))) for r in out) == expected


def test_remove_repeats_whole_characters(spark):
    rng = random.Random(9)
    passage, other = ("".join(rng.choice("éèêëàâäôöûüçñ") for _ in range(n)) for n in (80, 60))
    # The first byte of all these letters is the same, so the strings that repeat end in the middle of a letter.
    rows = [(1, passage + "é", "fr", "a", 1), (2, "x" + passage + "ñ" + other, "fr", None, 2)]
    out = remove_repeats(documents(spark, rows), 100, whole_characters=True, keep=["lang", "source"]).orderBy("doc_id").collect()
    assert [bytes(r.kept).decode() for r in out] == [passage + "é", "x" + other]
    assert [(r.lang, r.source) for r in out] == [("fr", "a"), ("fr", None)]


@pytest.mark.parametrize(("seed", "words", "shortest"), [(1, 20, None), (2, 20, 5), (3, 12, 3), (4, 7, 7)])
def test_remove_repeated_windows(spark, seed, words, shortest):
    rows = odd_documents(random.Random(seed))
    out = remove_repeated_windows(documents(spark, rows), words, shortest).collect()
    got = collections.Counter((r.doc_id, r.n_words, sum(s["end"] - s["start"] for s in r.removed), r.kept) for r in out)
    assert got == answers(rows, cut_windows(rows, words))


def test_levels_must_double(spark):
    with pytest.raises(ValueError):
        remove_repeated_windows(empty(spark), 20, 6)


def test_empty_tables(spark):
    for run in (remove_repeats, remove_repeated_windows, simhash.near_duplicates, near_copies.one_of_each):
        assert run(empty(spark)).collect() == []


def test_queries_on_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    assert got == {(r[0], *v) for r, v in cut_strings(rows, 100).items()}
    got = {tuple(r) for r in QUERIES["op6_substring_dedup"](spark, SF).collect()}
    assert got == {(r[0], n, k, sha(text.encode())) for r, (n, k, text) in cut_windows(rows, 20).items()}


def plain_print(text, size):
    words = [w.encode() for w in WORD.findall((text or "").translate(LOWER))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Smallest node reachable, by union-find."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(spark):
    rng = random.Random(5)
    rows = [r for r in odd_documents(rng) if r[0] is not None]
    base = "the quick brown fox jumps over the lazy dog again and again until the very end of this long line".split()
    for i in range(40):
        words = base * 6
        words[rng.randrange(len(words))] = f"other{i % 9}"
        rows.append((200 + i, " ".join(words), None, None, None))
    got = {(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    prints = {r[0]: plain_print(r[1], 3) for r in rows}
    ids = sorted(prints)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 2]
    component = groups(ids, near)
    assert len(set(component.values())) < len(set(prints.values()))  # some links are no copies
    assert got == {(i, prints[i], component[i]) for i in ids}


def near_prints(rng, families=30, members=12, moved=5):
    """Fingerprints in families around a few values, many with equal halves, and loose ones."""
    out = {rng.getrandbits(64) for _ in range(200)}
    half = rng.getrandbits(32)
    for i in range(families):
        core = rng.getrandbits(64) if i % 3 else rng.getrandbits(32) << 32 | half
        for _ in range(members):
            value = core
            for _ in range(rng.randrange(moved)):
                value ^= 1 << rng.randrange(64)
            out.add(value)
    return sorted(out | {0, 1, (1 << 64) - 1})


@pytest.mark.parametrize(("bits", "hot"), [(0, 4096), (1, 4096), (2, 4096), (2, 2), (3, 4096), (4, 3), (6, 4096), (6, 5)])
def test_links_within_any_number_of_bits(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "_PAIRS", 64)
    prints = near_prints(random.Random(bits * 7 + hot))
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").repartition(3)
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.near_links(nodes, bits).collect()]
    near = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits]
    assert bool(near) == (bits > 0)
    assert groups(prints, found) == groups(prints, near)
    assert len(found) == len(set(found)) and all(a != b for a, b in found)


def test_runs_cover_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "_PAIRS", 5)
    for count in ([], [1], [12], [3, 1, 9, 5, 5, 1], [5, 5], [1] * 11):
        seen = []
        for first, last, skip, stop in simhash._runs(np.array(count, np.int64)):
            for i in range(first, last):
                seen += [(i, k) for k in range(skip if i == first else 0, stop if i == last - 1 else count[i])]
        assert seen == [(i, k) for i, n in enumerate(count) for k in range(n)]


def test_bits_out_of_range(spark):
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,)], "fp long"), 32)


def thue_morse(n):
    """Two different strings whose polynomials modulo a power of two agree for any odd base."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("length", [64, 128, 1024, 4096])
def test_long_words_keep_their_own_names(spark, length):
    one, two = thue_morse(length)
    tail = " ".join(f"w{i}" for i in range(25))
    rows = [(1, f"{one} {tail}", None, None, None), (2, f"{two} q {tail}", None, None, None), (3, f"{two} {tail}", None, None, None)]
    out = {r.doc_id: (r.n_words, r.kept) for r in remove_repeated_windows(documents(spark, rows)).collect()}
    expected = cut_windows(rows, 20)
    assert out == {r[0]: (expected[r[:2]][0], expected[r[:2]][2]) for r in rows}


def test_near_duplicates_null_ids(spark):
    rows = [(None, "a b c d", None, None, None), (7, "a b c d", None, None, None), (None, "quite another text", None, None, None)]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    loose = [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    linked = chain + star + loose + chain[:3] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*linked, (None, 3)], "a long, b long")).collect()}
    nodes = {n for a, b in linked if a != b for n in (a, b)}
    assert got == groups(nodes, [(a, b) for a, b in linked if a != b])


@pytest.mark.parametrize("hot", [2, 16])
def test_one_of_each(spark, monkeypatch, hot):
    monkeypatch.setattr(near_copies, "HOT", hot)
    rng = random.Random(8)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([None, "", " ", "a b", "A  b", "a c"])]
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 400]))]
        for k in range(rng.randrange(1, 6)):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append((1000 - 10 * i - k, " ".join(copy), None, None, None))
    rows += [rows[7], (None, "w1 w2 w3", None, None, None), (1000, "the same id but another text altogether", None, None, None)]
    out = near_copies.one_of_each(documents(spark, rows))
    assert out.columns == documents(spark, []).columns
    keys = sorted(set(r[:2] for r in rows), key=lambda r: (order(r), r[1] or ""))
    sets = []
    for _, text in keys:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    near = [(i, j) for i in range(len(keys)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    stay = {keys[i] for i, g in groups(range(len(keys)), near).items() if i == g}
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == stay


def survivors(rows):
    """Rows with the smallest id of their group, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    near = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    return {rows[i][0] for i, g in groups(range(len(rows)), near).items() if i == g}


def variants(rng, base, n, edits):
    """Texts that differ from ``base`` in some words, each in others."""
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), edits):
            words[at] = f"x{rng.randrange(10**9)}"
        yield " ".join(words)


@pytest.mark.parametrize("seed, rounds", [(1, near_copies.ROUNDS), (2, (1, 3, None))])
def test_one_of_each_of_a_large_family(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = list(enumerate(variants(rng, base, 400, 3)))
    expected = survivors(rows)
    assert 1 < len(expected) < 350
    out = near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in out.collect()} == expected


def test_one_of_each_does_not_depend_on_slices(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "HOT", 2)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(150)]
    texts = [t for _ in range(60) for t in variants(rng, passage + [f"w{rng.randrange(10**6)}" for _ in range(36)], 4, 2)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    expected = survivors(sorted(rows))
    assert 1 < len(expected) < 240
    for parts in (1, 7):
        out = near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
        assert {r.doc_id for r in out.collect()} == expected


def test_rolling_names():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3, 400).astype(np.uint64)
    names = Rolling(mixed(values)).windows(5)
    windows = [tuple(values[i : i + 5].tolist()) for i in range(396)]
    assert len(set(names.tolist())) == len(set(windows))
    assert all((names[i] == names[j]) == (windows[i] == windows[j]) for i in range(100) for j in range(100))
    least = leftmost_minima(mixed(values), 7)
    plain = [i + int(np.argmin(mixed(values)[i : i + 7] >> np.uint64(31))) for i in range(394)]
    assert least.tolist() == plain


@pytest.mark.parametrize("name", ["op1_warc_zip", "op2_suffix_dedup", "op3_mixing", "op6_substring_dedup"])
def test_queries_equal_sql(spark, name):
    table = duck(ORACLES[name])
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(table.column_names)
    expected = collections.Counter(zip(*(table.column(c).to_pylist() for c in df.columns), strict=True))
    assert collections.Counter(map(tuple, df.collect())) == expected


def test_batches_are_bounded_unless_set(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        blocks.bounded_batches(spark.range(1))
        assert spark.conf.get(key) == str(blocks.BATCH_BYTES)
        spark.conf.set(key, "1m")
        blocks.bounded_batches(spark.range(1))
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_pairs_tried_before_or_of_other_sizes_need_no_texts(spark):
    texts = {n: " ".join(f"w{i}" for i in range(m)) for n, m in ((1, 24), (2, 25), (3, 60))}
    nodes = spark.createDataFrame([(n, 0, n, len(t.split()) - 4) for n, t in texts.items()], "id long, tag int, node long, shingles int")
    held = spark.createDataFrame([(n, 0, t.encode()) for n, t in texts.items()], "id long, tag int, text binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 2)], "a long, b long")
    tried = []
    linked = near_copies._linked(pairs, tried, nodes, held, 5, 0.8)
    assert [tuple(r) for r in linked.collect()] == [(1, 2)]
    assert [tuple(r) for r in tried[0].collect()] == [(1, 2)]
    assert near_copies._linked(pairs, tried, nodes, held, 5, 0.8).collect() == []
    assert tried[1].collect() == []


def test_candidate_texts_are_sifted_and_not_written(spark, monkeypatch):
    """Of many texts only the candidates' are shuffled, rows that come twice count once, and no text goes to the scratch folder."""
    kept, real = [], near_copies._kept
    monkeypatch.setattr(near_copies, "_kept", lambda df, name: kept.append((name, df.columns)) or real(df, name))
    texts = {n: " ".join(f"w{n // 2}_{i}" for i in range(24 + n % 2)) for n in range(400)}
    nodes = spark.createDataFrame([(n, 0, n, len(t.split()) - 4) for n, t in texts.items()], "id long, tag int, node long, shingles int")
    held = spark.createDataFrame([(n, 0, t.encode()) for n, t in texts.items() for _ in range(1 + 2 * (n % 4 == 0))], "id long, tag int, text binary")
    repeated = real(held.groupBy("id", "tag").count().where("count > 1").select("id", "tag"), "repeated")
    pairs = spark.createDataFrame([(0, 1), (2, 3), (4, 5), (6, 9)], "a long, b long")
    linked = near_copies._linked(pairs, [], nodes, held, 5, 0.8, repeated)
    assert sorted(tuple(r) for r in linked.collect()) == [(0, 1), (2, 3), (4, 5)]
    assert kept == [("candidates", ["a", "b", "id_a", "tag_a", "id_b", "tag_b"])]
    assert "LeftSemi" in linked._jdf.queryExecution().executedPlan().toString()
