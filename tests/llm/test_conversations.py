"""Operators on conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from feedloom.llm import prefix_trie, repair
from feedloom.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import SF, duck
from tests.oracle import bag

ROWS = "conv_id long, turn long, role string, text string"
CLASH = ["conv", "depth", "id", "n", "len", "block", "level", "t1", "k1", "n1", "chunk", "total", "code", "first", "parent", "row"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, ROWS).repartition(3).selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASH))


def odd_conversations(rng: random.Random, n: int = 24) -> list[tuple]:
    """Shared starts, copies, long ones, nulls in any column, empty texts, ties and repeated rows."""
    starts = [[("system" if i == 0 else ("user", "assistant")[i % 2], f"s{k} {'é' * i}.") for i in range(9)] for k in range(3)]
    rows = []
    for c in rng.sample(range(60), n):
        turns = list(rng.choice(starts))[: rng.randrange(10)] + [(rng.choice(["user", "assistant", "system", None]), rng.choice(["", "a b.", None, "c", "d!"])) for _ in range(rng.randrange(4))]
        rows += [(c, t if t % 7 else rng.choice([t, None]), r, x) for t, (r, x) in enumerate(turns)]
    rows += [(7, i, ("user", "assistant")[i % 2], f"long {i // 3}." + "x" * (20_000 if i == 5 else 0)) for i in range(60)]
    rows += [(107, i, ("user", "assistant")[i % 2], f"long {i // 3}." + "x" * (20_000 if i == 5 else 0)) for i in range(60)]
    rows += [(-3, 0, "user", "below zero"), (-5, 0, "user", "below zero"), (None, 1, "user", "nobody"), (None, None, None, None)]
    return rows + [rows[3], rows[3], rows[10]]


def turn_order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
    return turn is not None, turn or 0, digest


def brute_trie(rows) -> list[tuple]:
    own = defaultdict(list)
    for row in sorted(rows, key=turn_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt, nodes = {}, defaultdict(list)
    for c, turns in own.items():
        shared = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        base = [] if c is None else own.get(c - (abs(c) % 5 if c > 0 else -(abs(c) % 5)), [])
        rebuilt[c] = tuple(base[:shared] + turns[shared:])
        for d in range(len(rebuilt[c]) + 1):
            nodes[rebuilt[c][:d]].append(c)
    small = lambda c: -(1 << 63) if c is None else c
    rep = {p: min(m, key=small) for p, m in nodes.items()}
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    below, out = {}, []
    for p in sorted(nodes, key=len, reverse=True):
        weight = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below[p] = (sum(below[k][0] for k in children[p]) or 1, weight + sum(below[k][1] for k in children[p]))
        ends = sorted((c for c in nodes[p] if len(rebuilt[c]) == len(p)), key=small)
        listed = ",".join("" if c is None else str(c) for c in ends)
        out.append((rep[p], len(p), rep[p[:-1]] if p else None, len(nodes[p]), len(children[p]), *below[p], hashlib.sha256(listed.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk, piece", [(1024, 1 << 15), (2, 3)])
def test_trie_against_brute_force(spark, monkeypatch, chunk, piece):
    rows = odd_conversations(random.Random(chunk))
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    got = [tuple(r) for r in prefix_trie.prefix_trie(conversations(spark, rows)).collect()]
    assert Counter(got) == Counter(brute_trie(rows))


def test_trie_of_one_hot_start_and_of_copies(spark):
    turns = [("user", "the same."), ("assistant", "answer.")]
    rows = [(c, t, r, x if t == 0 or c % 3 else f"{x} {c}") for c in range(400) for t, (r, x) in enumerate(turns)]
    got = [tuple(r) for r in prefix_trie.prefix_trie(conversations(spark, rows)).collect()]
    assert Counter(got) == Counter(brute_trie(rows))


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(conversations(spark, [(1, 0, "user", "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_prefix_trie"])
def test_query_against_sql(spark, name):
    (kinds, rows), (sql_kinds, sql_rows) = bag(QUERIES[name](spark, SF).toArrow()), bag(duck(ORACLES[name]))
    assert kinds == sql_kinds
    assert rows == sql_rows


# Repair

NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}


def edits_of(i, state, rows, limit):
    """Every way to edit rows from the i-th on, as (cost, audit, lines), with no more rows put in than the limit."""
    if i == len(rows) and state in (0, 3):
        yield 0, "", []
    if limit:
        role = NEXT[state]
        for cost, audit, lines in edits_of(i, STATE[role], rows, limit - 1):
            yield cost + 5, "I" + audit, [("user" if role == "u" else "assistant") + ":", *lines]
    if i < len(rows):
        role, text, fault = rows[i]
        for cost, audit, lines in edits_of(i + 1, state, rows, limit):
            yield cost + 2, "D" + audit, lines
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            if role[:1] == NEXT[state] or (role[:1] == "s" and state == 0):
                for cost, audit, lines in edits_of(i + 1, STATE[role[0]], rows, limit):
                    yield cost + extra, "K" + audit, [f"{role}:{text}", *lines]
            new = "user" if NEXT[state] == "u" else "assistant"
            for cost, audit, lines in edits_of(i + 1, STATE[NEXT[state]], rows, limit):
                yield cost + extra + 1, "R" + audit, [f"{new}:{text}", *lines]


def stepwise(rows):
    """The same by best prefixes, for rows too many to try every way."""
    best = {0: (0, "", [])}
    for k in range(len(rows) + 1):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                role = NEXT[state]
                offer = (cost + 5, audit + "I", [*lines, ("user" if role == "u" else "assistant") + ":"])
                if STATE[role] not in best or offer[:2] < best[STATE[role]][:2]:
                    best[STATE[role]] = offer
        if k == len(rows):
            return min((best[s] for s in (0, 3) if s in best), key=lambda b: b[:2])
        (role, text, fault), after = rows[k], {}
        for state, (cost, audit, lines) in best.items():
            offers = [(state, cost + 2, "D", [])]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role[:1] == NEXT[state] or (role[:1] == "s" and state == 0):
                    offers.append((STATE[role[0]], cost + extra, "K", [f"{role}:{text}"]))
                new = "user" if NEXT[state] == "u" else "assistant"
                offers.append((STATE[NEXT[state]], cost + extra + 1, "R", [f"{new}:{text}"]))
            for to, c, letter, line in offers:
                offer = (c, audit + letter, [*lines, *line])
                if to not in after or offer[:2] < after[to][:2]:
                    after[to] = offer
        best = after


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        place = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(place.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_repair(rows, names, best_of):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append((row[1], " " if row[2] is None else row[2], " " if row[3] is None else row[3]))
    out = []
    for conv in {*names, *groups}:
        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, text in own:
            solid = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = best_of([(r, x, f) for (_, r, x), f in zip(own, faults, strict=True)])
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def plain(codes):
    """Rows with these codes, for the brute-force searches."""
    return [(("system", "user", "assistant", "tool")[c % 4], f"{k}", ("", "blank", "duplicate", "truncated")[c // 4]) for k, c in enumerate(codes)]


def test_search_against_every_way():
    rng = random.Random(13)
    for n in [0, 1, 1, 2, 2, 3, 3, 4, 4, 5] * 12:
        codes = [rng.choice([0, 1, 1, 2, 2, 3, 4, 9, 12, 13, 14]) for _ in range(n)]
        expected = min((w[:2] for w in edits_of(0, 0, plain(codes), 3)))
        assert repair.search(codes, 0, frozenset({0, 3}), True) == expected
        assert stepwise(plain(codes))[:2] == expected


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_chunks_give_what_the_whole_gives(size):
    rng = random.Random(size)
    for n in [0, 1, 3, 7, 20, 60, 150]:
        codes = [rng.choice([0, 1, 1, 2, 2, 3, 4, 9, 12, 13, 14]) for _ in range(n)]
        parts = [codes[k : k + size] for k in range(0, n, size)] or [[]]
        tables = [repair.ways("".join(f"{c:x}" for c in p), k == 0, k == len(parts) - 1) for k, p in enumerate(parts)]
        path = repair.fold([[w[:4] for w in t] for t in tables])
        taken = [next(w for w in t if w[:2] == step) for t, step in zip(tables, path, strict=True)]
        expected = stepwise(plain(codes))[:2] if n else (0, "")
        assert (sum(w[2] for w in taken), "".join(w[4] for w in taken)) == expected


@pytest.mark.parametrize("pattern", ["1", "2", "0", "3", "d", "12", "1122", "0123", "9dce", "1dd2", "21"])
def test_search_of_many_rows_is_quick(pattern):
    codes = [int(c, 16) for c in pattern * (1024 // len(pattern))]
    for entry in range(4):
        for goals in ({0}, {1}, {2}, {3}, {0, 3}):
            repair.search(codes, entry, frozenset(goals), False)
    assert repair.search(codes, 0, frozenset({0, 3}), True) == stepwise(plain(codes))[:2]


@pytest.mark.parametrize("chunk", [1024, 4])
def test_repair_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "_PIECE", 64)
    rows = odd_conversations(random.Random(31))
    df = conversations(spark, rows)
    got = [tuple(r) for r in repair.repair(repair.damaged(df), df).collect()]
    assert Counter(got) == Counter(brute_repair(brute_damage(rows), {r[0] for r in rows}, stepwise))


def test_repair_of_all_dropped_and_of_nothing(spark):
    # CRC-32 of these places is 0 modulo 20.
    dropped = [(c, t, "user", "x.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    df = conversations(spark, dropped)
    got = {tuple(r) for r in repair.repair(repair.damaged(df), df).collect()}
    assert got == {(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in dropped}
    assert repair.repair(df.limit(0)).count() == 0


def test_repair_query(spark):
    rows = [tuple(r.values()) for r in duck("select conv_id, turn, role, text from conversations").to_pylist()]
    got = QUERIES["op13_conversation_repair"](spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert Counter(map(tuple, got.collect())) == Counter(brute_repair(brute_damage(rows), {r[0] for r in rows}, stepwise))
