"""Cheapest repair of the structure of conversations, by depth-first branch-and-bound.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: an optional system row, then user and assistant in turn. Rows
are kept, given another role, deleted or put in, each at a cost; the search finds the cheapest edits and of those the ones whose
initials (D, I, K, R) come first in ASCII order.

The search goes depth first with a stack of its own, trying edits in ASCII order. Each node (rows passed, state of the grammar) has a lower
bound for what is to come, from a wider grammar in which a system row need not be followed by anything; a table of the cheapest prefix
met at it, which eliminates costlier and later ones; and the incumbent, which a dive along the bounds gives first. When the stack is empty the incumbent is proved
optimal.

Conversations of any length: rows are numbered over ranges and cut into chunks. Each chunk is searched in a task of its own between all states
of the grammar; a fold over one small table per chunk then picks the states at the cuts. No edits of a chunk are the beginning of
others of the same chunk, so the first in ASCII order of the whole is made of the first of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.operators.ordering import numbered

#: Rows searched at once.
CHUNK = 1024
#: What edits cost; a truncated row that stays costs more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

_NO_ID = -(1 << 63)
_BLANK = " \t\n\x0b\x0c\r"
#: Faults and initials in codes of rows: fault * 4 + initial.
_FAULTS = ["", "blank", "duplicate", "truncated"]
_INITIALS = "sua"
# States of the grammar: nothing yet, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ACCEPT = frozenset({_START, _ASSISTANT})
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_FAR = 1 << 60


def _kept(state: int, initial: int) -> int | None:
    """The state after a row with this initial, if the grammar allows it."""
    if initial == 0 and state == _START:
        return _SYSTEM
    return _NEXT[state] if initial in (1, 2) and _NEXT[state] == initial + 1 else None


def _bounds(codes: list[int], goals: frozenset[int], close: bool) -> list[list[int]]:
    """Per rows passed and state, a lower bound of the cost of the rest.

    It is that of a wider grammar, in which a system row need not be followed by anything, unless that is where to end.
    """
    alone = _ASSISTANT if _SYSTEM not in goals else _SYSTEM
    inserts = [(_START, _USER), (alone, _USER), (_ASSISTANT, _USER), (_USER, _ASSISTANT)]

    def with_inserts(costs: list[int]) -> list[int]:
        for _ in range(2):
            for state, to in inserts:
                costs[state] = min(costs[state], INSERT + costs[to])
        costs[_SYSTEM] = costs[alone]
        return costs

    costs = [0 if s in goals else _FAR for s in range(4)]
    out = [with_inserts(costs) if close else [*costs[:1], costs[alone], *costs[2:]]]
    for code in reversed(codes):
        fault, initial = divmod(code, 4)
        after, costs = out[-1], [0] * 4
        for state in range(4):
            best = DELETE + after[state]
            if fault not in (1, 2):
                extra = TRUNCATED if fault == 3 else 0
                to = _kept(state, initial)
                if to is not None:
                    best = min(best, extra + after[to])
                best = min(best, extra + REROLE + after[_NEXT[state]])
            costs[state] = best
        out.append(with_inserts(costs))
    return out[::-1]


def search(codes: list[int], entry: int, goals: frozenset[int], close: bool) -> tuple[int, str] | None:
    """Cost and edits of the cheapest way from ``entry`` to one of ``goals`` over these rows; None if there is none.

    Rows may be put in before any row, and after the last one if ``close``.
    """
    n, bound = len(codes), _bounds(codes, goals, close)

    def moves(i: int, state: int) -> list[tuple[int, str, int, int]]:
        """Rows passed, edit, state and cost of each edit possible here, in ASCII order of edits."""
        out = []
        if i < n:
            fault, initial = divmod(codes[i], 4)
            out.append((i + 1, "D", state, DELETE))
        if i < n or close:
            out.append((i, "I", _NEXT[state], INSERT))
        if i < n and fault not in (1, 2):
            extra = TRUNCATED if fault == 3 else 0
            to = _kept(state, initial)
            if to is not None:
                out.append((i + 1, "K", to, extra))
            out.append((i + 1, "R", _NEXT[state], extra + REROLE))
        return out

    # The first incumbent: always on to where cost and bound are least. More than two rows put in at one place lead nowhere new.
    best, edits = _FAR, ""
    i, state, cost, path = 0, entry, 0, []
    while i < n or state not in goals:
        open_ = [m for m in moves(i, state) if path[-2:] != ["I", "I"] or m[1] != "I"]
        if not open_:
            break
        i, edit, state, more = min(open_, key=lambda m: (m[3] + bound[m[0]][m[2]], m[1] == "I"))
        cost += more
        path.append(edit)
    else:
        best, edits = cost, "".join(path)

    found = False  # by the search itself, which meets edits in ASCII order
    cheapest: dict[int, int] = {}
    stack = [(0, entry, 0, 0, "")]
    path = []
    while stack:
        i, state, cost, depth, edit = stack.pop()
        least = cost + bound[i][state]
        if least > best or (found and least == best):
            continue
        node = i * 4 + state
        if cost >= cheapest.get(node, _FAR):
            continue
        cheapest[node] = cost
        if depth:
            del path[depth - 1 :]
            path.append(edit)
        if i == n and state in goals:
            audit = "".join(path)
            if cost < best or (cost == best and audit < edits):
                best, edits = cost, audit
            found = True
            continue
        stack.extend((to, after, cost + more, depth + 1, letter) for to, letter, after, more in reversed(moves(i, state)))
    return None if best == _FAR else (best, edits)


def ways(codes: str, first: bool, last: bool) -> tuple[tuple[int, int, int, int, str], ...]:
    """The best edits of a chunk between all states it may be entered and left in: entry, exit, cost, rank of the edits among all, edits."""
    rows = [int(c, 16) for c in codes]
    found = []
    for entry in (_START,) if first else range(4):
        # The last chunk ends the conversation: all states it may end in are one exit.
        for goal, goals in [(_ASSISTANT, _ACCEPT)] if last else [(s, frozenset({s})) for s in range(4)]:
            way = search(rows, entry, goals, last)
            if way is not None:
                found.append((entry, goal, *way))
    rank = {e: k for k, e in enumerate(sorted({f[3] for f in found}))}
    return tuple((entry, goal, cost, rank[edits], edits) for entry, goal, cost, edits in found)


def fold(tables: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """Entry and exit of each chunk on the cheapest, then first, way over all chunks (each a list of entry, exit, cost, rank)."""
    # Per state: cost so far, and the place of the way there among all of the same chunk in ASCII order.
    here: dict[int, tuple[int, int]] = {_START: (0, 0)}
    back: list[dict[int, int]] = []
    for table in tables:
        offers: dict[int, tuple[int, int, int, int]] = {}
        for entry, goal, cost, rank in table:
            if entry in here:
                offer = (here[entry][0] + cost, here[entry][1], rank, entry)
                if goal not in offers or offer < offers[goal]:
                    offers[goal] = offer
        order = {way: k for k, way in enumerate(sorted({o[1:3] for o in offers.values()}))}
        here = {goal: (o[0], order[o[1:3]]) for goal, o in offers.items()}
        back.append({goal: o[3] for goal, o in offers.items()})
    goal = min(here, key=lambda s: here[s])
    out = []
    for entries in reversed(back):
        out.append((entries[goal], goal))
        goal = entries[goal]
    return out[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations (``conv_id``, ``turn``, ``role``, ``text``) after damage that a checksum of their place decides.

    Of CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes its ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes its role
    user. A null is one space.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = (F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20).cast("int")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__kind") == 3, 2).otherwise(1)))
    return rows.where("__kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("__copy")).drop("__copy")


def _fault(text: Column) -> Column:
    """1 blank, 3 truncated, else 0."""
    solid = F.rtrim(text, F.lit(_BLANK))
    return F.when(F.length(solid) == 0, 1).when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)


def _code(initial: Column, fault: Column) -> Column:
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.lower(F.hex(fault * 4 + place))


def _numbered_rows(rows: DataFrame) -> DataFrame:
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    mark = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    keyed = rows.select(conv, F.col("turn").cast("long").alias("turn"), role, text, F.unhex(mark).alias("mark"))
    return settled(numbered(keyed, ["conv"], ["turn", "mark"], alias="n", total="total"), "repair-rows")


def _chunks(rows: DataFrame) -> DataFrame:
    """Codes of the rows of each chunk: ``conv``, ``chunk``, ``last`` (whether it ends the conversation), ``codes``."""
    repeats = rows.groupBy("conv", "mark").agg(F.min("n").alias("seen"), F.count("*").alias("times")).where("times > 1").select("conv", "mark", "seen")
    meta = rows.select("conv", "n", "total", "mark", F.substring("role", 1, 1).alias("initial"), _fault(F.col("text")).alias("fault"))
    meta = lookup(meta, settled(repeats, "repair-repeats"), ["conv", "mark"])
    fault = F.when((F.col("fault") != 1) & (F.col("n") > F.col("seen")), 2).otherwise(F.col("fault"))
    coded = meta.select("conv", F.expr(f"(n - 1) div {CHUNK}").alias("chunk"), F.expr(f"(total - 1) div {CHUNK}").alias("end"), "n", _code(F.col("initial"), fault).alias("code"))
    listed = F.sort_array(F.collect_list(F.struct("n", "code")))
    grouped = coded.groupBy("conv", "chunk").agg(F.max("end").alias("end"), listed.alias("rows"))
    return grouped.select("conv", "chunk", F.expr("chunk = end").alias("last"), F.array_join("rows.code", "").alias("codes"))


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[str, bool, bool], tuple] = {}

    def once(codes: str, first: bool, last: bool) -> tuple:
        """Short conversations are much alike."""
        if len(codes) > 32 or len(known) > 1 << 15:
            return ways(codes, first, last)
        if (codes, first, last) not in known:
            known[codes, first, last] = ways(codes, first, last)
        return known[codes, first, last]

    for batch in batches:
        out = []
        for conv, chunk, last, codes in zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "last", "codes")], strict=True):
            legal = sum((int(a, 16) & 3, int(b, 16) & 3) in ((0, 1), (1, 2), (2, 1)) for a, b in zip(codes, codes[1:], strict=False))
            counts = [sum(int(c, 16) >> 2 == f for c in codes) for f in (1, 2, 3)]
            found = [dict(zip(("entry", "exit", "cost", "rank", "edits"), w, strict=True)) for w in once(codes, chunk == 0, last)]
            out.append((conv, chunk, last, *counts, len(codes) - 1 - legal, int(codes[0], 16) & 3, int(codes[-1], 16) & 3, found))
        yield pa.RecordBatch.from_pylist([dict(zip(_SEARCHED.names, r, strict=True)) for r in out], schema=_SEARCHED)


_WAY = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string())])
_SEARCHED = pa.schema(
    [("conv", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "head", "tail")], ("ways", pa.list_(_WAY))]
)
_SEARCHED_SQL = (
    "conv long, chunk long, last boolean, blank long, duplicate long, truncated long, illegal long, head long, tail long, "
    "ways array<struct<entry: int, exit: int, cost: long, rank: int, edits: string>>"
)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way to take through each chunk, and adjacent roles at cuts that do not fit."""
    for batch in batches:
        for row in batch.to_pylist():
            chunks = row["chunks"]
            path = fold([[(w["entry"], w["exit"], w["cost"], w["rank"]) for w in c["ways"]] for c in chunks])
            cuts = [0] + [int((a["tail"], b["head"]) not in ((0, 1), (1, 2), (2, 1))) for a, b in zip(chunks, chunks[1:], strict=False)]
            columns = [[row["conv"]] * len(path), [c["chunk"] for c in chunks], [e for e, _ in path], [x for _, x in path], cuts]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv", "chunk", "entry", "exit", "cut"])


def _chosen(searched: DataFrame) -> DataFrame:
    """Per chunk its counts and the edits taken: ``entry``, ``cost``, ``edits``."""
    counts = ["blank", "duplicate", "truncated"]
    whole = searched.where("chunk = 0 and last").select("conv", "chunk", "last", *counts, "illegal", F.explode("ways").alias("w"))
    parts = searched.where("not (chunk = 0 and last)")
    # A conversation of several chunks is a row of about a hundred bytes for each of them.
    small = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost"), w["rank"].alias("rank")))
    lists = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "head", "tail", small.alias("ways")))).alias("chunks"))
    path = lists.mapInArrow(_folded, "conv long, chunk long, entry int, exit int, cut long")
    parts = parts.select("conv", "chunk", "last", *counts, "illegal", F.explode("ways").alias("w"))
    parts = parts.select("*", F.col("w.entry").alias("entry"), F.col("w.exit").alias("exit"))
    parts = lookup(parts, settled(path, "repair-path"), ["conv", "chunk", "entry", "exit"], "inner").withColumn("illegal", F.col("illegal") + F.col("cut"))
    columns = ["conv", "chunk", "last", *counts, "illegal", "w.entry", "w.cost", "w.edits"]
    return whole.select(*columns).unionByName(parts.select(*columns))


def _lines(state: int, edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[bytes]:
    """The repaired rows as lines."""
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            yield b"user:" if state == _USER else b"assistant:"
            continue
        role, text = next(rows)
        if edit == "D":
            continue
        if edit == "R":
            state = _NEXT[state]
            role = "user" if state == _USER else "assistant"
        else:
            state = _SYSTEM if role[:1] == "s" else _NEXT[state]
        yield f"{role}:{text}".encode()


#: Bytes of repaired text in one piece.
_PIECE = 1 << 20


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired lines of chunks, whose edits come before their rows: a digest where a chunk is a whole conversation, else pieces of the text."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "n", "role", "text", "entry", "edits", "last")], strict=True)

    def record(conv: int, chunk: int, piece: int, digest: str | None, text: bytes | None, last: bool) -> dict:
        return {"conv": conv, "chunk": chunk, "piece": piece, "last": last, "digest": digest, "text": text}

    source = rows()
    for conv, chunk, _, _, _, entry, edits, last in source:
        texts = ((r[3], r[4]) for r in source)
        lines = _lines(entry, edits, texts)
        out = []
        if chunk == 0 and last:
            state, first = hashlib.sha256(), True
            for line in lines:
                state.update(line if first else b"\n" + line)
                first = False
            out.append(record(conv, chunk, 0, state.hexdigest(), None, last))
        else:
            held, size, piece = [], 0, 0
            for line in lines:
                held.append(line + b"\n")
                size += len(line)
                if size >= _PIECE:
                    out.append(record(conv, chunk, piece, None, b"".join(held), last))
                    held, size, piece = [], 0, piece + 1
                    yield pa.RecordBatch.from_pylist(out, schema=_REPAIRED)
                    out = []
            out.append(record(conv, chunk, piece, None, b"".join(held), last))
        yield pa.RecordBatch.from_pylist(out, schema=_REPAIRED)


_REPAIRED = pa.schema([("conv", pa.int64()), ("chunk", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("digest", pa.string()), ("text", pa.binary())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations out of their pieces in order. The newline after the last line is left out."""
    key, state, end = None, None, b""

    def one() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv": key, "digest": state.hexdigest()}], schema=pa.schema([("conv", pa.int64()), ("digest", pa.string())]))

    for batch in batches:
        for conv, text in zip(batch.column("conv").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if conv != key:
                if key is not None:
                    yield one()
                key, state, end = conv, hashlib.sha256(), b""
            if text:
                state.update(end + text[:-1])
                end = b"\n"
    if key is not None:
        yield one()


def _digests(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation: ``conv``, ``digest``."""
    chunk = F.expr(f"(n - 1) div {CHUNK}").alias("chunk")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("entry", "int"), ("edits", "string"), ("last", "boolean"))]
    heads = chosen.select("conv", "chunk", F.lit(0).cast("long").alias("n"), F.lit("").alias("role"), F.lit("").alias("text"), "entry", "edits", "last")
    both = rows.select("conv", chunk, "n", "role", "text", *none).unionByName(heads)
    dealt = both.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "n")
    schema = "conv long, chunk long, piece long, last boolean, digest string, text binary"
    done = settled(dealt.mapInArrow(_repaired, schema), "repair-text")
    parts = done.where("digest is null").repartition("conv").sortWithinPartitions("conv", "chunk", "piece").select("conv", "text")
    return done.where("digest is not null").select("conv", "digest").unionByName(parts.mapInArrow(_joined, "conv long, digest string"))


def _gaps(rows: DataFrame) -> DataFrame:
    """Turns missing between the first and the last."""
    turns = rows.groupBy("conv", "turn").agg(F.count("*").alias("n")).groupBy("conv")
    span = (F.max("turn").cast("decimal(20,0)") - F.min("turn") + 1 - F.count("turn")).try_cast("long")
    return turns.agg(F.coalesce(span, F.lit(0).cast("long")).alias("gaps"))


def repair(conversations: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """What is wrong with each conversation and its cheapest repair.

    Takes ``conv_id``, ``turn``, ``role`` and ``text``; further columns are ignored. ``names`` lists conversations to answer for besides (its ``conv_id``): those
    without rows have zeros, an empty audit and the digest of nothing. Returns ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and ``repaired_sha256``.

    Rows go by turn, null first, those of one turn by the digest of role and text. A null role or text is one space, so the row fits no role or is blank.
    Rows without ``conv_id`` are one conversation, whose id is null. A row's first fault counts. Conversations of any number of rows and texts of
    any length are taken chunk by chunk and piece by piece. An empty table and no names give no rows.
    """
    rows = _numbered_rows(conversations)
    searched = settled(_chunks(rows).mapInArrow(_searched, _SEARCHED_SQL), "repair-searched")
    chosen = settled(_chosen(searched), "repair-chosen")
    edits = F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "edits")))["edits"], "").alias("audit")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    each = chosen.groupBy("conv").agg(*[F.sum(c).alias(c) for c in counts], edits)
    found = each.join(_gaps(rows), "conv").join(_digests(rows, chosen), "conv")
    if names is not None:
        listed = names.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv")).distinct()
        found = listed.join(found, "conv", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *counts)]
    digest = F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")
    return found.select(F.nullif("conv", F.lit(_NO_ID)).alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), digest)
