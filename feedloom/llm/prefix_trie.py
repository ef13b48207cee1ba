"""Trie of conversation prefixes, by ROLLUP over the ids of turns.

Each conversation is a row per block of eight turns: ids of the turns in columns ``t1`` to ``t8``, and the name of the
node that the blocks before lead to. One ``GROUP BY node, ROLLUP(t1, ..., t8)`` then gives every prefix of every block
at once, and ``grouping_id`` says how long each is, so that a turn that is not there is told from one that is rolled up.
Long conversations go on in further blocks, in the same grouping. Sums over subtrees are a second such grouping: each node belongs to
its smallest member, whose row brings what its nodes hold to all nodes above.

Turn ids are 128 bits of SHA-256 of role and text, with the text's length. Nodes are named by two 64-bit sums (exclusive or)
of hashes of depth and turn, so names of blocks are sums over blocks before, worked out chunk by chunk in any order.
No step takes a conversation or a node's members as a whole, except that digests of member lists read them as a stream of
pieces, as SHA-256 asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup, settled
from feedloom.operators.ordering import numbered, running_total

#: Turns in a block: columns of the rollup.
BLOCK = 8
#: Blocks of a conversation that are summed in one window.
CHUNK = 1024
#: Turns that a conversation may take from the one it starts from: fewer than this.
SPREAD = 9
#: Conversations in a row of this many share their start.
FAMILY = 5
#: Member ids in a piece of a list.
PIECE = 1 << 15

_NO_ID = -(1 << 63)
_SLOTS = [f"t{j}" for j in range(1, BLOCK + 1)]
_NODE = ["depth", "n1", "n2"]


def _hash(seed: int, depth: str, turn: str) -> str:
    return f"xxhash64({seed}L, {depth}, {turn})"


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv``, ``turn`` and ``id`` of every row: 16 bytes of digest and four of the text's length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv")
    return conversations.select(conv, F.col("turn").cast("long").alias("turn"), F.unhex(F.concat(digest, size)).alias("id"))


def _shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.when(conv == _NO_ID, 0).otherwise(F.crc32(conv.cast("string").cast("binary")) % SPREAD).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of rebuilt conversations, and the conversations themselves with their length.

    Conversation c takes the first h turns of conversation c - c % 5 and goes on with its own after its first h. Rows are
    ``conv``, ``depth`` (from 1), ``id`` and ``len``; conversations are ``conv`` and ``len``.
    """
    rows = settled(numbered(turns, ["conv"], ["turn", "id"], alias="n", total="total"), "trie-turns")
    first = F.when(F.col("conv") == _NO_ID, F.col("conv")).otherwise(F.col("conv") - F.col("conv") % FAMILY)
    convs = rows.where("n = 1").select("conv", "total", _shared_turns(F.col("conv")).alias("h"), first.alias("first"))
    sizes = convs.select(F.col("conv").alias("first"), F.col("total").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    length = F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    convs = convs.join(sizes, "first", "left").withColumn("k", taken).withColumn("len", length)
    convs = settled(convs.select("conv", "first", "h", "k", "len"), "trie-conversations")
    own = rows.where(F.col("n") > _shared_turns(F.col("conv")))
    own = lookup(own, convs, ["conv"], "inner").select("conv", F.expr("n - h + k").alias("depth"), "id", "len")
    # At most SPREAD - 1 rows of a conversation meet the few that start from it.
    starts = rows.where(F.col("n") < SPREAD).select(F.col("conv").alias("first"), F.col("n").alias("depth"), "id")
    taken = starts.join(convs.where("k > 0"), "first").where("depth <= k").select("conv", "depth", "id", "len")
    return own.unionByName(taken), convs.select("conv", "len")


def blocks(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per block: ``conv``, ``len``, ``block``, the turns ``t1`` to ``t8``, the node before it (``k1``, ``k2``) and
    the one at its end (``e1``, ``e2``). A conversation without turns is a block without turns."""
    placed = rows.selectExpr(
        "conv", "len", f"(depth - 1) div {BLOCK} as block", f"((depth - 1) div {BLOCK}) div {CHUNK} as chunk",
        "depth", "id", f"{_hash(1, 'depth', 'id')} as z1", f"{_hash(2, 'depth', 'id')} as z2",
    )
    bare = convs.where("len = 0").selectExpr("conv", "len", "0L as block", "0L as chunk", "0L as depth", "cast(null as binary) as id", "0L as z1", "0L as z2")
    # One shuffle serves the grouping and the window.
    grouped = placed.unionByName(bare).repartition("conv", "chunk").groupBy("conv", "chunk", "block").agg(
        F.max("len").alias("len"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"),
        F.sort_array(F.collect_list(F.struct("depth", "id"))).alias("turns"),
    )
    slots = [F.get("turns", F.lit(j))["id"].alias(t) for j, t in enumerate(_SLOTS)]
    so_far = W.partitionBy("conv", "chunk").orderBy("block")
    run = [F.expr(f"bit_xor(x{i})").over(so_far).alias(f"e{i}") for i in (1, 2)]
    inside = grouped.select("conv", "chunk", "block", "len", "x1", "x2", *slots, *run)
    inside = settled(inside, "trie-chunks")
    # Only conversations of several chunks have anything before one.
    totals = inside.where(f"len > {BLOCK * CHUNK}").groupBy("conv", "chunk").agg(F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2"))
    before = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    marks = totals.select("conv", "chunk", *[F.coalesce(F.expr(f"bit_xor(c{i})").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    late = lookup(inside.where("chunk > 0"), settled(marks.where("chunk > 0"), "trie-marks"), ["conv", "chunk"], "inner")
    early = inside.where("chunk = 0").withColumns({"b1": F.lit(0).cast("long"), "b2": F.lit(0).cast("long")})
    names = [f"e{i} ^ b{i} ^ x{i} as k{i}" for i in (1, 2)] + [f"e{i} ^ b{i} as e{i}" for i in (1, 2)]
    return early.unionByName(late).selectExpr("conv", "len", "block", *_SLOTS, *names)


def _rolled(table: DataFrame, sums: str) -> DataFrame:
    """Every prefix of every block with ``sums``: its depth, its names, those of its parent and its last turn."""
    spark, slots = table.sparkSession, ", ".join(_SLOTS)
    groups = spark.sql(
        f"select k1, k2, block, {slots}, {BLOCK} - bit_count(grouping_id()) as level, {sums} "
        f"from {{table}} group by k1, k2, block, rollup({slots})",
        table=table,
    )
    last = f"element_at(array({slots}), level)"
    nodes = groups.withColumn("last", F.expr(f"case when level > 0 then {last} end"))
    # A prefix is there if its last turn is; the empty one is the root, or the last of the block before.
    nodes = nodes.where("last is not null or (level = 0 and block = 0)").withColumn("depth", F.expr(f"block * {BLOCK} + level"))

    def name(i: int, upto: int) -> str:
        terms = [f"case when level >= {j + upto} then {_hash(i, f'block * {BLOCK} + {j}', t)} else 0L end" for j, t in enumerate(_SLOTS, 1)]
        return " ^ ".join([f"k{i}", *terms])

    parents = [f"case when level > 0 then {name(i, 1)} end as p{i}" for i in (1, 2)]
    extra = [c for c in groups.columns if c not in {"k1", "k2", "block", "level", *_SLOTS}]
    return nodes.selectExpr("depth", f"{name(1, 0)} as n1", f"{name(2, 0)} as n2", *parents, "last", *extra)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of members of nodes out of rows in order, cut into pieces."""
    key, first, held = None, None, []

    def piece() -> pa.RecordBatch:
        values = [[key[0]], [key[1]], [key[2]], [first], [len(held)], [",".join("" if c == _NO_ID else str(c) for c in held).encode()]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [pa.int64()] * 5 + [pa.binary()], strict=True)], names=[*_NODE, "first", "n", "list"])

    for batch in batches:
        for d, a, b, conv in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "conv")], strict=True):
            if held and ((d, a, b) != key or len(held) >= PIECE):
                yield piece()
                held = []
            if not held:
                key, first = (d, a, b), conv
            held.append(conv)
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the list of each node, from its pieces in order."""
    key, state, count, done = None, None, 0, []

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done, strict=True), kinds, strict=True)], names=[*_NODE, "n_ends", "ends"])

    for batch in batches:
        for d, a, b, n, part in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "n", "list")], strict=True):
            if (d, a, b) != key:
                if key is not None:
                    done.append((*key, count, state.hexdigest()))
                    if len(done) >= 4096:
                        yield flush()
                        done = []
                key, state, count = (d, a, b), hashlib.sha256(part), n
            else:
                state.update(b"," + part)
                count += n
    if key is not None:
        done.append((*key, count, state.hexdigest()))
    if done:
        yield flush()


def endings(table: DataFrame) -> DataFrame:
    """Nodes at which conversations end: how many do, and the digest of their ids in order."""
    ends = table.where(f"block = greatest(len - 1, 0L) div {BLOCK}").selectExpr("len as depth", "e1 as n1", "e2 as n2", "conv")
    by = [*_NODE, "conv"]
    pieces = ends.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_pieces, "depth long, n1 long, n2 long, first long, n long, list binary")
    ordered = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return ordered.mapInArrow(_digests, "depth long, n1 long, n2 long, n_ends long, ends string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations.

    Takes ``conv_id``, ``turn``, ``role`` and ``text``; further columns are ignored. A node is a sequence of first turns, equal in role and text.
    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over its subtree, bytes of its last text that members after the first need not
    hold again) and ``ends_sha256`` (of the ids of members that end there).

    A null role or text is empty. Rows of a conversation go by turn, null first, and those with one turn by the digest of role and text;
    repeated rows are turns of their own. Rows without ``conv_id`` are one conversation, which takes no turns from others, counts as the smallest and
    is written as null, and as nothing in lists of ids. An empty table has no nodes. Texts of any length are read once, for their digest.
    """
    rows, convs = rebuilt(turn_ids(conversations))
    table = settled(blocks(rows, convs), "trie-blocks")
    size = "cast(conv(hex(substring(last, 17, 4)), 16, 10) as long)"
    nodes = _rolled(table, "min(conv) as conv, count(*) as n_convs")
    nodes = nodes.selectExpr(*_NODE, "p1", "p2", "conv", "n_convs", f"(n_convs - 1) * coalesce({size}, 0L) as weight")
    nodes = settled(nodes, "trie-nodes")

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, _NODE, "left").join(endings(table), _NODE, "left")
    known = known.withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "n_ends": F.coalesce("n_ends", F.lit(0)), "ends": F.coalesce("ends", F.sha2(F.lit(b""), 256))})
    known = settled(known.withColumn("leaf", (F.col("n_ends") == F.col("n_convs")).cast("long")), "trie-known")

    # What the nodes of each smallest member hold goes to all nodes that it is a member of.
    holds = known.groupBy("conv").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaves")).where("weight > 0 or leaves > 0")
    bearing = lookup(table, settled(holds, "trie-holds"), ["conv"], "inner")
    below = _rolled(bearing, "sum(weight) as below, sum(leaves) as n_leaves").select(*_NODE, "below", "n_leaves")
    # A node with one member has no weight below it and one leaf. Of the others' member, nodes above do not count.
    shared = running_total(known.where("n_convs > 1"), ["conv"], ["depth"], "weight", F.expr(f"depth div {BLOCK * CHUNK}"), "upto")
    shared = shared.join(below, _NODE, "left").selectExpr(*known.columns, "below - upto + weight as saved_tokens", "n_leaves")
    alone = known.where("n_convs = 1").withColumns({"saved_tokens": F.lit(0).cast("long"), "n_leaves": F.lit(1).cast("long")})

    names = nodes.selectExpr("depth + 1 as depth", "n1 as p1", "n2 as p2", "conv as parent")
    out = lookup(shared.unionByName(alone), names, ["depth", "p1", "p2"], "left")
    ids = [F.nullif(c, F.lit(_NO_ID)).alias(a) for c, a in (("conv", "conv_id"), ("parent", "parent_conv_id"))]
    return out.select(ids[0], F.col("depth").cast("long").alias("depth"), ids[1], "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
