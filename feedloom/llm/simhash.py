"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint's 64 bits are votes of the document's word shingles. Two documents are linked if their fingerprints
differ in few bits. To find all such pairs without comparing all, fingerprints are cut into segments, so many that of any two
linked ones some segment differs in one bit at most. Each segment has a table, where every fingerprint is filed under the
segment's value. It is searched with the Hamming ball of radius one around each fingerprint's own value, and what it gives is verified by
the whole distance.

A value that very many fingerprints share is split by further bits: the bits outside the segment are cut into one piece more than may
differ, of which any two linked fingerprints agree in one, and value and piece together are the key. What a task finds leaves it
as a spanning forest, never as all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import blocks
from feedloom.llm.components import components
from feedloom.llm.rolling import mixed
from feedloom.llm.words import words
from feedloom.operators.joins import lookup
from feedloom.operators.joins import settled as _kept

SEED = 42
RADIUS = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_CELL = {"cell": "<u8", "fingerprint": "<u8", "probe": "<u1"}
#: A segment's value that more fingerprints than this share is split by further bits, and so is none that fewer than one in
#: ``RARE`` share: there are no more such values than ``RARE`` times the number of segments.
HOT = 4096
RARE = 50_000
#: Pairs verified, and links held, at a time.
_PAIRS = 1 << 20
# At most so many shingles are spread into bits at a time.
_VOTES = 1 << 16


def shingle_hashes(words_of: list[bytes], size: int) -> np.ndarray:
    """XXH64 of all shingles of ``size`` words, repeats included; of the whole sequence if it is shorter."""
    if not words_of:
        return np.empty(0, np.uint64)
    text = b" ".join(words_of)
    ends = np.cumsum([len(w) + 1 for w in words_of]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    count = max(1, len(words_of) - size + 1)
    pairs = zip(starts[:count].tolist(), ends[-count:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(text[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _VOTES):
        part = hashes[at : at + _VOTES]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, offsets = blocks.text_offsets(batch.column("text"))
        out = np.zeros(batch.num_rows, np.uint64)
        for begin, stop in blocks.slices(batch.column("text")):
            text = LOWER[buffer[offsets[begin] : offsets[stop]]]
            found = words(text, offsets[begin : stop + 1] - offsets[begin])
            data, start, end = text.tobytes(), found.start.tolist(), found.end.tolist()
            for i in range(stop - begin):
                low, high = found.begins[i], found.begins[i + 1]
                if high > low:
                    out[begin + i] = fingerprint(shingle_hashes([data[a:b] for a, b in zip(start[low:high], end[low:high], strict=True)], size))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number, of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. A text with fewer words than a shingle is one
    shingle; null, empty and blank texts have fingerprint zero.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return texts.mapInArrow(lambda b: _fingerprints(b, shingle_words), "doc_id long, fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment: of two fingerprints within ``bits``, one segment differs in one bit at most."""
    return cuts(64, bits // 2 + 1)


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """First bit and width of each of so many parts, as equal as can be."""
    ends = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _values(fp: np.ndarray, start: int, width: int) -> np.ndarray:
    return (fp >> np.uint64(start)) & np.uint64((1 << width) - 1)


def _split(cell: np.ndarray, fp: np.ndarray, start: int, width: int, bits: int) -> Iterator[np.ndarray]:
    """Keys of crowded cells' entries, each with one piece of the bits outside the segment."""
    low = fp & np.uint64((1 << start) - 1)
    high = fp >> np.uint64(start + width) if start + width < 64 else np.zeros_like(fp)
    rest = low | (high << np.uint64(start))
    for i, (first, wide) in enumerate(cuts(64 - width, bits + 1)):
        yield mixed(cell ^ mixed(_values(rest, first, wide) * np.uint64(bits + 1) + np.uint64(i + 1)))


def _cells(batch: pa.RecordBatch, bits: int, hot: np.ndarray, buckets: int) -> Iterator[blocks.Entries]:
    """Each fingerprint under the value of each segment, and as a search for each value of the ball around it."""
    whole = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
    for at in range(0, len(whole), 4096):
        part = whole[at : at + 4096]
        for i, (start, width) in enumerate(segments(bits)):
            own = _values(part, start, width)
            steps = np.array([0] + ([1 << k for k in range(width)] if bits else []), np.uint64)
            cell = np.concatenate([own, (own[:, None] ^ steps[None, :]).reshape(-1)])
            if width < 64:
                cell |= np.uint64(i << width)
            fp = np.concatenate([part, np.repeat(part, len(steps))])
            probe = np.repeat(np.array([0, 1], np.uint8), [len(part), len(part) * len(steps)])
            crowded = np.isin(cell, hot)
            groups = [(cell[~crowded], fp[~crowded], probe[~crowded])]
            if crowded.any():
                groups += [(key, fp[crowded], probe[crowded]) for key in _split(cell[crowded], fp[crowded], start, width, bits)]
            for key, of, kind in groups:
                yield {"cell": key, "fingerprint": of, "probe": kind}, ((key * _ODD >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to the smallest one that these links lead to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[one], root[two]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]
    inner = root != np.arange(len(nodes))
    return nodes[root[inner]], nodes[inner]


def _meet(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links of the fingerprints that a search finds in a cell, whole distances verified, as a forest."""
    d = blocks.unpacked(batches, _CELL)
    filed = np.flatnonzero(d["probe"] == 0)
    filed = filed[np.argsort(d["cell"][filed], kind="stable")]
    table, held = d["cell"][filed], d["fingerprint"][filed]
    search = np.flatnonzero(d["probe"])
    begin = np.searchsorted(table, d["cell"][search], "left")
    count = np.searchsorted(table, d["cell"][search], "right") - begin
    met = count > 0
    begin, count, asked = begin[met], count[met], d["fingerprint"][search[met]]
    low, high = np.empty(0, np.uint64), np.empty(0, np.uint64)
    for first, last, skip, stop in _runs(count):
        n = count[first:last].copy()
        n[-1], n[0] = stop, n[0] if last - first > 1 else stop
        n[0] -= skip
        found = np.repeat(begin[first:last], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found[: n[0]] += skip
        x, y = np.repeat(asked[first:last], n), held[found]
        # Each pair meets both ways round.
        near = (x > y) & (np.bitwise_count(x ^ y) <= bits)
        low, high = np.concatenate([low, y[near]]), np.concatenate([high, x[near]])
        if len(low) >= _PAIRS:
            low, high = forest(low, high)
    low, high = forest(low, high)
    yield from blocks.record_batches([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], ["a", "b"], 1 << 16)


def _runs(count: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Searches ``[first, last)`` whose matches make up a bounded number of pairs; the first without those before ``skip``, the
    last up to ``stop``."""
    upto = np.cumsum(count)
    total = int(upto[-1]) if len(upto) else 0
    for at in range(0, total, _PAIRS):
        end = min(at + _PAIRS, total)
        first, last = int(np.searchsorted(upto, at, "right")), int(np.searchsorted(upto, end, "left"))
        yield first, last + 1, at - int(upto[first] - count[first]), end - int(upto[last] - count[last])


def _crowded(nodes: DataFrame, bits: int) -> np.ndarray:
    """Cells that many fingerprints share, at most ``RARE`` for each segment."""
    parts = segments(bits)
    if len(parts) == 1:
        return np.empty(0, np.uint64)  # such a cell holds 65 fingerprints at most
    least = max(HOT, nodes.count() // RARE)
    cells = [F.shiftrightunsigned("fp", start).bitwiseAND((1 << width) - 1).bitwiseOR(i << width) for i, (start, width) in enumerate(parts)]
    counted = nodes.select(F.explode(F.array(*cells)).alias("cell")).groupBy("cell").count().where(F.col("count") > least)
    return np.sort(np.array([r.cell for r in counted.select("cell").collect()], np.int64)).view(np.uint64)


def near_links(nodes: DataFrame, bits: int = RADIUS) -> DataFrame:
    """Links (``a``, ``b``) that connect all of ``nodes`` (``fp``, each fingerprint once) within ``bits`` of each other.

    Two nodes are linked directly or over others. ``bits`` may be any number below 32; each one more costs about as
    many searches of a fingerprint as before, in smaller segments.
    """
    if not 0 <= bits < 32:
        raise ValueError("bits must be 0 to 31")
    buckets = blocks.buckets_of(nodes)
    hot = _crowded(nodes, bits)
    return blocks.exchange(nodes.select("fp"), lambda b: _cells(b, bits, hot, buckets), list(_CELL), lambda b: _meet(b, bits), "a long, b long", buckets).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, bits: int = RADIUS) -> DataFrame:
    """Every row's fingerprint and the smallest ``doc_id`` reachable over links: ``doc_id``, ``fp``, ``component_id``.

    Fingerprints with ``bits`` or fewer differing bits are linked; equal ones are one node from the start, so copies
    cost nothing. Null, empty and blank texts all have fingerprint zero and are linked like any other. A null
    ``doc_id`` gets a component too, but never names one (a component of such rows alone has null). Rows with the same
    ``doc_id`` each keep their fingerprint. An empty table gives no rows. Other columns are ignored; texts are worked
    through whole.
    """
    prints = _kept(fingerprints(docs, shingle_words), "fingerprints")
    nodes = _kept(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    linked = components(near_links(nodes.select("fp"), bits))
    groups = lookup(nodes, linked, {"fp": "node"}).select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "component").select("fp", "component_id")
    return lookup(prints, named, ["fp"]).select("doc_id", "fp", "component_id")
