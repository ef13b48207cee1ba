"""Documents that hold benchmark items, by SimHash of item-sized windows.

Documents are read window by window, each as long as an item. A window and the items of its length are compared by
SimHash of their word shingles: fingerprints are cut into eight blocks of eight bits, each block of an item filed
under every value one bit around it. Fingerprints within ``RADIUS`` bits agree in some block up to one bit, so looking
up a window's eight blocks misses none of them. What is found is verified by the weighted similarity of the shingles
themselves.

Most windows need no fingerprint: a window cannot be as similar as asked if too few of its shingles occur in any item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import blocks
from feedloom.llm.documents import KEY, doc_id, keyed
from feedloom.llm.rolling import Rolling
from feedloom.llm.words import Words, words

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits of 64 within which a window and an item are sure to meet: blocks * (ball + 1) - 1.
RADIUS = 15
BLOCKS = 8
#: Bytes of items that are sent to every task at once; more of them are looked for in several rounds.
ITEM_BYTES = 32 << 20
#: A word is a run of letters and digits: ASCII ones, and all bytes of other characters.
BREAK = np.ones(256, bool)
BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _prints(votes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Fingerprints of sums of bits: set where more than half of ``n`` are."""
    return np.packbits(2 * votes > n[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _bits(names: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(names).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def shingles(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Names of all shingles of a slice and where each document's begin; a text shorter than a shingle is one."""
    names = found.names()
    rolling = Rolling(names)
    counts = np.diff(found.begins)
    shorter = np.minimum(counts, SHINGLE)
    per = np.where(counts > 0, counts - shorter + 1, 0)
    begins = np.r_[0, np.cumsum(per)]
    first = np.repeat(found.begins[:-1] - begins[:-1], per) + np.arange(begins[-1])
    return rolling.names(first, first + np.repeat(shorter, per)), begins


@dataclass
class _Size:
    """Items of one length in words: ids, fingerprints, shingles with their weights, and items by block value."""

    ids: list[int] = field(default_factory=list)
    prints: np.ndarray | None = None
    weights: list[Counter] = field(default_factory=list)
    filed: list[dict[int, list[int]]] = field(default_factory=list)


def _index(items: list[tuple[int, bytes]]) -> tuple[dict[int, _Size], np.ndarray]:
    sizes: dict[int, _Size] = {}
    every = [np.empty(0, np.uint64)]
    for item, text in sorted(items):
        data = LOWER[np.frombuffer(text, np.uint8)]
        found = words(data, np.array([0, len(data)]), BREAK)
        if not len(found.start):
            continue
        names, _ = shingles(found)
        size = sizes.setdefault(len(found.start), _Size())
        size.ids.append(item)
        size.weights.append(Counter(names.tolist()))
        one = _prints(_bits(names).sum(axis=0, dtype=np.int64)[None, :], np.array([len(names)]))
        size.prints = one if size.prints is None else np.r_[size.prints, one]
        every.append(names)
    for size in sizes.values():
        size.filed = [{} for _ in range(BLOCKS)]
        for i, value in enumerate(size.prints.tolist()):
            for b in range(BLOCKS):
                block = value >> 8 * b & 255
                for step in [0, *(1 << k for k in range(8))]:
                    size.filed[b].setdefault(block ^ step, []).append(i)
    return sizes, np.unique(np.concatenate(every))


def _candidates(prints: np.ndarray, size: _Size) -> Iterator[tuple[int, int]]:
    """Windows and items within the radius."""
    for w, value in enumerate(prints.tolist()):
        met = {i for b in range(BLOCKS) for i in size.filed[b].get(value >> 8 * b & 255, ())}
        for i in met:
            if (value ^ int(size.prints[i])).bit_count() <= RADIUS:
                yield w, i


def _similar(names: np.ndarray, weights: Counter) -> float:
    """Weighted Jaccard similarity: a shingle weighs as often as it occurs."""
    mine = Counter(names.tolist())
    both = sum(min(n, weights[s]) for s, n in mine.items() if s in weights)
    return both / (len(names) + sum(weights.values()) - both)


def _match(batches: Iterator[pa.RecordBatch], held, similarity: float) -> Iterator[pa.RecordBatch]:
    sizes, known = _index(held.value)
    need = similarity / (1 + similarity)
    seen = np.zeros(1 << 22, bool)
    seen[(known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    for batch in batches:
        ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
        buffer, offsets = blocks.text_offsets(batch.column("text"))
        out: list[tuple] = []
        for begin, stop in blocks.slices(batch.column("text")):
            found = words(LOWER[buffer[offsets[begin] : offsets[stop]]], offsets[begin : stop + 1] - offsets[begin], BREAK)
            names, begins = shingles(found)
            hit = seen[(names & np.uint64((1 << 22) - 1)).astype(np.int64)]
            at = np.flatnonzero(hit)
            hit[at] = np.isin(names[at], known)
            hits = np.r_[0, np.cumsum(hit)]
            for doc in np.flatnonzero(hits[begins[1:]] > hits[begins[:-1]]).tolist():
                low, high = begins[doc], begins[doc + 1]
                n_words = int(found.begins[doc + 1] - found.begins[doc])
                mine, here = names[low:high], hits[low : high + 1] - hits[low]
                votes = None
                best: dict[int, tuple] = {}
                for length, size in sizes.items():
                    wanted = max(1, length - SHINGLE + 1)
                    n = min(max(1, min(length, n_words) - SHINGLE + 1), len(mine)) if length >= SHINGLE or n_words <= length else 0
                    if length < SHINGLE and n_words > length:
                        continue  # such items have one shingle, of their own length; longer texts are looked through below
                    starts = np.flatnonzero(here[n:] - here[:-n] >= need * (n + wanted) - 1e-9)
                    if not len(starts):
                        continue
                    if votes is None:
                        first, last = max(0, int(starts[0])), high - low
                        votes = np.zeros((last + 1, 64), np.int32)
                        np.cumsum(_bits(mine), axis=0, dtype=np.int32, out=votes[1:])
                    prints = _prints(votes[starts + n] - votes[starts], np.full(len(starts), n))
                    for w, i in _candidates(prints, size):
                        start = int(starts[w])
                        value = _similar(mine[start : start + n], size.weights[i])
                        item = size.ids[i]
                        if value >= similarity and (item not in best or (-value, start) < (-best[item][0], best[item][1])):
                            best[item] = (value, start, min(length, n_words))
                out += [(ids[begin + doc], tags[begin + doc], item, *rest) for item, rest in sorted(best.items())]
            short = {k: v for k, v in sizes.items() if k < SHINGLE}
            if short:
                out += _short(found, ids[begin:stop], tags[begin:stop], short)
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "tag", "item_id", "similarity", "start_word", "n_words"]
        )


def _short(found: Words, ids: np.ndarray, tags: np.ndarray, sizes: dict[int, _Size]) -> list[tuple]:
    """Items shorter than a shingle are one shingle of their own length, so only equal windows are similar."""
    rolling, out = Rolling(found.names()), []
    for length, size in sizes.items():
        start, doc = found.window_starts(length)
        long = np.diff(found.begins)[doc] > length  # texts of just this length have been compared
        start, doc = start[long], doc[long]
        names = rolling.windows(length)[start] if len(start) else np.empty(0, np.uint64)
        for item, weights in zip(size.ids, size.weights, strict=True):
            at = np.flatnonzero(names == np.uint64(next(iter(weights))))
            docs, first = np.unique(doc[at], return_index=True)
            for d, f in zip(docs.tolist(), at[first].tolist(), strict=True):
                out.append((ids[d], tags[d], item, 1.0, int(start[f] - found.begins[d]), length))
    return out


def _rounds(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The items in parts that may be sent to every task, one at a time; at least one part."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("length(text) > 0")
    part: list[tuple[int, bytes]] = []
    size = 0
    for row in rows.toLocalIterator():
        text = bytes(row.text)
        if size + len(text) > ITEM_BYTES and part:
            yield part
            part, size = [], 0
        part.append((-1 if row.item_id is None else row.item_id, text))
        size += len(text)
    yield part


def keyed_matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """As :func:`matches`, with the keys of :mod:`feedloom.llm.documents` in place of ``doc_id``."""
    schema = "id long, tag int, item_id long, similarity double, start_word int, n_words int"
    texts, out = keyed(docs), None
    for part in _rounds(items):
        held = docs.sparkSession.sparkContext.broadcast(part)
        found = texts.mapInArrow(lambda b, held=held: _match(b, held, similarity), schema)
        out = found if out is None else out.union(found)
    return out


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Benchmark items found in documents: ``doc_id``, ``item_id``, ``similarity``, and where (``start_word``, ``n_words``).

    Words are runs of letters and digits, A-Z lower-cased; shingles have five words. A document holds an item if some
    window of as many words as the item has is within ``RADIUS`` bits and similar to it by at least ``similarity``:
    the weighted Jaccard similarity of shingles. The row tells of the most similar window, the first of equals. A
    document with fewer words than the item is compared as a whole, an item of fewer than five words as one shingle.

    ``items`` has ``item_id`` and ``text`` and is a benchmark: it passes the driver part by part and goes to every
    task, at most ``ITEM_BYTES`` at a time. Null and empty texts on either side match nothing, nor do items without a
    word; null item ids are given as -1. Repeated items are all told, repeated documents each get their rows. Empty
    tables give no rows. Other columns are ignored. Texts are read whole.
    """
    return keyed_matches(docs, items, similarity).select(doc_id(), "item_id", "similarity", "start_word", "n_words")


def without_matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    mark = keyed(docs.select("doc_id", "text")).columns
    found = keyed_matches(docs, items, similarity).select(F.col("id").alias("__id"), F.col("tag").alias("__tag")).distinct()
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    tag = F.shiftright(F.xxhash64("text"), 32).cast("int")
    assert mark[:2] == KEY
    return docs.join(found, (ident == F.col("__id")) & (tag == F.col("__tag")), "left_anti")
