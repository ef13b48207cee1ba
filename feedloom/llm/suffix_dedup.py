"""Removal of substrings that occur earlier, by blockwise suffix sorting with a cover sample.

Which windows of ``width`` bytes occur earlier is what neighbours in a suffix array with a common prefix of that length
tell. Sorting all suffixes of a corpus would move many times its size, so they are sorted block by
block, and what decides long ties is worked out beforehand:

1. *Cover sample.* Each window has an anchor, the place of its smallest ``GRAM``-gram. Like a difference cover, the
   anchors leave no two equal windows without a common sampled offset; chosen by content rather than by position
   modulo a number, they also fall on the same places in all copies of a passage. One position in about ``(width -
   GRAM) / 2`` is sampled.
2. *Ranks.* An anchor owns the windows around it. Anchors whose whole surroundings are equal get one name; all but the
   first of a name are repeats with every window they own. Anchors whose gram has one name only
   are done with. This settles the insides of copies, however many there are.
3. *Suffix buckets.* What is left are suffixes near the ends of passages. They are split by offset from their anchor,
   eight offsets to a block. Within one, suffixes share ``width - 7`` bytes, whose name is the rank that resolves the
   tie, and differ in at most seven bytes on either side. One offset is sorted at a time, by those bytes and that
   rank.

Both exchanges carry numbers only. Equal entries of one slice of text are folded before they are sent, so that a
passage in a third of all documents costs one entry per slice. A gram that has many names in some slice, as at the
edge of such a passage, is hot: its anchors are dealt out by name instead of by gram, and their suffixes by all their
bytes instead of by rank, so neither meets in one task. A mark tells the gram's own bucket, where slices with few
names of it have sent theirs; all open anchors of a gram are treated alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import blocks
from feedloom.llm.documents import KEY, doc_id, keyed, per_document
from feedloom.llm.rolling import BYTE_VALUES, Rolling, leftmost_minima, mixed
from feedloom.llm.spans import merged, spans_per_key

GRAM = 24
BLOCK = 8
#: Names of one gram in a slice from which the gram is hot. It decides where entries go, not what comes out.
HOT = 16
_SPANS = ["start", "end"]
_REPLY = "id long, tag int, start array<int>, end array<int>, anchor array<int>, hot array<int>"
_FOUND = {"id": "<i8", "tag": "<i4", "start": "<i4", "end": "<i4"}
_FOUND |= {"open_id": "<i8", "open_tag": "<i4", "open_start": "<i4", "open_last": "<i4", "open_anchor": "<i4", "open_hot": "<i4"}
_DONE = {"done_id": "<i8", "done_tag": "<i4", "done_start": "<i4", "done_end": "<i4"}
_ANCHORS = {"mark": "<u4", "hot": "u1", "gram": "<u4", "name": "<u8", "id": "<i8", "tag": "<i4", "start": "<i4", "last": "<i4", "anchor": "<i4"} | _DONE
_SUFFIXES = {"rank": "<u8", "left": "<u8", "right": "<u8", "near": "u1", "far": "u1", "id": "<i8", "tag": "<i4", "at": "<i4"} | _DONE


def _as(kinds: dict[str, str], columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {n: np.ascontiguousarray(v).astype(kinds[n]) for n, v in columns.items()}


def _ordered(same: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by what must be equal, then by place: the order, which entries open a group, and which come after another
    place of it."""
    order = np.lexsort((*place[::-1], *same[::-1]))
    if not len(order):
        return order, np.empty(0, bool), np.empty(0, bool)
    fresh = np.r_[True, np.any([k[order][1:] != k[order][:-1] for k in same], axis=0)]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = np.any([p[order] != p[order][first] for p in place], axis=0)
    return order, fresh, later


def _done(slot: int, buckets: int, ident: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> blocks.Entries:
    """Spans that a slice settles by itself, sent along."""
    (ident, tag), start, end, begins = spans_per_key([ident, tag], start, end)
    count = np.diff(begins)
    columns = {"done_id": np.repeat(ident, count), "done_tag": np.repeat(tag, count), "done_start": start, "done_end": end}
    return _as(_DONE, columns), np.full(len(start), slot % buckets)


def _spans(d: dict[str, np.ndarray], found: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[pa.RecordBatch]:
    """What is to be cut, packed for the documents' buckets."""
    found.append((d["done_id"], d["done_tag"], d["done_start"], d["done_end"]))
    ident, tag, start, end = (np.concatenate([f[i] for f in found]) for i in range(4))
    (ident, tag), start, end, begins = spans_per_key([ident, tag], start, end)
    count = np.diff(begins)
    columns = {"id": np.repeat(ident, count), "tag": np.repeat(tag, count), "start": start, "end": end}
    yield from blocks.packed(_as(_FOUND, columns), blocks.homes(columns["id"], buckets), list(_FOUND))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with spans to be cut, merged, and one per document with open anchors."""
    d = blocks.unpacked(batches, _FOUND)
    (ident, tag), start, end, begins = spans_per_key([d["id"], d["tag"]], d["start"], d["end"])
    none = pa.nulls(len(ident), pa.list_(pa.int32()))
    names = [*KEY, *_SPANS, "anchor", "hot"]
    yield from blocks.record_batches([pa.array(ident), pa.array(tag), *(blocks.list_array(x, begins) for x in (start, end)), none, none], names)
    order = np.lexsort((d["open_start"], d["open_tag"], d["open_id"]))
    ident, tag = d["open_id"][order], d["open_tag"][order]
    fresh = np.flatnonzero(np.r_[True, (ident[1:] != ident[:-1]) | (tag[1:] != tag[:-1])]) if len(order) else order
    lists = [blocks.list_array(d[n][order], np.r_[fresh, len(order)]) for n in ("open_start", "open_last", "open_anchor", "open_hot")]
    yield from blocks.record_batches([pa.array(ident[fresh]), pa.array(tag[fresh]), *lists], names)


def _texts(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch, which may come with further columns in a struct."""
    column = batch.column("text")
    return column.flatten()[0] if pa.types.is_struct(column.type) else column


def _anchors(batch: pa.RecordBatch, width: int, buckets: int) -> Iterator[blocks.Entries]:
    """The anchors of each slice, those with equal surroundings folded."""
    texts = _texts(batch)
    buffer, offsets = blocks.text_offsets(texts)
    ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
    for begin, stop in blocks.slices(texts):
        at = offsets[begin : stop + 1] - offsets[begin]
        text = buffer[offsets[begin] : offsets[stop]]
        counts = np.maximum(np.diff(at) - width + 1, 0)
        starts = np.repeat(at[:-1] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        if not len(starts):
            continue
        rolling = Rolling(BYTE_VALUES[text])
        grams = rolling.windows(GRAM)
        anchor = leftmost_minima(grams, width - GRAM + 1)[starts]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]
        first, last, anchor = starts[new], starts[np.r_[new[1:], True]], anchor[new]
        own = ((anchor - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
        name = mixed(rolling.names(first, last + width) ^ mixed(own))
        gram = grams[anchor]
        doc = np.searchsorted(at, first, "right") - 1
        base, ident, tag = at[doc], ids[begin:stop][doc], tags[begin:stop][doc]
        order, fresh, later = _ordered([name], [ident, tag, first - base])
        keep, drop = order[fresh], order[later]
        columns = {"gram": gram, "name": name, "id": ident, "tag": tag, "start": first - base, "last": last - base, "anchor": anchor - base}
        keep = np.sort(keep)
        grams_here, which, count = np.unique(gram[keep], return_inverse=True, return_counts=True)
        hot = count[which] >= HOT
        columns = {n: v[keep] for n, v in columns.items()} | {"hot": hot}
        bucket = (np.where(hot, name[keep], gram[keep]) >> np.uint64(33)).astype(np.int64) % buckets
        yield _as(_ANCHORS, columns), bucket
        marked = grams_here[count >= HOT]
        yield _as(_ANCHORS, {"mark": marked}), (marked >> np.uint64(33)).astype(np.int64) % buckets
        yield _done(int(name[0] >> np.uint64(40)), buckets, ident[drop], tag[drop], (first - base)[drop], (last - base)[drop] + width)


def _resolve_anchors(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated anchors; and the first of each name whose gram has other names too, to be looked at suffix by
    suffix."""
    d = blocks.unpacked(batches, _ANCHORS)
    order, fresh, later = _ordered([d["hot"], d["gram"], d["name"]], [d["id"], d["tag"], d["start"]])
    drop = order[later]
    yield from _spans(d, [(d["id"][drop], d["tag"][drop], d["start"][drop], d["last"][drop] + width)], buckets)
    first = order[fresh]
    gram, hot = d["gram"][first], d["hot"][first] > 0
    if len(first):
        same = (gram[1:] == gram[:-1]) & ~hot[1:]
        hot |= np.isin(gram, d["mark"])
        left = np.r_[same, False] | np.r_[False, same] | hot
        hot, left = hot[left], first[left]
        columns = {f"open_{n}": d[n][left] for n in ("id", "tag", "start", "last", "anchor")} | {"open_hot": hot}
        yield from blocks.packed(_as(_FOUND, columns), blocks.homes(columns["open_id"], buckets), list(_FOUND))


def _low_bytes(count: np.ndarray) -> np.ndarray:
    """Masks of so many low bytes, at most seven."""
    return (np.uint64(1) << (8 * count).astype(np.uint64)) - np.uint64(1)


def _suffixes(batch: pa.RecordBatch, width: int, buckets: int) -> Iterator[blocks.Entries]:
    """The suffixes that open anchors own, in blocks of offsets."""
    texts = _texts(batch)
    buffer, offsets = blocks.text_offsets(texts)
    ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
    for begin, stop in blocks.slices(texts):
        at = offsets[begin : stop + 1] - offsets[begin]
        text = np.pad(buffer[offsets[begin] : offsets[stop]], (BLOCK, BLOCK))  # reads past either end give bytes that masks blank out
        part = batch.slice(begin, stop - begin)
        doc = np.repeat(np.arange(stop - begin), part.column("start").value_lengths().to_numpy(zero_copy_only=False))
        start, last, anchor = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) + at[doc] for c in ("start", "end", "anchor"))
        hot = part.column("hot").flatten().to_numpy(zero_copy_only=False) > 0
        low, high = (anchor - last) // BLOCK, (anchor - start) // BLOCK
        count = high - low + 1
        each = np.repeat(np.arange(len(doc)), count)
        block = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        if not len(each):
            continue
        core = anchor[each] - BLOCK * block
        near = np.maximum(anchor - last, 0)[each] - BLOCK * block
        far = (anchor - start)[each] - BLOCK * block
        near, far = np.maximum(near, 0), np.minimum(far, BLOCK - 1)
        rolling = Rolling(BYTE_VALUES[text])
        size = width - BLOCK + 1
        rank = mixed(rolling.names(core + BLOCK, core + BLOCK + size) + block.astype(np.uint64))
        before, after = np.zeros(len(each), np.uint64), np.zeros(len(each), np.uint64)
        for i in range(BLOCK - 1):
            shift = np.uint64(8 * i)
            before |= np.where(i < far, text[np.maximum(core + BLOCK - 1 - i, 0)].astype(np.uint64) << shift, np.uint64(0))
            after |= np.where(i < BLOCK - 1 - near, text[np.minimum(core + BLOCK + size + i, len(text) - 1)].astype(np.uint64) << shift, np.uint64(0))
        ident, tag, place, hot = ids[begin:stop][doc[each]], tags[begin:stop][doc[each]], core - at[doc[each]], hot[each]
        if hot.any():
            # One entry for each suffix, with the bytes that count for it only.
            count = np.where(hot, far - near + 1, 1)
            which = np.repeat(np.arange(len(hot)), count)
            offset = near[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            rank, before, after, ident, tag, place, near, far, hot = (x[which] for x in (rank, before, after, ident, tag, place, near, far, hot))
            near, far = np.where(hot, offset, near), np.where(hot, offset, far)
            before = np.where(hot, before & _low_bytes(offset), before)
            after = np.where(hot, after & _low_bytes(BLOCK - 1 - offset), after)
        order, fresh, later = _ordered([rank, before, after, near, far], [ident, tag, place])
        keep, drop = np.sort(order[fresh]), order[later]
        columns = {"rank": rank, "left": before, "right": after, "near": near, "far": far, "id": ident, "tag": tag, "at": place}
        whole = mixed(rank ^ mixed(before ^ mixed(after + near.astype(np.uint64))))
        bucket = (np.where(hot, whole, rank)[keep] >> np.uint64(33)).astype(np.int64) % buckets
        yield _as(_SUFFIXES, {n: v[keep] for n, v in columns.items()}), bucket
        yield _done(int(rank[0] >> np.uint64(40)), buckets, ident[drop], tag[drop], place[drop] - far[drop], place[drop] - near[drop] + width)


def _resolve_suffixes(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorts the suffixes of one offset at a time."""
    d = blocks.unpacked(batches, _SUFFIXES)
    found = []
    for offset in range(BLOCK):
        here = np.flatnonzero((d["near"] <= offset) & (offset <= d["far"]))
        before = d["left"][here] & np.uint64((1 << 8 * offset) - 1)
        after = d["right"][here] & np.uint64((1 << 8 * (BLOCK - 1 - offset)) - 1)
        order, _, later = _ordered([d["rank"][here], before, after], [d["id"][here], d["tag"][here], d["at"][here]])
        drop = here[order[later]]
        start = d["at"][drop] - offset
        found.append((d["id"][drop], d["tag"][drop], start, start + width))
    yield from _spans(d, found, buckets)


def _cut(batches: Iterator[pa.RecordBatch], whole_characters: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, offsets = blocks.text_offsets(_texts(batch))
        spans = [batch.column(c) for c in _SPANS]
        kept, lists = [], []
        for i in range(batch.num_rows):
            text = buffer[offsets[i] : offsets[i + 1]]
            start, end = (np.array(s[i].values.to_numpy() if s[i].is_valid else [], np.int64) for s in spans)
            start, end = merged(start, end)
            if whole_characters:
                edge = np.r_[(text & 0xC0) == 0x80, False]
                for _ in range(3):
                    start, end = start - edge[start], end + edge[end]
                start, end = merged(start, end)
            keep = np.zeros(len(text) + 1, np.int8)
            np.add.at(keep, start, 1)
            np.add.at(keep, end, -1)
            kept.append(text[np.cumsum(keep[:-1]) == 0].tobytes())
            lists.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        arrays = [batch.column("id"), pa.array(np.diff(offsets)), pa.array(lists, kind), pa.array(kept, pa.binary())]
        column = batch.column("text")
        rest = column.flatten()[1:] if pa.types.is_struct(column.type) else []
        carried = [column.type.field(i).name for i in range(1, 1 + len(rest))]
        yield pa.RecordBatch.from_arrays([*arrays, *rest], names=["id", "n_bytes", "removed", "kept", *carried])


def remove_repeats(docs: DataFrame, width: int = 100, whole_characters: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Cut every byte that a ``width``-byte string covers which also starts earlier, in any document.

    Earlier means a smaller ``doc_id``, or an earlier start in the same one. Strings are judged on the input, overlaps
    count, and no string crosses a document's end. Needs ``doc_id`` and ``text``; other columns are ignored. Result:
    ``doc_id``, ``n_bytes`` (length of the UTF-8 text), ``removed`` (maximal spans, ``end`` exclusive) and ``kept``
    (the remaining bytes). With ``whole_characters``, characters that a span cuts into go as a whole, so that what is
    kept is UTF-8 again. ``keep`` names further columns to return.

    Null and empty texts give zero bytes and no spans, texts shorter than ``width`` stay whole, texts of any length
    are handled in memory linear in that one text. A null ``doc_id`` comes before all others. Rows with the same
    ``doc_id`` and text are the same document: none repeats the other. With the same ``doc_id`` and different texts
    they are ordered by a hash of the text. An empty table gives no rows.
    """
    if width < GRAM + BLOCK * 2:
        raise ValueError(f"width must be at least {GRAM + BLOCK * 2}")
    blocks.bounded_batches(docs)
    buckets = blocks.buckets_of(docs)
    texts = keyed(docs, keep)
    found = blocks.packed_schema(list(_FOUND))

    def at_home(rows: DataFrame) -> DataFrame:
        return blocks.dealt(rows, buckets).mapInArrow(_documents, _REPLY)

    anchors = at_home(
        blocks.exchange(texts, lambda b: _anchors(b, width, buckets), list(_ANCHORS), lambda b: _resolve_anchors(b, width, buckets), found, buckets)
    )
    # One row per document, of few bytes: hashing it spares sorting the texts it is joined to.
    open_anchors = texts.join(anchors.where("anchor is not null").hint("shuffle_hash"), KEY)
    suffixes = at_home(
        blocks.exchange(
            open_anchors, lambda b: _suffixes(b, width, buckets), list(_SUFFIXES), lambda b: _resolve_suffixes(b, width, buckets), found, buckets
        )
    )
    spans = anchors.where("anchor is null").select(*KEY, *_SPANS).union(suffixes.select(*KEY, *_SPANS))
    cut = texts.join(per_document(spans, _SPANS), KEY, "left").mapInArrow(
        lambda b: _cut(b, whole_characters),
        ", ".join(
            ["id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"]
            + [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
        ),
    )
    return cut.select(doc_id(), "n_bytes", "removed", "kept", *keep)
