"""Removal of word windows that occur earlier, found by doubling their length.

A window can only be repeated if both its halves are. So windows of a short length are looked at first, all of them;
those that occur more than once are alive. At twice the length only windows with two living halves are looked at, and
so on until the length asked for is reached or nothing is alive. Each level is one exchange of packed names: four
bytes a window while it only prunes, where an accidental match merely keeps a window alive, and eight at the last
level, which decides.

Equal windows of one slice of text are folded before they are sent, so a passage in a third of all documents costs one
entry per slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedloom.llm import blocks
from feedloom.llm.documents import KEY, doc_id, keyed
from feedloom.llm.groups import folded
from feedloom.llm.rolling import Rolling
from feedloom.llm.spans import merged, spans_per_key
from feedloom.llm.words import word_slices

_SPANS = {"id": "<i8", "tag": "<i4", "start": "<i4", "count": "<i4"}
_REPLY = "id long, tag int, start array<int>, count array<int>"
_DONE = {"done_id": "<i8", "done_tag": "<i4", "done_start": "<i4", "done_end": "<i4"}


def _columns(last: bool) -> dict[str, str]:
    return {"name": "<u8" if last else "<u4", "many": "u1", "id": "<i8", "tag": "<i4", "at": "<i4"} | _DONE


def _alive(batch: pa.RecordBatch, begins: np.ndarray, n: int) -> np.ndarray:
    """A flag for every word of a slice: whether a living window starts there."""
    count = batch.column("count").flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(batch.num_rows), batch.column("start").fill_null([]).value_lengths().to_numpy(zero_copy_only=False))
    start = batch.column("start").flatten().to_numpy(zero_copy_only=False) + begins[doc]
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + count, -1)
    return np.cumsum(change[:-1]) > 0


def _windows(batch: pa.RecordBatch, size: int, first: bool, last: bool, buckets: int) -> Iterator[blocks.Entries]:
    kinds = _columns(last)
    ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
    for begin, stop, found in word_slices(batch):
        start, doc = found.window_starts(size)
        if not first:
            alive = _alive(batch.slice(begin, stop - begin), found.begins, len(found.start))
            both = alive[start] & alive[start + size // 2]
            start, doc = start[both], doc[both]
        if not len(start):
            continue
        name = Rolling(found.names()).windows(size)[start]
        ident, tag, at = ids[begin:stop][doc], tags[begin:stop][doc], start - found.begins[doc]
        keep, many, later = folded(name, [ident, tag, at])
        order = np.argsort(keep)
        keep, many = keep[order], many[order]
        columns = {"name": name[keep], "many": many, "id": ident[keep], "tag": tag[keep], "at": at[keep]}
        bucket = ((name[keep] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        yield {n: v.astype(kinds[n]) for n, v in columns.items()}, bucket
        (ident, tag), begun, end, begins = spans_per_key([ident[later], tag[later]], at[later], at[later] + (size if last else 1))
        count = np.diff(begins)
        columns = {"done_id": np.repeat(ident, count), "done_tag": np.repeat(tag, count), "done_start": begun, "done_end": end}
        slot = np.full(len(begun), int(name[0] >> np.uint64(40)) % buckets)
        yield {n: v.astype(kinds[n]) for n, v in columns.items()}, slot


def _resolve(batches: Iterator[pa.RecordBatch], size: int, last: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    """Before the last level the windows that are alive; at the last the words that repeated windows cover. Packed for
    the documents' buckets."""
    d = blocks.unpacked(batches, _columns(last))
    keep, several, later = folded(d["name"], [d["id"], d["tag"], d["at"]])
    hit = later if last else np.r_[later, keep[several | (d["many"][keep] > 0)]]
    keys = [np.r_[d["id"][hit], d["done_id"]], np.r_[d["tag"][hit], d["done_tag"]]]
    at = d["at"][hit].astype(np.int64)
    (ident, tag), start, end, begins = spans_per_key(keys, np.r_[at, d["done_start"]], np.r_[at + (size if last else 1), d["done_end"]])
    count = np.diff(begins)
    columns = {"id": np.repeat(ident, count), "tag": np.repeat(tag, count), "start": start, "count": end - start}
    yield from blocks.packed({n: v.astype(_SPANS[n]) for n, v in columns.items()}, blocks.homes(columns["id"], buckets), list(_SPANS))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its spans from all buckets, merged."""
    d = blocks.unpacked(batches, _SPANS)
    (ident, tag), start, end, begins = spans_per_key([d["id"], d["tag"]], d["start"], d["start"] + d["count"])
    lists = [blocks.list_array(x, begins) for x in (start, end - start)]
    yield from blocks.record_batches([pa.array(ident), pa.array(tag), *lists], list(_SPANS))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for begin, stop, found in word_slices(batch):
            data, lists, kept = found.text.tobytes(), [], []
            starts, counts = batch.column("start"), batch.column("count")
            for i in range(begin, stop):
                low, high = found.begins[i - begin], found.begins[i - begin + 1]
                keep = np.ones(high - low, bool)
                span = []
                if starts[i].is_valid:
                    start = starts[i].values.to_numpy().astype(np.int64)
                    start, end = merged(start, start + counts[i].values.to_numpy())
                    for a, b in zip(start.tolist(), end.tolist(), strict=True):
                        keep[a:b] = False
                        span.append({"start": a, "end": b})
                pairs = zip(found.start[low:high][keep].tolist(), found.end[low:high][keep].tolist(), strict=True)
                kept.append(b" ".join([data[a:b] for a, b in pairs]))
                lists.append(span)
            n_words = np.diff(found.begins).astype(np.int64)
            arrays = [batch.column("id").slice(begin, stop - begin), pa.array(n_words), pa.array(lists, spans), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "removed", "kept"])


def remove_repeated_windows(docs: DataFrame, words: int = 20, shortest: int | None = None) -> DataFrame:
    """Cut every word that a window of ``words`` consecutive words covers whose sequence also starts earlier, in any
    document.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Earlier means a smaller ``doc_id``, or an earlier start in the same
    one. Windows are judged on the input and overlap. ``shortest`` is the length of the first level (half of ``words``
    unless given), from which doubling must lead to ``words``. Result: ``doc_id``, ``n_words``, ``removed`` (maximal
    spans of words, ``end`` exclusive) and ``kept`` (the remaining words, joined by one space).

    Null and empty texts have no words; texts of fewer words than a window stay whole; texts of any length are handled
    in memory linear in that one text. A null ``doc_id`` comes before all others. Rows with the same ``doc_id`` and
    text are the same document: none repeats the other. With the same ``doc_id`` and different texts they are ordered
    by a hash of the text. An empty table gives no rows. Other columns are ignored.
    """
    size = shortest or max(1, words // 2)
    if size < 1 or words % size or (words // size) & (words // size - 1):
        raise ValueError(f"doubling {size} does not lead to {words}")
    buckets = blocks.buckets_of(docs)
    texts = keyed(docs)
    rows, first = texts, True
    while True:
        last = size == words
        found = blocks.exchange(
            rows,
            lambda b, size=size, first=first, last=last: _windows(b, size, first, last, buckets),
            list(_columns(last)),
            lambda b, size=size, last=last: _resolve(b, size, last, buckets),
            blocks.packed_schema(list(_SPANS)),
            buckets,
        )
        # One row per document, of few bytes: hashing it spares sorting the texts it is joined to.
        found = blocks.dealt(found, buckets).mapInArrow(_documents, _REPLY).hint("shuffle_hash")
        if last:
            break
        rows, first, size = texts.join(found, KEY), False, size * 2
    schema = "id long, n_words long, removed array<struct<start:int,end:int>>, kept string"
    return texts.join(found, KEY, "left").mapInArrow(_cut, schema).select(doc_id(), "n_words", "removed", "kept")
