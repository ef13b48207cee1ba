"""Words of many texts at once, as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from feedloom.llm import blocks
from feedloom.llm.rolling import BYTE_VALUES, Rolling

#: Bytes that end a word: blank and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Words of more bytes than this are named by XXH64. Polynomials modulo 2**64 are no good for them: there are pairs of strings of 1024 bytes
#: that have one name whatever the base, and for a few hundred bytes some pairs differ in the upper bits only.
LONG = 32


def word_names(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name of each word ``text[start:end]``; equal words have equal names, in any text."""
    out = Rolling(BYTE_VALUES[text]).names(start, end)
    for i in np.flatnonzero(end - start > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(text[start[i] : end[i]].tobytes())
    return out


@dataclass
class Words:
    """Words of one slice: the bytes, where each word starts and ends, and where each document's words begin."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    begins: np.ndarray

    def names(self) -> np.ndarray:
        return word_names(self.text, self.start, self.end)

    def window_starts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every window of ``size`` words inside one document: its first word, and the document."""
        counts = np.maximum(np.diff(self.begins) - size + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        return self.begins[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts), doc


def words(text: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Words of consecutive texts; none runs over from one text to the next."""
    n = len(text)
    inside = ~space[text]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]][:n] | edge[:n]))
    end = np.flatnonzero(inside & (np.r_[~inside[1:], True][:n] | edge[1:])) + 1
    return Words(text, start, end, np.searchsorted(start, offsets))


def word_slices(batch: pa.RecordBatch, column: str = "text"):
    """Row ranges of a batch with their words."""
    buffer, offsets = blocks.text_offsets(batch.column(column))
    for begin, stop in blocks.slices(batch.column(column)):
        yield begin, stop, words(buffer[offsets[begin] : offsets[stop]], offsets[begin : stop + 1] - offsets[begin])
