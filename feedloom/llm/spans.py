"""Covers of positions by spans, per document."""

from __future__ import annotations

import numpy as np


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, ascending spans ``[start, end)`` that cover the same positions; touching spans become one."""
    if not len(start):
        return start.astype(np.int64), end.astype(np.int64)
    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), np.maximum.accumulate(end[order].astype(np.int64))
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], np.r_[end[:-1][new[1:]], end[-1]]


def spans_per_key(keys: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Merged spans per combination of keys: the keys of each, starts, ends, and where each one's spans begin in these."""
    if not len(start):
        return [k[:0] for k in keys], start.astype(np.int32), end.astype(np.int32), np.zeros(1, np.int64)
    order = np.lexsort((start, *keys[::-1]))
    keys, start, end = [k[order] for k in keys], start[order].astype(np.int64), end[order].astype(np.int64)
    fresh = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
    group = np.cumsum(fresh) - 1
    # Shift each group beyond the one before it, and the running maximum of ends stays within the group.
    width = int(end.max()) + 2
    start, end = start + group * width, np.maximum.accumulate(end + group * width)
    new = np.r_[True, start[1:] > end[:-1]]
    group, start, end = group[new], start[new], np.r_[end[:-1][new[1:]], end[-1]]
    starts = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group)]
    return [k[fresh] for k in keys], (start - group * width).astype(np.int32), (end - group * width).astype(np.int32), starts
