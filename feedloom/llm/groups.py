"""Groups of equal names in arrays."""

from __future__ import annotations

import numpy as np


def folded(name: np.ndarray, place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first entry of each name by place, whether the name is at several places, and the entries at later places.

    Entries equal in name and place are one; only names that occur more than once are sorted by place.
    """
    n = len(name)
    order = np.argsort(name, kind="stable")
    ranked = name[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]] if n else np.empty(0, bool)
    alone = fresh & np.r_[fresh[1:], True] if n else fresh
    single, rest = order[alone], order[~alone]
    if not len(rest):
        return single, np.zeros(len(single), bool), rest
    rest = rest[np.lexsort((*[p[rest] for p in place[::-1]], name[rest]))]
    fresh = np.r_[True, name[rest][1:] != name[rest][:-1]]
    group = np.cumsum(fresh) - 1
    first = rest[fresh]
    later = np.any([p[rest] != p[first][group] for p in place], axis=0)
    several = np.zeros(len(first), bool)
    several[group[later]] = True
    return np.r_[single, first], np.r_[np.zeros(len(single), bool), several], rest[later]
