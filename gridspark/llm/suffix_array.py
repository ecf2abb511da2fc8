"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np


def packed(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; behind the end are zeros."""
    out = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    for step in (1, 2, 4):
        nxt = np.concatenate([out[step:], np.zeros(step, np.uint64)])
        out = (out << np.uint64(8 * step)) | nxt
    return out[: len(text)]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the text in the order of the suffixes that start there.

    After each round places are ranked by h characters; only groups of equal rank are sorted again, by the rank of what
    lies h further on.
    """
    n = len(text)
    key = packed(text)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = first
    h = 8
    while h < 2 * n:
        last = np.append(new[1:], True)
        open_ = np.flatnonzero(~(new & last))  # members of groups of two or more
        if not len(open_):
            break
        at = order[open_]
        key = first[open_] * (n + 1) + rank[np.minimum(at + h, n)] + 1
        again = np.argsort(key, kind="stable")
        order[open_], key = at[again], key[again]
        new[open_[1:]] |= key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = first
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, chain: int = 256) -> np.ndarray:
    """For each entry of the suffix array, the characters (up to depth) that it shares with the entry before it.

    Kasai's walk in text order, where a place shares at least one less than the place before it; the text is cut into
    chains that walk side by side, each from nothing.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    start = np.arange(0, n, chain)
    have = np.zeros(len(start), np.int64)
    for s in range(min(chain, n)):
        at = start + s
        there = at < n
        at, have = at[there], have[: there.sum()]
        other = before[at]
        have = np.where(other < 0, 0, np.maximum(have - 1, 0))
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            i, j = at[grow] + have[grow], other[grow] + have[grow]
            ok = (have[grow] < depth) & (i < n) & (j < n)
            grow, i, j = grow[ok], i[ok], j[ok]
            grow = grow[text[i] == text[j]]
            have[grow] += 1
        out[at] = have
    return out[order]
