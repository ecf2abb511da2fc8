"""Texts as arrays of word hashes, and their five-word shingles."""

from __future__ import annotations

import functools

import numpy as np
import regex

from .common import mix64

SHINGLE = 5
#: Characters whose words are hashed at a time.
PIECE = 1 << 20
_ALNUM = regex.compile(r"[\p{L}\p{N}\p{M}]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER, _KEPT, _SPACE = 0, 1, 2


@functools.cache
def kinds() -> np.ndarray:
    """For each code point whether it is a letter, mark or digit, white space, or something else."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for m in _ALNUM.finditer(every):
        a, b = (ord(every[i]) for i in (m.start(), m.end() - 1))
        out[a : b + 1] = _KEPT
    out[0xD800:0xE000] = _OTHER
    out[[i for i in range(0x3001) if chr(i).isspace()]] = _SPACE
    return out


@functools.lru_cache(maxsize=4)
def powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    return np.cumprod(np.full(n, _STEP), dtype=np.uint64)


class Words:
    """Texts to arrays of 64-bit hashes of lower-cased words; what is no letter, mark or digit is dropped.

    A word's hash is a polynomial in its characters, made for all words of a piece of text at once.
    """

    def hashes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' hashes one after another, and how many each text has."""
        lower = [t.lower() for t in texts]
        points = np.frombuffer(" ".join(lower).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in lower], dtype=np.int64)
        out, starts, a = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while a < len(points):
            b = min(a + PIECE, len(points))
            kind = kinds()[points[a:b]]
            while b < len(points) and not (gaps := np.flatnonzero(kind == _SPACE)).size:
                # a word longer than a piece
                b = min(b + (b - a), len(points))
                kind = kinds()[points[a:b]]
            if b < len(points):
                b = a + int(gaps[-1]) + 1
                kind = kind[: b - a]
            h, start = self.piece(points[a:b], kind)
            out.append(h)
            starts.append(start + a)
            a = b
        h, start = np.concatenate(out), np.concatenate(starts)
        return h, np.bincount(np.searchsorted(ends, start, side="right"), minlength=len(texts)).astype(np.int64)

    @staticmethod
    def piece(points: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words, and the place of each one's first character that counts."""
        kept = np.flatnonzero(kind == _KEPT)
        if not len(kept):
            return np.zeros(0, np.uint64), kept
        word = np.cumsum(kind == _SPACE, dtype=np.int32)[kept]
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(first, len(kept)))
        inner = np.arange(len(kept)) - np.repeat(first, size)
        longest = 1 << int(size.max() - 1).bit_length()
        h = np.add.reduceat(mix64(points[kept].astype(np.uint64) + np.uint64(1)) * powers(max(64, longest))[inner], first)
        return np.maximum(mix64(h), np.uint64(1)), kept[first]


@functools.cache
def worker_words() -> Words:
    return Words()


def shingles(h: np.ndarray, size: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each text, and the text of each; a text of fewer words is one run."""
    of = np.repeat(np.arange(len(size)), size)
    end = np.cumsum(size)[of]
    at = np.arange(len(h))
    out, width = np.zeros(len(h), np.uint64), np.minimum(k, size[of])
    for j in range(k):
        there = j < width
        out = np.where(there, out * _STEP + h[np.minimum(at + j, len(h) - 1)], out) if len(h) else out
    ok = at + width <= end
    return mix64(out[ok]), of[ok]


def multiset(shingle: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within it: (shingle, text, count)."""
    order = np.lexsort((shingle, of))
    s, t = shingle[order], of[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    return s[first], t[first], np.diff(np.append(first, len(s)))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted shingles, counts)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = np.where(b[0][at] == a[0], np.minimum(a[1], b[1][at]), 0).sum()
    return float(both) / float(a[1].sum() + b[1].sum() - both)
