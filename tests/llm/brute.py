"""Plain versions to hold the operators against."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np

from gridspark.llm.words import Words, shingles


def near_components(rows, similarity=0.8):
    """doc_id -> smallest doc_id that links of multiset overlap reach."""
    words, bags = Words(), {}
    for i, t in rows:
        h, size = words.hashes([t or ""])
        if len(h):
            bags[i] = Counter(shingles(h, size)[0].tolist())
    inside = defaultdict(list)
    for i, b in bags.items():
        for x in b:
            inside[x].append(i)
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, b in bags.items():
        for j in {j for x in b for j in inside[x] if j < i}:
            both = sum((b & bags[j]).values())
            if both >= similarity * (b.total() + bags[j].total() - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def without_repeats(rows, length=100):
    """doc_id -> (bytes, removed, spans, sha256 of the rest), rows in order."""
    seen, out = set(), {}
    for i, t in rows:
        x = (t or "").encode()
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - length + 1):
            if (g := x[p : p + length]) in seen:
                gone[p : p + length] = True
            seen.add(g)
        left = bytes(b for b, d in zip(x, gone, strict=True) if not d)
        out[i] = len(x), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(left).hexdigest()
    return out


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


class KneserNey:
    """Interpolated Kneser-Ney over the symbols of words (a start mark, letters, an end mark), by dictionaries; words: word -> count."""

    def __init__(self, words, order, symbols):
        self.order, self.floor = order, 1 / (symbols + 1)
        self.counts = [None] * (order + 1)
        for n in range(1, order + 1):
            c, wider = Counter(), set()
            for w, k in words.items():
                if not k:
                    continue
                s = f"\0{w}\1"
                for end in range(max(1, n - 1), len(s)):
                    gram = s[end - n + 1 : end + 1]
                    if n == order or end == n - 1:
                        c[gram] += k
                    if n < order and end >= n:
                        wider.add(s[end - n : end + 1])
            for g in wider:
                c[g[1:]] += 1
            self.counts[n] = c
        self.discount, self.total, self.kinds = [0] * (order + 1), [None] * (order + 1), [None] * (order + 1)
        for n in range(1, order + 1):
            once, twice = (sum(v == k for v in self.counts[n].values()) for k in (1, 2))
            self.discount[n] = once / (once + 2 * twice) if once and twice else 0.5
            self.total[n], self.kinds[n] = Counter(), Counter()
            for g, v in self.counts[n].items():
                self.total[n][g[:-1]] += v
                self.kinds[n][g[:-1]] += 1

    def p(self, gram):
        n = len(gram)
        if not n:
            return self.floor
        lower = self.p(gram[1:])
        total = self.total[n][gram[:-1]]
        if not total:
            return lower
        d = self.discount[n]
        return max(self.counts[n][gram] - d, 0) / total + d * self.kinds[n][gram[:-1]] / total * lower

    def score(self, word):
        s = f"\0{word}\1"
        return sum(np.log(self.p(s[max(0, end - self.order + 1) : end + 1])) for end in range(1, len(s)))
