"""Operator 8: language ID by interpolated Kneser-Ney character language models.

A word is its letters, lower-cased, between a start and an end mark; each language has a model of order ``ORDER`` over
those symbols, with one absolute discount an order.  The tables of all languages lie side by side: for each order the
sorted 64-bit hashes of the n-grams that any language has seen, with each language's interpolated log-probability, and
the sorted hashes of the contexts with each language's back-off weight.  A text's cross-entropy in a language is the mean
over all its symbols; the lowest names the language.  A symbol's log-probabilities follow from it and the three before it:
each worker numbers these n-grams of a text's symbols, and scores each once while its cache holds it.

Training: all labelled documents whose crc32(doc_id as text) mod 4 is not 2.  Tasks count the n-grams of their words by
language and fold (a hash of doc_id); the driver gets one row for each n-gram of ``ORDER`` symbols (or that opens a word),
language and fold, so its memory follows the model and not the corpus.  Rejection is calibrated on the same rows, all of
them, out of sample: each is scored by models of the other fold (a language that the other fold lacks: of all rows), by
aggregation: a text goes when its cross-entropy lies more than ``SLACK`` times as far above its language's mean as the texts
at quantile ``LEVEL``, measured in standard errors of its own length.

The score is the posterior of a stretch of ``SHARP`` symbols at the text's cross-entropies, whatever the text's length; for
a rejected text it is lowered by how far it passes the limit.

Defined results: ``und`` with score 0 where text is null or has no letter; ties go to the language that sorts first;
without any training row everything is ``und``; rows with null doc_id are never held out; repeated rows are judged row
by row; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHE_ENTRIES, bounded_batches, cut, discard, map_batches, mix64, resident, slices

#: Symbols of the longest n-grams, four at most: they travel in two 64-bit integers.
ORDER = 4
#: Parts of the training rows of which each is scored by models of the others.
FOLDS = 2
MAX_LANGUAGES = 400
SLACK = 1.5
#: Symbols for which a score is the posterior, at the text's mean entropies.
SHARP = 10
#: Quantile of the excess, one text in 400 above it, and the accuracy of its mergeable sketch.
LEVEL, SKETCH = 1 - 1 / 400, 100_000
#: Symbols whose n-grams are numbered at a time, and the most languages whose totals are summed symbol by symbol.
WINDOW, FEW = 1 << 17, 16
GRAMS = "lang string, fold int, high long, low long, n long"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_STEP, _UPPER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_32, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
_OTHER, _LETTER, _SPACE = 0, 1, 2


@functools.cache
def kinds() -> np.ndarray:
    """For each code point whether it is a letter, white space, or something else, which words drop."""
    return np.array([_LETTER if c.isalpha() else _SPACE if c.isspace() else _OTHER for c in map(chr, range(0x110000))], np.uint8)


@dataclass
class Symbols:
    """The symbols of words one after another, with the hash of the n-gram that ends at each (index 0: order 1)."""

    place: np.ndarray
    keys: list[np.ndarray]
    starts: np.ndarray

    @staticmethod
    def of(words: list[str], order: int) -> Symbols:
        size = np.array([len(w) + 2 for w in words], np.int64)
        starts = np.cumsum(size) - size
        s = np.frombuffer("".join([f"\x00{w}\x01" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
        place = np.arange(len(s)) - np.repeat(starts, size)
        keys = [mix64(s + np.uint64(1))]
        for n in range(1, order):
            key = keys[-1].copy()
            if len(key) > n:
                key[n:] = mix64(key[n:] * _STEP + s[:-n] + np.uint64(1))
            keys.append(key)
        return Symbols(place, keys, starts)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys are in a sorted table, and whether they are."""
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


@dataclass
class Model:
    languages: list[str]
    order: int
    unseen: float
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    mean: np.ndarray = field(default=None)
    limit: np.ndarray = field(default=None)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods of words, one column a language, and their numbers of predicted symbols."""
        if not words:
            return np.zeros((0, len(self.languages))), np.zeros(0)
        x = Symbols.of(words, self.order)
        total = self.predict(x.keys, [np.roll(k, 1) for k in x.keys], x.place)
        size = np.diff(np.append(x.starts, len(x.place))) - 1
        return np.add.reduceat(total.astype(np.float64), x.starts, axis=0), size

    def predict(self, keys: list[np.ndarray], before: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        """Log-probabilities of symbols at a place in their word (0: start marks, not predicted), one column a language.

        keys and before are the hashes of the n-grams that end at the symbols and right before them.
        """
        total = np.zeros((len(place), len(self.languages)), np.float32)
        open_ = place >= 1
        for n in range(self.order, 0, -1):
            at = np.flatnonzero(open_ & (place >= n - 1))
            where, hit = find(self.grams[n - 1], keys[n - 1][at])
            total[at[hit]] += self.logp[n - 1][where[hit]]
            open_[at[hit]] = False
            miss = at[~hit]
            if n > 1:
                where, hit = find(self.contexts[n - 1], before[n - 2][miss])
                total[miss[hit]] += self.backoff[n - 1][where[hit]]
            else:
                total[miss] += self.backoff[0][0] + np.float32(self.unseen)
        return total

    def last_symbols(self, four: np.ndarray) -> np.ndarray:
        """Log-probabilities of the last symbol of n-grams as ``Grams`` has them."""
        s = four[:, ::-1].astype(np.uint64)
        place = 1 + np.cumprod(s[:, 1:] > 0, axis=1).sum(axis=1)
        keys, before = [mix64(s[:, 0] + np.uint64(1))], [mix64(s[:, 1] + np.uint64(1))]
        for n in range(1, self.order):
            keys.append(mix64(keys[-1] * _STEP + s[:, n] + np.uint64(1)))
            if n < 3:
                before.append(mix64(before[-1] * _STEP + s[:, n + 1] + np.uint64(1)))
        return self.predict(keys, before, place)


def added(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each n-gram once, with the sum of its counts."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])[: len(high)])
    return high[first], low[first], np.add.reduceat(n[order], first) if len(first) else n


def counted(words: list[str], n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams that end at each symbol of words of letters, from the word's start on if it is nearer than order symbols.

    Two integers hold the last four symbols; a start mark is 0, and so is what lies before it.
    """
    x = Symbols.of(words, 1)
    s = np.frombuffer("".join([f"\x00{w}\x01" for w in words]).encode("utf-32-le"), "<u4").astype(np.int64)
    at = np.flatnonzero(x.place >= 1)
    back = [np.where(x.place[at] >= j, s[np.maximum(at - j, 0)], 0) if j < order else np.zeros(len(at), np.int64) for j in range(4)]
    return added(back[3] << 32 | back[2], back[1] << 32 | back[0], np.repeat(n, np.diff(np.append(x.starts, len(s))) - 1))


def train(words: list[str], counts: np.ndarray, order: int = ORDER, languages: list[str] | None = None) -> Model:
    """Words of letters and how often each language (a column of counts) has them."""
    own = [counted([words[i] for i in some], counts[some, k], order) for k in range(counts.shape[1]) for some in [np.flatnonzero(counts[:, k])]]
    high, low, _ = added(*(np.concatenate([x[i] for x in own]) for i in range(3)))
    return train_grams(high, low, np.stack([spread(high, low, x) for x in own], axis=1), order, list(languages or map(str, range(len(own)))))


def spread(high: np.ndarray, low: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The counts of some n-grams, as a column over all n-grams (sorted by high, low)."""
    order = np.lexsort((np.concatenate([np.zeros(len(high), bool), np.ones(len(own[0]), bool)]), np.concatenate([low, own[1]]), np.concatenate([high, own[0]])))
    out, mine = np.zeros(len(high)), np.flatnonzero(order >= len(high))
    out[order[mine - 1]] = own[2][order[mine] - len(high)]  # an n-gram of some follows itself among all
    return out


def train_grams(high: np.ndarray, low: np.ndarray, counts: np.ndarray, order: int, languages: list[str]) -> Model:
    """The model of n-grams as ``counted`` has them, each once, and how often each language (a column of counts) has them."""
    back = [x.astype(np.uint64) for x in (low & 0xFFFFFFFF, low >> 32, high & 0xFFFFFFFF, high >> 32)]
    width = np.minimum(order, 1 + sum((x > 0).astype(np.int64) for x in back))
    keys, context = [mix64(back[0] + np.uint64(1))], [mix64(back[1] + np.uint64(1))]
    for n in range(1, order):
        keys.append(mix64(keys[-1] * _STEP + back[n] + np.uint64(1)))
        if n < 3:
            context.append(mix64(context[-1] * _STEP + back[n + 1] + np.uint64(1)))
    # shorter n-grams that open a word count as they are, others by the symbols seen before them
    levels, rows, c = [], np.zeros(0, np.int64), np.zeros((0, len(languages)))
    for n in range(order, 0, -1):
        own = np.flatnonzero(width == n)
        rows, c = np.concatenate([rows, own]), np.vstack([c > 0, counts[own]])
        grams, first, inverse = np.unique(keys[n - 1][rows], return_index=True, return_inverse=True)
        rows, c = rows[first], np.stack([np.bincount(inverse, x, len(grams)) for x in c.T], axis=1)
        levels.append((n, grams, rows, c))
    unseen = -np.log(len(levels[-1][1]) + 1.0)
    model = Model(languages, order, unseen, [], [], [], [])
    below = None
    for n, grams, rows, count in reversed(levels):
        contexts, of_context = np.unique(context[n - 2][rows], return_inverse=True) if n > 1 else (np.zeros(1, np.uint64), np.zeros(len(rows), np.int64))
        p, lam = np.zeros(count.shape), np.ones((len(contexts), len(languages)))
        for k, c in enumerate(count.T):
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total = np.bincount(of_context, c, len(contexts))
            kinds = np.bincount(of_context, c > 0, len(contexts))
            some = total > 0
            lam[some, k] = d * kinds[some] / total[some]
            p[:, k] = np.maximum(c - d, 0) / np.maximum(total, 1e-300)[of_context]
        lower = np.full(count.shape, np.exp(unseen)) if below is None else below[1][np.searchsorted(below[0], keys[n - 2][rows])]
        p += lam[of_context] * lower
        below = grams, p
        model.grams.append(grams)
        model.logp.append(np.log(p).astype(np.float32))
        model.contexts.append(contexts)
        model.backoff.append(np.log(lam).astype(np.float32))
    return model


def grown(a: np.ndarray, n: int) -> np.ndarray:
    """a, or a longer copy of it whose last axis has n places at least."""
    return a if a.shape[-1] >= n else np.concatenate([a, np.zeros((*a.shape[:-1], max(n, 2 * a.shape[-1]) - a.shape[-1]), a.dtype)], axis=-1)


class Grams:
    """Numbers, from 1 on, the n-grams of four symbols that end at each symbol of texts; ``learn`` gets each that is new.

    A symbol is a lower-cased letter or the end of a word (1); start marks and what lies before them are 0.  A table of
    slots finds most numbers at once; n-grams that share a slot with another are found by their text.
    """

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.keys = np.zeros(1024, np.uint64)
        bits = max(10, (8 * self.entries).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.zeros(1 << bits, np.int32)

    def learn(self, four: np.ndarray, number: np.ndarray) -> None:
        """New n-grams (code points, the last symbol last) and their numbers, which follow those before."""

    @staticmethod
    def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The code points of all texts' letters, with 0 after each word, and how many symbols each text has."""
        lower = [t.lower() for t in texts]
        points = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le"), "<u4")
        kind = kinds()[points]
        there = kind != _OTHER
        c = (points * (kind == _LETTER))[there]
        ends = c != 0
        ends[1:] |= c[:-1] != 0
        there[there] = ends.copy()
        size = np.fromiter(map(len, lower), np.int64, len(lower)) + 1
        return c[ends], np.add.reduceat(there, np.cumsum(size) - size, dtype=np.int64)

    def windows(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers of n-grams, texts that they are of, first place of each) for whole texts, or for pieces of a long one."""
        if not texts:
            return
        c, size = self.symbols(texts)
        c, end, some = np.concatenate([np.zeros(3, c.dtype), c]), np.cumsum(size), np.flatnonzero(size)
        first, last, i = (end - size)[some], end[some], 0
        while i < len(some):
            j = max(i + 1, int(np.searchsorted(last, first[i] + WINDOW, side="right")))
            for a in range(first[i], last[j - 1], WINDOW):
                yield self.rows(c[a : min(a + WINDOW, last[j - 1]) + 3]), some[i:j], first[i:j] - first[i]
            i = j

    def rows(self, c: np.ndarray) -> np.ndarray:
        """Numbers of the n-grams that end at the symbols of c, of which the first three only lead the others."""
        x = c.astype(np.uint64)
        pair = x[:-1] << _32 | x[1:]
        upper, lower = pair[:-2] * ((x[1:-2] != 0) & (x[2:-1] != 0)), pair[2:]
        key = lower + upper * _UPPER
        slot = (key * _STEP >> self.shift).view(np.int64)
        row = self.slots[slot]
        miss = np.flatnonzero(self.keys[row] != key)
        if not len(miss):
            return row
        _, at, inverse = np.unique(key[miss], return_index=True, return_inverse=True)
        at = miss[at]
        four = np.stack([upper[at] >> _32, upper[at] & _LOW, lower[at] >> _32, np.maximum(lower[at] & _LOW, 1)], axis=1).astype("<u4")
        text = four.tobytes().decode("utf-32-le")
        names = [text[i : i + 4] for i in range(0, len(text), 4)]
        new = [i for i, w in enumerate(names) if w not in self.row]
        if self.row and len(self.row) + len(new) > self.entries:
            self.forget()
            return self.rows(c)
        if new:
            number = np.arange(len(self.row) + 1, len(self.row) + 1 + len(new), dtype=np.int32)
            self.keys = grown(self.keys, int(number[-1]) + 1)
            self.keys[number] = key[at[new]]
            self.row.update(zip([names[i] for i in new], number.tolist(), strict=True))
            free = self.slots[slot[at[new]]] == 0
            self.slots[slot[at[new]][free]] = number[free]
            self.learn(four[new], number)
        row[miss] = np.array([self.row[w] for w in names], np.int32)[inverse]
        return row


class Judge(Grams):
    """Scores texts, each n-gram once while the cache holds it; one for each worker."""

    def __init__(self, model: Model, entries: int = CACHE_ENTRIES):
        self.model = model
        super().__init__(entries)

    def forget(self) -> None:
        super().forget()
        self.table = np.zeros((len(self.model.languages), 1024))

    def learn(self, four: np.ndarray, number: np.ndarray) -> None:
        self.table = grown(self.table, int(number[-1]) + 1)
        self.table[:, number] = self.model.last_symbols(four).T

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods of texts by language and their numbers of symbols (0: no letter)."""
        out, n = np.zeros((len(texts), len(self.table))), np.zeros(len(texts))
        for row, of, first in self.windows(texts):
            ends = np.append(first[1:], len(row))
            n[of] += ends - first
            if len(self.table) <= FEW:
                for k, logp in enumerate(self.table):
                    out[of, k] += np.add.reduceat(logp[row], first)
            else:
                for i, a, b in zip(of.tolist(), first.tolist(), ends.tolist(), strict=True):
                    some, count = np.unique(row[a:b], return_counts=True)
                    out[i] += self.table[:, some] @ count
        return out, n

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1: und), score, and whether calibrated rejection lets the text go."""
        if not self.model.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        ll, n = self.totals(texts)
        mean = ll / np.maximum(n, 1)[:, None]  # minus the cross-entropies
        best = mean.argmax(axis=1)
        high = mean[np.arange(len(ll)), best]
        with np.errstate(under="ignore"):
            score = 1 / np.exp(SHARP * (mean - high[:, None])).sum(axis=1)
        some = n > 0
        rejected = ~some
        if self.model.limit is not None:
            excess = (-high - self.model.mean[best]) * np.sqrt(n)
            rejected |= excess > self.model.limit[best]
            score = np.where(excess > self.model.limit[best], score * self.model.limit[best] / np.maximum(excess, 1e-9), score)
        return np.where(some, best, -1), np.where(some, score, 0.0), rejected


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Tally(Grams):
    """Counts of the n-grams of groups of texts."""

    def __init__(self, order: int, entries: int = CACHE_ENTRIES):
        self.order, self.held = order, {}
        self.counts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        super().__init__(entries)

    def forget(self) -> None:
        self.settle()
        super().forget()
        self.four = np.zeros((4, 1024), np.int64)

    def learn(self, four: np.ndarray, number: np.ndarray) -> None:
        self.four = grown(self.four, int(number[-1]) + 1)
        self.four[:, number] = four.T

    def add(self, group: tuple[str, int], texts: list[str]) -> None:
        for row, _, _ in self.windows(texts):
            n = np.bincount(row)
            before = grown(self.held.get(group, n[:0]), len(n))
            before[: len(n)] += n
            self.held[group] = before
        if sum(map(len, self.held.values())) > 16 * self.entries:
            self.settle()

    def settle(self) -> None:
        """Counts by numbers become counts by symbols, which outlive the numbers."""
        for group, n in self.held.items():
            some = np.flatnonzero(n)
            four = self.four[:, some] * (np.arange(4) >= 4 - self.order)[:, None]
            own = four[0] << 32 | four[1], four[2] << 32 | four[3], n[some]
            self.counts[group] = added(*map(np.concatenate, zip(self.counts[group], own, strict=True))) if group in self.counts else added(*own)
        self.held.clear()


def count_grams(order: int, entries: int = CACHE_ENTRIES):
    """Counts of a task's n-grams by language and fold; the n-gram -1, -1 counts its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: Counter = Counter()
        tally = Tally(order, entries)
        for batch in slices(batches, "text"):
            groups: dict[tuple[str, int], list[str]] = {}
            for lang, text, fold in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "fold")), strict=True):
                groups.setdefault((lang, fold), []).append(text)
            for group, texts in groups.items():
                number[group] += len(texts)
                tally.add(group, texts)
        tally.settle()
        for (lang, fold), n in number.items():
            own = tally.counts.get((lang, fold), [np.zeros(0, np.int64)] * 3)
            high, low, c = (np.append(x, y) for x, y in zip(own, (-1, -1, n), strict=True))
            columns = [pa.array([lang] * len(c), pa.string()), pa.array(np.full(len(c), fold, np.int32)), pa.array(high), pa.array(low), pa.array(c.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "fold", "high", "low", "n"])

    return run


def fit(docs: DataFrame, order: int = ORDER) -> Model:
    """The model of docs(doc_id, text, lang), learned from and calibrated on all labelled rows that aren't held out."""
    bounded_batches(docs.sparkSession)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(FOLDS)).cast("int").alias("fold")
    rows = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out()).select("lang", "text", fold)
    table = cut(rows.mapInArrow(count_grams(order), GRAMS).groupBy("lang", "fold", "high", "low").agg(F.sum("n").alias("n")), "language-grams")
    languages = sorted(r.lang for r in table.where("high < 0").select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        discard(table)
        return Model([], order, 0.0, [], [], [], [])
    own = {}
    for k, lang in enumerate(languages):
        got = table.where((F.col("lang") == lang) & (F.col("high") >= 0)).select("fold", "high", "low", "n").toArrow()
        part, *columns = (got.column(c).to_numpy() for c in ("fold", "high", "low", "n"))
        own |= {(k, i): tuple(x[part == i] for x in columns) for i in range(FOLDS)}
    discard(table)
    high, low, _ = added(*(np.concatenate([x[i] for x in own.values()]) for i in range(3)))
    counts = np.stack([np.stack([spread(high, low, added(*own[k, i])) for k in range(len(languages))], axis=1) for i in range(FOLDS)])
    model = train_grams(high, low, counts.sum(axis=0), order, languages)

    # calibration: means and spreads of rows by models that haven't seen them
    others = counts.sum(axis=0) - counts
    others = np.where(others.any(axis=1, keepdims=True), others, counts.sum(axis=0))
    apart = [train_grams(high, low, c, order, languages) for c in others]
    sent, key = docs.sparkSession.sparkContext.broadcast(apart), uuid.uuid4().hex

    def entropy(batch: pa.RecordBatch) -> pa.RecordBatch:
        judges = resident(("language_id", key), lambda: [Judge(m, CACHE_ENTRIES // FOLDS) for m in sent.value])
        texts, of = batch.column("text").to_pylist(), batch.column("fold").to_numpy()
        ll, m = np.zeros((len(texts), len(languages))), np.zeros(len(texts))
        for i, judge in enumerate(judges):
            at = np.flatnonzero(of == i)
            ll[at], m[at] = judge.totals([texts[j] for j in at.tolist()])
        best = ll.argmax(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(best, pa.int32()), pa.array(-ll[np.arange(len(ll)), best] / np.maximum(m, 1)), pa.array(m)], names=["k", "ce", "m"])

    told = cut(map_batches(rows.select("text", "fold"), entropy, "k int, ce double, m double").where("m > 0"), "language-entropy")
    model.mean, model.limit = np.zeros(len(languages)), np.full(len(languages), np.inf)
    for r in told.groupBy("k").agg((F.sum(F.col("ce") * F.col("m")) / F.sum("m")).alias("mean")).collect():
        model.mean[r.k] = r.mean
    mean = F.element_at(F.array(*map(F.lit, model.mean.tolist())), F.col("k") + 1)
    excess = (F.col("ce") - mean) * F.sqrt("m")
    for r in told.groupBy("k").agg(F.percentile_approx(excess, LEVEL, SKETCH).alias("high")).collect():
        model.limit[r.k] = SLACK * max(r.high, 1.0)
    discard(told)
    return model


def worker_judge(key: str, sent: Broadcast) -> Judge:
    """The worker's one judge of a broadcast model."""
    return resident(("language_id", key), lambda: Judge(sent.value))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, lang_score and rejected beside its columns; clashing names are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "rejected")]
    docs = docs.select(kept)
    sent, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judge = worker_judge(key, sent)
        best, score, rejected = judge.judge([t or "" for t in batch.column("text").to_pylist()])
        names = [*judge.model.languages, "und"]
        columns = [pa.array([names[i] for i in best], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, "lang_pred", "lang_score", "rejected"])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, *T.StructType.fromDDL("lang_pred string, lang_score double, rejected boolean")]))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
