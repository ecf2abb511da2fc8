"""Operator 10: benchmark decontamination by latent semantic retrieval.

Passages are windows of words (``WINDOWS`` sizes, every ``BLOCK`` words, over whole texts).  Each word of the benchmark is a
feature of its own; all others are hashed to ``DIMS`` features.  Document frequencies are counted over all documents,
outside the runs of ``GRAM`` words that they share with an item, lest a leak make its own words frequent.  A benchmark word
always weighs something (``FLOOR`` at least), however frequent it is; a hashed feature of more than ``STOP`` of the documents
(and of more than ``STOP_LEAST``) weighs nothing and does not count in a window: it is in no item.  The leading right singular
vectors of the TF-IDF matrix of all passages of ``BLOCK`` words, those of all documents and of the benchmark, come from a
one-pass randomised sketch (Nystrom): tasks sum up how often features share a passage, folded by random signs into
``WIDE`` columns, in whole numbers, so that their order changes nothing.  Each vector is divided by its singular value, lest a
few directions (the language above all) decide every cosine.  The pass reads features that the first one has written.  Passages whose cosine with a benchmark passage reaches ``COSINE`` are candidates.
So is, whatever its words weigh, every place of a document that shares a run of ``GRAM`` words with an item (all of a
shorter item); its cosine is 0 where no passage led there.  A candidate is confirmed where the longest common subsequence
of words covers ``OVERLAP`` of the item (in its neighbourhood in the document) and enough of the item's rarest words, which
stand for its answer, occur there.  Documents that lack those words for every item can confirm nothing; they are known by
look-ups, and only the others are projected.

The benchmark is broadcast; the numbers of its items and words are checked.  Defined results: null or empty texts and items
without words match nothing; an item of frequent words alone is searched like any other; an item may match several
documents and a document several items (one row each, with the best place); items that repeat an item_id or a text give a
row each; repeated rows are judged row by row, those with null doc_id too; an item whose parts a document holds in
another order shares only the longest part in order; an empty table on either side gives an empty result; other columns
are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, cut, discard, mix64, slices, trim
from .words import _STEP, Words, worker_words

#: Hashed features, singular vectors, columns of the sketch, and what its weights are multiplied by to be whole numbers.
DIMS, RANK, WIDE, WHOLE = 1 << 16, 64, 96, 256
#: Pieces of the sketch that travel as rows.
PIECES = 64
#: Words between the starts of passages, and the lengths of passages in such steps; stop words don't count.
BLOCK, WINDOWS = 5, (2, 4, 8)
#: Items of fewer words than this fill less of a passage; their least cosine is lower by the root of their share.
SHORT = 16
#: Words of an item's passages; longer items have several, which overlap by half.
ITEM_PASSAGE = 32
COSINE, OVERLAP, RARE, RARE_SHARE = 0.4, 0.6, 6, 0.5
#: Hashed features of more than this share of the documents, and of more than so many, weigh nothing.
STOP, STOP_LEAST = 0.05, 20
#: The least weight of a benchmark's word.
FLOOR = 0.05
#: Words of the runs that an item and a document have in common, and slots of the table that drops most other runs early.
GRAM, SLOTS = 5, 1 << 20
#: The benchmark's size is checked against these: items, words in all, different words.
MAX_ITEMS, MAX_LENGTH, MAX_WORDS = 100_000, 4_000_000, 400_000
SLICE = 1 << 20
#: Cosines that a task holds at a time.
PRODUCT = 1 << 22
CODED = "f binary, feature int, n long"
SCHEMA = "doc_id long, item_id long, overlap double, cosine double, start_word long"


@dataclass
class Features:
    """Words to features: a benchmark's (sorted hashes) are numbered from 0, others hashed to the numbers behind them."""

    words: np.ndarray

    @property
    def size(self) -> int:
        return len(self.words) + DIMS

    def of(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, len(self.words) + (h & np.uint64(DIMS - 1)).astype(np.int64))


def telling(f: np.ndarray, size: np.ndarray, tells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features that weigh anything, how many each text has, and their places among all words."""
    at = np.flatnonzero(tells[f])
    of = np.repeat(np.arange(len(size)), size)[at]
    return f[at], np.bincount(of, minlength=len(size)), at


def passages(table: np.ndarray, f: np.ndarray, size: np.ndarray, windows: tuple[int, ...] = WINDOWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the table's rows of the features in each window, the window's first word within its text, and its text's number."""
    n_blocks = -(-size // BLOCK)
    first_word, first_block = np.cumsum(size) - size, np.cumsum(n_blocks) - n_blocks
    of = np.repeat(np.arange(len(size)), n_blocks)
    start = (np.arange(len(of)) - first_block[of]) * BLOCK
    sums, at, left = np.zeros((len(of), table.shape[1]), np.float32), first_word[of] + start, size[of] - start
    for j in range(BLOCK if len(of) else 0):
        row = np.take(table, f[np.minimum(at + j, len(f) - 1)], axis=0)
        if (short := left <= j).any():
            row[short] = 0
        sums += row
    upto = np.vstack([np.zeros((1, table.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
    end = (first_block + n_blocks)[of]
    at = np.arange(len(of))
    out = [(upto[np.minimum(at + m, end)] - upto[at]).astype(np.float32) if m > 1 else sums for m in windows]
    return np.vstack(out), np.tile(start, len(windows)), np.tile(of, len(windows))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; masks: places of each word of the item of n words."""
    full = (1 << n) - 1
    row = full
    for w in words:
        if (m := masks.get(w)) is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def runs(h: np.ndarray, size: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words within the texts, and the place of each among all words."""
    at = np.arange(max(len(h) - k + 1, 0))
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = out * _STEP + h[j : len(at) + j]
    ok = at + k <= np.repeat(np.cumsum(size), size)[: len(at)]
    return mix64(out[ok]), at[ok]


@dataclass
class Grams:
    """The items' runs of GRAM words (an item of fewer words is one run), by length: sorted hashes, item, place in the item."""

    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(h: np.ndarray, size: np.ndarray) -> Grams:
        tables, first = {}, np.cumsum(size) - size
        of = np.repeat(np.arange(len(size)), size)
        for k in sorted(set(np.minimum(size[size > 0], GRAM).tolist())):
            run, at = runs(h, size, k)
            fits = np.minimum(size[of[at]], GRAM) == k
            run, at = run[fits], at[fits]
            # a run that an item repeats leads to its first place
            order = np.lexsort((at, of[at], run))
            run, at = run[order], at[order]
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (of[at[1:]] != of[at[:-1]])
            run, at = run[new], at[new]
            slot = np.zeros(SLOTS, bool)
            slot[(run & np.uint64(SLOTS - 1)).astype(np.int64)] = True
            tables[k] = run, of[at], at - first[of[at]], slot
        return Grams(tables)

    def hits(self, h: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: it, the places of common runs among all words, and the first and last row of the table for each."""
        for k, (table, _, _, slot) in self.tables.items():
            run, at = runs(h, size, k)
            likely = slot[(run & np.uint64(SLOTS - 1)).astype(np.int64)]
            run, at = run[likely], at[likely]
            low, high = np.searchsorted(table, run), np.searchsorted(table, run, "right")
            some = high > low
            yield k, at[some], low[some], high[some]

    def covered(self, h: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which words lie in a run of an item."""
        out = np.zeros(len(h), bool)
        for k, at, _, _ in self.hits(h, size):
            for j in range(k):
                out[at + j] = True
        return out

    def places(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text's number, item's number, where in the text the item would begin), each once in BLOCK words."""
        out, first = [np.zeros((0, 3), np.int64)], np.cumsum(size) - size
        of = np.repeat(np.arange(len(size)), size)
        for k, at, low, high in self.hits(h, size):
            _, item, place, _ = self.tables[k]
            n = high - low
            row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
            at = np.repeat(at, n)
            out.append(np.stack([of[at], item[row], at - first[of[at]] - place[row]], axis=1))
        every = np.vstack(out)
        _, one = np.unique(np.column_stack([every[:, :2], every[:, 2] // BLOCK]), axis=0, return_index=True)
        return tuple(every[one].T)


@dataclass
class Item:
    item_id: int
    n: int
    masks: dict[int, int]
    rare: list[int]

    @staticmethod
    def of(item_id: int, h: np.ndarray, weights: np.ndarray) -> Item:
        words, masks = h.tolist(), {}
        for i, w in enumerate(words):
            masks[w] = masks.get(w, 0) | 1 << i
        weight = dict(zip(words, weights.tolist(), strict=True))
        return Item(item_id, len(words), masks, sorted(masks, key=lambda w: (-weight[w], w))[:RARE])

    def answered(self, have: set[int]) -> bool:
        """Whether enough of its rare words are there."""
        return sum(w in have for w in self.rare) >= RARE_SHARE * len(self.rare)

    def overlap(self, words: list[int]) -> float:
        """Share of the item in the longest common subsequence; 0 where its rare words are missing."""
        if not self.answered(set(words)):
            return 0.0
        return common_subsequence(self.masks, self.n, words) / self.n


@dataclass
class Answers:
    """The items' rarest words by feature: which items each belongs to, and how many of them each item needs."""

    number: np.ndarray
    first: np.ndarray
    items: np.ndarray
    need: np.ndarray

    @staticmethod
    def of(items: list[Item], features: Features) -> Answers:
        pairs = np.array([(f, i) for i, x in enumerate(items) if x.rare for f in features.of(np.array(x.rare, np.uint64)).tolist()], np.int64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        words, first = np.unique(pairs[:, 0], return_index=True)
        number = np.full(len(features.words), -1)
        number[words] = np.arange(len(words))
        return Answers(number, np.append(first, len(pairs)), pairs[:, 1], np.array([int(np.ceil(RARE_SHARE * len(x.rare))) for x in items], np.int64))

    def hopeful(self, f: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sorted numbers text * items + item of the pairs in which the text holds enough of the item's rarest words."""
        at = np.flatnonzero(f < len(self.number))
        number = self.number[f[at]]
        at, number = at[number >= 0], number[number >= 0]
        of = np.repeat(np.arange(len(size)), size)[at]
        pair = np.unique(of * np.int64(len(self.first)) + number)
        of, number = np.divmod(pair, len(self.first))
        n = self.first[number + 1] - self.first[number]
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.first[number], n)
        item = self.items[row]
        pair, n = np.unique(np.repeat(of, n) * np.int64(len(self.need)) + item, return_counts=True)
        return pair[n >= self.need[pair % len(self.need)]]


@dataclass
class Index:
    """The projection (and which features weigh anything) and the benchmark in it: passage rows, the item of each, and the items."""

    features: Features
    tells: np.ndarray
    table: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    item_of: np.ndarray
    items: list[Item]
    answers: Answers
    grams: Grams


def coded(docs: DataFrame, grams: Grams, features: Features) -> DataFrame:
    """The features of the words of each document, and in how many documents of a task each feature occurs outside the items' runs (-1: documents)."""
    sent = docs.sparkSession.sparkContext.broadcast((grams, features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, features = sent.value
        df, n, words = np.zeros(features.size, np.int64), 0, worker_words()
        for batch in slices(batches, "text", limit=SLICE):
            h, size = words.hashes([t or "" for t in batch.column("text").to_pylist()])
            f = features.of(h)
            pair = (np.repeat(np.arange(len(size)), size) * features.size + f)[~grams.covered(h, size)]
            df += np.bincount(np.unique(pair) % features.size, minlength=features.size)
            n += len(size)
            ends = np.concatenate([[0], 4 * np.cumsum(size)]).astype(np.int32)
            own = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(f.astype(np.int32))])
            yield pa.RecordBatch.from_arrays([own, pa.nulls(len(size), pa.int32()), pa.nulls(len(size), pa.int64())], names=["f", "feature", "n"])
        if n:
            count = np.append(n, df[df > 0])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(count), pa.binary()), pa.array(np.append(-1, np.flatnonzero(df)), pa.int32()), pa.array(count)], names=["f", "feature", "n"])

    return cut(docs.select("text").mapInArrow(run, CODED), "features")


def document_frequencies(table: DataFrame, features: Features) -> tuple[np.ndarray, int]:
    """In how many of all documents of a coded table each feature occurs, and the number of documents."""
    rows = table.where("feature is not null").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out, at, n = np.zeros(features.size, np.int64), rows.column("feature").to_numpy(), rows.column("n").to_numpy()
    out[at[at >= 0]] = n[at >= 0]
    return out, int(n[at < 0].sum())


def folded(f: np.ndarray, size: np.ndarray, column: np.ndarray, weight: np.ndarray, total: np.ndarray) -> None:
    """Adds to the rows of the features f, at its column, the weight of each feature in the same passage of BLOCK words (its own too)."""
    first, n_blocks = np.cumsum(size) - size, -(-size // BLOCK)
    of = np.repeat(np.arange(len(size)), size)
    block = (np.cumsum(n_blocks) - n_blocks)[of] + (np.arange(len(f)) - first[of]) // BLOCK
    row, c, w = f.astype(np.int64) * WIDE, column[f], weight[f]
    np.add.at(total, row + c, w)
    for j in range(1, BLOCK):
        at = np.flatnonzero(block[j:] == block[:-j])
        np.add.at(total, row[at] + c[at + j], w[at + j])
        np.add.at(total, row[at + j] + c[at], w[at])


def sketch(table: DataFrame, tells: np.ndarray, column: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first number, what it comes to) for pieces of the folded table of all documents of a coded table."""
    spark, size = table.sparkSession, len(tells)
    sent, step = spark.sparkContext.broadcast((tells, column, weight)), -(-size // PIECES) * WIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tells, column, weight), total = sent.value, np.zeros(size * WIDE)
        column, weight = column.astype(np.int64), weight.astype(np.float64)  # np.add.at is slow for types that were pickled
        for batch in slices(batches, "f", limit=SLICE):
            f = np.frombuffer(b"".join(batch.column("f").to_pylist()), np.int32)
            told, n, _ = telling(f, pc.binary_length(batch.column("f")).to_numpy().astype(np.int64) // 4, tells)
            folded(told, n, column, weight, total)
        for a in range(0, len(total), step):
            if (own := total[a : a + step]).any():
                yield pa.RecordBatch.from_arrays([pa.array([a // step], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["piece", "total"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in rows.column("total").to_pylist())
        return pa.table({"piece": rows.column("piece")[:1], "total": pa.array([total.tobytes()], pa.binary())})

    kind = "piece int, total binary"
    # as many sums as tasks can run at a time, whatever the input
    parts = table.where("f is not null").select("f").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(run, kind)
    for r in parts.groupBy("piece").applyInArrow(add, kind).toLocalIterator():
        yield r.piece * step, np.frombuffer(r.total, np.float64)
    sent.destroy()


def projection(table: DataFrame, f: np.ndarray, size: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The leading right singular vectors over their values, times the weights: of the passages of a coded table and of texts with the features f."""
    rng = np.random.default_rng(10)
    column, weight = rng.integers(0, WIDE, len(idf)), np.rint(rng.choice([-1.0, 1.0], len(idf)) * idf * WHOLE)
    total = np.zeros(len(idf) * WIDE)
    folded(*telling(f, size, idf > 0)[:2], column, weight, total)
    for a, part in sketch(table, idf > 0, column, weight):
        total[a : a + len(part)] += part
    total = total.reshape(-1, WIDE)
    core = np.zeros((WIDE, WIDE))
    for c in range(WIDE):
        core[c] = weight[column == c] @ total[column == c]
    values, turn = np.linalg.eigh((core + core.T) / 2)
    some = values > 1e-9 * max(values[-1], 1e-30)
    left = (idf[:, None] * total.astype(np.float32)).astype(np.float32) @ (turn[:, some] / np.sqrt(values[some])).astype(np.float32)
    del total
    values, turn = np.linalg.eigh((left.T @ left).astype(np.float64))
    values, turn = np.maximum(values[::-1][:RANK], 1e-6 * max(values[-1], 1e-30) if len(values) else 0), turn[:, ::-1][:, :RANK]
    return idf[:, None] * (left @ (turn / values).astype(np.float32))


def weights(df: np.ndarray, n: int, n_own: int) -> np.ndarray:
    """Inverse document frequencies: of the first n_own features FLOOR at least, of the others 0 if they are frequent."""
    idf = np.log((n + 1) / (df + 1))
    return np.where(np.arange(len(df)) < n_own, np.maximum(idf, FLOOR), np.where(df > max(STOP * n, STOP_LEAST), 0, idf)).astype(np.float32)


def fit(docs: DataFrame, benchmark: DataFrame) -> Index | None:
    """The index of benchmark(item_id, text) in the latent space of docs(doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    listed = benchmark.selectExpr("cast(item_id as long) item_id", "text").limit(MAX_ITEMS + 1).toArrow().to_pylist()
    h, size = Words().hashes([r["text"] or "" for r in listed])
    features = Features(np.unique(h))
    if len(listed) > MAX_ITEMS or len(h) > MAX_LENGTH or len(features.words) > MAX_WORDS:
        raise ValueError(f"more than {MAX_ITEMS} items, {MAX_LENGTH} words or {MAX_WORDS} different words; the benchmark is broadcast")
    if not len(h):
        return None
    grams = Grams.of(h, size)
    known = coded(docs, grams, features)
    df, n = document_frequencies(known, features)
    if not n:
        discard(known)
        return None
    idf = weights(df, n, len(features.words))
    f, starts = features.of(h), np.cumsum(size) - size
    items = [Item.of(r["item_id"], h[a : a + m], idf[f[a : a + m]]) for r, a, m in zip(listed, starts, size, strict=True)]
    table = projection(known, f, size, idf)
    discard(known)
    trim()

    # an item's passages: itself if it is short, else windows of it
    long_ = ITEM_PASSAGE
    rows, least, item_of = [], [], []
    for i, (a, m) in enumerate(zip(starts, size, strict=True)):
        for b in range(0, max(1, m - long_ + long_ // 2), long_ // 2) if m else ():
            rows.append(table[f[a + b : a + min(m, b + long_)]].sum(axis=0))
            least.append(min(1.0, (min(m - b, long_) / SHORT) ** 0.5))
            item_of.append(i)
    return Index(features, idf > 0, table, unit(np.array(rows, np.float32).reshape(-1, table.shape[1])), np.array(least), np.array(item_of, np.int64), items, Answers.of(items, features), grams)


def alike(index: Index, vectors: np.ndarray, item: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(passage, cosine) of the passages that are like one of the item's; the product is made in blocks."""
    low, high = np.searchsorted(index.item_of, [item, item + 1])
    least, out = (cosine * index.least[low:high]).astype(np.float32), [(np.zeros(0, np.int64), np.zeros(0, np.float32))]
    step = max(1, PRODUCT // max(1, high - low))
    for a in range(0, len(vectors), step):
        sims = vectors[a : a + step] @ index.rows[low:high].T
        at = np.flatnonzero((sims >= least).any(axis=1))
        out.append((at + a, np.where(sims[at] >= least, sims[at], 0).max(axis=1)))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def candidates(index: Index, h: np.ndarray, f: np.ndarray, size: np.ndarray, pairs: list[tuple[int, int]], cosine: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each of the pairs (text, item), the places of the text's words at which to look and their cosines: by passages, the most alike first, then by runs of words."""
    told, n_told, place = telling(f, size, index.tells)
    vectors, start, of = passages(index.table, told, n_told)
    first, first_told = np.cumsum(size) - size, np.cumsum(n_told) - n_told
    start = place[first_told[of] + start] - first[of]  # among all words of the text
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(len(size) + 1))
    run_doc, run_item, run_start = index.grams.places(h, size)
    of_run = run_doc * len(index.items) + run_item
    by_run = np.argsort(of_run, kind="stable")
    of_run, run_start = of_run[by_run], run_start[by_run]
    text = -1
    for d, i in pairs:
        if d != text:
            text, mine = d, order[ends[d] : ends[d + 1]]
            units = unit(vectors[mine])
        at, like = alike(index, units, i, cosine)
        best = np.argsort(-like, kind="stable")
        low, high = np.searchsorted(of_run, [d * len(index.items) + i, d * len(index.items) + i + 1])
        yield d, i, np.concatenate([start[mine[at[best]]], run_start[low:high]]), np.concatenate([like[best], np.zeros(high - low)])


def matches(index: Index, h: np.ndarray, size: np.ndarray, cosine: float = COSINE, overlap: float = OVERLAP) -> list[tuple[int, int, float, float, int]]:
    """(text's number, item's number, overlap, cosine, first word) of the best place for each pair."""
    f, n_items = index.features.of(h), len(index.items)
    pairs = index.answers.hopeful(f, size)
    if not len(pairs):
        return []
    # only texts that hold some item's rarest words go on
    texts = np.unique(pairs // n_items)
    here = np.zeros(len(size), bool)
    here[texts] = True
    words = np.repeat(here, size)
    h, f, size = h[words], f[words], size[here]
    first = np.cumsum(size) - size
    here = np.searchsorted(texts, pairs // n_items).tolist()
    found: dict[tuple[int, int], tuple[float, float, int]] = {}
    for d, i, places, like in candidates(index, h, f, size, list(zip(here, (pairs % n_items).tolist(), strict=True)), cosine):
        one, tried = index.items[i], set()
        for begin, c in zip(places.tolist(), like.tolist(), strict=True):
            low = max(0, begin - one.n // 2)
            # one trial for places that lie close together
            if (spot := low // BLOCK) in tried:
                continue
            tried.add(spot)
            high = min(int(size[d]), begin + one.n + one.n // 2)
            share = one.overlap(h[first[d] + low : first[d] + high].tolist())
            if share >= overlap and share > found.get((d, i), (0,))[0]:
                found[d, i] = share, c, low
                if share >= 1.0:
                    break
    return [(int(texts[d]), i, *v) for (d, i), v in found.items()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, overlap: float = OVERLAP) -> DataFrame:
    """A row for each document and benchmark item that it contains or paraphrases."""
    spark = docs.sparkSession
    if (index := fit(docs, benchmark)) is None:
        return spark.createDataFrame([], SCHEMA)
    sent = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit=SLICE):
            h, size = worker_words().hashes([t or "" for t in batch.column("text").to_pylist()])
            if found := matches(sent.value, h, size, cosine, overlap):
                ids = batch.column("doc_id").to_pylist()
                columns = list(zip(*((ids[d], sent.value.items[i].item_id, s, c, w) for d, i, s, c, w in found), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True)], names=["doc_id", "item_id", "overlap", "cosine", "start_word"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, overlap: float = OVERLAP) -> DataFrame:
    """The rows of docs, with all their columns, that neither contain nor paraphrase an item; each is judged by its own text."""
    if (index := fit(docs, benchmark)) is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit=SLICE):
            clean = np.ones(batch.num_rows, bool)
            clean[[d for d, *_ in matches(sent.value, *worker_words().hashes([t or "" for t in batch.column("text").to_pylist()]), cosine, overlap)]] = False
            yield batch if clean.all() else batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "item_id", "overlap")
