"""Operator 4: near-duplicates by BagMinHash.

A document is the multiset of its five-word shingles.  The weights (counts) are discretised into levels 0, 1, 2, ...,
each a Poisson process of unit rate whose points fall on one of ``HASHES`` places.  The processes are hierarchical: block
k holds the levels from 2^k - 1 up to 2^(k+1) - 1 and is one process of rate 2^k; a point names its level within the
block and counts only if the shingle's weight reaches it.  A shingle of weight w thus needs log2(w) processes, and a
process ends once its time passes the largest minimum of the signature.  Each place's earliest point agrees between two
documents with probability equal to their weighted Jaccard similarity.

Candidates: documents that agree in a whole band of ``ROWS`` places.  Documents of the same words form a class, and its
smallest doc_id stands for it.  In each bucket every member is verified against the smallest one by the exact overlap of
the multisets.  Buckets whose members do not lie in one component then have their members of different components
compared by signature, in tiles of bounded size, and those that could reach the threshold are verified in the tile.  So
no pair of a bucket stays undecided unless other links join it, and no group of copies is expanded into its pairs.

Result: every document with the smallest doc_id that links reach.  Defined results: null texts, texts without words and
rows with null doc_id link with nothing (the last have a null component and are kept); documents of fewer than five words
are one shingle; rows that repeat a doc_id are one document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, cut, discard, map_batches, mix64, slices
from .components import Forest, components
from .words import multiset, overlap, shingles, worker_words

HASHES, ROWS = 128, 4
SIMILARITY = 0.8
#: Share of equal places (of one byte each) below which a pair needs no verification: over five deviations below SIMILARITY.
ESTIMATE = 0.6
TILE = 512
#: Points of a process that are made at a time (doubling up to this, whatever else is signed), and processes that are run side by side.
POINTS, PROCESSES = 16, 1 << 16
#: Slots of the table of wanted ids: a multiple of one piece, up to the most that is broadcast (16 MB).
PIECE, SLOTS = 1 << 15, 1 << 27
SIGNED = "doc_id long, c1 long, c2 long, n long, bands array<long>, places binary"
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def signatures(shingle: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, m: int = HASHES) -> np.ndarray:
    """Times of the earliest point at each of m places for n documents, from their distinct shingles."""
    out = np.full(n * m, np.inf)
    level = np.floor(np.log2(np.maximum(weight, 1))).astype(np.int64)  # last block that the weight reaches
    item = np.repeat(np.arange(len(shingle)), level + 1)
    block = np.arange(len(item)) - np.repeat(np.cumsum(level + 1) - level - 1, level + 1)
    seed = mix64(shingle[item] + _A * (block + 1).astype(np.uint64))
    doc, left = of[item], weight[item] - (1 << block) + 1  # levels of the block that count
    time, made, points = np.zeros(len(seed)), 0, 1
    while len(seed):
        bits = mix64(seed[:, None] + _B * np.arange(made + 1, made + points + 1, dtype=np.uint64))
        step = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (1 << block)[:, None]
        # the sums are made in the same order whatever documents are signed together
        at = time[:, None] + np.cumsum(step, axis=1)
        other = mix64(bits ^ _C)
        place = ((other >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        counts = (other & np.uint64(0xFFFFFFFF)) * (np.uint64(1) << block.astype(np.uint64))[:, None] >> np.uint64(32)
        ok = counts.astype(np.int64) < left[:, None]
        np.minimum.at(out, (doc[:, None] * m + place)[ok], at[ok])
        time, made = at[:, -1], made + points
        points = min(made, POINTS)
        alive = time < out.reshape(n, m).max(axis=1)[doc]
        seed, doc, left, time, block = seed[alive], doc[alive], left[alive], time[alive], block[alive]
    return out.reshape(n, m)


def signed_apart(shingle: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """signatures of documents, so many at a time that the processes' points fit in a bounded memory."""
    ends = np.searchsorted(of, np.arange(n + 1))
    out, a = [], 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + PROCESSES, side="right")) - 1)
        part = slice(ends[a], ends[b])
        out.append(signatures(shingle[part], of[part] - a, weight[part], b - a))
        a = b
    return np.vstack(out)


def sign(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    h, size = worker_words().hashes([t or "" for t in batch.column("text").to_pylist()])
    some = np.flatnonzero(size)
    if not len(some):
        return None
    end = np.cumsum(size)
    keys = np.array([divmod(xxhash.xxh3_128_intdigest(h[end[i] - size[i] : end[i]].tobytes()), 1 << 64) for i in some], np.uint64).view(np.int64)
    size = size[some]
    sig = signed_apart(*multiset(*shingles(h, size)), len(size)).view(np.uint64)
    bands = mix64(sig[:, 0::ROWS])
    for r in range(1, ROWS):
        bands = mix64(bands * _A + sig[:, r::ROWS])
    places = (mix64(sig) & np.uint64(255)).astype(np.uint8)
    bands = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), pa.array(bands.view(np.int64).ravel()))
    return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(some)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(size), bands, pa.array([x.tobytes() for x in places], pa.binary())], names=["doc_id", "c1", "c2", "n", "bands", "places"])


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of docs whose id may be among ids: a broadcast table of slots, whose size follows their number up to SLOTS, drops most others early."""
    bounded_batches(docs.sparkSession)
    n = ids.count()
    slots = int(min(SLOTS, PIECE * -(-16 * max(n, 1) // PIECE)))
    slot = F.pmod(F.xxhash64("id", F.lit(40)), F.lit(slots)) + 1
    pieces = ids.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    table = np.zeros((slots // PIECE, PIECE // 8), np.uint8)
    # one job, of as many bytes as the table: a local iterator runs one for each partition
    for r in pieces.collect():
        table[r.piece - 1] = np.frombuffer(r.bits, np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(table.ravel())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("slot").to_numpy()
            yield batch.select(["id", "text"]).filter(pa.array((sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    rows = docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as long) id", "text")
    return rows.withColumn("slot", slot - 1).mapInArrow(keep, "id long, text string")


def verified(docs: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of pairs(a, b) whose multisets overlap enough, with the similarity."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = texts_of(docs, ids).join(ids, "id", "left_semi").dropDuplicates(["id"])
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "left", "right"):
            a, b, left, right = (c.to_pylist() for c in batch.columns)
            text = dict(zip(a, left, strict=True)) | dict(zip(b, right, strict=True))
            s, of, c = multiset(*shingles(*worker_words().hashes(list(text.values()))))
            ends = np.searchsorted(of, np.arange(len(text) + 1))
            bag = {i: (s[x:y], c[x:y]) for i, x, y in zip(text, ends, ends[1:], strict=False)}
            like = np.array([overlap(bag[i], bag[j]) for i, j in zip(a, b, strict=True)])
            ok = pa.array(like >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like)], names=["a", "b", "similarity"]).filter(ok)

    return both.mapInArrow(run, "a long, b long, similarity double")


def equal_places(places: np.ndarray, k: int) -> np.ndarray:
    """How many places (of one byte, a multiple of eight in all and at most 2040) each row has in common with row k."""
    words = (places == places[k]).view(np.uint64).sum(axis=1)
    return (words * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64) if places.shape[1] <= 248 else (places == places[k]).sum(axis=1)


class Bags:
    """The multisets of a tile's texts, with its shingles numbered."""

    def __init__(self, shingle: np.ndarray, of: np.ndarray, count: np.ndarray, n: int):
        values, self.number = np.unique(shingle, return_inverse=True)
        self.count, self.ends = count, np.searchsorted(of, np.arange(n + 1))
        self.total = np.add.reduceat(np.append(count, 0), self.ends[:-1]) * (np.diff(self.ends) > 0) if n else np.zeros(0, np.int64)
        self.mine = np.zeros(len(values), np.int64)

    @staticmethod
    def of(texts: list[str]) -> Bags:
        return Bags(*multiset(*shingles(*worker_words().hashes(texts))), len(texts))

    def overlaps(self, k: int, others: list[int]) -> np.ndarray:
        """Weighted Jaccard similarities of text k and others."""
        if not others:
            return np.zeros(0)
        own = slice(self.ends[k], self.ends[k + 1])
        self.mine[self.number[own]] = self.count[own]
        low, size = self.ends[others], self.ends[np.array(others) + 1] - self.ends[others]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(low - first, size)
        both = np.minimum(self.mine[self.number[at]], self.count[at])
        both = np.add.reduceat(np.append(both, 0), first) * (size > 0)
        self.mine[self.number[own]] = 0
        return both / np.maximum(self.total[k] + self.total[others] - both, 1)


def apart(docs: DataFrame, rest: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between different components among members of rest(band, key, id, label, places).

    Buckets that share members form one crowd, in which each document's text is read once; a crowd is spread over tiles
    of at most TILE documents a side.  A tile compares signatures of documents of different components, verifies those
    that look alike enough by their multisets, and returns what connects components, never the pairs that fail.
    """
    first = rest.groupBy("band", "key").agg(F.min("id").alias("b"))
    crowd = components(rest.join(first, ["band", "key"]).select(F.col("id").alias("a"), "b"), "minhash-crowds")
    member = cut(rest.select("id", "label", "places").dropDuplicates(["id"]).join(crowd, "id"), "minhash-crowd-members")
    known, member = member, cut(member.join(texts_of(docs, member).dropDuplicates(["id"]), "id"), "minhash-members")
    discard(known)
    sized = member.join(member.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "root")
    own = F.pmod(F.xxhash64("id", F.lit(4)), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = sized.withColumn("own", own).withColumn("other", other).select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "label", "places", "text")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        places = np.frombuffer(b"".join(rows.places), np.uint8).reshape(len(rows), -1)
        ids, side = rows.id.to_numpy(), rows.own.to_numpy()
        value, labels, n = np.unique(rows.label, return_inverse=True, return_counts=True)
        bags = Bags.of(rows.text.tolist())
        forest, out, least = Forest(len(value)), [], ESTIMATE * places.shape[1]
        # of two rows of different components one at least is outside the most frequent component
        for k in np.flatnonzero(labels != n.argmax()).tolist():
            same = equal_places(places, k)
            hit = np.flatnonzero((same >= least) & (labels != labels[k]) & ((i == j) | (side != side[k])))
            hit = hit[np.argsort(-same[hit], kind="stable")]
            # the likeliest first: most joins need few of them
            for x in range(0, len(hit), 64):
                few = [d for d in hit[x : x + 64].tolist() if forest.root(labels[k]) != forest.root(labels[d])]
                for d, like in zip(few, bags.overlaps(k, few).tolist(), strict=True):
                    if like >= similarity and forest.link(labels[k], labels[d]):
                        out.append((max(ids[k], ids[d]), min(ids[k], ids[d])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return tiled.groupBy("root", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, component_id (the smallest doc_id that links reach) and kept, for each row of docs(doc_id, text)."""
    signed = cut(map_batches(docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as long) doc_id", "text"), sign, SIGNED), "minhash-signed")
    classes = signed.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "bands", "places")).alias("r"))
    reps = cut(classes.select("c1", "c2", F.col("r.doc_id").alias("id"), "r.bands", "r.places"), "minhash-classes")
    rows = reps.select("id", F.posexplode("bands").alias("band", "key"))
    # written first: both sides of the join are then plain shuffles, whose hot keys Spark can split
    buckets = cut(rows.groupBy("band", "key").agg(F.min("id").alias("center"), F.max("id").alias("last")).where("center <> last").select("band", "key", "center"), "minhash-centers")
    crowd = cut(rows.join(buckets, ["band", "key"]), "minhash-buckets")
    pairs = cut(crowd.where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct(), "minhash-pairs")
    links = cut(verified(docs, pairs, similarity).select("a", "b"), "minhash-links")
    discard(buckets, pairs)
    group = cut(components(links), "minhash-groups")
    labelled = crowd.join(group, "id", "left").select("band", "key", "id", F.coalesce("root", "id").alias("label"))
    split = cut(labelled.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band", "key"), "minhash-split")
    rest = labelled.join(split, ["band", "key"]).join(reps.select("id", "places"), "id")
    rest = cut(rest, "minhash-rest")
    discard(crowd, split)
    more = cut(apart(docs, rest, similarity), "minhash-more")
    if not more.isEmpty():
        first, group = group, cut(components(links.union(more)), "minhash-groups")
        discard(first)
    discard(rest, links, more)
    member = signed.select("doc_id", "c1", "c2").distinct().join(reps.select("c1", "c2", "id"), ["c1", "c2"]).join(group, "id", "left").select("doc_id", F.coalesce("root", "id").alias("component_id"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(member, "doc_id", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
