"""Operator 2: near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has its own codebook (k-means on a bounded sample); the pairs of centroids form a grid of
cells, and every vector lies in the cell of its nearest centroids.  A vector visits cells in the order of the sum of its two
squared distances to their centroids (multi-sequence traversal of the two sorted lists) until that sum exceeds its own
cell's by ``T``.  T is calibrated for the target recall: of the sample's vectors, turned by the angle of the least cosine in
random directions, that share has T cover the smaller of the two excesses (of either vector in the other's traversal).
A pair is found if either of the two visits the other's cell; closer pairs are missed less often.  A recall of 1 visits all
cells.  Vectors in visited cells, and no others, are verified by cosine in double precision.

Equal vectors of a label are one representative with a weight and a key of its own.  Members and visitors of a stripe of the
grid (a label and a centroid of the first half) meet in tiles of at most ``TILE`` each, so a hot label or cell is spread over
many tasks; a tile multiplies cell by cell and returns counts and the links that connect its vectors, never all pairs.  Of a
pair that both traversals find, the one of the smaller key counts.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label or
vec_id, link with nothing (n_links 0, a component of their own); vectors of different lengths don't compare; rows that
repeat a vec_id are other vectors, each with its own links; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, cut, discard
from .components import components

COSINE = 0.93
SAMPLE = 8192
TILE = 1024
#: Share of the pairs at exactly the least cosine that are found, and how many of them the calibration draws.
RECALL, DRAWS = 0.99999, 200_000


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, scaled first so that no square over- or underflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T, 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids; equal centroids are dropped."""
    c = x[np.random.default_rng(2).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return np.unique(c, axis=0)


def halves(x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of the rows' halves to the centroids."""
    at = books[0].shape[1]
    return distances(x[:, :at], books[0]), distances(x[:, at:], books[1])


def excess(d: tuple[np.ndarray, np.ndarray], cell: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How much farther than its own cell each row's given cell is."""
    at = np.arange(len(d[0]))
    return sum(x[at, c] - x.min(axis=1) for x, c in zip(d, cell, strict=True))


def reach(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], cosine: float, recall: float) -> float:
    """The excess up to which cells are visited for the target recall, from sampled rows x."""
    if recall >= 1:
        return math.inf
    rng, found = np.random.default_rng(22), []
    x = x[rng.permutation(len(x))[:2000]]
    mine = halves(x, books)
    home = tuple(d.argmin(axis=1) for d in mine)
    for _ in range(-(-DRAWS // len(x))):
        turn = rng.standard_normal(x.shape)
        turn -= (turn * x).sum(axis=1, keepdims=True) * x
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-30)
        theirs = halves(cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * turn, books)
        found.append(np.minimum(excess(mine, tuple(d.argmin(axis=1) for d in theirs)), excess(theirs, home)))
    return float(np.quantile(np.concatenate(found), recall, method="higher")) + 1e-9


def traverse(a: np.ndarray, b: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) in the order of a[i] + b[j], while that is at most ``most``."""
    i_of, j_of = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    x, y = a[i_of].tolist(), b[j_of].tolist()
    agenda, front = [(x[0] + y[0], 0, 0)], 0
    while agenda:
        s, i, j = heapq.heappop(agenda)
        if s > most:
            return
        yield i_of[i], j_of[j]
        if j + 1 < len(y):
            heapq.heappush(agenda, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            front = i + 1
            heapq.heappush(agenda, (x[front] + y[0], front, 0))


def representatives(vectors: DataFrame) -> DataFrame:
    """(id, label, dim, vec, weight): one row for each different vector of a label; id is its smallest vec_id."""
    finite = "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0"
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(finite).where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("v"))
    return rows.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))


def codebooks(reps: DataFrame, n: int, cosine: float, recall: float) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Both codebooks and the reach for each length of vector, from a bounded sample chosen by a hash of the key."""
    hashed = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    by_dim = defaultdict(list)
    for r in reps.where(hashed < min(1.0, SAMPLE / n)).orderBy("key").select("v").limit(2 * SAMPLE).toLocalIterator():
        by_dim[len(r.v)].append(r.v)
    k = int(min(512, max(8, 4 * n**0.25)))
    out = {}
    for dim, rows in by_dim.items():
        x = units(np.array(rows))
        books = codebook(x[:, : dim // 2], k), codebook(x[:, dim // 2 :], k)
        out[dim] = (*books, reach(x, books, cosine, recall))
    return out


def lists_of(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length."""
    size, flat = pc.list_value_length(column).to_numpy(), column.flatten().to_numpy()
    first = np.cumsum(size) - size
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        yield at, flat[first[at][:, None] + np.arange(dim)]


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of 0..n-1 that links between a and b reach from each."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, a, before[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            return low


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of vectors(vec_id, embedding, label)."""
    bounded_batches(vectors.sparkSession)
    reps = cut(representatives(vectors).withColumn("key", F.monotonically_increasing_id()), "vectors")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("v"))
    books = vectors.sparkSession.sparkContext.broadcast(codebooks(reps, max(1, reps.count()), cosine, recall))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, key, weight = (batch.column(c).to_pylist() for c in ("label", "key", "weight"))
            for at, v in lists_of(batch.column("v")):
                dim, x = v.shape[1], units(v)
                # lengths that the sample lacks have a grid of one cell
                left, right, most = books.value.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)), 0.0)
                d = halves(x, (left, right))
                home, out = [y.argmin(axis=1).tolist() for y in d], []
                least = (d[0].min(axis=1) + d[1].min(axis=1) + most + 1e-12).tolist()
                for k, r in enumerate(at.tolist()):
                    stripes = defaultdict(list)
                    for i, j in traverse(d[0][k], d[1][k], least[k]):
                        stripes[i].append(j)
                    own, visits = home[0][k] * len(right) + home[1][k], [i * len(right) + j for i, js in stripes.items() for j in js]
                    head = (f"{dim}:{label[r]}", key[r], weight[r], x[k].tobytes(), own)
                    out.append((*head, home[0][k], True, visits))
                    out += [(*head, i, False, [i * len(right) + j for j in js]) for i, js in stripes.items()]
                columns = zip(("label", "key", "weight", "unit", "home", "stripe", "member", "cells"), zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32())), strict=True)
                yield pa.RecordBatch.from_pydict({name: pa.array(c, t) for name, c, t in columns})

    placed = cut(reps.select("key", "label", "v", "weight").mapInArrow(place, "label string, key long, weight long, unit binary, home int, stripe int, member boolean, cells array<int>"), "placed")
    tiles = lambda member: F.ceil(F.count(F.when(F.col("member") == member, 1)) / TILE).cast("int")
    sizes = placed.groupBy("label", "stripe").agg(tiles(True).alias("m"), tiles(False).alias("q")).where("m > 0 and q > 0")
    sized = placed.join(sizes, ["label", "stripe"])
    own = F.pmod(F.xxhash64("key", F.lit(22)), F.when(F.col("member"), F.col("m")).otherwise(F.col("q"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("member"), F.col("q")).otherwise(F.col("m")) - 1))
    tiled = sized.withColumn("own", own).withColumn("other", other).select("label", "stripe", F.when(F.col("member"), F.col("own")).otherwise(F.col("other")).alias("mt"), F.when(F.col("member"), F.col("other")).otherwise(F.col("own")).alias("qt"), "key", "weight", "unit", "home", "member", "cells")

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        members, guests = rows[rows.member], rows[~rows.member]
        if not len(members) or not len(guests):
            return pd.DataFrame({"key": [], "n": [], "root": []}).astype("int64")
        x, y = (np.frombuffer(b"".join(r.unit), np.float64).reshape(len(r), -1) for r in (members, guests))
        mine, theirs = members.key.to_numpy(), guests.key.to_numpy()
        home, there = members.home.to_numpy(), guests.home.to_numpy()
        cell, guest = np.concatenate(list(guests.cells)), np.repeat(np.arange(len(guests)), guests.cells.map(len))
        order = np.argsort(cell, kind="stable")
        cell, guest = cell[order], guest[order]
        g, m = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c in np.unique(home).tolist():
            inside, near = np.flatnonzero(home == c), guest[np.searchsorted(cell, c) : np.searchsorted(cell, c, side="right")]
            a, b = np.nonzero(y[near] @ x[inside].T >= cosine)
            g.append(near[a])
            m.append(inside[b])
        g, m = np.concatenate(g), np.concatenate(m)
        # the other traversal finds the pair too if the member visits the guest's own cell
        span = int(max(cell.max(initial=0), home.max(), there.max(), max(max(c) for c in members.cells))) + 1
        visits = np.sort(np.repeat(np.arange(len(members)), members.cells.map(len)) * span + np.concatenate(list(members.cells)))
        asked = m * span + there[g]
        both = visits[np.minimum(np.searchsorted(visits, asked), len(visits) - 1)] == asked
        ok = (theirs[g] != mine[m]) & (~both | (theirs[g] < mine[m]))
        g, m = g[ok], m[ok]
        keys, at = np.unique(np.concatenate([theirs[g], mine[m]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([members.weight.to_numpy()[m], guests.weight.to_numpy()[g]]), len(keys)).astype(np.int64)
        root = keys[roots(at[: len(g)], at[len(g) :], len(keys))] if len(keys) else keys
        return pd.DataFrame({"key": keys, "n": n, "root": root})

    found = cut(tiled.groupBy("label", "stripe", "mt", "qt").applyInPandas(verify, "key long, n long, root long"), "vector-links")
    discard(placed)
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    group = components(found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")), "vector-components").withColumnRenamed("id", "key")
    linked = reps.select("key", "id").join(group, "key")
    lowest = linked.groupBy("root").agg(F.min("id").alias("low"))
    component = linked.join(lowest, "root").select("key", "low")
    told = reps.join(counts, "key", "left").join(component, "key", "left").select("label", "v", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("low", "id").alias("component_id"))
    out = ids.join(told, (ids.label == told.label) & (ids.v == told.v) & ids.vec_id.isNotNull(), "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
with recursive v as (select vec_id, label, [x::double for x in embedding] as e from embeddings
    where label is not null and embedding is not null),
u as (select vec_id, label, e, sqrt(list_dot_product(e, e)) as n from v),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id
    where a.n > 0 and b.n > 0 and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
r(id, root) as (select vec_id, vec_id from embeddings union select l.b, r.root from r join l on l.a = r.id),
c as (select id, min(root) as component_id from r group by id),
k as (select a, count(*) as n from l group by a)
select vec_id, coalesce(k.n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join c on c.id = vec_id left join k on k.a = vec_id
"""
