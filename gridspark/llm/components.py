"""Connected components of edge tables, by alternating large and small stars.

Each task first replaces its edges by the stars of their components, ``EDGES`` at a time.  What is left is finished by one
task if it is no more than ``EDGES``, and else goes through rounds of stars until it is.  Nothing is gathered on the driver
but the number of edges and whether a round is the last.  Groups are reduced by aggregation and joined back, so that a hub's
neighbours can be split among tasks.  Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard

#: Edges whose components one task finds in memory.
EDGES = 1_000_000


def rooted(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """The ids that edges touch, ascending, and the smallest id that each reaches by them."""
    ends = [np.concatenate([b.column(c).to_numpy() for b in batches]) for c in (0, 1)]
    ids, at = np.unique(np.concatenate(ends), return_inverse=True)
    forest = Forest(len(ids))
    for i, j in zip(at[: len(ends[0])].tolist(), at[len(ends[0]) :].tolist(), strict=True):
        forest.link(i, j)
    return ids, ids[forest.roots()]


def task_stars(names: list[str], limit: int, whole: bool):
    """Stars of a task's edges, more than ``limit`` edges at a time; whole: with the smallest ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n > limit:
                yield star(held)
                held, n = [], 0
        if n:
            yield star(held)

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, root = rooted(held)
        some = np.ones(len(ids), bool) if whole else ids != root
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some])], names=names)

    return run


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(id, root) for every id that edges(a long, b long) touch: root is the smallest id that links reach."""
    own = edges.where("a <> b").select("a", "b").mapInArrow(task_stars(["u", "v"], EDGES, False), "u long, v long")
    now = cut(own.distinct(), tag)
    while now.count() > EDGES:
        if stars(now):
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(now.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
        # the least neighbours are written before they are joined: both sides are then plain shuffles, and Spark can split a hub
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), tag)
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), tag)
        discard(now, least)
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), tag)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        now = cut(small.distinct(), tag)
        discard(large, least)
    # all edges that are left are within the limit of one batch of stars
    out = cut(now.coalesce(1).mapInArrow(task_stars(["id", "root"], EDGES, True), "id long, root long"), tag)
    discard(now)
    return out


def stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then each component is a star around its smallest id."""
    if not edges.groupBy("u").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


class Forest:
    """Union-find over 0..n-1 in one task; the smallest index is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def link(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)
