"""Joins of boxes by grid cells: an equi-join with a residual predicate instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlaps(a: str, b: str, touching: bool) -> Column:
    """Boxes (l, b, r, t) of two aliases meet; touching: shared edges count."""
    c = lambda side, name: F.col(f"{side}.{name}")
    if touching:
        return (c(a, "l") <= c(b, "r")) & (c(a, "r") >= c(b, "l")) & (c(a, "b") <= c(b, "t")) & (c(a, "t") >= c(b, "b"))
    return (c(a, "l") < c(b, "r")) & (c(a, "r") > c(b, "l")) & (c(a, "b") < c(b, "t")) & (c(a, "t") > c(b, "b"))


def _cells(df: DataFrame, size: float) -> DataFrame:
    """A row for each cell that the box meets, edges included."""
    span = lambda low, high: F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))
    return df.withColumn("_cx", F.explode(span("l", "r"))).withColumn("_cy", F.explode(span("b", "t")))


def box_join(left: DataFrame, right: DataFrame, size: float, touching: bool = False, how: str = "inner") -> DataFrame:
    """Rows of left (alias a) and right (alias b), both with l, b, r, t, whose boxes meet, once a pair.

    A pair meets in several cells; the one that holds the lower left corner of the common box reports it.
    how: inner, or left_semi (rows of left with any partner; equal rows stay as often as they are there).
    """
    if how == "left_semi":
        # partners are looked for by cell and box; each different box of left once, so that its rows need no key of their own
        box = ["l", "b", "r", "t"]
        met = _cells(left.select(box).distinct(), size).alias("a").join(_cells(right.select(box), size).alias("b"), (F.col("a._cx") == F.col("b._cx")) & (F.col("a._cy") == F.col("b._cy")) & overlaps("a", "b", touching), "left_semi").select(box).distinct()
        return left.join(met, box, "left_semi").select(left.columns)
    a, b = _cells(left, size).alias("a"), _cells(right, size).alias("b")
    same = (F.col("a._cx") == F.col("b._cx")) & (F.col("a._cy") == F.col("b._cy"))
    first = (F.col("a._cx") == F.floor(F.greatest("a.l", "b.l") / size)) & (F.col("a._cy") == F.floor(F.greatest("a.b", "b.b") / size))
    return a.join(b, same & overlaps("a", "b", touching) & first, how).drop("_cx", "_cy")
