"""Features: existence, clipping and burning into pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import box_join

#: What is left of the values that are burned into a pixel one after another, by their order.
BURN = {"count": lambda _: F.count("*"), "asc": F.max, "none": F.max, "desc": F.min}


def tiles_with_features(tiles: DataFrame, features: DataFrame, size: float = 10.0) -> DataFrame:
    """Tiles that any feature meets, shared edges included."""
    return box_join(tiles, features.select("l", "b", "r", "t"), size, touching=True, how="left_semi")


def clipped(tiles: DataFrame, features: DataFrame, size: float = 10.0) -> DataFrame:
    """Features cut to the tiles that they meet; what has no area is dropped."""
    pairs = box_join(tiles, features, size, touching=True)
    low, high = (lambda c: F.greatest(f"a.{c}", f"b.{c}").alias(c)), (lambda c: F.least(f"a.{c}", f"b.{c}").alias(c))
    rest = [F.col(f"b.{c}") for c in features.columns if c not in ("l", "b", "r", "t")]
    return pairs.select("a.tile_id", *rest, low("l"), low("b"), high("r"), high("t")).where("r > l and t > b")


def burn_boxes(boxes: DataFrame, res: float = 1.0) -> DataFrame:
    """Pixels (px, py) whose centres lie in each box, made by the box's own extent; edges at the right and top are open."""
    span = lambda low, high: F.sequence(F.ceil(F.col(low) / res - 0.5), F.ceil(F.col(high) / res - 0.5) - 1)
    some = boxes.where(F.ceil(F.col("l") / res - 0.5) < F.ceil(F.col("r") / res - 0.5)).where(F.ceil(F.col("b") / res - 0.5) < F.ceil(F.col("t") / res - 0.5))
    return some.withColumn("px", F.explode(span("l", "r"))).withColumn("py", F.explode(span("b", "t")))


def rasterize(boxes: DataFrame, how: str, value: str = "v", res: float = 1.0) -> DataFrame:
    """count: how many features; value: the last burned in ascending (asc, none) or descending (desc) order of value."""
    if how not in BURN:
        raise ValueError(f"no order {how}")
    return burn_boxes(boxes, res).groupBy("px", "py").agg(BURN[how](value).alias(value if how != "count" else "n"))


RINGS = "array<array<struct<x:double,y:double>>>"


def cut_ring(ring: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """A ring (n x 2, its end not repeated) cut to a box (l, b, r, t), one edge after another."""
    for axis, bound, sign in ((0, box[0], 1), (1, box[1], 1), (0, box[2], -1), (1, box[3], -1)):
        if not len(ring):
            break
        before = np.roll(ring, 1, axis=0)
        inside, was = sign * (ring[:, axis] - bound) >= 0, sign * (before[:, axis] - bound) >= 0
        crosses = inside != was
        with np.errstate(divide="ignore", invalid="ignore"):
            share = (bound - before[:, axis]) / (ring[:, axis] - before[:, axis])
        point = before + np.where(crosses, share, 0)[:, None] * (ring - before)
        point[:, axis] = bound
        # where the edge to a corner crosses the bound, the crossing comes before the corner
        both = np.stack([point, ring], axis=1).reshape(-1, 2)
        ring = both[np.stack([crosses, inside], axis=1).ravel()]
    return ring


def ring_area(ring: np.ndarray) -> float:
    """Twice-summed cross products, halved; positive whichever way the ring runs."""
    x, y = ring[:, 0], ring[:, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def rings_of(column: pa.ListArray) -> list[list[np.ndarray]]:
    """The polygons of an Arrow batch as rings of points, without the repeated last one."""
    inner = column.flatten()
    points = inner.flatten()
    xy = np.column_stack([points.field(0).to_numpy(zero_copy_only=False), points.field(1).to_numpy(zero_copy_only=False)])
    size = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False)
    rings = np.split(xy, np.cumsum(size)[:-1]) if len(size) else []
    rings = [p[:-1] if len(p) > 1 and (p[0] == p[-1]).all() else p for p in rings]
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(count)
    return [rings[e - n : e] for e, n in zip(ends.tolist(), count.tolist(), strict=True)]


def polygons_clipped(tiles: DataFrame, features: DataFrame, size: float = 10.0) -> DataFrame:
    """Polygons of features(.., rings, l, b, r, t) cut to the tiles that they meet, with rings and area; what has no area is dropped.

    rings: outer rings and holes of a polygon or of several, by the even-odd rule.  A hole lies inside its outer ring.
    """
    rest = [c for c in features.columns if c not in ("rings", "l", "b", "r", "t")]
    pairs = box_join(tiles, features, size, touching=True).select("a.tile_id", *(F.col(f"b.{c}") for c in rest), F.col("b.rings").cast(RINGS).alias("rings"), *(F.col(f"a.{c}").alias(f"_{c}") for c in ("l", "b", "r", "t")))
    kept = ["tile_id", *rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        for batch in batches:
            boxes = zip(*(batch.column(f"_{c}").to_pylist() for c in ("l", "b", "r", "t")), strict=True)
            cut, area = [], []
            for rings, box in zip(rings_of(batch.column("rings")), boxes, strict=True):
                parts = [p for p in (cut_ring(r, box) for r in rings) if len(p) > 2]
                # a ring inside an odd number of others is a hole
                signs = [(-1) ** sum(inside(p, q) for q in parts if q is not p) for p in parts]
                area.append(sum(s * ring_area(p) for s, p in zip(signs, parts, strict=True)))
                cut.append([[{"x": x, "y": y} for x, y in np.vstack([p, p[:1]]).tolist()] for p in parts])
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(cut, kind), pa.array(area, pa.float64())], names=[*kept, "rings", "area"])
            yield out.filter(pa.array(np.array(area) > 0, pa.bool_()))

    fields = T.StructType([*pairs.select(kept).schema.fields, *T.StructType.fromDDL(f"rings {RINGS}, area double")])
    return pairs.mapInArrow(run, fields)


def crossings(ring: np.ndarray, y: float) -> np.ndarray:
    """Where a ring crosses a horizontal line, from left to right."""
    a, b = ring, np.roll(ring, -1, axis=0)
    over = (a[:, 1] <= y) != (b[:, 1] <= y)
    return np.sort(a[over, 0] + (y - a[over, 1]) / (b[over, 1] - a[over, 1]) * (b[over, 0] - a[over, 0]))


def inside(ring: np.ndarray, other: np.ndarray) -> bool:
    """Whether a ring lies in another one that it does not cross."""
    if ring_area(ring) >= ring_area(other):
        return False
    y = (ring[:, 1].min() + ring[:, 1].max()) / 2
    x = crossings(ring, y)
    return len(x) > 1 and bool((crossings(other, y) > (x[0] + x[1]) / 2).sum() % 2)


def burn_polygons(polygons: DataFrame, res: float = 1.0) -> DataFrame:
    """The columns of polygons(.., rings) but rings, with (px, py) of each pixel whose centre lies inside by the even-odd rule.

    Scan lines give runs of pixels; Spark makes the pixels of the runs.
    """
    kept = [c for c in polygons.columns if c != "rings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows, low, high = [], [], [], []
            for k, rings in enumerate(rings_of(batch.column("rings"))):
                a = np.vstack([np.zeros((0, 2)), *rings]) / res
                b = np.vstack([np.zeros((0, 2)), *(np.roll(r, -1, axis=0) for r in rings)]) / res
                # every edge crosses the scan lines between its ends
                first, last = (np.ceil(f(a[:, 1], b[:, 1]) - 0.5).astype(np.int64) for f in (np.minimum, np.maximum))
                edge = np.repeat(np.arange(len(a)), last - first)
                row = np.arange(len(edge)) - np.repeat(np.cumsum(last - first) - (last - first) - first, last - first)
                x = a[edge, 0] + (row + 0.5 - a[edge, 1]) / (b[edge, 1] - a[edge, 1]) * (b[edge, 0] - a[edge, 0])
                order = np.lexsort((x, row))
                x, row = np.ceil(x[order] - 0.5).astype(np.int64).reshape(-1, 2), row[order].reshape(-1, 2)[:, 0]
                some = x[:, 0] < x[:, 1]
                of.append(np.full(some.sum(), k))
                rows.append(row[some])
                low.append(x[some, 0])
                high.append(x[some, 1] - 1)
            of = np.concatenate([np.zeros(0, np.int64), *of]).astype(np.int64)
            out = [batch.column(c).take(pa.array(of)) for c in kept] + [pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)) for x in (rows, low, high)]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, "py", "_low", "_high"])

    cast = polygons.select(*kept, F.col("rings").cast(RINGS).alias("rings"))
    fields = T.StructType([*cast.select(kept).schema.fields, *T.StructType.fromDDL("py long, _low long, _high long")])
    return cast.mapInArrow(run, fields).select(*kept, F.explode(F.sequence("_low", "_high")).alias("px"), "py")


def polygons_rasterized(polygons: DataFrame, how: str, value: str = "v", res: float = 1.0, start: float | None = None) -> DataFrame:
    """count: how many polygons cover a pixel (on top of start); value: the last burned in order of value."""
    if how not in BURN:
        raise ValueError(f"no order {how}")
    out = burn_polygons(polygons.select("rings", *([value] if how != "count" else [])), res).groupBy("px", "py").agg(BURN[how](value).alias(value if how != "count" else "n"))
    return out if how != "count" or not start else out.withColumn("n", F.col("n") + start)


def ring_column(l: Column, b: Column, r: Column, t: Column) -> Column:  # noqa: E741
    """A box as a closed ring."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(l, t), corner(r, t), corner(r, b), corner(l, b), corner(l, t))
