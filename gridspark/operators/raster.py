"""Mosaics, band stacks, resampling, statistics and histograms of pixel rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calc import DTYPES

#: Kernels that aggregate the source pixels of an output pixel.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "average": F.avg,
    "mode": lambda v: F.mode(v, True),
    "max": F.max,
    "min": F.min,
    "med": F.median,
    "q1": lambda v: F.percentile(v, 0.25),
    "q3": lambda v: F.percentile(v, 0.75),
    "sum": F.sum,
    "rms": lambda v: F.sqrt(F.avg(v * v)),
}
#: Kernels that weigh the neighbours of a place: how many pixels a side.
KERNELS = {"bilinear": 1, "cubic": 2, "cubic_spline": 2, "lanczos": 3}
METHODS = ("nearest", *KERNELS, *AGGREGATES)


def resampling_method(name: str) -> str:
    if name not in METHODS:
        raise ValueError(f"Cannot convert {name} to a resampling method")
    return name


def mosaic(pixels: DataFrame, order: str, value: str, keys: tuple[str, ...] = ("row_i", "col_i")) -> DataFrame:
    """For each pixel the valid value of the last file in order (of equal ones the greatest); masked values never cover valid ones."""
    return pixels.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(F.struct(order, value)).alias("_last")).select(*keys, F.col(f"_last.{value}").alias(value))


def band_stack(bands: list[DataFrame], keys: tuple[str, ...] = ("row_i", "col_i")) -> DataFrame:
    """Bands side by side; a pixel that one of them lacks is masked there."""
    out = bands[0]
    for b in bands[1:]:
        out = out.join(b, list(keys), "full_outer")
    return out


def resample(pixels: DataFrame, ratio: int, method: str, value: str = "v", row: str = "row_i", col: str = "col_i", group: tuple[str, ...] = (), size: tuple[int, int] | None = None) -> DataFrame:
    """Pixels at a resolution that is coarser by a whole ratio: (group, r, c, value)."""
    method = resampling_method(method)
    if method == "nearest":
        middle = (F.pmod(row, F.lit(ratio)) == ratio // 2) & (F.pmod(col, F.lit(ratio)) == ratio // 2)
        return pixels.where(middle).select(*group, F.floor(F.col(row) / ratio).cast("int").alias("r"), F.floor(F.col(col) / ratio).cast("int").alias("c"), value)
    if method in KERNELS:
        return interpolate(pixels, ratio, method, value, row, col, group, size)
    valid = pixels.where(F.col(value).isNotNull())
    return valid.groupBy(*group, F.floor(F.col(row) / ratio).cast("int").alias("r"), F.floor(F.col(col) / ratio).cast("int").alias("c")).agg(AGGREGATES[method](F.col(value)).alias(value))


def kernel(method: str, d: Column) -> Column:
    """Weight at a distance in pixels (at the source's resolution)."""
    x = F.abs(d)
    if method == "bilinear":
        return F.greatest(F.lit(0.0), 1 - x)
    if method == "cubic":  # Catmull-Rom
        near, far = 1.5 * x * x * x - 2.5 * x * x + 1, -0.5 * x * x * x + 2.5 * x * x - 4 * x + 2
        return F.when(x <= 1, near).when(x < 2, far).otherwise(0.0)
    if method == "cubic_spline":
        near, far = 2 / 3 - x * x + x * x * x / 2, (2 - x) * (2 - x) * (2 - x) / 6
        return F.when(x <= 1, near).when(x < 2, far).otherwise(0.0)
    px = x * math.pi
    return F.when(x == 0, 1.0).when(x < 3, 3 * F.sin(px) * F.sin(px / 3) / (px * px)).otherwise(0.0)


def interpolate(pixels: DataFrame, ratio: int, method: str, value: str, row: str, col: str, group: tuple[str, ...] = (), size: tuple[int, int] | None = None) -> DataFrame:
    """Each source pixel adds its weight to the output pixels whose centres it is near to; valid pixels share the weight.

    The kernel is as many times wider as the output is coarser, so that every source pixel counts.
    size: rows and columns of the source; kernels reach output pixels beyond it, which go.
    """
    reach = KERNELS[method] * ratio

    def near(c: str, name: str) -> Column:
        # output pixel o is centred at (o + 1/2) ratio - 1/2 in source pixels
        low, high = F.ceil((F.col(c) - reach + 0.5) / ratio - 0.5), F.floor((F.col(c) + reach + 0.5) / ratio - 0.5)
        return F.explode(F.sequence(low, high)).alias(name)

    spread = pixels.where(F.col(value).isNotNull()).select("*", near(row, "_r")).select("*", near(col, "_c"))
    at = lambda name, c: kernel(method, (F.col(c) - ((F.col(name) + 0.5) * ratio - 0.5)) / ratio)
    weight = (at("_r", row) * at("_c", col)).alias("_w")
    sums = spread.where("_r >= 0 and _c >= 0").select("*", weight).where("_w <> 0").groupBy(*group, F.col("_r").cast("int").alias("r"), F.col("_c").cast("int").alias("c")).agg(F.sum(F.col(value) * F.col("_w")).alias("_s"), F.sum("_w").alias("_w"))
    if size:
        sums = sums.where((F.col("r") * ratio < size[0]) & (F.col("c") * ratio < size[1]))
    return sums.where(F.abs("_w") > 1e-9).select(*group, "r", "c", (F.col("_s") / F.col("_w")).alias(value))


#: Rows of an axis up to which it is broadcast.
AXIS_ROWS = 1_000_000


def axis(spark: SparkSession, n: int, edge: Callable[[Column], Column], method: str) -> DataFrame:
    """(dst, src, w): which source rows (or columns) each of n output rows draws on, and their weights.

    edge: where in source pixels the output's edge k lies (and, with k + 1/2, its centre), rising or falling with k.  Any
    ratio and any projection that keeps rows apart from columns is expressed by it.
    """
    method = resampling_method(method)
    k = F.col("id")
    rows = spark.range(n).select(k.cast("int").alias("dst"), F.least(edge(k), edge(k + 1)).alias("low"), F.greatest(edge(k), edge(k + 1)).alias("high"), edge(k + 0.5).alias("middle"))
    if method == "nearest":
        out = rows.select("dst", F.floor("middle").alias("src"), F.lit(1.0).alias("w"))
    elif method in KERNELS:
        wide = rows.withColumn("scale", F.greatest(F.lit(1.0), F.col("high") - F.col("low")))
        reach = KERNELS[method] * F.col("scale")
        some = wide.withColumn("src", F.explode(F.sequence(F.floor(F.col("middle") - reach), F.ceil(F.col("middle") + reach))))
        out = some.select("dst", "src", kernel(method, (F.col("src") + 0.5 - F.col("middle")) / F.col("scale")).alias("w"))
    else:
        some = rows.withColumn("src", F.explode(F.sequence(F.floor("low"), F.ceil("high"))))
        out = some.select("dst", "src", (F.least(F.col("high"), F.col("src") + 1) - F.greatest(F.col("low"), "src")).alias("w")).where("w > 1e-12")
    return out.where("abs(w) > 1e-12").select("dst", F.col("src").cast("int").alias("src"), "w")


def warp(pixels: DataFrame, rows: DataFrame, cols: DataFrame, method: str, value: str = "v", row: str = "row_i", col: str = "col_i", group: tuple[str, ...] = ()) -> DataFrame:
    """Pixels on another raster: (group, r, c, value), by the axes of its rows and columns.

    Means and sums weigh a source pixel by the share that lies in the output pixel; the other aggregates count all that touch it.
    """
    method = resampling_method(method)
    side = lambda a, name, key, w: (F.broadcast(a) if a.count() <= AXIS_ROWS else a).select(F.col("dst").alias(name), F.col("src").alias(key), F.col("w").alias(w))
    met = pixels.where(F.col(value).isNotNull()).select(*group, row, col, value).join(side(rows, "_r", row, "_wr"), row).join(side(cols, "_c", col, "_wc"), col)
    v, w, at = F.col(value), F.col("_wr") * F.col("_wc"), (F.col("_r").alias("r"), F.col("_c").alias("c"))
    if method == "nearest":
        return met.select(*group, *at, value)
    if method in AGGREGATES and method not in ("average", "sum", "rms"):
        return met.groupBy(*group, "_r", "_c").agg(AGGREGATES[method](v).alias(value)).select(*group, *at, value)
    sums = met.groupBy(*group, "_r", "_c").agg(F.sum(v * w).alias("_s"), F.sum(v * v * w).alias("_q"), F.sum(w).alias("_w")).where(F.abs("_w") > 1e-9)
    out = {"sum": F.col("_s"), "rms": F.sqrt(F.col("_q") / F.col("_w"))}.get(method, F.col("_s") / F.col("_w"))
    return sums.select(*group, *at, out.alias(value))


def band_stats(pixels: DataFrame, value: str, *keys: str) -> DataFrame:
    """Count, minimum, maximum, mean and population deviation of valid pixels."""
    v = F.col(value).cast("double")
    return pixels.groupBy(*keys).agg(F.count(value).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std_dev"))


def byte_histogram(pixels: DataFrame, value: str) -> DataFrame:
    """256 buckets over -0.5 to 255.5, empty ones included."""
    counted = pixels.where(F.col(value).isNotNull()).groupBy(F.width_bucket(F.col(value).cast("double"), F.lit(-0.5), F.lit(255.5), F.lit(256)).alias("bucket")).agg(F.count("*").alias("n"))
    return pixels.sparkSession.range(1, 257).select(F.col("id").alias("bucket")).join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def metadata(pixels: DataFrame, bands: dict[str, tuple[str, float | None]], size: tuple[int, int], block: int, crs: str, *keys: str) -> DataFrame:
    """A row for each key with width, height, crs and bands: name, data type, no_data, block, statistics of valid pixels.

    bands: name -> (data type, no_data).  A band without valid pixels has null statistics.
    """

    def band(name: str, kind: str, no_data: float | None) -> Column:
        v = F.col(name).cast("double")
        stats = F.struct(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std_dev"))
        stored, bits, _ = DTYPES[kind.lower()]
        return F.struct(F.lit(name).alias("name"), F.lit(stored).alias("data_type"), F.lit(no_data).cast("double").alias("no_data"), F.lit(1 if kind.lower() == "boolean" else bits).alias("nbits"), F.lit(block).alias("blockxsize"), F.lit(block).alias("blockysize"), F.when(F.count(v) > 0, stats).alias("stats"))

    out = pixels.groupBy(*keys).agg(F.array(*(band(n, k, x) for n, (k, x) in bands.items())).alias("bands"))
    return out.select(*keys, F.lit(size[0]).alias("width"), F.lit(size[1]).alias("height"), F.lit(crs).alias("crs"), "bands")


def histogram(pixels: DataFrame, value: str, low: float, high: float, buckets: int, *keys: str) -> DataFrame:
    """(keys, bucket, n) over equal buckets of low to high; values outside count in the first or last, empty buckets are left out."""
    at = F.least(F.greatest(F.width_bucket(F.col(value).cast("double"), F.lit(low), F.lit(high), F.lit(buckets)), F.lit(1)), F.lit(buckets))
    return pixels.where(F.col(value).isNotNull()).groupBy(*keys, at.alias("bucket")).agg(F.count("*").alias("n"))
