"""Codecs, checks and small rules as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .calc import DTYPES

#: Schemes and the prefixes that stand for them (fixed values).
VSI = {"s3": "/vsis3/", "gs": "/vsigs/"}


def to_vsi(uri: Column) -> Column:
    out = F.raise_error(F.concat(F.lit("no known scheme: "), uri)).cast("string")
    for scheme, prefix in VSI.items():
        out = F.when(uri.startswith(f"{scheme}://"), F.concat(F.lit(prefix), F.substring_index(uri, "://", -1))).otherwise(out)
    return out


def from_vsi(path: Column) -> Column:
    out = F.raise_error(F.concat(F.lit("no known prefix: "), path)).cast("string")
    for scheme, prefix in VSI.items():
        out = F.when(path.startswith(prefix), F.concat(F.lit(f"{scheme}://"), F.regexp_replace(path, f"^{prefix}", ""))).otherwise(out)
    return out


def url_parts(uri: Column) -> tuple[Column, Column, Column]:
    """Scheme, bucket and key; schemes other than s3 and gs are an error."""
    scheme = F.regexp_extract(uri, "^([a-z0-9]+)://", 1)
    known = F.when(scheme.isin(*VSI), scheme).otherwise(F.raise_error(F.concat(F.lit("no known scheme: "), uri)).cast("string"))
    return known, F.regexp_extract(uri, "^[a-z0-9]+://([^/]*)", 1), F.regexp_extract(uri, "^[a-z0-9]+://[^/]*/(.*)$", 1)


def path_parts(path: Column) -> tuple[Column, Column]:
    """File name, and what comes before it."""
    return F.substring_index(path, "/", -1), F.regexp_replace(path, "/[^/]*$", "")


def to_bool(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False).otherwise(F.raise_error(F.concat(F.lit("no truth value: "), text)).cast("boolean"))


def blocks_in_memory(memory: Column, divisor: Column | int, block_bytes: Column | int) -> Column:
    """How many blocks, as a square, a worker holds at once; at least one."""
    side = F.floor(F.sqrt(memory / (divisor * block_bytes)))
    return F.greatest(F.lit(1), side * side)


def chunk_divisor(divisor: Column, floats: Column, doubles: Column, bands: Column, workers: Column, has_calc: Column) -> Column:
    """The share of a worker's memory that a chunk may take: doubled for floats and again for doubles, times bands and co-workers, squared for a calculation."""
    out = divisor * F.when(doubles, 4).when(floats, 2).otherwise(1) * bands * F.when(workers >= 2, workers).otherwise(1)
    return F.when(has_calc, out * out).otherwise(out)


def vsi_key(path: Column) -> Column:
    """A prefixed path without its first three parts (the empty one, the prefix and the bucket)."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0))), "/")


def dense_index(column: str) -> Column:
    """Place among distinct values of a small table."""
    return F.dense_rank().over(Window.orderBy(column)).cast("int")


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """A global place by ranges: each range is numbered alone, and moved by the sizes of the ranges before it."""
    # a number of partitions keeps Spark from merging them differently in the two branches
    spread = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_part", F.spark_partition_id())
    numbered = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    before = numbered.groupBy("_part").agg(F.count("*").alias("_size")).withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(before, "_part").select(*df.columns, (F.col("_n") + F.col("_before")).cast("int").alias("place"))


def no_data_fits(dtype: Column, text: Column) -> Column:
    """Whether a no_data value, as it is written, suits the type: 0 for one bit, integers for integers, fractions for floats."""
    whole = text.rlike(r"^-?\d+$")
    floats = [k for k, v in DTYPES.items() if v[1] is None]
    return F.when(F.lower(dtype) == "boolean", text == "0").when(F.lower(dtype).isin(*floats), ~whole).otherwise(whole)


def source_fits(source_type: Column, uri: Column) -> Column:
    """Raster layers have a source, vector layers none."""
    return (source_type == "raster") == uri.isNotNull()


def nan_text(v: Column, digits: int = 4) -> Column:
    """Numbers as text, NaN as the word."""
    return F.when(F.isnan(v), "nan").otherwise(F.when(~F.isnan(v), v).cast(f"decimal(18,{digits})").cast("string"))
