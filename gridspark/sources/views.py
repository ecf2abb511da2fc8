"""Views of the generic tables that stand for points, pixels, blocks, features, source files and tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "((event_id*37)%35990)/100.0D-179.95D as x", "((event_id*91+user_id)%17990)/100.0D-89.95D as y", "value", "event_type")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping files on one tile of 64 x 64 pixels; A below 5 is masked in M."""
    return table(spark, sf_dir, "lineitem").selectExpr("cast(l_suppkey%64 as int) as row_i", "cast(l_partkey%64 as int) as col_i", "l_orderkey*10+l_linenumber as k", "l_quantity as A", "cast(round(l_discount*100) as int) as B", "cast(round(l_tax*100) as int) as C", "case when l_quantity >= 5 then l_quantity end as M")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Float blocks of 8 x 8 as pixel rows."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), F.posexplode("embedding").alias("pos", "v")).selectExpr("tile", "cast(pos div 8 as int) as r", "cast(pos % 8 as int) as c", "cast(v as double) as v")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").selectExpr("c_custkey as fid", "cast((c_custkey*53)%3400 as double)/10-170 as l", "cast((c_custkey*29)%1600 as double)/10-80 as b", "c_mktsegment as seg", "c_nationkey as v")
    return base.selectExpr("fid", "l", "b", "l+1+fid%5 as r", "b+1+fid%4 as t", "seg", "v")


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as file_id", "concat('s3://bucket/raw/', lower(replace(s_name, '#', '_')), '.tif') as uri", "cast((s_suppkey*47)%340-170 as double) as l", "cast((s_suppkey*31)%160-80 as double) as b", "cast((s_suppkey*47)%340-160 as double) as r", "cast((s_suppkey*31)%160-70 as double) as t", "1+s_nationkey%3 as band_count")


def tiles10(spark: SparkSession) -> DataFrame:
    from ..functions.grids import latlng_tiles, tile_id

    return latlng_tiles(spark, 10).withColumn("tile_id", tile_id(F.col("left"), F.col("top"))).selectExpr("tile_id", "left", "top", "cast(left as double) as l", "cast(top-10 as double) as b", "cast(left+10 as double) as r", "cast(top as double) as t")


def feature_of(text: Column) -> Column:
    """(name, rings) of a GeoJSON feature: the rings of a polygon, or of all polygons of several, outer ones and holes."""
    f = F.from_json(text, "properties struct<name:string>, geometry struct<type:string,coordinates:string>")
    one = F.from_json(f["geometry"]["coordinates"], "array<array<array<double>>>")
    several = F.flatten(F.from_json(f["geometry"]["coordinates"], "array<array<array<array<double>>>>"))
    rings = F.when(f["geometry"]["type"] == "Polygon", one).when(f["geometry"]["type"] == "MultiPolygon", several)
    points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return F.struct(f["properties"]["name"].alias("name"), points.alias("rings"))


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """(name, rings) of a FeatureCollection's features; a feature that is no polygon has null rings."""
    texts = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "features array<string>")["features"]).alias("f"))
    return texts.select(feature_of(F.col("f")).alias("f")).select("f.*")


def vector_table(spark: SparkSession, url: str, name: str, bounds: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table of features over JDBC; bounds: a whole-number column, its range, and how many tasks read it side by side.

    Credentials come from the session's own configuration of the source, not from here.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    if bounds:
        column, low, high, tasks = bounds
        reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", tasks)
    return reader.load()


def dsn(host: str, port: int, database: str) -> str:
    """The address of a database for vector_table."""
    return f"jdbc:postgresql://{host}:{port}/{database}"


def job_catalogue(spark: SparkSession, listed: dict) -> DataFrame:
    """(layer, field, grid, type, uri, depends_on, calc, resampling, order, rasterize_method) of a nested catalogue, as a YAML or JSON parser gives it.

    listed: layer -> field -> settings with grids: grid -> settings.  A job's own settings come before its field's.
    """
    names = ("type", "uri", "depends_on", "calc", "resampling", "order", "rasterize_method")
    text = lambda x: None if x is None else ",".join(map(str, x)) if isinstance(x, (list, tuple)) else str(x)
    rows = []
    for layer, attributes in listed.items():
        for attribute, settings in attributes.items():
            for grid, own in (settings.get("grids") or {}).items():
                both = settings | (own or {})
                rows.append((layer, attribute, grid, *(text(both.get(k)) for k in names)))
    return spark.createDataFrame(rows, "layer string, field string, grid string, " + ", ".join(f"`{k}` string" for k in names))


def listing(spark: SparkSession, path: str, suffix: str = ".tif") -> DataFrame:
    """Files below a folder, or with a trailing * those whose path starts so; sizes come from the listing alone."""
    folder, prefix = (path[:-1].rsplit("/", 1)[0], path[:-1]) if path.endswith("*") else (path.rstrip("/"), path.rstrip("/") + "/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return files.where(F.regexp_replace("path", "^file:/+", "/").startswith(prefix))
