"""Catalogues: GeoJSON features, extents, job reports, dependency levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def feature_json(name: Column, l: Column, b: Column, r: Column, t: Column) -> Column:  # noqa: E741
    """A tile's footprint as a GeoJSON feature."""
    at = lambda x, y: F.array(x, y)
    ring = F.array(at(l, t), at(r, t), at(r, b), at(l, b), at(l, t))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(name.alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))


def extent(boxes: DataFrame) -> DataFrame:
    """Envelope and covered area of boxes that lie on one grid."""
    area = (F.col("r") - F.col("l")) * (F.col("t") - F.col("b"))
    return boxes.distinct().agg(F.min("l").alias("l"), F.min("b").alias("b"), F.max("r").alias("r"), F.max("t").alias("t"), F.sum(area).alias("area"))


def dissolved(boxes: DataFrame, cell: float, *keys: str) -> DataFrame:
    """(keys, l, b, r, t): boxes on a grid of cells as few boxes that cover the same and don't overlap.

    Cells are joined along rows first; runs that are alike in neighbouring rows are joined then.
    """
    steps = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell + 1e-9), F.ceil(F.col(high) / cell - 1e-9) - 1))
    cells = boxes.where("l < r and b < t").select(*keys, "l", "r", steps("b", "t").alias("y")).select(*keys, "y", steps("l", "r").alias("x")).distinct()
    row = Window.partitionBy(*keys, "y").orderBy("x")
    runs = cells.withColumn("g", F.col("x") - F.row_number().over(row)).groupBy(*keys, "y", "g").agg(F.min("x").alias("x0"), F.max("x").alias("x1"))
    stack = Window.partitionBy(*keys, "x0", "x1").orderBy("y")
    out = runs.withColumn("h", F.col("y") - F.row_number().over(stack)).groupBy(*keys, "x0", "x1", "h").agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    edge = lambda c: (F.col(c) * cell).cast("double")
    return out.select(*keys, edge("x0").alias("l"), edge("y0").alias("b"), (edge("x1") + cell).alias("r"), (edge("y1") + cell).alias("t"))


def collection(features: DataFrame, order: str = "feature") -> DataFrame:
    """One row with the GeoJSON of all features(feature), in order; an empty table gives an empty collection.

    The features are the tiles of a layer, whose number the grid bounds.
    """
    listed = F.transform(F.sort_array(F.collect_list(F.struct(order, F.col("feature").alias("_feature")))), lambda x: x["_feature"])
    return features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(listed, ","), F.lit("]}")).alias("geojson"))


def write_collection(features: DataFrame, path: str) -> None:
    """The collection as one text file below path."""
    collection(features).coalesce(1).write.mode("overwrite").text(path)


def exit_code(statuses: DataFrame) -> DataFrame:
    """0, or 1 if a tile failed, or 137 if a process was killed."""
    killed, failed = F.count_if(F.col("status") == "failed - subprocess was killed"), F.count_if(F.col("status").startswith("failed"))
    return statuses.agg(F.when(killed > 0, 137).when(failed > 0, 1).otherwise(0).alias("exit_code"))


def dag_levels(jobs: DataFrame) -> DataFrame:
    """(job, level) of jobs(job, parent): a job without a parent has level 0, others one more than their highest parent.

    Jobs that wait for ever have a null level: those of a cycle, those whose parent is no job, and what depends on either.
    Each level is found from the one before it alone, which is checkpointed where the session has a folder for that.
    """
    sc = jobs.sparkSession.sparkContext
    keep = (lambda df: df.checkpoint()) if sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) else (lambda df: df.persist())
    edges = jobs.select("job", "parent").distinct()
    named = edges.groupBy("job").agg(F.count("parent").alias("waits"))
    left = keep(named)
    now, k = left.where("waits = 0").select("job"), 0
    out = now.withColumn("level", F.lit(0))
    while not (now := keep(now)).isEmpty():
        # a job is ready at the level after its last parent's
        done = edges.join(now.select(F.col("job").alias("parent")), "parent").groupBy("job").agg(F.count("*").alias("done"))
        left = keep(left.join(done, "job", "left").select("job", (F.col("waits") - F.coalesce("done", F.lit(0))).alias("waits"), F.col("done").isNotNull().alias("moved")))
        k += 1
        now = left.where("waits = 0 and moved").select("job")
        out = out.union(now.withColumn("level", F.lit(k)))
        left = left.select("job", "waits")
    return named.select("job").join(out, "job", "left").select("job", "level")
