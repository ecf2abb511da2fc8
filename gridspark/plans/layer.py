"""A layer's job as one plan: specification, tile statuses, pixels, catalogue."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calc import DTYPES, band_names, compile_calc, fill_cast
from ..functions.grids import grid_named
from ..operators.catalog import exit_code, feature_json
from ..operators.joins import box_join
from ..operators.raster import band_stats, mosaic, resampling_method, warp
from ..operators.vector import BURN, burn_boxes, burn_polygons, clipped, polygons_clipped

#: Versions (fixed value).
VERSION = r"^v\d{1,8}(\.\d{1,3}){0,2}?$|^latest$"
#: Bits that a narrower stored width may have, by type (fixed values).
NBITS = {8: range(1, 8), 16: range(9, 16), 32: range(17, 32)}

#: Tiles of a grid at most, for what the driver lists of them.
MAX_TILES = 1_000_000


@dataclass(frozen=True)
class LayerSpec:
    dataset: str
    version: str
    source_type: str
    pixel_meaning: str
    data_type: str
    grid: str
    source_uri: tuple[str, ...] = ()
    calc: str | None = None
    no_data: float | int | tuple | None = None
    nbits: int | None = None
    band_count: int = 1
    union_bands: bool = False
    resampling: str = "nearest"
    rasterize_method: str = "value"
    order: str | None = None
    photometric: str | None = None
    compute_stats: bool = False
    compute_histogram: bool = False
    symbology: dict = field(default_factory=dict)

    @staticmethod
    def parse(text: str, **over) -> LayerSpec:
        given = json.loads(text) | over
        if isinstance(uri := given.get("source_uri") or (), str):
            uri = [uri]
        no_data = given.get("no_data")
        return LayerSpec(**(given | {"source_uri": tuple(uri), "no_data": tuple(no_data) if isinstance(no_data, list) else no_data}))

    def __post_init__(self):
        if not re.match(VERSION, self.version):
            raise ValueError(f"no version: {self.version}")
        if self.source_type not in ("raster", "vector"):
            raise ValueError(f"no source type: {self.source_type}")
        if (self.source_type == "raster") != bool(self.source_uri):
            raise ValueError("raster layers need source_uri, vector layers have none")
        if self.data_type.lower() not in DTYPES:
            raise ValueError(f"no data type is called {self.data_type}")
        if self.rasterize_method not in ("value", "count") or self.order not in (None, "asc", "desc"):
            raise ValueError("unknown rasterize method or order")
        grid_named(self.grid)
        resampling_method(self.resampling)
        validate_no_data(self.data_type, self.no_data, self.nbits, self.band_count)

    @property
    def stored_nbits(self) -> int | None:
        if self.data_type.lower() == "boolean":
            return 1
        if self.data_type.lower() in ("float16", "half"):
            return 16
        _, bits, _ = DTYPES[self.data_type.lower()]
        return self.nbits if bits and self.nbits in NBITS[bits] else None

    @property
    def no_data_value(self) -> float | int | None:
        return self.no_data[0] if isinstance(self.no_data, tuple) else self.no_data


def validate_no_data(data_type: str, no_data, nbits: int | None, bands: int) -> None:
    values = no_data if isinstance(no_data, tuple) else (no_data,)
    if isinstance(no_data, tuple) and (len(values) != bands or len({str(v) for v in values}) != 1):
        raise ValueError("a list of no_data has one equal value for each band")
    stored, bits, _ = DTYPES[data_type.lower()]
    for v in values:
        if v is None:
            continue
        if (data_type.lower() == "boolean" or nbits == 1) and (v != 0 or isinstance(v, float)):
            raise ValueError("no_data of one bit is 0 or none")
        if bits and (isinstance(v, bool) or not isinstance(v, int)):
            raise ValueError(f"no_data of {stored} is an integer")
        if not bits and not isinstance(v, float):
            raise ValueError(f"no_data of {stored} is a float")


def status(in_subset: Column, meets: Column, exists: Column, has_data: Column, failed: Column | None = None) -> Column:
    """A tile's status: the first of the reasons in the order of the stages."""
    out = F.when(~in_subset, "skipped (not in subset)").when(~meets, "skipped (does not intersect)").when(exists, "existing").when(~has_data, "skipped (has no data)")
    return (out if failed is None else out.when(failed, "failed")).otherwise("processed")


def tile_prefix(spec: LayerSpec) -> str:
    code = grid_named(spec.grid).crs.lower().replace(":", "-")
    return "/".join((spec.dataset, spec.version, "raster", code, spec.grid, spec.pixel_meaning))


def profile(spec: LayerSpec, kind: str, left: float, top: float) -> dict:
    """What a tile's file declares; the plain format lacks what only one library reads."""
    grid = grid_named(spec.grid)
    stored, _, signed = DTYPES[spec.data_type.lower()]
    out = {
        "driver": "GTiff", "width": grid.cols, "height": grid.cols, "count": spec.band_count, "crs": grid.crs, "transform": (grid.res, 0.0, left, 0.0, -grid.res, top),
        "dtype": stored, "compress": "CCITTFAX4" if spec.data_type.lower() == "boolean" else "DEFLATE", "tiled": True, "blockxsize": grid.block, "blockysize": grid.block,
        "pixeltype": "SIGNEDBYTE" if stored == "int8" and signed else "DEFAULT", "nodata": spec.no_data_value, "sparse_ok": "TRUE", "interleave": "BAND",
    }
    out |= {"photometric": spec.photometric} if spec.photometric else {}
    out |= {"nbits": spec.stored_nbits} if spec.stored_nbits else {}
    if kind == "geotiff":
        out = {k: v for k, v in out.items() if k not in ("nbits", "sparse_ok", "interleave")} | {"compress": "DEFLATE"}
    return out


def chunk_blocks(spec: LayerSpec, source_type: str, memory: float, divisor: int = 4, workers: int = 1) -> int:
    """How many blocks of a tile a worker reads at once, as a square."""
    stored = DTYPES[spec.data_type.lower()][0]
    width = lambda kind: int("".join(c for c in kind if c.isdigit())) // 8
    either = (stored, DTYPES[source_type.lower()][0])
    divisor *= 4 if "float64" in either else 2 if any(k.startswith("float") for k in either) else 1
    divisor *= spec.band_count * (workers if workers >= 2 else 1)
    divisor = divisor**2 if spec.calc else divisor
    block = max(1, len(spec.source_uri)) * grid_named(spec.grid).block ** 2 * max(map(width, either))
    return max(1, int((memory / divisor / block) ** 0.5) ** 2)


def tile_path(spec: LayerSpec, tile: Column, kind: str) -> Column:
    return F.concat(F.lit(f"{tile_prefix(spec)}/{kind}/"), tile, F.lit(".tif"))


def transform(spec: LayerSpec, pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Blocks without valid pixels go; then calc, fill and cast: one output column a band."""
    some = pixels.where(F.coalesce(*bands).isNotNull())
    cols = {name: F.col(b) for name, b in zip(band_names(len(bands)), bands, strict=True)}
    out = compile_calc(spec.calc, cols) if spec.calc else list(cols.values())
    if len(out) != spec.band_count:
        raise ValueError(f"calc gives {len(out)} bands, the layer has {spec.band_count}")
    keys = [c for c in pixels.columns if c not in bands]
    return some.select(*keys, *(fill_cast(c, spec.no_data_value, spec.data_type).alias(f"band_{i + 1}") for i, c in enumerate(out)))


def prune(tiles: DataFrame, files: DataFrame, size: float) -> DataFrame:
    """Tiles that a source file overlaps; shared edges alone don't count."""
    return box_join(tiles, files.select("l", "b", "r", "t"), size, how="left_semi")


def write_blocks(blocks: DataFrame, path: str, slices: int = 32) -> None:
    """Pixel rows below one folder a tile; only the tiles that blocks has are replaced.

    A tile's rows are dealt to so many tasks by blocks of rows, so that no task holds a whole tile.
    """
    band = F.pmod(F.floor(F.col("r") / 256), F.lit(slices))
    blocks.repartition("tile_id", band).write.partitionBy("tile_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def written_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tile_id) of the tiles that a run has written below path; none if there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "tile_id string")
    return spark.read.schema("tile_id string").parquet(path).select("tile_id").distinct()


@dataclass(frozen=True)
class LayerRun:
    """What a run gives: (tile_id, status), the pixels of processed tiles, their statistics, and the catalogue's features."""

    statuses: DataFrame
    pixels: DataFrame
    stats: DataFrame
    features: DataFrame

    def report(self) -> DataFrame:
        return self.statuses.groupBy("status").agg(F.count("*").alias("n"))

    def exit_code(self) -> DataFrame:
        return exit_code(self.statuses)


def raster_bands(spec: LayerSpec, pixels: DataFrame, axes: tuple[DataFrame, DataFrame] | None) -> tuple[DataFrame, list[str]]:
    """Pixels(tile_id, band, k, r, c, v) as one column a band: mosaics, brought to the tile's raster where axes tell how.

    union_bands: all sources are one band, in which later ones cover earlier ones.
    """
    bands = [0] if spec.union_bands else list(range(max(1, len(spec.source_uri))))
    out = None
    for name, b in zip(band_names(len(bands)), bands, strict=True):
        own = pixels if spec.union_bands else pixels.where(F.col("band") == b)
        one = mosaic(own, "k", "v", ("tile_id", "r", "c"))
        if axes:
            one = warp(one, *axes, spec.resampling, "v", "r", "c", ("tile_id",))
        one = one.withColumnRenamed("v", name)
        out = one if out is None else out.join(one, ["tile_id", "r", "c"], "full_outer")
    return out, band_names(len(bands))


def run(spec: LayerSpec, tiles: DataFrame, source: DataFrame, path: str | None = None, files: DataFrame | None = None, subset: list[str] | None = None, overwrite: bool = False, existing: DataFrame | None = None, axes: tuple[DataFrame, DataFrame] | None = None, cell: float = 10.0, res: float = 1.0) -> LayerRun:
    """A layer from its specification to its report.

    tiles(tile_id, l, b, r, t); source: for raster layers pixels(tile_id, band, k, r, c, v), where k orders the files and
    band counts the sources from 0, and files(l, b, r, t) for the extents; for vector layers features(l, b, r, t, value,
    and rings where they are more than boxes), burned at res.  Tiles outside the subset, beyond the sources' extents, or
    there already (below path, or in existing) are left as they are, the last only without overwrite; the others are
    read, calculated, filled, cast and, with a path, written, and stay unwritten where they have no data.
    """
    spark = tiles.sparkSession
    there = existing if existing is not None else written_tiles(spark, path) if path else spark.createDataFrame([], "tile_id string")
    there = there if path is None or existing is not None else spark.createDataFrame([tuple(x) for x in there.limit(MAX_TILES).collect()], "tile_id string")
    flag = lambda df, name: df.select("tile_id").distinct().withColumn(name, F.lit(True))
    extents = source if spec.source_type == "vector" else files
    meets = tiles if extents is None else box_join(tiles, extents.select("l", "b", "r", "t"), cell, touching=spec.source_type == "vector", how="left_semi")
    marked = tiles.select("tile_id").join(flag(meets, "meets"), "tile_id", "left").join(flag(there, "there"), "tile_id", "left")
    marked = marked.withColumn("wanted", F.lit(True) if subset is None else F.col("tile_id").isin(*subset) if subset else F.lit(False))
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    todo = marked.where(on("wanted") & on("meets") & (F.lit(overwrite) | ~on("there"))).select("tile_id")
    if spec.source_type == "vector":
        if "rings" in source.columns:
            cut = polygons_clipped(tiles.join(todo, "tile_id", "left_semi"), source.select("value", "rings", "l", "b", "r", "t"), cell).select("tile_id", "value", "rings")
            burned = burn_polygons(cut, res)
        else:
            burned = burn_boxes(clipped(tiles.join(todo, "tile_id", "left_semi"), source.select("value", "l", "b", "r", "t"), cell), res)
        burned = burned.select("tile_id", "value", "px", "py")
        how = "count" if spec.rasterize_method == "count" else spec.order or "none"
        bands = burned.groupBy("tile_id", F.col("py").cast("int").alias("r"), F.col("px").cast("int").alias("c")).agg(BURN[how]("value").alias("A"))
        names = ["A"]
    else:
        bands, names = raster_bands(spec, source.join(todo, "tile_id", "left_semi"), axes)
    raster_spec = spec if spec.source_type == "raster" else replace(spec, calc=None)
    pixels = transform(raster_spec, bands, names)
    if path:
        write_blocks(pixels, path)
        pixels = spark.read.parquet(path).select(pixels.columns).join(todo, "tile_id", "left_semi")
    stats = band_stats(pixels, "band_1", "tile_id")
    done = flag(pixels, "done")
    full = marked.join(done, "tile_id", "left")
    statuses = full.select("tile_id", status(on("wanted"), on("meets"), on("there") & F.lit(not overwrite), on("done")).alias("status"))
    named = statuses.where(F.col("status").isin("processed", "existing")).join(tiles, "tile_id")
    features = named.select("tile_id", feature_json(tile_path(spec, F.col("tile_id"), "geotiff"), F.col("l"), F.col("b"), F.col("r"), F.col("t")).alias("feature"))
    return LayerRun(statuses, pixels, stats, features)
