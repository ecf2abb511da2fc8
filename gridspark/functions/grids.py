"""The named tile grids, and their arithmetic as Columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Radius of the sphere of web Mercator; half the side of its square world.
RADIUS = 6378137.0
HALF_WORLD = math.pi * RADIUS
#: Area of use of web Mercator in degrees: all longitudes, latitudes up to this (fixed value).
MERCATOR_LAT = 85.05112878
#: Named lat/lng grids (fixed values): tile width in degrees, pixels a side.
LATLNG = ((1, 4000), (3, 33600), (10, 40000), (10, 100000), (8, 32000), (90, 27008), (90, 9984), (90, 1008))
ZOOMS = range(23)
WM_BLOCK = 256


@dataclass(frozen=True)
class Grid:
    name: str
    kind: str
    crs: str
    width: float
    cols: int
    res: float
    block: int
    tiles_x: int
    tiles_y: int


def block_size(cols: int) -> int:
    """The largest multiple of 16 from 128 to 528 that divides the tile."""
    fits = [b for b in range(128, 529, 16) if cols % b == 0]
    if not fits:
        raise ValueError(f"no block of 128 to 528 pixels divides {cols}")
    return max(fits)


def latlng_grid(width: int, cols: int) -> Grid:
    if 360 % width or cols % 16 or (width % 2 and (360 % width or 180 % width)):
        raise ValueError(f"no grid of {width} degrees and {cols} pixels")
    return Grid(f"{width}/{cols}", "latlng", "EPSG:4326", width, cols, width / cols, block_size(cols), 360 // width, 2 * highest_top(width) // width)


def highest_top(width: int) -> int:
    """Top of the northernmost row: 90, or, where half a tile lies on either side of the equator, the last that fits."""
    return (90 - width // 2) // width * width + width // 2 if 180 % width else 90


def mercator_grid(zoom: int) -> Grid:
    side = max(1, 2**zoom * 256 // 65536)
    return Grid(f"zoom_{zoom}", "wm", "EPSG:3857", 2 * HALF_WORLD / side, 2**zoom * 256 // side, 2 * HALF_WORLD / (256 * 2**zoom), WM_BLOCK, side, side)


CATALOGUE = {g.name: g for g in [*(latlng_grid(*g) for g in LATLNG), *map(mercator_grid, ZOOMS)]}


def grid_named(name: str) -> Grid:
    if name not in CATALOGUE:
        raise ValueError(f"no grid is called {name}")
    return CATALOGUE[name]


def grids_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g.name, g.kind, g.crs, float(g.width), g.cols, g.res, g.block, g.tiles_x, g.tiles_y) for g in CATALOGUE.values()], "name string, kind string, crs string, width double, cols long, res double, block int, tiles_x long, tiles_y long")


def tile_origin(x: Column, y: Column, width: int, offset: int = 0) -> tuple[Column, Column]:
    """Left and top of the tile that holds a point; offset shifts both axes of grids that don't meet at zero.

    Both are null for a point whose tile would not lie on earth as a whole: it has no tile.
    """
    left = F.floor((x + offset) / width) * width - offset
    top = F.ceil((y + offset) / width) * width - offset
    there = left.between(-180, 180 - width) & top.between(width - 90, 90)
    return F.when(there, left).cast("int"), F.when(there, top).cast("int")


def padded(number: Column, digits: int) -> Column:
    """A whole number with leading zeros; longer ones keep all digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(digits), F.length(text)), "0")


def tile_id(left: Column, top: Column) -> Column:
    """A tile's name from its corner; null if that is."""
    lat = F.concat(padded(F.abs(top), 2), F.when(top >= 0, "N").otherwise("S"))
    lng = F.concat(padded(F.abs(left), 3), F.when(left >= 0, "E").otherwise("W"))
    return F.concat(lat, F.lit("_"), lng)


def tile_box(tile: Column, width: int) -> tuple[Column, Column, Column, Column]:
    """Left, bottom, right and top of a tile from its name, in degrees."""
    left, top = tile_corner(tile)
    return left.cast("double"), (top - width).cast("double"), (left + width).cast("double"), top.cast("double")


def tile_corner(tile: Column) -> tuple[Column, Column]:
    """Left and top from a tile's id."""
    lat, lng = F.split(tile, "_")[0], F.split(tile, "_")[1]
    top = F.substring(lat, 1, 2).cast("int") * F.when(lat.endswith("S"), -1).otherwise(1)
    left = F.substring(lng, 1, 3).cast("int") * F.when(lng.endswith("W"), -1).otherwise(1)
    return left, top


def latlng_tiles(spark: SparkSession, width: int) -> DataFrame:
    """(left, top) of all tiles of a grid, made by tasks."""
    highest = highest_top(width)
    n_x, n_y = 360 // width, 2 * highest // width
    i = F.col("id")
    left, top = F.pmod(i, F.lit(n_x)) * width - 180, F.lit(highest) - F.floor(i / n_x) * width
    return spark.range(n_x * n_y).select(left.cast("int").alias("left"), top.cast("int").alias("top"))


def mercator_tiles(spark: SparkSession, zoom: int) -> DataFrame:
    """Rows, columns and ids of a zoom level's tiles, made by tasks."""
    n = grid_named(f"zoom_{zoom}").tiles_x
    row, col = F.floor(F.col("id") / n).cast("int"), F.pmod("id", F.lit(n)).cast("int")
    return spark.range(n * n).select(row.alias("row"), col.alias("col"), mercator_tile_id(row, col).alias("tile_id"))


def mercator_tile_id(row: Column, col: Column) -> Column:
    return F.concat(padded(row, 3), F.lit("R_"), padded(col, 3), F.lit("C"))


def mercator_tile_box(tile: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    """Left, bottom, right and top of a tile from its name, in metres."""
    side = grid_named(f"zoom_{zoom}").width
    row, col = (F.regexp_extract(tile, p, 1).cast("long") for p in (r"^(\d+)R", r"_(\d+)C$"))
    return col * side - HALF_WORLD, HALF_WORLD - (row + 1) * side, (col + 1) * side - HALF_WORLD, HALF_WORLD - row * side


def snapped(v: Column, res: float, up: bool) -> Column:
    """The next pixel edge up (for latitudes) or down, counted from the whole degree above or below."""
    if up:
        return F.ceil(v) - F.floor((F.ceil(v) - v) / res + 1e-6) * res
    return F.floor(v) + F.floor((v - F.floor(v)) / res + 1e-6) * res


def mercator_x(lng: Column) -> Column:
    return F.radians(lng) * RADIUS


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * RADIUS


def longitude(x: Column) -> Column:
    """The inverse of mercator_x."""
    return F.degrees(x / RADIUS)


def latitude(y: Column) -> Column:
    """The inverse of mercator_y."""
    return F.degrees(F.lit(2.0) * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def world_bounds(crs: str) -> tuple[float, float, float, float]:
    """Left, bottom, right and top of the world in a system's own units."""
    if crs == "EPSG:4326":
        return -180.0, -90.0, 180.0, 90.0
    if crs == "EPSG:3857":
        return -HALF_WORLD, -HALF_WORLD, HALF_WORLD, HALF_WORLD
    raise ValueError(f"no bounds are known for {crs}")


def reprojected(l: Column, b: Column, r: Column, t: Column, source: str, target: str) -> tuple[Column, ...]:  # noqa: E741
    """A box in another system, edge by edge, rounded to 8 digits; what lies beyond the target's world ends at its edge."""
    if source == target:
        return tuple(F.round(c, 8) for c in (l, b, r, t))
    to = {("EPSG:4326", "EPSG:3857"): (mercator_x, mercator_y), ("EPSG:3857", "EPSG:4326"): (longitude, latitude)}
    if (source, target) not in to:
        raise ValueError(f"no way from {source} to {target}")
    x, y = to[source, target]
    low_x, low_y, high_x, high_y = map(F.lit, world_bounds(target))
    if target == "EPSG:3857":
        # at the poles the projection has no value
        b, t = (F.least(F.greatest(c, F.lit(-MERCATOR_LAT)), F.lit(MERCATOR_LAT)) for c in (b, t))
    inside = lambda c, low, high: F.round(F.least(F.greatest(c, low), high), 8)
    return inside(x(l), low_x, high_x), inside(y(b), low_y, high_y), inside(x(r), low_x, high_x), inside(y(t), low_y, high_y)


def destination_window(l: Column, b: Column, r: Column, t: Column, left: float, top: float, res: float, source: str, target: str) -> tuple[Column, ...]:  # noqa: E741
    """(col_off, row_off, width, height) in pixels of a raster of target (corner left, top) that a box of source covers."""
    wl, wb, wr, wt = reprojected(l, b, r, t, source, target)
    return (wl - left) / res, (F.lit(top) - wt) / res, (wr - wl) / res, (wt - wb) / res


def block_windows(width: Column, height: Column, block: Column | int) -> Column:
    """Array of (col_off, row_off, width, height): the blocks of a raster, those at the right and bottom cut."""
    block = F.lit(block) if isinstance(block, int) else block
    at = lambda size: F.when(size > 0, F.sequence(F.lit(0), size - 1, block)).otherwise(F.array().cast("array<int>"))
    window = lambda c, r: F.struct(c.alias("col_off"), r.alias("row_off"), F.least(block, width - c).alias("width"), F.least(block, height - r).alias("height"))
    return F.flatten(F.transform(at(height), lambda r: F.transform(at(width), lambda c: window(c, r))))


def pixel_window(a: tuple[Column, ...], b: tuple[Column, ...], res: float) -> tuple[Column, ...]:
    """(col_off, row_off, width, height) of what box b covers of box a (l, b, r, t each), in whole pixels of a (halves to even)."""
    px = lambda c: F.bround(c / res).cast("int")
    left, bottom, right, top = F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])
    return px(left - a[0]), px(a[3] - top), px(right - left), px(top - bottom)
