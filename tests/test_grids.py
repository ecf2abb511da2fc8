import pytest
from pyspark.sql import functions as F

from gridspark.functions import grids as G


@pytest.mark.parametrize("width, cols, block", [(3, 33600, 480), (10, 40000, 400), (8, 32000, 400), (90, 27008, 128), (90, 9984, 416)])
def test_block_sizes(width, cols, block):
    assert G.latlng_grid(width, cols).block == block


def test_catalogue():
    assert len(G.CATALOGUE) == 31
    with pytest.raises(ValueError):
        G.grid_named("zoom_30")
    with pytest.raises(ValueError):
        G.latlng_grid(7, 4000)


@pytest.mark.parametrize("width, offset, x, y, want", [(10, 0, 0, 0, "00N_000E"), (10, 0, 1, 1, "10N_000E"), (10, 0, -1, -1, "00N_010W"), (10, 0, 90, 90, "90N_090E"), (8, 4, 0, 0, "04N_004W"), (8, 4, 1, 1, "04N_004W"), (8, 4, -5, 5, "12N_012W"), (8, 4, 5, -5, "04S_004E")])
def test_tile_ids(spark, width, offset, x, y, want):
    left, top = G.tile_origin(F.lit(float(x)), F.lit(float(y)), width, offset)
    assert spark.range(1).select(G.tile_id(left, top)).first()[0] == want


@pytest.mark.parametrize("width, n", [(1, 64800), (3, 7200), (10, 648), (90, 8), (8, 945)])
def test_tile_counts(spark, width, n):
    tiles = G.latlng_tiles(spark, width)
    assert tiles.distinct().count() == n
    g = next(g for g in G.CATALOGUE.values() if g.kind == "latlng" and g.width == width)
    assert g.tiles_x * g.tiles_y == n


@pytest.mark.parametrize("zoom, n", [(1, 1), (10, 16), (14, 4096)])
def test_mercator_tiles(spark, zoom, n):
    assert G.mercator_tiles(spark, zoom).count() == n


def test_points_off_the_grid_have_no_tile(spark):
    ids = lambda x, y, width, offset=0: spark.range(1).select(G.tile_id(*G.tile_origin(F.lit(float(x)), F.lit(float(y)), width, offset))).first()[0]
    assert ids(-180, 90, 10) == "90N_180W" and ids(179.9, -79.9, 10) == "70S_170E" and ids(179.9, -89.9, 10) == "80S_170E"
    assert ids(180, 0, 10) is None and ids(0, -90, 10) is None and ids(-180.5, 0, 10) is None and ids(0, 90.5, 10) is None
    assert ids(0, 89, 8, 4) is None and ids(0, 84, 8, 4) == "84N_004W"


def test_ids_of_high_zooms(spark):
    tiles = G.mercator_tiles(spark, 18)
    n = G.CATALOGUE["zoom_18"].tiles_x
    assert n == 1024 and tiles.select("tile_id").distinct().count() == n * n
    box = G.mercator_tile_box(F.col("tile_id"), 18)
    row = tiles.where("row = 1023 and col = 1000").select("tile_id", *(c.alias(x) for c, x in zip(box, "lbrt", strict=True))).first()
    side = 2 * G.HALF_WORLD / n
    assert row.tile_id == "1023R_1000C" and abs(row.b + G.HALF_WORLD) < 1e-6 and abs(row.l - (1000 * side - G.HALF_WORLD)) < 1e-6


def test_projections_invert_and_end_at_the_world(spark):
    at = spark.createDataFrame([(-179.5, -80.25), (0.0, 0.0), (12.75, 66.5)], "x double, y double")
    back = at.select("x", "y", G.longitude(G.mercator_x(F.col("x"))).alias("a"), G.latitude(G.mercator_y(F.col("y"))).alias("b")).collect()
    assert all(abs(r.x - r.a) < 1e-9 and abs(r.y - r.b) < 1e-9 for r in back)
    box = lambda *v, s="EPSG:4326", t="EPSG:3857": tuple(spark.range(1).select(*G.reprojected(*(F.lit(float(x)) for x in v), s, t)).first())
    whole = box(-180, -90, 180, 90)
    assert all(abs(abs(v) - G.HALF_WORLD) < 1e-2 for v in whole)
    assert all(abs(a - b) < 1e-6 for a, b in zip(box(*whole, s="EPSG:3857", t="EPSG:4326"), (-180, -G.MERCATOR_LAT, 180, G.MERCATOR_LAT), strict=True))
    assert box(1, 2, 3, 4, t="EPSG:4326") == (1, 2, 3, 4)
    with pytest.raises(ValueError):
        box(1, 2, 3, 4, t="EPSG:9999")


def test_snapping(spark):
    at = lambda lng, lat: tuple(round(v, 6) for v in spark.range(1).select(G.snapped(F.lit(lng), 0.00025, False), G.snapped(F.lit(lat), 0.00025, True)).first())
    assert at(10.111, 9.777) == (10.111, 9.777)
    assert at(10.1117, 9.7777) == (10.1115, 9.77775)


def test_round_trip_of_ids(spark):
    tiles = G.latlng_tiles(spark, 10).withColumn("tile", G.tile_id(F.col("left"), F.col("top")))
    left, top = G.tile_corner(F.col("tile"))
    assert tiles.where((left != F.col("left")) | (top != F.col("top"))).count() == 0
