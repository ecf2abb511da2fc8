import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.operators import catalog, raster, vector
from gridspark.operators.joins import box_join
from gridspark.plans import layer
from gridspark.plans.layer import LayerSpec, status, tile_path, transform
from gridspark.sources import tiff, views

SPEC = {"dataset": "snow", "version": "v7", "source_type": "raster", "pixel_meaning": "depth_cm", "data_type": "uint16", "grid": "10/40000", "source_uri": ("s3://b/k",)}


@pytest.mark.parametrize("version, ok", [("v7", True), ("v20240131", True), ("v10.20.30", True), ("latest", True), ("v7.x", False), ("7", False), ("ver7", False), ("v7.1.2.3", False), ("latest7", False)])
def test_versions(version, ok):
    if ok:
        LayerSpec(**SPEC | {"version": version})
    else:
        with pytest.raises(ValueError):
            LayerSpec(**SPEC | {"version": version})


@pytest.mark.parametrize("change", [{"grid": "5/5"}, {"source_uri": ()}, {"source_type": "vector"}, {"data_type": "text"}, {"no_data": 1.5}, {"no_data": (0, 0)}, {"data_type": "boolean", "no_data": 1}, {"data_type": "float32", "no_data": 1}, {"resampling": "gauss"}])
def test_rejections(change):
    with pytest.raises(ValueError):
        LayerSpec(**SPEC | change)


def test_spec_details(spark):
    assert LayerSpec(**SPEC | {"nbits": 12}).stored_nbits == 12
    assert LayerSpec(**SPEC | {"nbits": 16}).stored_nbits is None
    assert LayerSpec(**SPEC | {"data_type": "boolean"}).stored_nbits == 1
    assert LayerSpec.parse('{"dataset":"d","version":"v1","source_type":"raster","pixel_meaning":"is","data_type":"uint8","grid":"1/4000","source_uri":"s3://b/k","no_data":[0],"calc":"A+1"}').no_data_value == 0
    path = spark.range(1).select(tile_path(LayerSpec(**SPEC), F.lit("10N_010E"), "geotiff")).first()[0]
    assert path == "snow/v7/raster/epsg-4326/10/40000/depth_cm/geotiff/10N_010E.tif"


def test_transform_drops_empty_blocks(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 2.0), (0, 1, None, None), (0, 2, None, 5.0)], "r int, c int, A double, B double")
    out = transform(LayerSpec(**SPEC | {"calc": "A + B", "no_data": 7}), df, ["A", "B"])
    assert sorted(map(tuple, out.collect())) == [(0, 0, 3), (0, 2, 7)]


def test_status_order(spark):
    t, f = F.lit(True), F.lit(False)
    row = spark.range(1).select(status(f, f, t, f), status(t, f, t, f), status(t, t, t, f), status(t, t, f, f), status(t, t, f, t, t), status(t, t, f, t)).first()
    assert list(row) == ["skipped (not in subset)", "skipped (does not intersect)", "existing", "skipped (has no data)", "failed", "processed"]


def test_box_join_equals_nested_loop(spark):
    boxes = lambda seed: spark.createDataFrame([(i, float((i * 7 + seed) % 41 - 20), float((i * 11 + seed) % 37 - 18), float((i * 7 + seed) % 41 - 19 + i % 7), float((i * 11 + seed) % 37 - 17 + i % 5)) for i in range(120)], "id long, l double, b double, r double, t double")
    a, b = boxes(1), boxes(5)
    for touching, op in ((False, "<"), (True, "<=")):
        want = a.alias("a").join(b.alias("b"), F.expr(f"a.l {op} b.r and b.l {op} a.r and a.b {op} b.t and b.b {op} a.t")).select("a.id", "b.id").collect()
        got = box_join(a, b, 4.0, touching).select("a.id", "b.id").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_kernels_keep_constants(spark):
    df = spark.range(400).selectExpr("cast(id div 20 as int) row_i", "cast(id % 20 as int) col_i", "3.5D v")
    for method in raster.METHODS:
        out = [r.v for r in raster.resample(df, 4, method, "v", size=(20, 20)).collect()]
        assert len(out) == 25 and all(abs(v - (56 if method == "sum" else 3.5)) < 1e-9 for v in out)
    with pytest.raises(ValueError):
        raster.resample(df, 4, "gauss", "v")


def test_statistics(spark):
    df = spark.range(4000).selectExpr("1 tile", "cast(id % 4 + 1 as double) v")
    r = raster.band_stats(df, "v", "tile").first()
    assert (r.min, r.max, r.mean, round(r.std_dev, 3)) == (1, 4, 2.5, 1.118)
    h = {x.bucket: x.n for x in raster.byte_histogram(df, "v").collect()}
    assert len(h) == 256 and h[1] == 0 and h[2] == 1000


BOX = [(1.0, 1.0), (4.0, 1.0), (4.0, 3.0), (1.0, 3.0)]
HOLE = [(2.0, 1.5), (3.0, 1.5), (3.0, 2.5), (2.0, 2.5)]
FAR = [(6.0, 1.0), (9.0, 1.2), (7.0, 4.0)]


def polygons(spark, *shapes):
    closed = lambda ring: [{"x": x, "y": y} for x, y in [*ring, ring[0]]]
    rows = [(i, [closed(r) for r in rings], *(f(p[k] for r in rings for p in r) for f, k in ((min, 0), (min, 1), (max, 0), (max, 1)))) for i, rings in enumerate(shapes)]
    return spark.createDataFrame(rows, f"fid long, rings {vector.RINGS}, l double, b double, r double, t double")


def even_odd(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            odd ^= (ay <= y) != (by <= y) and x < ax + (y - ay) / (by - ay) * (bx - ax)
    return odd


def test_polygons_are_burned_by_their_centres(spark):
    shapes = [[BOX], [BOX, HOLE], [BOX, HOLE, FAR], [[(0.1, 0.2), (5.3, 1.1), (2.2, 4.7)]], [[(0.0, 0.0), (0.3, 0.0), (0.0, 0.3)]]]
    for res in (1.0, 0.25):
        got = {(r.fid, r.px, r.py) for r in vector.burn_polygons(polygons(spark, *shapes).drop("l", "b", "r", "t"), res).collect()}
        want = {(i, px, py) for i, rings in enumerate(shapes) for px in range(-2, 50) for py in range(-2, 50) if even_odd(rings, (px + 0.5) * res, (py + 0.5) * res)}
        assert got == want
    assert vector.burn_polygons(polygons(spark, [BOX]).limit(0).select("rings")).count() == 0


def test_polygons_are_cut_to_tiles(spark):
    tiles = spark.createDataFrame([("a", 0.0, 0.0, 2.5, 2.0), ("b", 2.5, 0.0, 5.0, 2.0), ("c", 0.0, 2.0, 2.5, 4.0), ("d", 2.5, 2.0, 10.0, 4.0), ("e", 4.0, 0.0, 5.0, 1.0)], "tile_id string, l double, b double, r double, t double")
    out = {(r.tile_id, r.fid): r for r in vector.polygons_clipped(tiles, polygons(spark, [BOX], [BOX, HOLE], [BOX, FAR]), 2.0).collect()}
    # what only touches is dropped; the hole is taken off where it lies
    assert {k: round(r.area, 9) for k, r in out.items() if k[1] < 2} == {("a", 0): 1.5, ("b", 0): 1.5, ("c", 0): 1.5, ("d", 0): 1.5, ("a", 1): 1.25, ("b", 1): 1.25, ("c", 1): 1.25, ("d", 1): 1.25}
    assert len(out["a", 1].rings) == 2 and all(0 <= p.x <= 2.5 and 0 <= p.y <= 2 for r in out["a", 1].rings for p in r)
    assert all(r[0] == r[-1] for r in out["a", 1].rings)


def test_features_with_holes_and_parts(spark, tmp_path):
    polygon = '{"type":"Feature","properties":{"name":"p"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[9,0],[9,9],[0,0]],[[5,1],[6,1],[6,2],[5,1]]]}}'
    several = '{"type":"Feature","properties":{"name":"m"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}'
    point = '{"type":"Feature","properties":{"name":"x"},"geometry":{"type":"Point","coordinates":[0,0]}}'
    (tmp_path / "t.geojson").write_text('{"type":"FeatureCollection","features":[%s]}' % ",".join((polygon, several, point)))
    rows = {r.name: r.rings for r in views.geojson_features(spark, str(tmp_path / "t.geojson")).collect()}
    assert [len(r) for r in rows["p"]] == [4, 4] and [len(r) for r in rows["m"]] == [4, 4] and rows["x"] is None
    features = spark.createDataFrame([(polygon,), (several,)], "feature string")
    catalog.write_collection(features, str(tmp_path / "out"))
    assert {r.name for r in views.geojson_features(spark, str(tmp_path / "out")).collect()} == {"p", "m"}
    assert catalog.collection(features.limit(0)).first()[0] == '{"type":"FeatureCollection","features":[]}'


def test_dissolve(spark):
    boxes = [(0, 0, 2, 2), (1, 1, 3, 2), (2, 0, 3, 1), (5, 5, 6, 6), (5, 5, 6, 6), (1, 1, 1, 1)]
    df = spark.createDataFrame([tuple(map(float, b)) for b in boxes], "l double, b double, r double, t double")
    got = sorted(tuple(r) for r in catalog.dissolved(df, 1.0).collect())
    assert got == [(0, 0, 3, 2), (5, 5, 6, 6)]
    assert catalog.dissolved(df.limit(0), 1.0).count() == 0


def test_semi_join_keeps_equal_rows(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 25.0, 1.0), (1, 0.0, 0.0, 25.0, 1.0), (2, 40.0, 0.0, 41.0, 1.0)], "id long, l double, b double, r double, t double")
    b = spark.createDataFrame([(0.0, 0.0, 30.0, 1.0), (5.0, 0.0, 6.0, 1.0)], "l double, b double, r double, t double")
    assert [r.id for r in box_join(a, b, 10.0, how="left_semi").collect()] == [1, 1]


def test_levels_of_long_chains_and_cycles(spark):
    chain = [(0, None), *((i, i - 1) for i in range(1, 70))]
    odd = [(100, 101), (101, 100), (102, 100), (200, 999), (300, 3), (300, 9), (400, None), (400, 0)]
    got = {r.job: r.level for r in catalog.dag_levels(spark.createDataFrame(chain + odd, "job long, parent long")).collect()}
    assert all(got[i] == i for i in range(70)) and got[300] == 10 and got[400] == 1
    assert all(got[i] is None for i in (100, 101, 102, 200))


def test_warp_by_axes(spark):
    """Against plain loops: any ratio, rows that run the other way, weights of shares."""
    df = spark.range(120).selectExpr("cast(id div 12 as int) row_i", "cast(id % 12 as int) col_i", "cast(id * id % 31 as double) v")
    v = {(r.row_i, r.col_i): r.v for r in df.collect()}
    edge_r, edge_c = (lambda k: 10 - 2.5 * k), (lambda k: 1.0 + 1.7 * k)
    span = lambda e, o: (min(e(o), e(o + 1)), max(e(o), e(o + 1)))
    share = lambda low, high, s: max(0, min(high, s + 1) - max(low, s))
    for method in ("average", "nearest", "min"):
        rows, cols = raster.axis(spark, 4, lambda k: 10 - 2.5 * k, method), raster.axis(spark, 6, lambda k: 1.0 + 1.7 * k, method)
        got = {(r.r, r.c): r.v for r in raster.warp(df, rows, cols, method).collect()}
        for r in range(4):
            for c in range(6):
                if method == "nearest":
                    want = v.get((int(edge_r(r + 0.5) // 1), int(edge_c(c + 0.5) // 1)))
                else:
                    near = {k: share(*span(edge_r, r), k[0]) * share(*span(edge_c, c), k[1]) for k in v}
                    near = {k: w for k, w in near.items() if w > 1e-9}
                    want = None if not near else min(v[k] for k in near) if method == "min" else sum(v[k] * w for k, w in near.items()) / sum(near.values())
                assert (got.get((r, c)) is None) == (want is None) and (want is None or abs(got[r, c] - want) < 1e-9)
    flat = df.withColumn("v", F.lit(2.5))
    for method in raster.METHODS:
        out = [r.v for r in raster.warp(flat, raster.axis(spark, 4, lambda k: k * 2.5, method), raster.axis(spark, 6, lambda k: k * 2.0, method), method).collect()]
        assert len(out) == 24 and all(abs(x - (12.5 if method == "sum" else 2.5)) < 1e-9 for x in out)


def test_metadata(spark):
    df = spark.createDataFrame([("t", 1.0, None), ("t", 3.0, None), ("u", None, 2.0)], "tile string, A double, B double")
    rows = {r.tile: r for r in raster.metadata(df, {"A": ("uint8", 0), "B": ("boolean", None)}, (64, 32), 16, "EPSG:4326", "tile").collect()}
    a, b = rows["t"].bands
    assert (a.name, a.data_type, a.no_data, a.nbits, a.stats.min, a.stats.max, a.stats.mean, a.stats.std_dev) == ("A", "uint8", 0, 8, 1, 3, 2, 1)
    assert (b.data_type, b.nbits, b.stats) == ("uint8", 1, None) and (rows["u"].width, rows["u"].height) == (64, 32)


def test_profiles_and_chunks():
    spec = LayerSpec(**SPEC | {"nbits": 12, "photometric": "MINISBLACK"})
    big, plain = layer.profile(spec, "gdal-geotiff", 10.0, 20.0), layer.profile(spec, "geotiff", 10.0, 20.0)
    assert big["nbits"] == 12 and big["transform"] == (0.00025, 0.0, 10.0, 0.0, -0.00025, 20.0) and big["photometric"] == "MINISBLACK"
    assert not {"nbits", "sparse_ok", "interleave"} & plain.keys() and plain["compress"] == "DEFLATE"
    assert layer.profile(LayerSpec(**SPEC | {"data_type": "int8"}), "geotiff", 0, 0)["pixeltype"] == "SIGNEDBYTE"
    blocks = lambda source, memory, **change: layer.chunk_blocks(LayerSpec(**SPEC | change), source, memory)
    one = 400 * 400 * 2
    assert blocks("uint16", 4 * 9 * one) == 9 and blocks("float32", 8 * 9 * 2 * one) == 9 and blocks("float64", 16 * 9 * 4 * one) == 9
    assert blocks("uint16", 16 * 9 * one, calc="A") == 9 and blocks("uint16", 1) == 1


def test_job_catalogue(spark):
    listed = {"trees": {"cover": {"calc": "A", "type": "raster", "grids": {"10/40000": {"uri": ["s3://a", "s3://b"]}, "1/4000": {"depends_on": "trees/cover", "calc": "A+1"}}}}, "roads": {"is": {"grids": None}}}
    rows = sorted(tuple(r)[:7] for r in views.job_catalogue(spark, listed).collect())
    assert rows == [("trees", "cover", "1/4000", "raster", None, "trees/cover", "A+1"), ("trees", "cover", "10/40000", "raster", "s3://a,s3://b", None, "A")]


def header(**change):
    return tiff.Header(**{"width": 50, "height": 40, "count": 2, "dtype": "int16", "nbits": 16, "compress": "DEFLATE", "tiled": True, "blockxsize": 16, "blockysize": 16, "interleave": "BAND", "crs": "EPSG:4326", "no_data": -1.0, "transform": (0.25, 0.0, 10.0, 0.0, -0.25, 20.0)} | change)


def test_rasters_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    bands = rng.integers(-1, 5, (2, 40, 50)).astype("int16")
    bands[:, :16, :16] = -1
    for name, h in (("a", header()), ("b", header(compress=None, dtype="float32", nbits=32)), ("c", header(dtype="uint8", nbits=8, no_data=None))):
        data = bands.astype(h.dtype) if h.dtype != "uint8" else (bands + 1).astype("uint8")
        tiff.put(f"{tmp_path}/{name}.tif", tiff.encode(data, h))
    files = tiff.listed(spark, [f"{tmp_path}/{n}.tif" for n in "abc"])
    rows = {r.path[-5]: r for r in tiff.profiles(files).collect()}
    a = rows["a"]
    assert (a.width, a.height, a["count"], a.dtype, a.compress, a.tiled, a.blockxsize, a.interleave, a.crs, a.no_data) == (50, 40, 2, "int16", "DEFLATE", True, 16, "BAND", "EPSG:4326", -1)
    assert (a.l, a.b, a.r, a.t) == (10, 10, 22.5, 20) and rows["b"].compress is None and rows["c"].no_data is None
    got = {(r.band, r.r, r.c): r.v for r in tiff.pixels(files.where("path like '%a.tif'")).collect()}
    assert len(got) == 4000 and all((v is None) == (bands[k] == -1) and v in (None, bands[k]) for k, v in got.items())
    part = tiff.pixels(files.where("path like '%b.tif'"), (14, 10, 20, 9)).collect()
    assert {(r.band, r.r, r.c) for r in part} == {(b, r, c) for b in (0, 1) for r in range(10, 19) for c in range(14, 34)}
    assert tiff.pixels(files, (60, 0, 5, 5)).count() == 0
    with open(f"{tmp_path}/a.tif", "rb") as f:
        h = tiff.read_header(f)
    assert 0 in h.sizes and sum(x == 0 for x in h.sizes) == 2
    copies = {r.path[-5]: r.copy for r in tiff.convert(files, f"{tmp_path}/copies", None).collect()}
    again = {(r.band, r.r, r.c): r.v for r in tiff.pixels(tiff.listed(spark, [copies["a"]])).collect()}
    assert again == got and tiff.profiles(tiff.listed(spark, [copies["a"]])).first().compress is None
    (tmp_path / "x.tif").write_bytes(b"nothing")
    for bad in ("x", "missing"):
        with pytest.raises(Exception, match=f"{bad}.tif"):
            tiff.profiles(tiff.listed(spark, [f"{tmp_path}/{bad}.tif"])).collect()


def test_window_files(spark, tmp_path):
    rows = [("10N_010E", 10.0, 20.0, r, c, [float(r * 50 + c), 1.0]) for r in (0, 15, 16, 39) for c in range(50)]
    blocks = spark.createDataFrame(rows, "tile_id string, left double, top double, r int, c int, bands array<double>")
    out = [r.path for r in tiff.write_windows(blocks, str(tmp_path), header(), 16).collect()]
    assert sorted(p.rsplit("/", 1)[1] for p in out) == sorted(f"10N_010E_{c}_{r}.tif" for c in (0, 16, 32, 48) for r in (0, 16, 32))
    one = tiff.profiles(tiff.listed(spark, [f"{tmp_path}/10N_010E_48_32.tif"])).first()
    assert (one.width, one.height, one.l, one.t) == (2, 8, 22.0, 12.0)
    got = {(r.band, r.r, r.c): r.v for r in tiff.pixels(tiff.listed(spark, [f"{tmp_path}/10N_010E_48_32.tif"])).where("v is not null").collect()}
    assert got == {(0, 7, 0): 1998.0, (0, 7, 1): 1999.0, (1, 7, 0): 1.0, (1, 7, 1): 1.0}


TILES = [("10N_000E", 0.0, 0.0, 10.0, 10.0), ("10N_010E", 10.0, 0.0, 20.0, 10.0), ("20N_000E", 0.0, 10.0, 10.0, 20.0), ("20N_010E", 10.0, 10.0, 20.0, 20.0), ("30N_000E", 0.0, 20.0, 10.0, 30.0)]


def test_a_run_and_its_resumption(spark, tmp_path):
    """Later files cover earlier ones, bands meet, empty tiles stay unwritten, and tiles that are there are kept."""
    path = str(tmp_path / "layer")
    tiles = spark.createDataFrame(TILES, "tile_id string, l double, b double, r double, t double")
    files = spark.createDataFrame([(1.0, 1.0, 12.0, 12.0)], "l double, b double, r double, t double")
    spec = LayerSpec(**SPEC | {"source_uri": ("s3://b/k", "s3://b/l"), "calc": "A + B", "no_data": 0})
    rows = [("10N_000E", 0, 1, 0, 0, 5.0), ("10N_000E", 0, 2, 0, 0, 7.0), ("10N_000E", 0, 3, 0, 0, None), ("10N_000E", 1, 1, 0, 0, 100.0), ("10N_000E", 1, 1, 0, 1, 1.0), ("10N_010E", 0, 1, 5, 5, 1.0), ("10N_010E", 1, 1, 5, 5, 2.0), ("30N_000E", 0, 1, 0, 0, 9.0)]
    pixels = lambda rows: spark.createDataFrame(rows, "tile_id string, band int, k long, r int, c int, v double")
    done = layer.run(spec, tiles, pixels(rows), path, files, subset=["10N_000E", "20N_010E", "20N_000E", "30N_000E"])
    want = {"10N_000E": "processed", "10N_010E": "skipped (not in subset)", "20N_000E": "skipped (has no data)", "20N_010E": "skipped (has no data)", "30N_000E": "skipped (does not intersect)"}
    assert {r.tile_id: r.status for r in done.statuses.collect()} == want
    assert sorted((r.tile_id, r.r, r.c, r.band_1) for r in done.pixels.collect()) == [("10N_000E", 0, 0, 107), ("10N_000E", 0, 1, 0)]
    assert done.stats.first().max == 107 and done.exit_code().first()[0] == 0 and done.features.count() == 1
    # the next run finds the tile, keeps it, and adds the other
    again = layer.run(spec, tiles, pixels([(t, b, k, r, c, 50.0) for t, b, k, r, c, _ in rows]), path, files)
    assert {r.tile_id: r.status for r in again.statuses.collect()} == want | {"10N_000E": "existing", "10N_010E": "processed"}
    assert {(r.tile_id, r.r, r.c): r.band_1 for r in spark.read.parquet(path).collect()} == {("10N_000E", 0, 0): 107, ("10N_000E", 0, 1): 0, ("10N_010E", 5, 5): 100}
    over = layer.run(spec, tiles, pixels([(t, b, k, r, c, 50.0) for t, b, k, r, c, _ in rows]), path, files, subset=["10N_000E"], overwrite=True)
    assert {r.status for r in over.statuses.where("tile_id = '10N_000E'").collect()} == {"processed"}
    assert {(r.tile_id, r.r, r.c): r.band_1 for r in spark.read.parquet(path).collect()} == {("10N_000E", 0, 0): 100, ("10N_000E", 0, 1): 0, ("10N_010E", 5, 5): 100}
    assert {r.tile_id: r.n for r in layer.run(spec, tiles, pixels(rows), path, files, subset=[]).report().withColumnRenamed("status", "tile_id").collect()} == {"skipped (not in subset)": 5}


def test_vector_and_warped_runs(spark):
    tiles = spark.createDataFrame(TILES, "tile_id string, l double, b double, r double, t double")
    spec = LayerSpec(**{k: v for k, v in SPEC.items() if k != "source_uri"} | {"source_type": "vector", "data_type": "uint8", "order": "desc"})
    shapes = polygons(spark, [[(1.0, 1.0), (4.0, 1.0), (4.0, 4.0), (1.0, 4.0)], [(2.0, 2.0), (3.0, 2.0), (3.0, 3.0), (2.0, 3.0)]], [[(3.0, 3.0), (12.0, 3.0), (12.0, 5.0), (3.0, 5.0)]]).withColumn("value", F.col("fid") + 1)
    done = layer.run(spec, tiles, shapes)
    burned = {(r.tile_id, r.r, r.c): r.band_1 for r in done.pixels.collect()}
    assert len(burned) == 8 + 13 + 4 and burned["10N_000E", 3, 3] == 1 and ("10N_000E", 2, 2) not in burned and burned["10N_010E", 4, 11] == 2
    assert {r.status for r in done.statuses.where("tile_id = '30N_000E'").collect()} == {"skipped (does not intersect)"}
    counted = layer.run(LayerSpec(**spec.__dict__ | {"rasterize_method": "count"}), tiles, shapes)
    assert {(r.tile_id, r.r, r.c): r.band_1 for r in counted.pixels.collect()}["10N_000E", 3, 3] == 2
    boxes = layer.run(spec, tiles, shapes.drop("rings"))
    assert boxes.pixels.count() == 9 + 13 + 4
    pixels = spark.range(100).selectExpr("'10N_000E' tile_id", "0 band", "1L k", "cast(id div 10 as int) r", "cast(id % 10 as int) c", "cast(id as double) v")
    one = raster.axis(spark, 4, lambda k: k * 2.5, "average")
    warped = layer.run(LayerSpec(**SPEC | {"resampling": "average", "union_bands": True}), tiles, pixels, axes=(one, one))
    assert warped.pixels.count() == 16


def test_catalogue(spark, tmp_path):
    jobs = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "job string, parent string")
    assert {r.job: r.level for r in catalog.dag_levels(jobs).collect()} == {"a": 0, "b": 1, "c": 2}
    codes = [catalog.exit_code(spark.createDataFrame([(s,) for s in x], "status string")).first()[0] for x in (["processed"], ["failed"], ["failed", "failed - subprocess was killed"])]
    assert codes == [0, 1, 137]
    box = spark.createDataFrame([(10.0, 9.0, 11.0, 10.0), (11.0, 10.0, 12.0, 11.0)], "l double, b double, r double, t double")
    assert tuple(catalog.extent(box).first()) == (10, 9, 12, 11, 2)
    feature = box.select(catalog.feature_json(F.lit("x"), F.col("l"), F.col("b"), F.col("r"), F.col("t"))).first()[0]
    (tmp_path / "tiles.geojson").write_text('{"type":"FeatureCollection","features":[%s]}' % feature)
    assert views.geojson_features(spark, str(tmp_path / "tiles.geojson")).first().name == "x"
    (tmp_path / "a_1.tif").write_bytes(b"x")
    (tmp_path / "b_1.tif").write_bytes(b"xy")
    assert views.listing(spark, f"{tmp_path}/a*").count() == 1 and views.listing(spark, str(tmp_path)).count() == 2
