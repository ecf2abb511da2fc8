"""Queries of the gridded operators and their SQL.

Each pair computes the same rows: the query through the package's operators, the SQL from the tables alone.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .functions.calc import DTYPES, band_names, compile_calc, fill_cast, vector_calc
from .functions.grids import HALF_WORLD, MERCATOR_LAT, block_windows, grids_table, latitude, longitude, mercator_tile_box, mercator_tiles, mercator_x, mercator_y, pixel_window, reprojected, snapped, tile_box, tile_corner, tile_id, tile_origin
from .operators import catalog, raster, vector
from .operators.joins import box_join
from .plans.layer import VERSION, LayerSpec, profile, run, status, tile_path
from .sources import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The views in SQL.
VIEWS = {
    "points": "select event_id, ((event_id*37)%35990)/100.0::double-179.95::double as x, ((event_id*91+user_id)%17990)/100.0::double-89.95::double as y, value, event_type from events",
    "pixels": "select cast(l_suppkey%64 as int) as row_i, cast(l_partkey%64 as int) as col_i, l_orderkey*10+l_linenumber as k, l_quantity as A, cast(round(l_discount*100) as int) as B, cast(round(l_tax*100) as int) as C, case when l_quantity >= 5 then l_quantity end as M from lineitem",
    "blocks": "select vec_id as tile, cast(p//8 as int) as r, cast(p%8 as int) as c, v::double as v from (select vec_id, unnest(range(64)) as p, unnest(embedding) as v from embeddings)",
    "feat": "select c_custkey as fid, ((c_custkey*53)%3400)::double/10-170 as l, ((c_custkey*29)%1600)::double/10-80 as b, ((c_custkey*53)%3400)::double/10-170+1+c_custkey%5 as r, ((c_custkey*29)%1600)::double/10-80+1+c_custkey%4 as t, c_mktsegment as seg, c_nationkey as v from customer",
    "files": "select s_suppkey as file_id, 's3://bucket/raw/'||lower(replace(s_name, '#', '_'))||'.tif' as uri, ((s_suppkey*47)%340-170)::double as l, ((s_suppkey*31)%160-80)::double as b, ((s_suppkey*47)%340-160)::double as r, ((s_suppkey*31)%160-70)::double as t, 1+s_nationkey%3 as band_count from supplier",
    "tiles10": "select lpad(abs(top)::varchar,2,'0')||case when top>=0 then 'N' else 'S' end||'_'||lpad(abs(lft)::varchar,3,'0')||case when lft>=0 then 'E' else 'W' end as tile_id, lft::int as left_i, top::int as top_i, lft::double as l, (top-10)::double as b, (lft+10)::double as r, top::double as t from (select unnest(range(-180,180,10)) as lft), (select unnest(range(-80,100,10)) as top)",
}


def query(sql: str | None = None, *uses: str):
    """Registers a query and its SQL, with the views that the SQL names."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = functools.wraps(f)(lambda spark, sf_dir: f(spark, sf_dir))
        if sql:
            SQL[name] = ("with " + ", ".join(f"{v} as ({VIEWS[v]})" for v in uses) + " " if uses else "") + sql
        return f

    return register


C = F.col
ID10 = "lpad(abs((ceil(y/10)*10)::int)::varchar,2,'0')||case when ceil(y/10)*10>=0 then 'N' else 'S' end||'_'||lpad(abs((floor(x/10)*10)::int)::varchar,3,'0')||case when floor(x/10)*10>=0 then 'E' else 'W' end"


def with_tile(points: DataFrame, width: int = 10, offset: int = 0) -> DataFrame:
    left, top = tile_origin(C("x"), C("y"), width, offset)
    return points.withColumn("left_i", left).withColumn("top_i", top).withColumn("tile_id", tile_id(C("left_i"), C("top_i")))


# --- flagship and grids -----------------------------------------------------------------------------------------------
@query(f"select {ID10} as tile_id, count(*)::bigint as n, min(value) as min_v, max(value) as max_v, round(avg(value), 6) as mean_v from points group by 1", "points")
def q_zonal_tile_stats(spark, sf):
    return with_tile(V.points(spark, sf)).groupBy("tile_id").agg(F.count("*").alias("n"), F.min("value").alias("min_v"), F.max("value").alias("max_v"), F.round(F.avg("value"), 6).alias("mean_v"))


GRIDS_SQL = "(select w||'/'||c as name, w::double as width, c as cols from (values (1,4000),(3,33600),(10,40000),(10,100000),(8,32000),(90,27008),(90,9984),(90,1008)) v(w, c))"


@query("select n.n_nationkey, g.name, g.width, g.cols::bigint as cols from nation n join " + GRIDS_SQL + " g on g.name = case when n.n_nationkey % 2 = 0 then '10/40000' else '1/4000' end")
def q_grid_lookup(spark, sf):
    nation = V.table(spark, sf, "nation").select("n_nationkey", F.when(C("n_nationkey") % 2 == 0, "10/40000").otherwise("1/4000").alias("name"))
    return nation.join(F.broadcast(grids_table(spark).select("name", "width", "cols")), "name").select("n_nationkey", "name", "width", "cols")


@query("select p_partkey, (360 % (1 + p_size) = 0 and (p_partkey*16 % 16) = 0 and ((1 + p_size) % 2 = 0 or 180 % (1 + p_size) = 0)) as valid from part")
def q_grid_valid(spark, sf):
    w = C("p_size") + 1
    return V.table(spark, sf, "part").select("p_partkey", ((F.lit(360) % w == 0) & (C("p_partkey") * 16 % 16 == 0) & ((w % 2 == 0) | (F.lit(180) % w == 0))).alias("valid"))


@query("select name, width / cols as res from " + GRIDS_SQL)
def q_grid_res(spark, sf):
    return grids_table(spark).where("kind = 'latlng'").select("name", (C("width") / C("cols")).alias("res"))


@query("select name, (select max(b) from range(128, 529, 16) r(b) where cols % b = 0)::int as block from " + GRIDS_SQL)
def q_grid_block(spark, sf):
    return grids_table(spark).where("kind = 'latlng'").select("name", "block")


@query("select tile_id, left_i, top_i from tiles10", "tiles10")
def q_tile_enum(spark, sf):
    return V.tiles10(spark).select("tile_id", C("left").alias("left_i"), C("top").alias("top_i")).distinct()


@query("select event_id, (floor(x/10)*10)::int as left_i, (ceil(y/10)*10)::int as top_i from points", "points")
def q_xy_to_tile(spark, sf):
    return with_tile(V.points(spark, sf)).select("event_id", "left_i", "top_i")


@query("select event_id, case when there then l else -999 end as left_i, case when there then t else -999 end as top_i from (select *, l between -180 and 172 and t between -82 and 90 as there from (select event_id, (floor((x+4)/8)*8-4)::int as l, (ceil((y+4)/8)*8-4)::int as t from points))", "points")
def q_xy_to_tile_offset(spark, sf):
    off = lambda c: F.coalesce(c, F.lit(-999)).alias(c)  # noqa: E731  points whose tile would reach beyond the earth have none
    return with_tile(V.points(spark, sf), 8, 4).select("event_id", off("left_i"), off("top_i"))


@query(f"select event_id, {ID10} as tile_id from points", "points")
def q_tile_id_format(spark, sf):
    return with_tile(V.points(spark, sf)).select("event_id", "tile_id")


@query("select tile_id, left_i, top_i from tiles10", "tiles10")
def q_tile_id_parse(spark, sf):
    left, top = tile_corner(C("tile_id"))
    return V.tiles10(spark).select("tile_id", left.alias("left_i"), top.alias("top_i"))


@query("select tile_id, l, b, r, t from tiles10", "tiles10")
def q_tile_bounds(spark, sf):
    return V.tiles10(spark).select("tile_id", *(c.alias(n) for c, n in zip(tile_box(C("tile_id"), 10), "lbrt", strict=True)))


#: Row and column names of at least three digits.
WM_ID = "lpad(r::varchar,greatest(3,length(r::varchar))::int,'0')||'R_'||lpad(c::varchar,greatest(3,length(c::varchar))::int,'0')||'C'"


@query(f"select r::int as row, c::int as col, {WM_ID} as tile_id from range(1024) a(r), range(1024) b(c)")
def q_wm_tile_enum(spark, sf):
    return mercator_tiles(spark, 18)


@query(f"select {WM_ID} as tile_id, round(-{HALF_WORLD!r}::double+c*{HALF_WORLD / 2!r}::double, 4) as l, round({HALF_WORLD!r}::double-(r+1)*{HALF_WORLD / 2!r}::double, 4) as b from range(4) a(r), range(4) d(c)")
def q_wm_tile_bounds(spark, sf):
    left, bottom, _, _ = mercator_tile_box(C("tile_id"), 10)
    return mercator_tiles(spark, 10).select("tile_id", F.round(left, 4).alias("l"), F.round(bottom, 4).alias("b"))


@query(f"select 'zoom_'||z as name, round({2 * HALF_WORLD!r}::double/(256*pow(2, z)), 6) as res, (case when z < 8 then pow(2, z)*256 else 65536 end)::bigint as cols, 256 as block from range(23) a(z)")
def q_wm_grid_res(spark, sf):
    return grids_table(spark).where("kind = 'wm'").select("name", F.round("res", 6).alias("res"), "cols", "block")


@query(f"select event_id, round(radians(x)*6378137.0::double, 4) as wm_x, round(ln(tan(pi()/4+radians(yy)/2))*6378137.0::double, 3) as wm_y from (select event_id, x, ((event_id*91)%16000)/100.0::double-80 as yy from points)", "points")
def q_wgs84_to_wm(spark, sf):
    p = V.points(spark, sf).select("event_id", "x", F.expr("((event_id*91)%16000)/100.0D-80").alias("yy"))
    return p.select("event_id", F.round(mercator_x(C("x")), 4).alias("wm_x"), F.round(mercator_y(C("yy")), 3).alias("wm_y"))


@query("select event_id, round(floor(x)+floor((x-floor(x))/0.00025::double+1e-6)*0.00025::double, 6) as sx, round(ceil(y)-floor((ceil(y)-y)/0.00025::double+1e-6)*0.00025::double, 6) as sy from points", "points")
def q_snap_coord(spark, sf):
    return V.points(spark, sf).select("event_id", F.round(snapped(C("x"), 0.00025, False), 6).alias("sx"), F.round(snapped(C("y"), 0.00025, True), 6).alias("sy"))


@query(f"select file_id, round(radians(greatest(l,-180))*6378137.0::double, 4) as wl, round(ln(tan(pi()/4+radians(greatest(b,-{MERCATOR_LAT}::double))/2))*6378137.0::double, 3) as wb, round(radians(least(r,180))*6378137.0::double, 4) as wr, round(ln(tan(pi()/4+radians(least(t,{MERCATOR_LAT}::double))/2))*6378137.0::double, 3) as wt from files", "files")
def q_reproject_bounds(spark, sf):
    wl, wb, wr, wt = reprojected(C("l"), C("b"), C("r"), C("t"), "EPSG:4326", "EPSG:3857")
    return V.source_files(spark, sf).select("file_id", F.round(wl, 4).alias("wl"), F.round(wb, 3).alias("wb"), F.round(wr, 4).alias("wr"), F.round(wt, 3).alias("wt"))


@query("select event_id, round(degrees(x*100000/6378137.0::double), 6) as lng, round(degrees(2*atan(exp(y*200000/6378137.0::double))-pi()/2), 6) as lat from points", "points")
def q_wm_to_wgs84(spark, sf):
    return V.points(spark, sf).select("event_id", F.round(longitude(C("x") * 100_000), 6).alias("lng"), F.round(latitude(C("y") * 200_000), 6).alias("lat"))


@query("select file_id, p, x, y from (select file_id, unnest(range(5))::int as p, unnest([l,r,r,l,l]) as x, unnest([t,t,b,b,t]) as y from files)", "files")
def q_footprint_ring(spark, sf):
    ring = vector.ring_column(C("l"), C("b"), C("r"), C("t"))
    return V.source_files(spark, sf).select("file_id", F.posexplode(ring).alias("p", "v")).select("file_id", "p", "v.x", "v.y")


@query("select fid, round_even((r-l)/0.25::double, 0)::int as width, round_even((t-b)/0.25::double, 0)::int as height from feat", "feat")
def q_vrt_dims(spark, sf):
    return V.features(spark, sf).select("fid", F.bround((C("r") - C("l")) / 0.25).cast("int").alias("width"), F.bround((C("t") - C("b")) / 0.25).cast("int").alias("height"))


@query("select event_id, round_even(x*2, 0)::int as col_off, round_even(y*2, 0)::int as row_off from points", "points")
def q_window_snap(spark, sf):
    return V.points(spark, sf).select("event_id", F.bround(C("x") * 2).cast("int").alias("col_off"), F.bround(C("y") * 2).cast("int").alias("row_off"))


@query("select t.tile_id, f.file_id, round_even((greatest(t.l,f.l)-t.l)/0.25::double, 0)::int as col_off, round_even((t.t-least(t.t,f.t))/0.25::double, 0)::int as row_off, round_even((least(t.r,f.r)-greatest(t.l,f.l))/0.25::double, 0)::int as width, round_even((least(t.t,f.t)-greatest(t.b,f.b))/0.25::double, 0)::int as height from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b", "tiles10", "files")
def q_intersect_window(spark, sf):
    side = lambda a: tuple(C(f"{a}.{c}") for c in "lbrt")
    window = pixel_window(side("a"), side("b"), 0.25)
    return box_join(V.tiles10(spark), V.source_files(spark, sf), 10.0).select("a.tile_id", "b.file_id", *(c.alias(n) for c, n in zip(window, ("col_off", "row_off", "width", "height"), strict=True)))


@query("select fid, c::int as col_off, r::int as row_off, least(8, w-c)::int as width, least(8, h-r)::int as height from (select fid, ceil((r-l)*4)::int as w, ceil((t-b)*4)::int as h from feat), range(0, 64, 8) a(c), range(0, 64, 8) d(r) where c < w and r < h", "feat")
def q_block_windows(spark, sf):
    sized = V.features(spark, sf).select("fid", F.ceil((C("r") - C("l")) * 4).cast("int").alias("w"), F.ceil((C("t") - C("b")) * 4).cast("int").alias("h"))
    return sized.select("fid", F.explode(block_windows(C("w"), C("h"), 8)).alias("x")).select("fid", "x.*")


@query("select n_nationkey, greatest(1, pow(floor(sqrt((n_nationkey+1)*1000000.0::double/(d*400*400))), 2))::bigint as blocks from (select n_nationkey, case when n_nationkey%5=0 then d*d else d end as d from (select n_nationkey, 4*(case when n_nationkey%4=0 then 4 when n_nationkey%2=0 then 2 else 1 end)*(1+n_nationkey%3)*(case when n_nationkey%3=2 then 2 else 1 end) as d from nation))")
def q_chunk_plan(spark, sf):
    n = C("n_nationkey")
    divisor = S.chunk_divisor(F.lit(4), n % 2 == 0, n % 4 == 0, 1 + n % 3, n % 3, n % 5 == 0)
    return V.table(spark, sf, "nation").select(n, S.blocks_in_memory((n + 1) * 1_000_000.0, divisor, 400 * 400).alias("blocks"))


@query("select i::int as i, case when i <= 26 then chr((64+i)::int) else chr((64+(i-1)//26)::int)||chr((65+(i-1)%26)::int) end as name from range(1, 61) a(i)")
def q_band_names(spark, sf):
    return spark.createDataFrame(list(enumerate(band_names(60), 1)), "i int, name string")


# --- map algebra ------------------------------------------------------------------------------------------------------
def calc(spark, sf, text: str, *names: str) -> DataFrame:
    out = compile_calc(text, {b: C(b) for b in ("A", "B", "C", "M")})
    return V.pixels(spark, sf).select("row_i", "col_i", "k", "A", *(c.alias(n) for c, n in zip(out, names, strict=True)))


@query("select row_i, col_i, k, A, A*5+1 as v from pixels", "pixels")
def q_calc_single(spark, sf):
    return calc(spark, sf, "A*5+1", "v")


@query("select row_i, col_i, k, A, (A+B)*(C+2) as v from pixels", "pixels")
def q_calc_multi_in(spark, sf):
    return calc(spark, sf, "(A+B)*(C+2)", "v")


@query("select row_i, col_i, k, A, A+B as v1, M*2 as v2, case when C <> 0 then A/C end as v3 from pixels", "pixels")
def q_calc_multi_out(spark, sf):
    return calc(spark, sf, "np.ma.array([A+B, M*2, A/C])", "v1", "v2", "v3")


@query("select row_i, col_i, k, A, (A>10)::int+(A>20)::int+(A>30)::int+(A>40)::int as v from pixels", "pixels")
def q_calc_threshold(spark, sf):
    return calc(spark, sf, "1*(A>10)+1*(A>20)+1*(A>30)+1*(A>40)", "v")


@query("select row_i, col_i, k, ((coalesce(M, 300)*7)::bigint % 256)::bigint as u8, (case when (coalesce(M*7, 0)::bigint) % 256 >= 128 then (coalesce(M*7, 0)::bigint) % 256 - 256 else (coalesce(M*7, 0)::bigint) % 256 end)::bigint as i8 from pixels", "pixels")
def q_fill_cast(spark, sf):
    return V.pixels(spark, sf).select("row_i", "col_i", "k", fill_cast(F.coalesce("M", F.lit(300)) * 7, None, "uint8").alias("u8"), fill_cast(C("M") * 7, 0, "int8").alias("i8"))


@query("select row_i, col_i, k, ((B & 3) + (C | 8) - (~B))::bigint as v, case when (A > 10) and not (B = 3) then 1 else 0 end as w from pixels", "pixels")
def q_calc_bits(spark, sf):
    return calc(spark, sf, "[(B & 3) + (C | 8) - ~B, 1*((A > 10) & ~(B == 3))]", "v", "w").drop("A")


@query("select fid, case when seg='BUILDING' or seg='MACHINERY' then 1 when v>12 then 3 else 2 end as v, seg as plain from feat", "feat")
def q_vector_calc_case(spark, sf):
    text = "case when seg='BUILDING' or seg='MACHINERY' then 1 when v>12 then 3 else 2 end"
    return V.features(spark, sf).select("fid", vector_calc(text, "v").alias("v"), vector_calc(None, "seg").alias("plain"))


# --- mosaics, stacks, blocks ------------------------------------------------------------------------------------------
LAST = "select row_i, col_i, arg_max(A, row(k, A)) as v from pixels group by all"


def one_tile(spark, sf) -> DataFrame:
    return raster.mosaic(V.pixels(spark, sf), "k", "A").withColumnRenamed("A", "v")


@query("select row_i, col_i, arg_max(M, row(k, M)) as M from pixels where M is not null group by all", "pixels")
def q_mosaic_last_wins(spark, sf):
    return raster.mosaic(V.pixels(spark, sf), "k", "M")


@query("select row_i, col_i, a.A, b.B from (select row_i, col_i, max(A) as A from pixels where k%7<4 group by all) a full join (select row_i, col_i, max(B)::double as B from pixels where k%7>=4 group by all) b using (row_i, col_i)", "pixels")
def q_band_stack(spark, sf):
    # the files whose number leaves less than 4 of 7 are the first band's source, the others the second's
    p, first = V.pixels(spark, sf), C("k") % 7 < 4
    return raster.band_stack([p.where(first).groupBy("row_i", "col_i").agg(F.max("A").alias("A")), p.where(~first).groupBy("row_i", "col_i").agg(F.max(C("B").cast("double")).alias("B"))])


@query("select t.tile_id, band::int as band, count(f.file_id)::bigint as n_files from tiles10 t cross join range(1, 4) g(band) left join files f on f.band_count >= band and t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b group by all", "tiles10", "files")
def q_band_pad_outer(spark, sf):
    bands = box_join(V.tiles10(spark), V.source_files(spark, sf), 10.0).select("a.tile_id", F.explode(F.sequence(F.lit(1), C("b.band_count").cast("int"))).alias("band")).groupBy("tile_id", "band").agg(F.count("*").alias("n"))
    want = V.tiles10(spark).select("tile_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("band"))
    return want.join(bands, ["tile_id", "band"], "left").select("tile_id", "band", F.coalesce("n", F.lit(0)).alias("n_files"))


@query("select f.file_id, band::int as band, dense_rank() over (order by band)::int as band_idx from files f, range(1, 4) g(band) where band <= band_count", "files")
def q_band_expand(spark, sf):
    bands = V.source_files(spark, sf).select("file_id", F.explode(F.sequence(F.lit(1), C("band_count").cast("int"))).alias("band"))
    rank = bands.select("band").distinct().withColumn("band_idx", S.dense_index("band"))
    return bands.join(F.broadcast(rank), "band").select("file_id", "band", "band_idx")


@query("select (file_id%7)::bigint as src, count(distinct band_count)::bigint as kinds, count(distinct band_count) = 1 as same from files group by 1", "files")
def q_band_count_check(spark, sf):
    return V.source_files(spark, sf).groupBy((C("file_id") % 7).alias("src")).agg(F.countDistinct("band_count").alias("kinds")).withColumn("same", C("kinds") == 1)


@query(f"select w.row_i-16 as r, w.col_i-16 as c, w.v from ({LAST}) w where row_i between 16 and 47 and col_i between 16 and 47", "pixels")
def q_window_read(spark, sf):
    return one_tile(spark, sf).where("row_i between 16 and 47 and col_i between 16 and 47").select((C("row_i") - 16).alias("r"), (C("col_i") - 16).alias("c"), "v")


@query("select row_i//8 as br, col_i//8 as bc from pixels group by all having count(M) + count(case when B > 0 then 1 end) > 0", "pixels")
def q_block_has_data(spark, sf):
    p = V.pixels(spark, sf).groupBy(F.floor(C("row_i") / 8).cast("int").alias("br"), F.floor(C("col_i") / 8).cast("int").alias("bc"))
    return p.agg((F.count("M") + F.count(F.when(C("B") > 0, 1))).alias("n")).where("n > 0").select("br", "bc")


@query("select row_i as tile, bool_or(M is not null) as has_data from pixels group by 1", "pixels")
def q_tile_has_data(spark, sf):
    return V.pixels(spark, sf).groupBy(C("row_i").alias("tile")).agg(F.bool_or(C("M").isNotNull()).alias("has_data"))


@query("select row_i, count(M)::bigint + count(B)::bigint as n from pixels group by 1", "pixels")
def q_valid_pixels(spark, sf):
    return V.pixels(spark, sf).groupBy("row_i").agg((F.count("M") + F.count("B")).alias("n"))


RESAMPLE = {
    "nearest": "select (row_i//4)::int as r, (col_i//4)::int as c, v from t where row_i%4=2 and col_i%4=2",
    "average": "avg(v)", "max": "max(v)", "min": "min(v)", "med": "median(v)", "q1": "quantile_cont(v, 0.25)", "q3": "quantile_cont(v, 0.75)", "sum": "sum(v)", "rms": "sqrt(avg(v*v))",
    "mode": "select r, c, v from (select (row_i//4)::int as r, (col_i//4)::int as c, v, row_number() over (partition by row_i//4, col_i//4 order by count(*) desc, v) as n from t group by row_i//4, col_i//4, v) where n = 1",
}


def _resample(method: str, sql: str) -> None:
    body = sql if sql.startswith("select") else f"select (row_i//4)::int as r, (col_i//4)::int as c, {sql} as v from t group by 1, 2"
    body = f"select r, c, round(v, 6) as v from ({body})"

    def q(spark, sf):
        return raster.resample(one_tile(spark, sf), 4, method, "v").select("r", "c", F.round("v", 6).alias("v"))

    q.__name__ = f"q_resample_{method}"
    query(body.replace("from t", f"from ({LAST}) t"), "pixels")(q)


for _method, _sql in RESAMPLE.items():
    _resample(_method, _sql)


def _kernel_sql(weight: str, reach: int) -> str:
    at = lambda o: f"(abs({{p}} - (({o}+0.5::double)*4-0.5::double))/4)"
    wr, wc = weight.replace("D", at("r").replace("{p}", "row_i")), weight.replace("D", at("c").replace("{p}", "col_i"))
    near = lambda p, o: f"abs({p}-(({o}+0.5::double)*4-0.5::double)) <= {4 * reach}"
    return f"select r::int as r, c::int as c, round(sum(v*w)/sum(w), 6) as v from (select r, c, v, ({wr})*({wc}) as w from ({LAST}) t, range(16) a(r), range(16) b(c) where {near('row_i', 'r')} and {near('col_i', 'c')}) where w <> 0 group by r, c having abs(sum(w)) > 1e-9"


#: Kernels in SQL by the distance D in output pixels, and how far they reach.
KERNEL_SQL = {
    "bilinear": ("greatest(0.0::double, 1-D)", 1),
    "cubic": ("case when D<=1 then 1.5::double*D*D*D-2.5::double*D*D+1 when D<2 then -0.5::double*D*D*D+2.5::double*D*D-4*D+2 else 0 end", 2),
    "cubic_spline": ("case when D<=1 then 2.0::double/3-D*D+D*D*D/2 when D<2 then (2-D)*(2-D)*(2-D)/6 else 0 end", 2),
    "lanczos": ("case when D=0 then 1 when D<3 then 3*sin(pi()*D)*sin(pi()*D/3)/(pi()*pi()*D*D) else 0 end", 3),
}


def _interpolate(method: str) -> None:
    def q(spark, sf):
        return raster.resample(one_tile(spark, sf), 4, method, "v", size=(64, 64)).select("r", "c", F.round("v", 6).alias("v"))

    q.__name__ = f"q_resample_{method}"
    query(_kernel_sql(*KERNEL_SQL[method]), "pixels")(q)


for _method in KERNEL_SQL:
    _interpolate(_method)


# --- other rasters: 64 rows and columns become 26, of 2.5 source pixels each -------------------------------------------
AXIS_SQL = "select o::int as o, s::int as s, least(2.5::double*(o+1), s+1)-greatest(2.5::double*o, s) as w from range(26) a(o), range(66) b(s) where least(2.5::double*(o+1), s+1)-greatest(2.5::double*o, s) > 0"


def axes(spark, method: str) -> tuple[DataFrame, DataFrame]:
    one = raster.axis(spark, 26, lambda k: k * 2.5, method)
    return one, one


def _warp(method: str, sql: str) -> None:
    def q(spark, sf):
        return raster.warp(one_tile(spark, sf), *axes(spark, method), method).select("r", "c", F.round("v", 6).alias("v"))

    q.__name__ = f"q_warp_{method}"
    query(sql, "pixels")(q)


for _method, _sql in {"average": "sum(v*a.w*b.w)/sum(a.w*b.w)", "max": "max(v)", "med": "median(v)", "sum": "sum(v*a.w*b.w)"}.items():
    _warp(_method, f"select a.o as r, b.o as c, round({_sql}, 6) as v from ({LAST}) t join ({AXIS_SQL}) a on a.s=t.row_i join ({AXIS_SQL}) b on b.s=t.col_i group by 1, 2")
_warp("nearest", f"select a.o::int as r, b.o::int as c, round(v, 6) as v from ({LAST}) t, range(26) a(o), range(26) b(o) where t.row_i=floor(2.5::double*(a.o+0.5::double)) and t.col_i=floor(2.5::double*(b.o+0.5::double))")
_TENT = "select o::int as o, s::int as s, 1-abs(s+0.5::double-2.5::double*(o+0.5::double))/2.5::double as w from range(26) a(o), range(-4, 70) b(s) where abs(s+0.5::double-2.5::double*(o+0.5::double)) < 2.5::double"
_warp("bilinear", f"select a.o as r, b.o as c, round(sum(v*a.w*b.w)/sum(a.w*b.w), 6) as v from ({LAST}) t join ({_TENT}) a on a.s=t.row_i join ({_TENT}) b on b.s=t.col_i group by 1, 2")


@query(f"select a.o::int as r, b.o::int as c, v from ({LAST}) t, range(45) a(o), range(35) b(o) where t.row_i=floor(64-degrees(2*atan(exp((9000000-200000*(a.o+0.5::double))/6378137.0::double))-pi()/2)) and t.col_i=floor(degrees(200000*(b.o+0.5::double)/6378137.0::double))", "pixels")
def q_warp_to_wm(spark, sf):
    # the tile's 64 rows and columns are degrees from 64 N and 0 E; the target's pixels are 200 km
    rows = raster.axis(spark, 45, lambda k: 64 - latitude(9_000_000 - 200_000 * k), "nearest")
    cols = raster.axis(spark, 35, lambda k: longitude(200_000 * k), "nearest")
    return raster.warp(one_tile(spark, sf), rows, cols, "nearest")


@query("select floor(radians(x)*6378137.0::double/1000000)::int as px, floor(ln(tan(pi()/4+radians(y)/2))*6378137.0::double/1000000)::int as py, max(value) as v from points where abs(y) < 85 group by all", "points")
def q_reproject_wm(spark, sf):
    p = V.points(spark, sf).where("abs(y) < 85")
    return p.groupBy(F.floor(mercator_x(C("x")) / 1_000_000).cast("int").alias("px"), F.floor(mercator_y(C("y")) / 1_000_000).cast("int").alias("py")).agg(F.max("value").alias("v"))


# --- statistics -------------------------------------------------------------------------------------------------------
@query("select tile, count(v)::bigint as n, round(min(v), 6) as min, round(max(v), 6) as max, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std_dev from blocks group by tile", "blocks")
def q_band_stats(spark, sf):
    out = raster.band_stats(V.blocks(spark, sf), "v", "tile")
    return out.select("tile", "n", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std_dev")))


@query("select b.bucket::bigint as bucket, count(p.A)::bigint as n from range(1, 257) b(bucket) left join pixels p on floor(p.A+0.5::double)+1 = b.bucket group by 1", "pixels")
def q_band_histogram(spark, sf):
    return raster.byte_histogram(V.pixels(spark, sf), "A")


META = "select row_i as tile, 64 as width, 64 as height, 'EPSG:4326' as crs, '{0}' as name, '{1}' as data_type, {2}::double as no_data, {3} as nbits, 16 as block, min({0})::double as min, max({0})::double as max, round(avg({0}), 6) as mean, round(stddev_pop({0}), 6) as std_dev from pixels group by 1"


@query(META.format("A", "float64", "0.5", "0") + " union all " + META.format("B", "uint8", "0", "8"), "pixels")
def q_tile_metadata(spark, sf):
    meta = raster.metadata(V.pixels(spark, sf).withColumnRenamed("row_i", "tile"), {"A": ("float64", 0.5), "B": ("uint8", 0)}, (64, 64), 16, "EPSG:4326", "tile")
    x = meta.select("tile", "width", "height", "crs", F.explode("bands").alias("x"))
    return x.select("tile", "width", "height", "crs", "x.name", "x.data_type", "x.no_data", F.coalesce("x.nbits", F.lit(0)).alias("nbits"), C("x.blockxsize").alias("block"), "x.stats.min", "x.stats.max", F.round("x.stats.mean", 6).alias("mean"), F.round("x.stats.std_dev", 6).alias("std_dev"))


@query("select tile, least(greatest(floor((v+1)*16)+1, 1), 32)::bigint as bucket, count(*)::bigint as n from blocks where v is not null group by 1, 2", "blocks")
def q_block_histogram(spark, sf):
    return raster.histogram(V.blocks(spark, sf), "v", -1.0, 1.0, 32, "tile")


# --- filters ----------------------------------------------------------------------------------------------------------
@query("select tile_id, case when tile_id in ('10N_010E','00N_010W','50S_120E') then 'pending' else 'skipped (not in subset)' end as status from tiles10", "tiles10")
def q_filter_subset(spark, sf):
    subset = spark.createDataFrame([(x,) for x in ("10N_010E", "00N_010W", "50S_120E")], "tile_id string").withColumn("wanted", F.lit(True))
    return V.tiles10(spark).join(F.broadcast(subset), "tile_id", "left").select("tile_id", F.when(C("wanted"), "pending").otherwise("skipped (not in subset)").alias("status"))


@query("select tile_id from tiles10 t where exists (select 1 from files f where t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b)", "tiles10", "files")
def q_filter_src_extent(spark, sf):
    return box_join(V.tiles10(spark), V.source_files(spark, sf).select("l", "b", "r", "t"), 10.0, how="left_semi").select("tile_id")


@query("select tile_id from tiles10 t where exists (select 1 from feat f where t.l<=f.r and t.r>=f.l and t.b<=f.t and t.t>=f.b)", "tiles10", "feat")
def q_vector_exists(spark, sf):
    return vector.tiles_with_features(V.tiles10(spark), V.features(spark, sf)).select("tile_id")


EXISTING = "(select distinct case when (o_orderkey//18)%3=0 then 'geotiff' else 'gdal-geotiff' end as fmt, lpad((abs((o_custkey%18)*10-80))::varchar,2,'0')||case when (o_custkey%18)*10-80>=0 then 'N' else 'S' end||'_'||lpad((o_orderkey%18*10)::varchar,3,'0')||'E' as tile_id from orders)"


def existing(spark, sf) -> DataFrame:
    """Tiles and formats that are already there, from the orders."""
    left, top = (C("o_orderkey") % 18 * 10).cast("int"), (C("o_custkey") % 18 * 10 - 80).cast("int")
    plain = F.floor(C("o_orderkey") / 18) % 3 == 0
    return V.table(spark, sf, "orders").select(F.when(plain, "geotiff").otherwise("gdal-geotiff").alias("fmt"), tile_id(left, top).alias("tile_id")).distinct()


@query(f"select t.tile_id, case when count(e.fmt)=2 then 'existing' else 'pending' end as status from tiles10 t left join {EXISTING} e using (tile_id) group by 1", "tiles10")
def q_filter_existing(spark, sf):
    done = existing(spark, sf).groupBy("tile_id").agg(F.count("*").alias("n"))
    return V.tiles10(spark).join(done, "tile_id", "left").select("tile_id", F.when(C("n") == 2, "existing").otherwise("pending").alias("status"))


@query(f"select t.tile_id, f.fmt, e.fmt is not null as there from tiles10 t cross join (values ('geotiff'),('gdal-geotiff')) f(fmt) left join {EXISTING} e on e.tile_id=t.tile_id and e.fmt=f.fmt", "tiles10")
def q_existing_probe(spark, sf):
    there = existing(spark, sf).withColumn("there", F.lit(True))
    return formats(V.tiles10(spark)).join(there, ["tile_id", "fmt"], "left").select("tile_id", "fmt", F.coalesce("there", F.lit(False)).alias("there"))


@query("select fid from feat where l<=12 and r>=-8 and b<=30 and t>=-5", "feat")
def q_st_intersects_box(spark, sf):
    return V.features(spark, sf).where("l<=12 and r>=-8 and b<=30 and t>=-5").select("fid")


@query("select t.tile_id, f.file_id from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b", "tiles10", "files")
def q_tile_file_join(spark, sf):
    return box_join(V.tiles10(spark), V.source_files(spark, sf), 10.0).select("a.tile_id", "b.file_id")


@query("select t.tile_id, count(*)::bigint as n from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b group by 1", "tiles10", "files")
def q_file_prune(spark, sf):
    return box_join(V.tiles10(spark), V.source_files(spark, sf), 10.0).groupBy(C("a.tile_id").alias("tile_id")).agg(F.count("*").alias("n"))


# --- vectors ----------------------------------------------------------------------------------------------------------
@query("select count(*)::bigint as n, min(l) as l, min(b) as b, max(r) as r, max(t) as t from feat", "feat")
def q_vector_scan(spark, sf):
    return V.features(spark, sf).agg(F.count("*").alias("n"), F.min("l").alias("l"), F.min("b").alias("b"), F.max("r").alias("r"), F.max("t").alias("t"))


CLIP = "select t.tile_id, f.fid, f.seg, f.v, greatest(t.l,f.l) as l, greatest(t.b,f.b) as b, least(t.r,f.r) as r, least(t.t,f.t) as t from tiles10 t join feat f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b"


@query(CLIP, "tiles10", "feat")
def q_vector_fetch(spark, sf):
    return vector.clipped(V.tiles10(spark), V.features(spark, sf)).select("tile_id", "fid", "seg", "v", "l", "b", "r", "t")


@query(f"select fid, round(sum((r-l)*(t-b)), 6) as area from ({CLIP}) group by 1", "tiles10", "feat")
def q_clip_box(spark, sf):
    return vector.clipped(V.tiles10(spark), V.features(spark, sf)).groupBy("fid").agg(F.round(F.sum((C("r") - C("l")) * (C("t") - C("b"))), 6).alias("area"))


@query("select fid, v, row_number() over (order by v, fid)::int as place from feat", "feat")
def q_vector_order(spark, sf):
    return S.ranked(V.features(spark, sf).select("fid", "v"), "v", "fid")


BURN = "from feat f, range(-180, 181) x(px), range(-90, 91) y(py) where px+0.5::double>=f.l and px+0.5::double<f.r and py+0.5::double>=f.b and py+0.5::double<f.t group by px, py"


@query(f"select px::bigint as px, py::bigint as py, count(*)::bigint as n {BURN}", "feat")
def q_rasterize_count(spark, sf):
    return vector.rasterize(V.features(spark, sf), "count")


@query(f"select px::bigint as px, py::bigint as py, max(v) as v {BURN}", "feat")
def q_rasterize_value_asc(spark, sf):
    return vector.rasterize(V.features(spark, sf), "asc")


@query(f"select px::bigint as px, py::bigint as py, min(v) as v {BURN}", "feat")
def q_rasterize_value_desc(spark, sf):
    return vector.rasterize(V.features(spark, sf), "desc")


# --- polygons: a diamond in each feature's box, with a hole of half its size -------------------------------------------
DIAMOND = "(select fid, v, (l+r)/2+0.037::double as cx, (b+t)/2+0.0213::double as cy, (r-l)/2 as w, (t-b)/2 as h from feat)"


def diamonds(spark, sf) -> DataFrame:
    f = V.features(spark, sf).selectExpr("fid", "v", "(l+r)/2+0.037D as cx", "(b+t)/2+0.0213D as cy", "(r-l)/2 as w", "(t-b)/2 as h")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = lambda k: F.array(*(corner(C("cx") + C("w") * x * k, C("cy") + C("h") * y * k) for x, y in ((-1, 0), (0, 1), (1, 0), (0, -1), (-1, 0))))
    return f.select("fid", "v", F.array(ring(1.0), ring(0.5)).alias("rings"), (C("cx") - C("w")).alias("l"), (C("cy") - C("h")).alias("b"), (C("cx") + C("w")).alias("r"), (C("cy") + C("h")).alias("t"))


@query(f"select fid, round(1.5::double*w*h, 6) as area from {DIAMOND}", "feat")
def q_polygon_clip(spark, sf):
    return vector.polygons_clipped(V.tiles10(spark), diamonds(spark, sf)).groupBy("fid").agg(F.round(F.sum("area"), 6).alias("area"))


@query(f"select distinct tile_id, fid from tiles10 t, {DIAMOND} d where greatest(0, t.l-cx, cx-t.r)/w+greatest(0, t.b-cy, cy-t.t)/h < 1", "tiles10", "feat")
def q_polygon_intersects(spark, sf):
    return vector.polygons_clipped(V.tiles10(spark), diamonds(spark, sf)).select("tile_id", "fid")


POLYGON_BURN = f"(select px, py, v, abs(px+0.5::double-cx)/w+abs(py+0.5::double-cy)/h as m from (select *, unnest(range(floor(cy-h)::int-1, ceil(cy+h)::int+2)) as py from (select *, unnest(range(floor(cx-w)::int-1, ceil(cx+w)::int+2)) as px from {DIAMOND})))"


@query(f"select px::bigint as px, py::bigint as py, max(v) as v from {POLYGON_BURN} where m < 1 and m >= 0.5::double group by px, py", "feat")
def q_polygon_rasterize(spark, sf):
    return vector.polygons_rasterized(diamonds(spark, sf), "asc")


@query(f"select px::bigint as px, py::bigint as py, count(*)::bigint as n from {POLYGON_BURN} where m < 1 and m >= 0.5::double group by px, py", "feat")
def q_polygon_count(spark, sf):
    return vector.polygons_rasterized(diamonds(spark, sf), "count")


# --- catalogues and jobs ----------------------------------------------------------------------------------------------
def formats(tiles: DataFrame) -> DataFrame:
    return tiles.withColumn("fmt", F.explode(F.array(F.lit("geotiff"), F.lit("gdal-geotiff"))))


@query("select tile_id, fmt from tiles10, (values ('geotiff'),('gdal-geotiff')) f(fmt)", "tiles10")
def q_format_cross(spark, sf):
    return formats(V.tiles10(spark)).select("tile_id", "fmt")


LAYER = LayerSpec("level", "v201911", "raster", "is", "uint8", "10/40000", ("s3://b/k",), calc="A*2+1", no_data=0)


@query("select tile_id, 'level/v201911/raster/epsg-4326/10/40000/is/geotiff/'||tile_id||'.tif' as path from tiles10", "tiles10")
def q_output_path(spark, sf):
    return V.tiles10(spark).select("tile_id", tile_path(LAYER, C("tile_id"), "geotiff").alias("path"))


RING = "'[['||l||','||t||'],['||r||','||t||'],['||r||','||b||'],['||l||','||b||'],['||l||','||t||']]'"


@query("select '{\"type\":\"Feature\",\"properties\":{\"name\":\"'||tile_id||'\"},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":['||" + RING + "||']}}' as feature from tiles10", "tiles10")
def q_geojson_tiles(spark, sf):
    return V.tiles10(spark).select(catalog.feature_json(C("tile_id"), C("l"), C("b"), C("r"), C("t")).alias("feature"))


@query("select tile_id, l, t from tiles10 where l >= 0 and t > 0", "tiles10")
def q_geojson_scan(spark, sf):
    text = V.tiles10(spark).where("l >= 0 and t > 0").select(catalog.feature_json(C("tile_id"), C("l"), C("b"), C("r"), C("t")).alias("feature"))
    f = text.select(V.feature_of(C("feature")).alias("f"))
    return f.select(C("f.name").alias("tile_id"), C("f.rings")[0][0]["x"].alias("l"), C("f.rings")[0][0]["y"].alias("t"))


@query("select '{\"type\":\"FeatureCollection\",\"features\":['||string_agg('{\"type\":\"Feature\",\"properties\":{\"name\":\"'||tile_id||'\"},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":['||" + RING + "||']}}', ',' order by tile_id)||']}' as geojson from tiles10", "tiles10")
def q_feature_collection(spark, sf):
    f = V.tiles10(spark).select("tile_id", catalog.feature_json(C("tile_id"), C("l"), C("b"), C("r"), C("t")).alias("feature"))
    return catalog.collection(f, "tile_id")


MET = "(select distinct l::int//10 as x, b::int//10 as y from (select floor(t.l) as l, floor(t.b) as b from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b))"


@query(f"with runs as (select y, min(x) as x0, max(x) as x1 from (select x, y, x-row_number() over (partition by y order by x) as g from {MET}) group by y, g) select x0*10.0::double as l, min(y)*10.0::double as b, x1*10.0::double+10 as r, max(y)*10.0::double+10 as t from (select *, y-row_number() over (partition by x0, x1 order by y) as h from runs) group by x0, x1, h".replace("with runs", "select * from (with runs") + ")", "tiles10", "files")
def q_extent_dissolve(spark, sf):
    met = box_join(V.tiles10(spark), V.source_files(spark, sf).select("l", "b", "r", "t"), 10.0, how="left_semi")
    return catalog.dissolved(met, 10.0)


@query("select min(l) as l, min(b) as b, max(r) as r, max(t) as t, sum(area) as area from (select distinct l, b, r, t, (r-l)*(t-b) as area from (select t.* from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b))", "tiles10", "files")
def q_extent_union(spark, sf):
    return catalog.extent(box_join(V.tiles10(spark), V.source_files(spark, sf), 10.0).select("a.l", "a.b", "a.r", "a.t"))


@query("select band_count::bigint as band_count, min(x)::double as l, min(y)::double as b, max(x)+1::double as r, max(y)+1::double as t, count(*)::double as area from (select distinct band_count, x, unnest(range(b::int, t::int)) as y from (select band_count, b, t, unnest(range(l::int, r::int)) as x from files)) group by 1", "files")
def q_geom_union(spark, sf):
    parts = catalog.dissolved(V.source_files(spark, sf), 1.0, "band_count")
    area = F.sum((C("r") - C("l")) * (C("t") - C("b"))).alias("area")
    return parts.groupBy(C("band_count").cast("long").alias("band_count")).agg(F.min("l").alias("l"), F.min("b").alias("b"), F.max("r").alias("r"), F.max("t").alias("t"), area)


@query("select (fid%500)::bigint as g, max(l) as l, max(b) as b, min(r) as r, min(t) as t, max(l) < min(r) and max(b) < min(t) as some from feat group by 1", "feat")
def q_geom_intersection(spark, sf):
    out = V.features(spark, sf).groupBy((C("fid") % 500).alias("g")).agg(F.max("l").alias("l"), F.max("b").alias("b"), F.min("r").alias("r"), F.min("t").alias("t"))
    return out.withColumn("some", (C("l") < C("r")) & (C("b") < C("t")))


STATUS_SQL = f"select t.tile_id, case when t.top_i<-40 then 'skipped (not in subset)' when f.tile_id is null then 'skipped (does not intersect)' when e.n=2 then 'existing' when d.tile_id is null then 'skipped (has no data)' else 'processed' end as status from tiles10 t left join (select distinct t.tile_id from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b) f using (tile_id) left join (select tile_id, count(*) as n from {EXISTING} group by 1) e using (tile_id) left join (select distinct {ID10} as tile_id from points) d using (tile_id)"


def statuses(spark, sf) -> DataFrame:
    tiles = V.tiles10(spark)
    mark = lambda df, name: df.select("tile_id").distinct().withColumn(name, F.lit(True))
    meets = mark(box_join(tiles, V.source_files(spark, sf).select("l", "b", "r", "t"), 10.0, how="left_semi"), "meets")
    there = mark(existing(spark, sf).groupBy("tile_id").agg(F.count("*").alias("n")).where("n = 2"), "there")
    some = mark(with_tile(V.points(spark, sf)), "some")
    on = lambda c: F.coalesce(c, F.lit(False))
    out = tiles.join(meets, "tile_id", "left").join(there, "tile_id", "left").join(some, "tile_id", "left")
    return out.select("tile_id", status(C("top") >= -40, on("meets"), on("there"), on("some")).alias("status"))


@query(f"select status, count(*)::bigint as n from ({STATUS_SQL}) group by 1", "tiles10", "files", "points")
def q_status_report(spark, sf):
    return statuses(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


@query(STATUS_SQL, "tiles10", "files", "points")
def q_tile_status(spark, sf):
    return statuses(spark, sf)


@query(f"select tile_id, fmt from (select tile_id, fmt from {EXISTING} union all select tile_id, 'geotiff' from tiles10 where l > 100)", "tiles10")
def q_catalog_merge(spark, sf):
    return existing(spark, sf).select("tile_id", "fmt").union(V.tiles10(spark).where("l > 100").select("tile_id", F.lit("geotiff")))


@query(f"select fmt, list_aggregate(list_sort(list('s3://bucket/'||fmt||'/'||tile_id||'.tif')), 'string_agg', ',') as uris from {EXISTING} group by 1")
def q_uris_per_format(spark, sf):
    uri = F.concat(F.lit("s3://bucket/"), "fmt", F.lit("/"), "tile_id", F.lit(".tif"))
    return existing(spark, sf).groupBy("fmt").agg(F.array_join(F.sort_array(F.collect_list(uri)), ",").alias("uris"))


@query("select p_partkey as job, coalesce(level, -1)::int as level from part left join (with recursive d(job, level) as (select p_partkey, 0 from part where p_partkey%10=0 union all select p.p_partkey, d.level+1 from part p join d on p.p_partkey%10<>0 and d.job=p.p_partkey-1) select job, level::int as level from d) on job = p_partkey")
def q_dag_levels(spark, sf):
    return catalog.dag_levels(V.table(spark, sf, "part").select(C("p_partkey").alias("job"), F.when(C("p_partkey") % 10 != 0, C("p_partkey") - 1).alias("parent"))).select("job", F.coalesce("level", F.lit(-1)).alias("level"))


@query("select o_orderkey, case when o_custkey%3=0 then 'dependent' when o_custkey%3=1 and o_orderkey%4=0 then 'excluded' else 'runnable' end as kind from orders")
def q_catalog_split(spark, sf):
    jobs = V.table(spark, sf, "orders").select("o_orderkey", F.when(C("o_custkey") % 3 == 0, F.lit("parent")).alias("depends_on"), F.when((C("o_custkey") % 3 == 1) & (C("o_orderkey") % 4 == 0), "1/4000").otherwise("10/40000").alias("grid"))
    return jobs.select("o_orderkey", F.when(C("depends_on").isNotNull(), "dependent").when(C("grid") == "1/4000", "excluded").otherwise("runnable").alias("kind"))


# --- a layer from its specification to its report -----------------------------------------------------------------------
RUN_SQL = """
select t.tile_id, case when t.top_i < -40 then 'skipped (not in subset)' when f.tile_id is null then 'skipped (does not intersect)' when t.left_i = 0 then 'existing' when d.tile_id is null then 'skipped (has no data)' else 'processed' end as status,
    coalesce(case when t.top_i >= -40 and f.tile_id is not null and t.left_i <> 0 then d.n end, 0)::bigint as n, coalesce(case when t.top_i >= -40 and f.tile_id is not null and t.left_i <> 0 then d.total end, 0)::bigint as total
from tiles10 t left join (select distinct t.tile_id from tiles10 t join files f on t.l<f.r and t.r>f.l and t.b<f.t and t.t>f.b) f using (tile_id)
left join (select tile_id, count(*)::bigint as n, sum(v)::bigint as total from (
    select lpad(abs(top)::varchar,2,'0')||case when top>=0 then 'N' else 'S' end||'_'||lpad(abs(lft)::varchar,3,'0')||case when lft>=0 then 'E' else 'W' end as tile_id, (arg_max(q, row(k, q))*2+1)::bigint%256 as v
    from (select (l_partkey%18)::int*10-80 as top, (l_orderkey%37)::int*10-180 as lft, l_suppkey%16 as r, l_linenumber as c, l_orderkey*10+l_linenumber as k, l_quantity as q from lineitem) group by top, lft, r, c) group by 1) d using (tile_id)
"""


@query(RUN_SQL, "tiles10", "files")
def q_layer_run(spark, sf):
    left, top = (C("l_orderkey") % 37 * 10 - 180).cast("int"), (C("l_partkey") % 18 * 10 - 80).cast("int")
    pixels = V.table(spark, sf, "lineitem").select(tile_id(left, top).alias("tile_id"), F.lit(0).alias("band"), (C("l_orderkey") * 10 + C("l_linenumber")).alias("k"), (C("l_suppkey") % 16).cast("int").alias("r"), C("l_linenumber").alias("c"), C("l_quantity").alias("v"))
    tiles = V.tiles10(spark)
    subset = [r.tile_id for r in tiles.where("top >= -40").select("tile_id").collect()]  # the grid's 648 tiles at most
    done = run(LAYER, tiles, pixels, files=V.source_files(spark, sf), subset=subset, existing=tiles.where("left = 0"))
    totals = done.pixels.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("band_1").alias("total"))
    return done.statuses.join(totals, "tile_id", "left").select("tile_id", "status", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"))


# --- scalars ----------------------------------------------------------------------------------------------------------
@query("select file_id, replace(uri, 's3://', '/vsis3/') as vsi, uri as back from files", "files")
def q_vsi_path(spark, sf):
    return V.source_files(spark, sf).select("file_id", S.to_vsi(C("uri")).alias("vsi")).select("file_id", "vsi", S.from_vsi(C("vsi")).alias("back"))


@query("select file_id, 's3' as scheme, 'bucket' as bucket, substr(uri, 13) as key from files", "files")
def q_url_parse(spark, sf):
    scheme, bucket, key = S.url_parts(C("uri"))
    return V.source_files(spark, sf).select("file_id", scheme.alias("scheme"), bucket.alias("bucket"), key.alias("key"))


@query("select file_id, regexp_extract(uri, '[^/]*$') as name, regexp_extract(uri, '^(.*)/[^/]*$', 1) as prefix from files", "files")
def q_path_parts(spark, sf):
    return V.source_files(spark, sf).select("file_id", *(c.alias(n) for c, n in zip(S.path_parts(C("uri")), ("name", "prefix"), strict=True)))


@query("select file_id from files where starts_with(uri, 's3://bucket/raw/supplier_00000000') and ends_with(uri, '.tif')", "files")
def q_prefix_glob(spark, sf):
    return V.source_files(spark, sf).where(C("uri").startswith("s3://bucket/raw/supplier_00000000") & C("uri").endswith(".tif")).select("file_id")


@query("select n_nationkey, n_nationkey%6 in (1, 3, 5) as flag from nation")
def q_to_bool(spark, sf):
    words = F.array(*map(F.lit, ("false", "true", "no", "YES", "0", "1")))
    return V.table(spark, sf, "nation").select("n_nationkey", S.to_bool(words[(C("n_nationkey") % 6).cast("int")]).alias("flag"))


@query(r"select p_partkey, regexp_matches(x, '^v\d{1,8}(\.\d{1,3}){0,2}?$|^latest$') as ok from (select p_partkey, case p_partkey%4 when 0 then 'v'||p_partkey when 1 then 'v1.'||p_partkey||'.3' when 2 then '1.'||p_partkey else 'latest' end as x from part)")
def q_version_regex(spark, sf):
    k, s = C("p_partkey") % 4, C("p_partkey").cast("string")
    x = F.when(k == 0, F.concat(F.lit("v"), s)).when(k == 1, F.concat(F.lit("v1."), s, F.lit(".3"))).when(k == 2, F.concat(F.lit("1."), s)).otherwise("latest")
    return V.table(spark, sf, "part").select("p_partkey", x.rlike(VERSION).alias("ok"))


@query("select n_nationkey, d as declared, s as stored from nation join (values (0,'boolean','uint8'),(1,'Int16','int16'),(2,'half','float16'),(3,'Double','float64')) t(i, d, s) on i = n_nationkey%4")
def q_dtype_lookup(spark, sf):
    stored = spark.createDataFrame([(k, v[0]) for k, v in DTYPES.items()], "name string, stored string")
    asked = F.array(*map(F.lit, ("boolean", "Int16", "half", "Double")))[(C("n_nationkey") % 4).cast("int")]
    return V.table(spark, sf, "nation").select("n_nationkey", asked.alias("declared")).join(F.broadcast(stored), F.lower("declared") == C("name")).select("n_nationkey", "declared", "stored")


@query("select p_partkey, case when p_partkey%3=0 then (p_size%2=0 and p_size%4=0) when p_partkey%3=1 then p_size%4<2 else p_size%4>=2 end as ok from part")
def q_nodata_validate(spark, sf):
    # types boolean, int16, float32 by key; no_data 0, 7, 0.0, 1.5 by size
    kind = F.array(*map(F.lit, ("boolean", "int16", "float32")))[(C("p_partkey") % 3).cast("int")]
    text = F.array(*map(F.lit, ("0", "7", "0.0", "1.5")))[C("p_size") % 4]
    return V.table(spark, sf, "part").select("p_partkey", S.no_data_fits(kind, text).alias("ok"))


@query("select o_orderkey, (o_orderkey%2=0) = (o_custkey%3<>0) as ok from orders")
def q_spec_validate(spark, sf):
    source, uri = F.when(C("o_orderkey") % 2 == 0, "raster").otherwise("vector"), F.when(C("o_custkey") % 3 != 0, F.lit("s3://b/k"))
    return V.table(spark, sf, "orders").select("o_orderkey", S.source_fits(source, uri).alias("ok"))


@query("select c_custkey, 'set_'||c_custkey as dataset, 'v'||(c_custkey%100) as version, case when c_custkey%2=0 then 2 else 1 end as band_count from customer")
def q_spec_json(spark, sf):
    spec = F.concat(F.lit('{"dataset":"set_'), C("c_custkey").cast("string"), F.lit('","version":"v'), (C("c_custkey") % 100).cast("string"), F.when(C("c_custkey") % 2 == 0, '","band_count":2}').otherwise('"}'))
    s = V.table(spark, sf, "customer").select("c_custkey", F.from_json(spec, "dataset string, version string, band_count int").alias("s"))
    return s.select("c_custkey", "s.dataset", "s.version", F.coalesce("s.band_count", F.lit(1)).alias("band_count"))


@query("select g.name, g.cols::bigint as width, d.dtype, d.stored, case when d.dtype='boolean' then 'CCITTFAX4' else 'DEFLATE' end as compress, (select max(b) from range(128, 529, 16) r(b) where cols % b = 0)::int as block, case when d.dtype='int8' then 'SIGNEDBYTE' else 'DEFAULT' end as pixeltype, d.nbits from " + GRIDS_SQL + " g, (values ('boolean','uint8',1),('uint16','uint16',0),('half','float16',16),('int8','int8',0)) d(dtype, stored, nbits)")
def q_dst_profile(spark, sf):
    rows = []
    for name in [r.name for r in grids_table(spark).where("kind = 'latlng'").collect()]:
        for kind in ("boolean", "uint16", "half", "int8"):
            x = profile(LayerSpec("d", "v1", "raster", "is", kind, name, ("s3://b/k",)), "gdal-geotiff", 0.0, 0.0)
            rows.append((name, x["width"], kind, x["dtype"], x["compress"], x["blockxsize"], x["pixeltype"], x.get("nbits", 0)))
    return spark.createDataFrame(rows, "name string, width long, dtype string, stored string, compress string, block int, pixeltype string, nbits int")


@query("select n_nationkey, case n_nationkey%3 when 0 then 'nearest' when 1 then 'mode' else 'average' end as method, n_nationkey%4<>3 as known from nation")
def q_resampling_lookup(spark, sf):
    names = spark.createDataFrame([(m,) for m in raster.METHODS], "m string")
    asked = F.array(*map(F.lit, ("nearest", "mode", "average")))[(C("n_nationkey") % 3).cast("int")]
    n = V.table(spark, sf, "nation").select("n_nationkey", asked.alias("method"), F.when(C("n_nationkey") % 4 == 3, "gauss").otherwise(asked).alias("m"))
    return n.join(F.broadcast(names.withColumn("known", F.lit(True))), "m", "left").select("n_nationkey", "method", F.coalesce("known", F.lit(False)).alias("known"))


@query("select row_i, col_i, k, case when C=0 then 'nan' else (A/C)::decimal(18,4)::varchar end as prop from pixels", "pixels")
def q_props_nan(spark, sf):
    v = F.when(C("C") == 0, F.lit(float("nan"))).otherwise(C("A") / C("C"))
    return V.pixels(spark, sf).select("row_i", "col_i", "k", S.nan_text(v).alias("prop"))


QUERIES = dict(sorted(QUERIES.items()))
