"""Golden values (fixed facts about the original pipeline's behaviour)."""

import datetime as dt

from pyspark.sql import functions as F

from fieldstack.functions import geo as GE
from fieldstack.functions.dates import date_spec, time_points
from fieldstack.functions.names import band_of_name, file_name, granule_id_from_name, granule_parts
from fieldstack.operators import search as SR
from fieldstack.operators.stats import band_percentiles
from fieldstack.plans.requests import explode_time_points, plan_requests

D = dt.date


def test_g1_time_points(spark):
    df = spark.createDataFrame([(D(2025, 3, 1), D(2025, 7, 1)), (D(2025, 1, 1), D(2025, 1, 6))], "s date, e date")
    got = [r.tp for r in df.select(time_points(F.col("s"), F.col("e")).alias("tp")).collect()]
    assert got[0] == [D(2025, 3, 1), D(2025, 5, 1), D(2025, 7, 1)]
    assert got[1] == [D(2025, 1, 1), D(2025, 1, 3), D(2025, 1, 6)]


def test_g2_bbox_and_utm(spark):
    df = spark.createDataFrame([(45.29107, 78.48538)], "lat double, lon double")
    b = df.select(GE.bbox_around(F.col("lat"), F.col("lon"), 0.1).alias("b")).first().b
    assert (b.south, b.west) == (45.191069999999996, 78.38538000000001)
    assert (b.north, b.east) == (45.39107, 78.58538)
    box = F.struct(F.lit(b.west).alias("west"), F.lit(b.south).alias("south"),
                   F.lit(b.east).alias("east"), F.lit(b.north).alias("north"))
    env = df.select(GE.bbox_to_utm(box, F.lit(44)).alias("e")).first().e
    assert [round(v, 2) for v in (env.minx, env.miny, env.maxx, env.maxy)] == \
        [294614.38, 5007012.59, 310990.73, 5029720.48]
    win = df.select(GE.pixel_window(F.struct(F.lit(env.minx).alias("minx"), F.lit(env.miny).alias("miny"),
                                             F.lit(env.maxx).alias("maxx"), F.lit(env.maxy).alias("maxy")),
                                    F.lit(env.minx), F.lit(env.maxy), 30.0).alias("w")).first().w
    assert (win.out_width, win.out_height) == (545, 756)
    # the row-level envelope gives the same numbers
    rows = GE.with_envelope(spark.createDataFrame([(1, b.west, b.south, b.east, b.north)],
                                                  "id int, w double, s double, e double, n double"),
                            F.col("w"), F.col("s"), F.col("e"), F.col("n"), F.lit(44), "env").first().env
    assert [round(v, 2) for v in (rows.minx, rows.miny, rows.maxx, rows.maxy)] == \
        [294614.38, 5007012.59, 310990.73, 5029720.48]


def test_g3_adaptive_window(spark):
    fields = spark.createDataFrame([(1, "x", 45.29107, 78.48538, D(2025, 3, 1), D(2025, 7, 1))],
                                   "polygon_number long, class string, lat double, lon double, start_date date, end_date date")
    tp = explode_time_points(plan_requests(fields, half_size=0.1))
    g = spark.createDataFrame([(i, f"G{i}", d, dt.datetime.combine(d, dt.time(5, 48, 19)), 10, 78.0, 45.0, 79.0, 46.0)
                               for i, d in enumerate([D(2025, 2, 18), D(2025, 3, 20), D(2025, 5, 13), D(2025, 6, 28)])],
                              "granule_key long, granule_id string, acquired date, acquired_at timestamp_ntz, cloud_pct long, west double, south double, east double, north double")
    picks = SR.adaptive_pick(SR.search_granules(tp, g, cell=1.0)).orderBy("time_idx").collect()
    assert [p.window_days for p in picks] == [14, 14, 3]
    assert [p.acquired for p in picks] == [D(2025, 2, 18), D(2025, 5, 13), D(2025, 6, 28)]


def test_g4_windows(spark):
    tp = spark.createDataFrame([(1, 0, D(2025, 3, 1))], "polygon_number long, time_idx int, t_date date")
    w = SR.search_windows(tp).orderBy("attempt").collect()
    assert [(r.window_start, r.window_end) for r in w[:3]] == [
        (D(2025, 2, 26), D(2025, 3, 4)), (D(2025, 2, 22), D(2025, 3, 8)), (D(2025, 2, 15), D(2025, 3, 15))]
    # future guard: nothing is widened after the first window is in the future
    fut = SR.search_windows(tp, as_of="2025-01-01").collect()
    assert len(fut) == 1 and fut[0].status == "FUTURE_DATE"


def test_g8_granule_time(spark):
    r = spark.createDataFrame([("HLS.S30.T44TLR.2025049T054819.v2.0",)], "g string") \
             .select(granule_parts(F.col("g")).alias("p")).first().p
    assert r.acquired_at == dt.datetime(2025, 2, 18, 5, 48, 19)
    assert (r.product, r.sensor, r.tile, r.version) == ("HLS", "S30", "T44TLR", "v2.0")


def test_g9_file_names(spark):
    gid = "HLS.S30.T42UXB.2025188T061639.v2.0"
    names = [f"https://x.example/a/{gid}.B11.tif", f"{gid}.Fmask.tif", f"{gid}_stac.json", "a.v2.0.BROWS.tif", "nodots"]
    df = spark.createDataFrame([(n,) for n in names], "u string")
    got = df.select(granule_id_from_name(file_name(F.col("u"))).alias("g"),
                    band_of_name(file_name(F.col("u"))).alias("b")).collect()
    assert [r.g for r in got] == [gid, gid, f"{gid}_stac.json", "a.v2.0.BROWS", "nodots"]
    assert [r.b for r in got] == ["B11", "Fmask", None, None, None]


def test_g10_percentiles(spark):
    df = spark.createDataFrame([(1, 0, "B02", v) for v in range(1, 101)],
                               "field_id long, time_idx int, band string, value int")
    r = band_percentiles(df).first()
    assert (r.p_low, r.p_high) == (2.98, 98.02)


def test_date_spec(spark):
    df = spark.createDataFrame([("2024-07-15",), ("2024-07-01, 2024-07-31",)], "s string")
    got = df.select(date_spec(F.col("s")).alias("d")).collect()
    assert (got[0].d.start, got[0].d.end) == (D(2024, 7, 15), D(2024, 7, 15))
    assert (got[1].d.start, got[1].d.end) == (D(2024, 7, 1), D(2024, 7, 31))


def test_bbox_order(spark):
    df = spark.createDataFrame([(45.2912, 78.49116, 45.24301, 78.44504)], "a double, b double, c double, d double")
    b = df.select(GE.bbox_from_corners(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("x")).first().x
    assert (b.west, b.south, b.east, b.north) == (78.44504, 45.24301, 78.49116, 45.2912)
    t = df.select(GE.bbox_from_text(F.lit("1, 2,3 ,4")).alias("t"), GE.bbox_from_text(F.lit("1,2,3")).alias("u")).first()
    assert (t.t.west, t.t.north, t.u) == (1.0, 4.0, None)
