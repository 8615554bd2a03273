"""Inverse projection, full extent and crop by geometry, on small inputs against plain rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldstack.functions import geo as GE
from fieldstack.operators import crop as CR
from fieldstack.operators import windows as WN


def test_round_trip_of_the_projection(spark):
    rnd = random.Random(3)
    points = [(rnd.uniform(-80, 84), z, z * 6 - 183 + rnd.uniform(-3.5, 3.5)) for z in range(1, 61) for _ in range(50)]
    df = spark.createDataFrame(points, "lat double, zone int, lon double").withColumn("north", F.col("lat") >= 0)
    xy = df.withColumn("p", GE.to_utm(F.col("lat"), F.col("lon"), F.col("zone"), F.col("north")))
    back = xy.withColumn("q", GE.from_utm(F.col("p.x"), F.col("p.y"), F.col("zone"), F.col("north")))
    worst = back.select(F.max(F.greatest(F.abs(F.col("q.lat") - F.col("lat")), F.abs(F.col("q.lon") - F.col("lon"))))).first()[0]
    assert worst < 1e-9


def test_degree_bounds_hold_the_box(spark):
    df = spark.createDataFrame([(500000.0, 4400000.0, 530000.0, 4430000.0, 42)], "l double, b double, r double, t double, zone int")
    got = GE.degree_bounds(df, F.col("l"), F.col("b"), F.col("r"), F.col("t"), F.col("zone"), df.columns, "deg").first().deg
    env = spark.createDataFrame([tuple(got)], "w double, s double, e double, n double").select(
        GE.bbox_to_utm(F.struct(F.col("w").alias("west"), F.col("s").alias("south"), F.col("e").alias("east"), F.col("n").alias("north")),
                       F.lit(42)).alias("v")).first().v
    assert env.minx <= 500000.001 and env.miny <= 4400000.001 and env.maxx >= 529999.999 and env.maxy >= 4429999.999
    assert env.maxx - env.minx < 30600 and env.maxy - env.miny < 30600


@pytest.mark.parametrize("box", [(None,) * 4, (70.1, float("nan"), 70.2, 40.2), (70.1, None, 70.2, 40.2), (float("inf"), 40.1, 70.2, 40.2)])
def test_full_extent_without_a_usable_box(spark, box):
    grids = spark.createDataFrame([(7, "T1", 42, 600000.0, 4500000.0, 630000.0, 4440000.0)],
                                  "granule_key long, tile string, zone int, x0 double, y0 double, x1 double, y1 double")
    picks = spark.createDataFrame([(1, 0, 7), (1, 1, 7)], "polygon_number long, time_idx int, granule_key long")
    req = spark.createDataFrame([(1, *box)], "polygon_number long, west double, south double, east double, north double")
    win = WN.field_windows(picks, grids, req, 30.0)
    rows = win.collect()
    assert len(rows) == 2
    for r in rows:
        assert (r.status, r.col_off, r.row_off, r.out_width, r.out_height) == ("FULL_EXTENT", 0.0, 0.0, 1000, 2000)
    assert WN.grid_status(win).first().status == "FULL_EXTENT"
    assert WN.window_chunks(win, 1000).where("crow < 2 and ccol < 1").count() == 4


N, CHUNK, PX = 24, 8, 10.0


def chunks(spark, granule=7):
    rows = [(granule, "B02", cr, cc, [(cr * CHUNK + i // CHUNK) * N + cc * CHUNK + i % CHUNK + 1 for i in range(CHUNK * CHUNK)])
            for cr in range(N // CHUNK) for cc in range(N // CHUNK)]
    return spark.createDataFrame(rows, "granule_key long, band string, crow long, ccol long, values array<int>")


def fields(spark, polygons):
    rows = [(i, 7, 1000.0, 5000.0, 1000.0 + N * PX, 5000.0 - N * PX, p) for i, p in enumerate(polygons)]
    return spark.createDataFrame(rows, "id long, granule_key long, x0 double, y0 double, x1 double, y1 double, "
                                       "polygon array<struct<x:double,y:double>>")


def plain_crop(polygon):
    xs, ys = [p[0] for p in polygon], [p[1] for p in polygon]
    r0, r1 = max(0, math.floor((5000 - max(ys)) / PX)), min(N, math.ceil((5000 - min(ys)) / PX))
    c0, c1 = max(0, math.floor((min(xs) - 1000) / PX)), min(N, math.ceil((max(xs) - 1000) / PX))
    out = {}
    for r in range(r0, r1):
        for c in range(c0, c1):
            x, y = 1000 + (c + 0.5) * PX, 5000 - (r + 0.5) * PX
            turns = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(polygon, polygon[1:] + polygon[:1])]
            inside = all(t >= 0 for t in turns) or all(t <= 0 for t in turns)
            out[r - r0, c - c0] = (inside, r * N + c + 1 if inside else 0)
    return out


def hull(points):
    points = sorted(points)
    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]
    return half(points) + half(points[::-1])


def test_crop_equals_the_centre_rule(spark):
    rnd = random.Random(5)
    polygons = [hull([(rnd.uniform(950, 1290), rnd.uniform(4710, 5050)) for _ in range(rnd.choice([3, 4, 9]))]) for _ in range(60)]
    polygons += [p[::-1] for p in polygons[:10]]                                                  # clockwise
    polygons += [[(1000.0, 4760.0), (1240.0, 4760.0), (1240.0, 5000.0), (1000.0, 5000.0)],        # the raster itself
                 [(1012.0, 4981.0), (1014.0, 4981.0), (1013.0, 4983.0)],                          # no centre inside
                 [(900.0, 4900.0), (2000.0, 4900.0), (2000.0, 4925.0), (900.0, 4925.0)]]          # over both edges
    got = {}
    for r in CR.clip_geometry(fields(spark, polygons), chunks(spark), CHUNK, PX, ["id"]).collect():
        got.setdefault(r.id, {})[r.row, r.col] = (r.inside, r.value)
    for i, p in enumerate(polygons):
        assert got.get(i, {}) == plain_crop(p), p


def test_crop_of_odd_fields(spark):
    odd = [[], None, [(5000.0, 5000.0), (5100.0, 5000.0), (5050.0, 5100.0)], [(1100.0, 4900.0)], [(1100.0, 4900.0), (1100.0, 4900.0), (1100.0, 4900.0)]]
    got = CR.clip_geometry(fields(spark, odd), chunks(spark), CHUNK, PX, ["id"], nodata=-1).collect()
    assert all(r.value == -1 and not r.inside for r in got)
    assert CR.clip_geometry(fields(spark, [[(1000.0, 4760.0), (1240.0, 4760.0), (1240.0, 5000.0)]]), chunks(spark).limit(0), CHUNK, PX,
                            ["id"]).count() == 0
