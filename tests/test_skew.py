"""A third of all requests in one (cell, time bin): the salted range join splits that key
and still returns exactly the brute-force pairs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fieldstack.operators import search as SR


def brute(reqs, grans, w):
    out = set()
    for (p, t, td, rw, rs, re_, rn) in reqs:
        for (k, gid, acq, at, cloud, gw, gs, ge, gn) in grans:
            if (abs((acq - td).days) <= w and 0 <= cloud <= 30
                    and rw <= ge and gw <= re_ and rs <= gn and gs <= rn):
                out.add((p, t, k))
    return out


def test_hot_cell_is_salted_and_exact(spark):
    rnd = random.Random(7)
    base = dt.date(2024, 6, 1)
    reqs = []
    for p in range(300):
        hot = p % 3 == 0   # a third of the requests: same cell, same dates
        lat = 45.5 if hot else rnd.uniform(40, 50)
        lon = 75.5 if hot else rnd.uniform(70, 80)
        td = base if hot else base + dt.timedelta(days=rnd.randint(-200, 200))
        reqs.append((p, 0, td, lon - 0.05, lat - 0.05, lon + 0.05, lat + 0.05))
    grans = []
    for k in range(400):
        gw, gs = float(rnd.randint(70, 79)), float(rnd.randint(40, 49))
        acq = base + dt.timedelta(days=rnd.randint(-230, 230))
        grans.append((k, f"G{k:04d}", acq, dt.datetime.combine(acq, dt.time(k % 24)), rnd.randint(0, 60),
                      gw, gs, gw + 1.0, gs + 1.0))
    grans += [(1000 + i, f"H{i}", base + dt.timedelta(days=i - 5), dt.datetime.combine(base, dt.time(1)), 10,
               75.0, 45.0, 76.0, 46.0) for i in range(10)]
    r = spark.createDataFrame(reqs, "polygon_number long, time_idx int, t_date date, west double, south double, east double, north double")
    g = spark.createDataFrame(grans, "granule_key long, granule_id string, acquired date, acquired_at timestamp_ntz, "
                                     "cloud_pct long, west double, south double, east double, north double")
    pairs = SR.search_granules(r, g, cell=1.0, hot_key_rows=20)
    got = {(x.polygon_number, x.time_idx, x.granule_key) for x in pairs.collect()}
    assert got == brute(reqs, grans, 30)
    # the hot key was split: its request rows carry several salt values
    tb = 61
    salted_r, _ = SR.salt_hot_keys(
        r.withColumn("tbin", F.floor(F.datediff("t_date", F.lit("1970-01-01").cast("date")) / tb))
         .withColumn("cx", F.floor("west")).withColumn("cy", F.floor("south")),
        g.withColumn("tbin", F.lit(0)).withColumn("cx", F.lit(0)).withColumn("cy", F.lit(0)),
        ["tbin", "cx", "cy"], ["polygon_number", "time_idx"], 20)
    n_salts = salted_r.where((F.col("cx") == 75) & (F.col("cy") == 45)).select("salt").distinct().count()
    assert n_salts >= 4


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

half = st.integers(0, 8).map(lambda k: 70 + k * 0.5)      # 0.5-degree grid: edges often touch cells
halfy = st.integers(0, 8).map(lambda k: 40 + k * 0.5)
size = st.integers(0, 3).map(lambda k: k * 0.5)            # includes zero-size (point) boxes


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(half, halfy, size, size, st.integers(-40, 40)), min_size=1, max_size=25),
       st.lists(st.tuples(half, halfy, size, size, st.integers(-40, 40), st.integers(0, 40)), min_size=1, max_size=25),
       st.sampled_from([None, 2]))
def test_range_join_touching_boxes_exact(spark, reqs, grans, hot):
    base = dt.date(2024, 6, 1)
    r = [(i, 0, base + dt.timedelta(days=d), x, y, x + w, y + h) for i, (x, y, w, h, d) in enumerate(reqs)]
    g = [(k, f"G{k:03d}", base + dt.timedelta(days=d), dt.datetime.combine(base + dt.timedelta(days=d), dt.time(0)),
          c, x, y, x + w, y + h) for k, (x, y, w, h, d, c) in enumerate(grans)]
    rdf = spark.createDataFrame(r, "polygon_number long, time_idx int, t_date date, west double, south double, east double, north double")
    gdf = spark.createDataFrame(g, "granule_key long, granule_id string, acquired date, acquired_at timestamp_ntz, "
                                   "cloud_pct long, west double, south double, east double, north double")
    got = [(x.polygon_number, x.time_idx, x.granule_key)
           for x in SR.search_granules(rdf, gdf, cell=1.0, hot_key_rows=hot).collect()]
    assert len(got) == len(set(got))          # no pair twice
    assert set(got) == brute(r, g, 30)
