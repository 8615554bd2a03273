"""Property tests (hypothesis) on the column functions: the box contains its centre,
corner order does not matter, time points are ordered and inside the range, and the
granule-name round trip holds."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldstack.functions import geo as GE
from fieldstack.functions.dates import ntz_doy_text, ntz_text, parse_doy_ntz, time_points

SETTINGS = settings(max_examples=15, deadline=None)
lat = st.floats(min_value=-89.0, max_value=89.0, allow_nan=False)
lon = st.floats(min_value=-179.0, max_value=179.0, allow_nan=False)


@SETTINGS
@given(st.lists(st.tuples(lat, lon, st.floats(min_value=0.001, max_value=1.0)), min_size=1, max_size=20))
def test_box_contains_centre_and_corner_order(spark, pts):
    df = spark.createDataFrame(pts, "lat double, lon double, h double")
    b = GE.bbox_around(F.col("lat"), F.col("lon"), F.col("h"))
    swapped = GE.bbox_from_corners(b.north, b.east, b.south, b.west)
    bad = df.where(~((b.west <= F.col("lon")) & (F.col("lon") <= b.east)
                     & (b.south <= F.col("lat")) & (F.col("lat") <= b.north))
                   | (swapped.west != b.west) | (swapped.north != b.north)).count()
    assert bad == 0


@SETTINGS
@given(st.lists(st.tuples(st.dates(dt.date(1990, 1, 1), dt.date(2030, 1, 1)), st.integers(2, 2000)),
                min_size=1, max_size=20))
def test_time_points_ordered_and_inside(spark, rows):
    df = spark.createDataFrame([(s, s + dt.timedelta(days=d)) for s, d in rows], "s date, e date")
    for r in df.select("s", "e", time_points(F.col("s"), F.col("e")).alias("t")).collect():
        assert r.t[0] == r.s and r.t[-1] == r.e and r.t[0] <= r.t[1] <= r.t[2]
        assert r.t[1] == r.s + dt.timedelta(days=(r.e - r.s).days // 2)


@SETTINGS
@given(st.lists(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2030, 1, 1)), min_size=1, max_size=20))
def test_granule_time_round_trip(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    out = df.select("ts", parse_doy_ntz(ntz_doy_text(F.col("ts"))).alias("back"),
                    ntz_text(F.col("ts")).alias("txt")).collect()
    for r in out:
        assert r.back == r.ts.replace(microsecond=0)
        assert r.txt == r.ts.strftime("%Y-%m-%d %H:%M:%S,") + f"{r.ts.microsecond // 1000:03d}"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50), st.booleans()), min_size=1, max_size=120),
       st.integers(1, 40))
def test_chunked_scans_equal_windows(spark, rows, width):
    from pyspark.sql import Window
    from fieldstack.operators.scan import last_seen, next_value, running_sums
    data = [(b, i, v, flag) for i, (b, v, flag) in enumerate(rows)]
    df = spark.createDataFrame(data, "b int, i int, v int, flag boolean")
    chunk = F.floor(F.col("i") / width)                       # any order-monotone chunking
    w = Window.partitionBy("b").orderBy("i")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    key = F.when(F.col("flag"), F.col("i"))
    ref = (df.withColumn("s_ref", F.sum("v").over(wr))
             .withColumn("l_ref", F.last(key, ignorenulls=True).over(wr))
             .withColumn("n_ref", F.lead("v").over(w)))
    got = running_sums(df, ["b"], ["i"], chunk, {"s": F.col("v")})
    got = last_seen(got, ["b"], ["i"], chunk, key, "l")
    got = next_value(got, ["b"], ["i"], chunk, F.col("v"), "n")
    j = got.join(ref, ["b", "i"])
    assert j.count() == len(data)
    assert j.where(~F.col("s").eqNullSafe(F.col("s_ref")) | ~F.col("l").eqNullSafe(F.col("l_ref"))
                   | ~F.col("n").eqNullSafe(F.col("n_ref"))).count() == 0

def test_scans_over_a_tree(spark, monkeypatch):
    """Small nodes, so that every level has several: equal to plain windows, with null keys, null chunks, null values and ties of a chunk."""
    import random

    from pyspark.sql import Window

    from fieldstack.operators import scan
    monkeypatch.setattr(scan, "BITS", 2)
    monkeypatch.setattr(scan, "HALF", 1 << 5)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, None if i < 9 else i // 3 - 20, rng.randrange(9), rng.choice([None, i])) for i in range(180)]
    df = spark.createDataFrame(rows, "b string, i int, c int, v int, k int").repartition(7)
    got = scan.running_sums(df, ["b"], ["i"], F.col("c"), {"s": F.col("v"), "one": F.lit(1)})
    got = scan.last_seen(got, ["b"], ["i"], F.col("c"), F.when(F.col("v") > 5, F.col("i")), "l")
    got = scan.next_value(got, ["b"], ["i"], F.col("c"), F.col("k"), "n")
    w = Window.partitionBy("b").orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"s": F.sum("v").over(upto), "one": F.count("*").over(upto), "l": F.max(F.when(F.col("v") > 5, F.col("i"))).over(upto),
                           "n": F.lead("k").over(w), "_total_s": F.sum("v").over(Window.partitionBy("b"))})
    cols = ["b", "i", "s", "one", "l", "n", "_total_s"]
    key = lambda d: sorted(map(repr, (tuple(r) for r in d.select(*cols).collect())))      # noqa: E731
    assert key(got) == key(want) and len(rows) == got.count()


def test_no_task_holds_a_file(spark):
    """A file with 200,000 distinct minutes: no sort of the plan is fed by its key alone, and the result is right."""
    from fieldstack.operators import scan
    df = spark.range(200_000).selectExpr("'f' as b", "id as i", "timestamp_seconds(id * 60) as ts", "1 as v")
    got = scan.running_sums(df, ["b"], ["i"], F.col("ts"), {"s": F.col("v")})
    assert got.where("s <> i + 1 or _total_s <> 200000").count() == 0 and got.count() == 200_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(b#" in plan
    import re
    assert not re.search(r"hashpartitioning\(b#\d+, \d+\)", plan)
