"""Facts about the driver tables measured independently at sf0.01 (FIXTURES.md, part B):
the adapters and the range join must reproduce them exactly."""

from scales import SF_CHECK
from pyspark.sql import functions as F

from fieldstack.operators import search as SR
from fieldstack.plans import catalog as C
from fieldstack.sources import driver as D


def test_requests_and_pairs(spark):
    assert C.time_points(spark, SF_CHECK).count() == 4431
    p = C.pairs(spark, SF_CHECK)
    r = p.agg(F.count("*").alias("n"), F.sum("granule_key").alias("k"),
              F.sum(F.abs("day_diff")).alias("d")).first()
    assert (r.n, r.k, r.d) == (4165, 32_053_695, 63_595)


def test_picks_per_window(spark):
    """The measured facts are of the search without a band filter."""
    plain = SR.adaptive_pick(C.pairs(spark, SF_CHECK))
    got = {(r.time_idx, r.window_days): r.n for r in
           plain.groupBy("time_idx", "window_days").agg(F.count("*").alias("n")).collect()}
    want = {(0, 3): 143, (0, 7): 161, (0, 14): 229, (0, 30): 342,
            (1, 3): 142, (1, 7): 165, (1, 14): 216, (1, 30): 357,
            (2, 3): 135, (2, 7): 151, (2, 14): 225, (2, 30): 357}
    assert got == want
    points = C.time_points(spark, SF_CHECK)
    assert SR.pick_status(points, plain).where("status = 'NO_DATA'").count() == 1808
    # with it 49 time points have no granule left in any window, and 25 others take another one
    banded = C.picks(spark, SF_CHECK)
    assert SR.pick_status(points, banded).where("status = 'NO_DATA'").count() == 1808 + 49
    both = plain.alias("a").join(banded.alias("b"), ["polygon_number", "time_idx"])
    assert both.where("a.granule_key <> b.granule_key").count() == 25


def test_files_and_pixels(spark):
    f = D.granule_files(spark, SF_CHECK)
    li = D.table(spark, SF_CHECK, "lineitem")
    assert li.select("l_orderkey", "l_linenumber").distinct().count() == 45_832
    per = (f.where(F.col("band") != "Fmask").groupBy("granule_key").agg(F.count_distinct("band").alias("k"))
            .groupBy("k").count())
    dist = {r.k: r["count"] for r in per.collect()}
    assert [dist.get(k, 0) for k in range(1, 7)] == [2238, 4312, 4456, 2649, 780, 101]
    px = D.pixels(spark, SF_CHECK).agg(F.count("*").alias("n"), F.sum("value").alias("s"),
                                       F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    assert (px.n, px.s, px.lo, px.hi) == (32_000, 31_984_692, 474, 1458)
    st = {r.status: r["count"] for r in C.QUERIES["stack_status"](spark, SF_CHECK).groupBy("status").count().collect()}
    assert st == {"READY": 27, "MISSING_BANDS": 1}
