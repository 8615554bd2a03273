"""A widening search deals its granules out once, and stops at a window that surely succeeds before it fetches any."""

import datetime as dt

from pyspark.sql import functions as F

from fieldstack.operators import search as SR
from test_first_pairs import GRANULE, REQUEST, WINDOWS

GRANULE, REQUEST = (x.replace("double", "long") for x in (GRANULE, REQUEST))      # tenths of a degree
DAY = dt.date(1970, 6, 1)      # far from the ends of a time bin


def request(p, day=DAY):
    return (p, 0, day, 704, 404, 706, 406)


def granules(spark, per_day=1):
    days = [DAY + dt.timedelta(days=d) for d in range(-30, 31)]
    return spark.createDataFrame([(i * per_day + j, f"G{i * per_day + j:04d}", d, dt.datetime.combine(d, dt.time(1)), 10, 700, 400, 710, 410)
                                  for i, d in enumerate(days) for j in range(per_day)], GRANULE)


def search(spark, requests, g, keys, n):
    wanted = g.where(F.col("granule_key").isin(keys)).select("granule_key") if keys is not None else g.select("granule_key")
    return SR.search_granules(spark.createDataFrame(requests, REQUEST), g, cell=10, max_results=n, windows=WINDOWS, wanted=wanted)


def rows(pairs):
    return sorted((r.polygon_number, r.day_diff) for r in pairs.collect())


def test_only_the_first_sure_window_is_fetched(spark):
    g = granules(spark)
    assert rows(search(spark, [request(1), request(2)], g, None, 5)) == [(1, -3), (2, -3)]
    # the day after the date is the first wanted one: its window of three days has four others before it
    assert rows(search(spark, [request(1)], g, [31], 5)) == [(1, d) for d in range(-3, 2)]
    # with a cap of four none of the windows reaches it, and all are fetched up to the cap
    assert rows(search(spark, [request(1)], g, [31], 4)) == [(1, d) for w in (30, 14, 7, 3) for d in range(-w, -w + 4)]
    # one date's granules count for the other's rank: nothing is cut
    two = [request(1), request(1, DAY + dt.timedelta(days=1))]
    assert len(rows(search(spark, two, g, None, 5))) == 2 * 19


def test_granules_are_dealt_out_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = search(spark, [request(p) for p in range(20)], granules(spark, 3), None, 5)
        assert pairs.count() == 20
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(g_west" in line and "block#" not in line]
    assert sum("ReusedExchange" not in line for line in dealt) == 1 and any("ReusedExchange" in line for line in dealt)
