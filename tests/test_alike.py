"""Requests that find the same granules are searched once; what is found is given to each of them."""

import datetime as dt

from pyspark.sql import functions as F
from test_first_pairs import GRANULE, REQUEST, tables

from fieldstack.operators import search as SR


def test_listing_of_representatives_is_that_of_all(spark):
    reqs, grans = tables(8, 30, 600)
    reqs += [(100 + i, 0, *q[2:]) for i, q in enumerate(reqs)]                                    # each again under another key
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
    # equal rows in catalogue order may come in any order: what orders them is compared
    shown = lambda df: sorted(tuple(map(str, x)) for x in df.select("polygon_number", "ordinal", "acquired_at", "granule_id").collect())      # noqa: E731
    want = shown(SR.granule_listing(SR.search_granules(r, g, window_days=14, cell=1.0), 7))
    for bins, hot in ((None, None), (10, 3)):
        members = SR.alike(r, g, 14, 1.0, time_bin_days=bins, hot_key_rows=hot)
        some = SR.representatives(r, members)
        found = SR.granule_listing(SR.search_granules(some, g, window_days=14, cell=1.0, max_results=7), 7)
        assert shown(SR.for_members(found, members)) == want
    assert len(want) > 100 and any(x[0] == "None" for x in want)


def test_one_search_for_requests_of_a_place_and_day(spark):
    day = dt.date(2024, 6, 1)
    reqs = [(p, 0, day + dt.timedelta(days=p % 2), 70.2 + p / 1000, 40.2, 70.3 + p / 1000, 40.3) for p in range(100)]
    grans = [(k, f"G{k}", day, dt.datetime.combine(day, dt.time(k)), 10, 70.0 + k % 2, 40.0, 71.0 + k % 2, 41.0) for k in range(20)]
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
    members = SR.alike(r, g, 14, 1.0)
    assert members.count() == 100 and members.select("rep").distinct().count() == 2
    assert SR.representatives(r, members).agg(F.sort_array(F.collect_list("polygon_number"))).first()[0] == [0, 1]
