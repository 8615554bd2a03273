"""Searches that need only their first granules fetch these, not every pair; their rows are those of the search over all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldstack.operators import search as SR

BASE = dt.date(2024, 6, 1)
REQUEST = "polygon_number long, time_idx int, t_date date, west double, south double, east double, north double"
GRANULE = ("granule_key long, granule_id string, acquired date, acquired_at timestamp_ntz, cloud_pct long, "
           "west double, south double, east double, north double")
WINDOWS = [3, 7, 14, 30]


def tables(seed, n_requests, n_granules, days=50, odd=True):
    rnd = random.Random(seed)
    day = lambda: BASE + dt.timedelta(days=rnd.randint(-days, days))      # noqa: E731
    reqs, grans = [], []
    for p in range(n_requests):
        x, y = rnd.randint(140, 148) / 2, rnd.randint(80, 86) / 2
        rows = 2 if odd and p % 5 == 0 else 1      # keys that repeat, with another date and box
        for i in range(rows):
            x, y = x + i, y
            reqs.append((None if odd and p == 7 else p, 0, None if odd and p % 11 == 3 and i else day(), x - 0.05, y - 0.05, x + 0.05, y + 0.05))
    if odd:
        reqs.append(reqs[0])
    for k in range(n_granules):
        w, s, a = float(rnd.randint(70, 74)), float(rnd.randint(40, 43)), day()
        side = 0.5 if odd and k % 9 == 0 else 1.0
        at = dt.datetime.combine(a, dt.time(rnd.randint(0, 3)))
        if odd and k % 13 == 0:
            at = None if k % 2 else at + dt.timedelta(days=rnd.randint(-4, 4))      # a time that isn't on its day
        grans.append((None if odd and k % 31 == 5 else k, f"G{k if k % 3 else k - k % 6:05d}", None if odd and k % 29 == 5 else a, at,
                      rnd.randint(0, 40), w, s, w + side, s + side))
    return reqs, grans


def picks_of_all(reqs, grans, has, n):
    """(key, date) -> (window, granule): every window of every key's rows, ranked in full."""
    pairs = [(q, g) for q in reqs for g in grans if q[2] and g[2] and abs((g[2] - q[2]).days) <= 30 and 0 <= g[4] <= 30
             and q[3] <= g[7] and g[5] <= q[5] and q[4] <= g[8] and g[6] <= q[6]]
    order = lambda p: (p[1][3] is not None, p[1][3] or dt.datetime.min, p[1][1], p[1][0] is not None, p[1][0] or 0)      # noqa: E731
    out = {}
    for key in {q[:2] for q in reqs}:
        mine = sorted((p for p in pairs if p[0][:2] == key), key=order)
        for w in WINDOWS:
            for q, g in [p for p in mine if abs((p[1][2] - p[0][2]).days) <= w][:n]:
                if g[0] in has:
                    out.setdefault((*key, q[2]), (w, g[0]))
    return out


@pytest.mark.parametrize("seed, n, hot", [(1, 2, None), (2, 5, None), (3, 1, 3), (4, 50, None)])
def test_picks_equal_those_of_all_pairs(spark, seed, n, hot):
    reqs, grans = tables(seed, 40, 900)
    has = set(range(0, 900, 4 if n < 50 else 23)) | {None}
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
    files = spark.createDataFrame([(k, "B02") for k in sorted(has - {None})] + [(None, "B02"), (1, "Fmask")], "granule_key long, band string")
    wanted = SR.wanted_granules(files, ["B02"])
    want = picks_of_all(reqs, grans, has - {None}, n)
    every = SR.search_granules(r, g, cell=1.0, hot_key_rows=hot)
    first = SR.search_granules(r, g, cell=1.0, hot_key_rows=hot, max_results=n, windows=WINDOWS, wanted=wanted, time_bin_days=61 if seed == 2 else None)
    for pairs in (every, first):
        got = SR.adaptive_pick_banded(pairs, files, ["B02"], max_results=n)
        assert {(x.polygon_number, x.time_idx, x.t_date): (x.window_days, x.granule_key) for x in got.collect()} == want
    assert len(want) > 10


def test_listing_equals_that_of_all_pairs(spark):
    reqs, grans = tables(5, 40, 900)
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
    # equal rows in catalogue order may come in any order: what orders them is compared
    shown = lambda df: sorted(tuple(map(str, x)) for x in df.select("polygon_number", "ordinal", "acquired_at", "granule_id").collect())      # noqa: E731
    want = shown(SR.granule_listing(SR.search_granules(r, g, cell=1.0), 7))
    assert shown(SR.granule_listing(SR.search_granules(r, g, cell=1.0, max_results=7, windows=[30]), 7)) == want
    assert shown(SR.search_granules(r, g, cell=1.0, max_results=7)) == want and len(want) > 100
    with pytest.raises(ValueError):
        SR.search_granules(r, g, windows=[3])


def test_pairs_do_not_grow_with_revisits(spark):
    """Four times the granules of the same days: no more pairs for the ranking than the cap allows."""
    fetched = []
    for n_granules in (4000, 16000):
        reqs, grans = tables(6, 30, n_granules, odd=False)
        r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
        all_wanted = g.select("granule_key")
        listed = SR.search_granules(r, g, cell=1.0, max_results=10, windows=[30]).groupBy("polygon_number").count()
        picked = SR.search_granules(r, g, cell=1.0, max_results=10, windows=WINDOWS, wanted=all_wanted).groupBy("polygon_number").count()
        fetched.append((listed.agg(F.max("count")).first()[0], picked.agg(F.max("count")).first()[0]))
    # a box meets at most four footprints here, each in at most two time bins
    assert all(a <= 10 * 8 and b <= 4 * 8 for a, b in fetched)
    assert fetched[1][1] <= fetched[0][1] + 4
