"""The search for all pairs joins runs: the granules of a footprint and time bin meet a request as a few rows, not one by one."""

import datetime as dt
import uuid
from collections import Counter

import pytest

from fieldstack.operators import search as SR
from fieldstack.sources import granule_store as GS
from test_first_pairs import BASE, GRANULE, REQUEST, tables


def shuffled(plan) -> dict[str, int]:
    """Records written by each exchange of an executed plan, by its text."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    out = {}
    if kind == "ShuffleExchangeExec":
        out[plan.simpleString(200)] = plan.metrics().apply("shuffleRecordsWritten").value()
    for i in range(plan.children().size()):
        out |= shuffled(plan.children().apply(i))
    return out


def one_footprint(spark):
    reqs = [(1, 0, BASE, 10.2, 20.2, 10.4, 20.4)]
    grans = [(k, f"G{k:05d}", BASE + dt.timedelta(days=k % 20 - 10), dt.datetime.combine(BASE, dt.time()), k % 50, 10.0, 20.0, 11.0, 21.0)
             for k in range(2000)]
    return spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)


def test_granules_of_a_footprint_are_joined_as_runs(spark):
    found = SR.search_granules(*one_footprint(spark), cell=1.0, cloud_max=100)
    assert len(found.collect()) == 2000
    joined = [n for text, n in shuffled(found._jdf.queryExecution().executedPlan()).items() if "salt#" in text]
    # a footprint touches four cells; one by one, the granules would be 8000 rows
    assert len(joined) == 2 and max(joined) <= 200


@pytest.mark.parametrize("run, window, time_bin, marked", [(1, 30, None, False), (3, 7, None, True), (4, 0, 5, False), (256, 30, 400, True)])
def test_runs_give_all_pairs(spark, monkeypatch, run, window, time_bin, marked):
    monkeypatch.setattr(SR, "RUN", run)
    reqs, grans = tables(run, 40, 500)
    grans += grans[:40]                                                     # rows that repeat
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans, GRANULE)
    wanted = spark.createDataFrame([(k,) for k in range(0, 500, 3)], "granule_key long") if marked else None
    got = SR.search_granules(r, g, window_days=window, cell=1.0, time_bin_days=time_bin, wanted=wanted, hot_key_rows=5 if run == 3 else None)
    want = Counter((*q[:3], *k[:5], (k[2] - q[2]).days, *([k[0] is not None and k[0] % 3 == 0] if marked else [])) for q in reqs for k in grans
                   if q[2] and k[2] and abs((k[2] - q[2]).days) <= window and k[4] <= 30
                   and q[3] <= k[7] and k[5] <= q[5] and q[4] <= k[8] and k[6] <= q[6])
    names = ["polygon_number", "time_idx", "t_date", "granule_key", "granule_id", "acquired", "acquired_at", "cloud_pct", "day_diff"]
    assert got.columns == names + ["wanted"] * marked
    assert Counter(tuple(x) for x in got.collect()) == want and sum(want.values()) > 10


def test_a_catalogue_stores_runs(spark, tmp_path):
    reqs, grans = one_footprint(spark)
    layout, name = GS.Layout(buckets=2), f"catalogue_{uuid.uuid4().hex}"
    GS.write_catalogue(grans, name, layout, str(tmp_path / name))
    assert spark.table(name).count() <= 200      # one by one: a granule in each of four cells, 8000 rows
    for low, high, days in ((0, 30, 30), (49, 49, 30), (10, 20, 3), (0, 0, 0)):
        found = GS.search_catalogue(reqs, spark, name, layout, window_days=days, cloud_min=low, cloud_max=high)
        assert found.count() == sum(low <= k % 50 <= high and abs(k % 20 - 10) <= days for k in range(2000)) > 0


@pytest.mark.parametrize("run, window, hot", [(1, 30, None), (3, 7, 5), (256, 30, 1000)])
def test_stored_runs_give_all_pairs(spark, monkeypatch, tmp_path, run, window, hot):
    monkeypatch.setattr(SR, "RUN", run)
    reqs, grans = tables(run + 1, 40, 500)
    r, g = spark.createDataFrame(reqs, REQUEST), spark.createDataFrame(grans + grans[:40], GRANULE)
    layout, name = GS.Layout(bin_days=20, slab_bins=2, block_cells=2, buckets=2), f"catalogue_{uuid.uuid4().hex}"
    GS.write_catalogue(g, name, layout, str(tmp_path / name))
    got = GS.search_catalogue(r, spark, name, layout, window_days=window, hot_key_rows=hot)
    want = SR.search_granules(r, g, window_days=window, cell=1.0)
    assert got.schema == want.schema and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.count() > 50
