"""The batch job: resume by output, duplicates, ledger rows, and outputs that survive later runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldstack.plans.batch import read_outputs, run_batch

BANDS = ["B02", "B03", "B04", "B8A", "B11", "B12"]
DAYS = [dt.date(2025, 3, 1), dt.date(2025, 5, 1), dt.date(2025, 7, 1)]
FIELDS = "polygon_number int, class string, lat double, lon double, input_pos long, start_date date, end_date date"


@pytest.fixture(scope="module")
def world(spark):
    """One tile with a complete granule on each date; a second tile that lacks a band on the last one; a third with nothing."""
    g, files = [], []
    for t, west in enumerate((78.0, 80.0)):
        for k, d in enumerate(DAYS):
            key = 10 * t + k
            g.append((key, f"G{key}", f"T{t}", d, dt.datetime.combine(d, dt.time(5)), 10, west, 45.0, west + 1, 46.0))
            files += [(key, f"G{key}", b, f"https://x/G{key}/G{key}.{b}.tif") for b in BANDS if (key, b) != (12, "B12")]
    granules = spark.createDataFrame(g, "granule_key long, granule_id string, tile string, acquired date, acquired_at timestamp_ntz, "
                                        "cloud_pct long, west double, south double, east double, north double")
    rasters = (granules.select("granule_key").crossJoin(spark.createDataFrame([(b,) for b in BANDS], "band string"))
               .crossJoin(spark.range(36).select(F.expr("id div 6").alias("crow"), (F.col("id") % 6).alias("ccol")))
               .withColumn("values", F.expr("transform(sequence(0, 63), i -> cast(granule_key * 1000 + crow * 6 + ccol + i as int))")))
    return granules, spark.createDataFrame(files, "granule_key long, granule_id string, band string, url string"), rasters


def rows(ids, lon=78.3, pos=None, start=DAYS[0], end=DAYS[2]):
    return [(i, "c", 45.2 + (i % 50) / 100, lon, i if pos is None else pos, start, end) for i in ids]


def run(spark, world, root, data, run_id, **kw):
    g, f, r = world
    day = dt.datetime(2026, 1, 1) + dt.timedelta(hours=sum(map(ord, run_id)))
    return run_batch(spark, spark.createDataFrame(data, FIELDS), g, f, str(root), half_size=0.05, cell=1.0, rasters=r, px=3000.0,
                     run_id=run_id, run_ts=day, **kw).first()


def fields_of(spark, root, name):
    return sorted(r[0] for r in read_outputs(spark, str(root), name).select("polygon_number").distinct().collect())


def test_later_runs_keep_what_earlier_ones_finished(spark, world, tmp_path):
    lacks_band = rows([900], lon=80.3)
    a = run(spark, world, tmp_path, rows(range(200)) + lacks_band, "a")
    assert (a.total, a.success, a.failed, a.skipped) == (201, 200, 1, 0) and a.total_cs > 0 and a.fields_per_hour > 0
    g, f, r = world
    b = run(spark, (g, f.union(spark.createDataFrame([(12, "G12", "B12", "https://x/G12/G12.B12.tif")], f.schema)), r), tmp_path,
            rows(range(260)) + lacks_band, "b")     # sixty more fields, and the failed one can be done now
    assert (b.total, b.success, b.failed, b.skipped) == (261, 61, 0, 200)
    want = [*range(260), 900]
    for name in ("manifest", "organized_table", "stack"):
        assert fields_of(spark, tmp_path, name) == want
    assert read_outputs(spark, str(tmp_path), "organized_table").count() == 18 * len(want)
    stack = read_outputs(spark, str(tmp_path), "stack")
    assert stack.groupBy("polygon_number", "row", "col").count().where("count > 1").isEmpty()
    # running b again replaces its rows
    again = run(spark, world, tmp_path, rows(range(260)) + lacks_band, "b")
    assert (again.total, again.skipped, again.failed) == (261, 200, 1)
    assert fields_of(spark, tmp_path, "stack") == list(range(260))


def test_second_date_range_is_another_output(spark, world, tmp_path):
    run(spark, world, tmp_path, rows([1]), "a")
    s = run(spark, world, tmp_path, rows([1], start=DAYS[0] + dt.timedelta(days=1)), "b")
    assert (s.total, s.success, s.skipped) == (1, 1, 0)
    assert read_outputs(spark, str(tmp_path), "organized_table").select("output_id").distinct().count() == 2


def test_all_done_and_duplicates(spark, world, tmp_path):
    two_places = rows([1], pos=0) + [(1, "c", 45.9, 78.9, 1, DAYS[0], DAYS[2])] + rows([2], pos=2)
    s = run(spark, world, tmp_path, two_places, "a")
    assert (s.processed, s.success, s.skipped) == (3, 2, 1)
    placed = read_outputs(spark, str(tmp_path), "manifest").where("polygon_number = 1").select("input_pos").distinct().collect()
    assert [r[0] for r in placed] == [0]
    s = run(spark, world, tmp_path, two_places, "b")
    assert (s.processed, s.success, s.skipped, s.failed) == (3, 0, 3, 0)
    s = run(spark, world, tmp_path / "back", two_places, "a", position=-F.col("input_pos"))
    assert (s.processed, s.skipped) == (3, 1)
    placed = read_outputs(spark, str(tmp_path / "back"), "manifest").where("polygon_number = 1").select("input_pos").distinct().collect()
    assert [r[0] for r in placed] == [1]


def test_failed_first_row_leaves_the_next_to_try(spark, world, tmp_path):
    far_first = [(1, "c", 10.0, 10.0, 0, DAYS[0], DAYS[2])] + rows([1], pos=1) + rows([1], pos=2)
    s = run(spark, world, tmp_path, far_first, "a")
    assert (s.failed, s.success, s.skipped) == (1, 1, 1)


def test_outcomes(spark, world, tmp_path):
    data = (rows([1]) + rows([2], lon=80.3) + [(3, "c", 10.0, 10.0, 3, DAYS[0], DAYS[2])] + rows([4], end=DAYS[0])
            + [(5, "c", 45.5, 78.97, 5, DAYS[0], DAYS[2])])
    run(spark, world, tmp_path, data, "a")
    got = {r.polygon_number: (r.status, r.message) for r in spark.read.parquet(f"{tmp_path}/ledger").collect()}
    assert got == {1: ("SUCCESS", "ok"), 2: ("FAILED", "t2: MISSING_BANDS"), 3: ("FAILED", "t0: NO_DATA"),
                   4: ("FAILED", "INVALID_RANGE"), 5: ("SUCCESS", "ok")}


def test_unreadable_ledger_is_an_error(spark, world, tmp_path):
    (tmp_path / "ledger" / "run_id=x").mkdir(parents=True)
    (tmp_path / "ledger" / "run_id=x" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        run(spark, world, tmp_path, rows([1]), "a")


def test_named_periods_reject_other_times(spark):
    from fieldstack.operators.assemble import assemble_named_periods
    px = spark.createDataFrame([(1, 2, "B02", 0, 0, 5)], "field_id long, time_idx int, band string, row int, col int, value int")
    with pytest.raises(Exception, match="no period is named"):
        assemble_named_periods(px, ["spring", "summer"]).collect()
