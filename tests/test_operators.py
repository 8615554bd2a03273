"""Operators on small literal inputs and on files written to a test folder."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldstack.operators import ledger as LG
from fieldstack.operators import logs as LO
from fieldstack.operators import organize as OG
from fieldstack.operators.scan import last_seen, next_value, running_sums
from fieldstack.operators.stats import band_histogram, band_stretch, band_percentiles
from fieldstack.sources import fields as FL
from fieldstack.sources import regions as RG


def test_fields_csv_load_and_rejects(spark, tmp_path):
    p = tmp_path / "fields.csv"
    p.write_text("Polygon Number,Class,Y Coordinate,X Coordinate,Extra\n"
                 "1,Sorghum,51.024681,71.841594,x\n"
                 "2,,51.0,71.8,y\n"
                 "x3,Other,50.9,71.9,z\n"
                 "4,Other,95.0,71.9,z\n"
                 "5,Other,abc,71.9,z\n")
    raw = FL.read_fields_csv(spark, str(p))
    valid, rej = FL.split_valid(FL.cast_fields(raw))
    v = {r.polygon_number: r["class"] for r in valid.collect()}
    assert v == {1: "Sorghum", 2: "Unknown"}
    assert sorted(r.reject_reason for r in rej.collect()) == [
        "BAD_COORDINATE", "BAD_POLYGON_NUMBER", "COORDINATE_OUT_OF_RANGE"]


def test_fields_csv_missing_columns(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Polygon Number,Y Coordinate\n1,2\n")
    with pytest.raises(FL.MissingColumns):
        FL.read_fields_csv(spark, str(p))


def test_regions_write_read_roundtrip(spark, tmp_path):
    boxes = spark.createDataFrame([(1, "45.191070", "78.385380", "45.391070", "78.585380"),
                                   (2, "-10.5", "-60.25", "-10.0", "-60.0")],
                                  "r long, a string, b string, c string, d string")
    lines = RG.region_lines(boxes, "r", {"sw_lat": F.col("a"), "sw_lon": F.col("b"),
                                         "ne_lat": F.col("c"), "ne_lon": F.col("d")})
    out = str(tmp_path / "regions")
    RG.write_regions(lines, out)
    parsed = RG.parse_regions(RG.read_region_files(spark, out)).collect()
    got = sorted((r.sw_lat, r.sw_lon, r.ne_lat, r.ne_lon, r.status) for r in parsed)
    assert got == [(-10.5, -60.25, -10.0, -60.0, "OK"), (45.19107, 78.38538, 45.39107, 78.58538, "OK")]


def test_regions_last_corner_wins_and_missing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("comment\nsw 1,2\nne 3 , 4\nsw 5,6\n")
    (tmp_path / "b.txt").write_text("sw 1,2\nNE 3,4\n")
    r = {x.region.rsplit("/", 1)[-1]: x for x in RG.parse_regions(RG.read_region_files(spark, str(tmp_path))).collect()}
    assert (r["a.txt"].sw_lat, r["a.txt"].sw_lon, r["a.txt"].ne_lat, r["a.txt"].status) == (5.0, 6.0, 3.0, "OK")
    assert r["b.txt"].status == "MISSING_CORNER"


def test_tif_tree_and_preference(spark, tmp_path):
    t0 = tmp_path / "f1" / "t0"
    t0.mkdir(parents=True)
    for name in ["x.B02.tif", "x.B02.tiff", "x.B03.tif", "notes.txt", "x.B04.tif"]:
        (t0 / name).write_bytes(b"\0")
    listing = OG.scan_tif_tree(spark, str(tmp_path))
    paths = sorted(r.path.rsplit("/", 1)[-1] for r in listing.collect())
    assert paths == ["x.B02.tif", "x.B03.tif", "x.B04.tif"]
    both = spark.createDataFrame([(str(t0), str(t0 / n)) for n in ["x.B02.tif", "x.B02.tiff", "x.B03.tif"]],
                                 "folder string, path string")
    pref = {r.band: r.path.rsplit("/", 1)[-1] for r in OG.prefer_tiff(both).collect()}
    assert pref == {"B02": "x.B02.tiff", "B03": "x.B03.tif"}


def test_log_text_continuation(spark, tmp_path):
    p = tmp_path / "run.log"
    p.write_text("preamble without time\n"
                 "2025-08-13 22:16:41,171 - INFO - Attempt 1/4: ±3 day window (2025-02-26,2025-03-04)\n"
                 "   continuation one\n"
                 "   continuation two\n"
                 "2025-08-13 22:16:58,901 - WARNING - Download failed\n"
                 "2025-08-13 22:17:00,000 - ERROR - No data found\n")
    lines = LO.read_log_text(spark, str(p))
    rec = LO.parse_records(lines, ["block", "pos"], F.col("block")).orderBy("ts").collect()
    assert [(r.level, r.n_lines) for r in rec] == [("INFO", 3), ("WARNING", 1), ("ERROR", 1)]
    lv = {r.level: r.n for r in LO.level_counts(lines).collect()}
    assert lv == {"INFO": 1, "WARNING": 1, "ERROR": 1, "other": 3}
    a = LO.attempts(LO.parse_records(lines, ["block", "pos"], F.col("block"))).first()
    assert (a.attempt, a.of, a.window_days, a.window_start) == (1, 4, 3, dt.date(2025, 2, 26))
    steps = LO.record_steps(LO.parse_records(lines, ["block", "pos"], F.col("block")), F.col("record_key.block"))
    assert sorted(r.step_ms for r in steps.collect() if r.step_ms is not None) == [1099, 17730]


def test_failure_rules_in_order(spark):
    texts = ["No data found for window", "Authentication failed", "x authentication y",
             "date is in the future", "Download timed out", "boom", "No data found; authentication"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.k for r in df.select(LG.classify_failure(F.col("t")).alias("k")).collect()]
    assert got == ["NO_DATA", "AUTH_FAILED", "AUTH_FAILED", "FUTURE_DATE", "TIMEOUT", "OTHER", "NO_DATA"]


def test_eta_text(spark):
    df = spark.createDataFrame([(None,), (4449,), (5950,), (6000,), (359_999,), (360_000,), (1_000_000,)], "r long")
    got = [r.e for r in df.select(LG.eta_text(F.col("r")).alias("e")).collect()]
    assert got == ["calculating...", "44s", "60s", "1.0m", "60.0m", "1.0h", "2.8h"]


def test_chunked_scans_equal_plain_windows(spark):
    rows = [(b, i, (i * 7919) % 13, i // 5) for b in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "b int, i int, v int, c int")
    got = running_sums(df, ["b"], ["i"], F.col("c"), {"s": F.col("v")})
    w = Window.partitionBy("b").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w))
    j = got.join(ref, ["b", "i"]).where(F.col("s") != F.col("ref")).count()
    assert j == 0
    key = F.when(F.col("v") % 4 == 0, F.col("i"))
    ls = last_seen(df, ["b"], ["i"], F.col("c"), key, "last")
    ref2 = df.withColumn("ref", F.last(key, ignorenulls=True).over(w))
    assert ls.join(ref2, ["b", "i"]).where(~F.col("last").eqNullSafe(F.col("ref"))).count() == 0
    nv = next_value(df, ["b"], ["i"], F.col("c"), F.col("v"), "nxt")
    ref3 = df.withColumn("ref", F.lead("v").over(Window.partitionBy("b").orderBy("i")))
    assert nv.join(ref3, ["b", "i"]).where(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0


def test_duplicate_resolution(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(7, t, 1, "FAILED"), (7, t, 2, "SUCCESS"), (7, t, 3, "FAILED"), (8, t, 4, "SUCCESS"), (8, t, 5, "SUCCESS")]
    df = spark.createDataFrame([(p, ts, e, s, dt.date(2024, 1, 1)) for p, ts, e, s in rows],
                               "polygon_number long, ts timestamp_ntz, event_id long, status string, batch_id date")
    got = {r.event_id: r.effective_status for r in LG.resolve_duplicates(df).collect()}
    assert got == {1: "FAILED", 2: "SUCCESS", 3: "SKIPPED", 4: "SUCCESS", 5: "SKIPPED"}


def test_histogram_sums_and_flat_stretch(spark):
    px = spark.createDataFrame([(1, 0, "B02", v) for v in [3, 3, 5, 9]] + [(2, 0, "B02", 7)] * 3,
                               "field_id long, time_idx int, band string, value int")
    h = band_histogram(px)
    tot = {r.field_id: (r.n, r.k) for r in h.groupBy("field_id").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    assert tot == {1: (4, 7), 2: (3, 1)}
    s = band_stretch(px, band_percentiles(px))
    flat = [r.stretched for r in s.where("field_id = 2").collect()]
    assert flat == [None, None, None]


def test_salted_range_join_equals_plain(spark):
    """Forcing every (cell, bin) key hot (threshold 3 rows) must not change the pairs."""
    from scales import SF_SMALL
    from fieldstack.operators import search as SR
    from fieldstack.plans import catalog as C
    from fieldstack.sources import driver as D
    tp, g = C.time_points(spark, SF_SMALL), D.granules(spark, SF_SMALL)
    plain = SR.search_granules(tp, g, cell=D.GRANULE_SIZE, hot_key_rows=None)
    salted = SR.search_granules(tp, g, cell=D.GRANULE_SIZE, hot_key_rows=3)
    cols = ["polygon_number", "time_idx", "granule_key"]
    assert salted.count() == plain.count()
    assert salted.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert "salt" in salted._jdf.queryExecution().executedPlan().toString()


def test_sinks_roundtrip(spark, tmp_path):
    from scales import SF_SMALL
    from fieldstack.plans import catalog as C
    from fieldstack.sinks import writers as W
    stack = C.QUERIES["stack_assemble"](spark, SF_SMALL)
    W.write_stack(stack, str(tmp_path / "stack"), n_buckets=4)
    back = spark.read.parquet(str(tmp_path / "stack")).drop("bucket")
    assert back.exceptAll(stack.select(back.columns)).count() == 0 and back.count() == stack.count()
    man = C.QUERIES["download_manifest"](spark, SF_SMALL)
    W.write_manifest(man, str(tmp_path / "man"), n_buckets=4)
    W.write_manifest(man, str(tmp_path / "man"), n_buckets=4)   # retried job: same result
    assert spark.read.parquet(str(tmp_path / "man")).count() == man.count()
    led = C.QUERIES["run_ledger"](spark, SF_SMALL).withColumn("run_id", F.lit("r1"))
    W.append_ledger(led, str(tmp_path / "ledger"))
    W.append_ledger(led, str(tmp_path / "ledger"))          # re-executed run: replaced, not doubled
    W.append_ledger(led.withColumn("run_id", F.lit("r2")), str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2 * led.count()
    org = C.QUERIES["organize_bands"](spark, SF_SMALL)
    W.write_organized(org, str(tmp_path / "org"))
    assert spark.read.parquet(str(tmp_path / "org")).count() == org.count()


def test_batch_run_and_resume(spark, tmp_path):
    from scales import SF_SMALL
    from fieldstack.plans import catalog as C
    from fieldstack.plans.batch import run_batch
    from fieldstack.sources import driver as D
    fields = C.valid_fields(spark, SF_SMALL)
    g, f = D.granules(spark, SF_SMALL), D.granule_files(spark, SF_SMALL)
    kw = dict(out_root=str(tmp_path / "out"), half_size=D.HALF_SIZE, cell=D.GRANULE_SIZE,
              units_per_degree=D.UNITS_PER_DEGREE)
    s1 = run_batch(spark, fields, g, f, batch_id="2024-01-01", **kw).first()
    assert s1.processed == fields.count()
    assert s1.success + s1.failed == s1.processed
    s2 = run_batch(spark, fields, g, f, batch_id="2024-01-02", **kw).first()
    # second run: finished fields are skipped, only the failed ones are tried again
    assert (s2.total, s2.skipped, s2.failed, s2.success) == (s1.total, s1.success, s1.failed, 0)


def test_resample_matches_brute_force(spark):
    import math
    from fieldstack.operators.assemble import resample_window
    px = spark.createDataFrame([(1, 0, "B02", r, c, r * 100 + c) for r in range(12) for c in range(12)],
                               "field_id long, time_idx int, band string, row int, col int, value int")
    win = dict(col_off=1.3, row_off=0.6, width=9.7, height=8.2)
    w = spark.createDataFrame([(1, *win.values())], "field_id long, col_off double, row_off double, width double, height double")
    got = {(r.row, r.col): r.value for r in resample_window(px, w).collect()}
    ow, oh = int(win["width"]), int(win["height"])
    want = {}
    for j in range(oh):
        for i in range(ow):
            sr = math.floor(win["row_off"] + (j + 0.5) * win["height"] / oh)
            sc = math.floor(win["col_off"] + (i + 0.5) * win["width"] / ow)
            want[(j, i)] = sr * 100 + sc
    assert got == want


def test_nearest_pick_and_cloud_validation(spark):
    import datetime as dt
    from fieldstack.operators import search as SR
    pairs = spark.createDataFrame(
        [(1, 0, dt.date(2025, 3, 1), k, f"G{k}", dt.date(2025, 3, 1) + dt.timedelta(days=d),
          dt.datetime(2025, 3, 1) + dt.timedelta(days=d), 5, d) for k, d in [(1, -6), (2, 5)]],
        "polygon_number long, time_idx int, t_date date, granule_key long, granule_id string, acquired date, "
        "acquired_at timestamp_ntz, cloud_pct long, day_diff int")
    assert SR.adaptive_pick(pairs).first().granule_key == 1           # first in catalogue order (+-7)
    assert SR.adaptive_pick(pairs, nearest=True).first().granule_key == 2
    with pytest.raises(ValueError):
        SR.validate_cloud_range(0.5, 0.2)


def test_summary_counts_unexpected_errors_as_failed_not_processed(spark):
    rows = [("SUCCESS", 100), ("SKIPPED", 0), ("FAILED", 50), ("ERROR", 10)]
    df = spark.createDataFrame([(dt.date(2024, 1, 1), s, d) for s, d in rows],
                               "batch_id date, status string, duration_cs long")
    r = LG.run_summary(df).first()
    assert (r.processed, r.success, r.skipped, r.failed) == (3, 1, 1, 2)
    assert r.success_rate_pct == 66.7
    empty = LG.run_summary(spark.createDataFrame([(dt.date(2024, 1, 1), "ERROR", 5)], df.schema)).first()
    assert empty.processed == 0 and empty.success_rate_pct is None and empty.avg_cs is None


def test_granule_select_modes(spark):
    from fieldstack.operators import search as SR
    df = spark.createDataFrame([(1, 0, i) for i in (1, 2)] + [(2, 0, i) for i in (1, 2, 3)],
                               "polygon_number long, time_idx int, ordinal int")
    got = {(r.polygon_number, r.ordinal): (r.status, r.selected) for r in SR.granule_select(df, [1, 3]).collect()}
    assert got[(1, 1)] == ("INVALID_SELECTION", False) and got[(2, 3)] == ("OK", True) and got[(2, 2)] == ("OK", False)
    assert all(r.selected for r in SR.granule_select(df, []).collect())
    assert not any(r.selected for r in SR.granule_select(df, [1], abort=True).collect())


def test_attempt_summary(spark, tmp_path):
    lines = [
        "2025-01-01 10:00:00,000 - INFO - Downloading data for t0: 2025-03-01",
        "2025-01-01 10:00:00,001 - INFO -    Attempt 1/4: +-3 day window (2025-02-26,2025-03-04)",
        "2025-01-01 10:00:10,000 - WARNING -    Download failed for t0 with +-3 day window: exit 1",
        "   STDERR: no granules",
        "2025-01-01 10:00:10,001 - INFO -    Attempt 2/4: +-7 day window (2025-02-22,2025-03-08)",
        "2025-01-01 10:00:20,001 - INFO -    Attempt 3/4: +-14 day window (2025-02-15,2025-03-15)",
        "2025-01-01 10:00:30,000 - INFO -    Download completed for t0 with +-14 day window",
        "2025-01-01 10:01:00,000 - INFO - Downloading data for t1: 2025-05-01",
        "2025-01-01 10:01:00,001 - INFO -    Attempt 1/4: +-3 day window (2025-04-28,2025-05-04)",
    ]
    p = tmp_path / "run.log"
    p.write_text("\n".join(lines) + "\n")
    rec = LO.parse_records(LO.read_log_text(spark, str(p)), ["block", "pos"], F.col("block"))
    got = {r.time_idx: (r.t_date, r.n_attempts, r.last_window, r.completed_window)
           for r in LO.attempt_summary(rec, F.col("record_key.block")).collect()}
    assert got == {0: (dt.date(2025, 3, 1), 3, 14, 14), 1: (dt.date(2025, 5, 1), 1, 3, None)}


def test_stack_write_read_unpivot_roundtrip(spark, tmp_path):
    from scales import SF_SMALL
    from fieldstack.operators import assemble as AS
    from fieldstack.sinks import writers as W
    from fieldstack.sources import driver as D
    px = D.pixels(spark, SF_SMALL)
    stack = AS.assemble_stack(px)
    W.write_stack(stack, str(tmp_path / "stack"), n_buckets=4)
    back = AS.stack_to_pixels(AS.read_stack(spark, str(tmp_path / "stack")))
    ready = AS.stack_status(px).where("status = 'READY'").select("field_id")
    want = px.join(ready, "field_id", "left_semi")
    cols = ["field_id", "time_idx", "band", "row", "col", "value"]
    assert back.count() == want.count()
    assert back.select(cols).exceptAll(want.select(cols)).count() == 0
    one = AS.read_stack(spark, str(tmp_path / "stack"), field_ids=[1], n_buckets=4)
    assert [r[0] for r in one.select("field_id").distinct().collect()] == [1]
    assert one.count() == stack.where("field_id = 1").count()
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_two_completeness_forms_agree(spark):
    from scales import SF_SMALL
    from fieldstack.plans import catalog as C
    pk = C.picks(spark, SF_SMALL)
    a = OG.band_completeness(pk, C.organize(spark, SF_SMALL, pk))
    b = OG.granule_band_completeness(pk, C.files(spark, SF_SMALL))
    cols = ["polygon_number", "time_idx", "missing", "n_found", "status"]
    assert a.count() == b.count() and a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_run_from_csv(spark, tmp_path):
    from fieldstack.plans.batch import run_from_csv
    csv = tmp_path / "fields.csv"
    csv.write_text("Polygon Number,Class,Y Coordinate,X Coordinate\n"
                   "1,Sorghum,45.29107,78.48538\n2,Other,45.30,78.50\n3,Other,95.0,78.5\n")
    g = spark.createDataFrame(
        [(k, f"G{k}", d, dt.datetime.combine(d, dt.time(5)), 10, 78.0, 45.0, 79.0, 46.0)
         for k, d in enumerate([dt.date(2025, 2, 18), dt.date(2025, 5, 13), dt.date(2025, 6, 28)])],
        "granule_key long, granule_id string, acquired date, acquired_at timestamp_ntz, cloud_pct long, "
        "west double, south double, east double, north double")
    bands = ["B02", "B03", "B04", "B8A", "B11", "B12"]
    f = spark.createDataFrame([(k, f"G{k}", b, f"https://x/G{k}/G{k}.{b}.tif") for k in range(3) for b in bands],
                              "granule_key long, granule_id string, band string, url string")
    s = run_from_csv(spark, str(csv), "2025-03-01", "2025-07-01", g, f, str(tmp_path / "out"),
                     batch_id="2025-08-13").first()
    assert (s.processed, s.success, s.failed) == (2, 2, 0)
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 1


def test_csv_files_with_headers_of_their_own(spark, tmp_path):
    """Swapped columns load right, quoted and marked headers too; a file without coordinates or without rows fails or adds nothing."""
    (tmp_path / "a.csv").write_text("Polygon Number,Class,Y Coordinate,X Coordinate\n1,Rice,45.1,71.2\n2,,46,72\n")
    (tmp_path / "b.csv").write_text("﻿X Coordinate,\"Y Coordinate\",Remark,Polygon Number\r\n71.2,45.1,\"x, y\",3\r\n500,45,z,4\r\n")
    (tmp_path / "c.csv").write_text("Polygon Number,Y Coordinate,X Coordinate,Class\n")
    got = FL.cast_fields(FL.read_fields_csv(spark, str(tmp_path))).orderBy("polygon_number").collect()
    assert [(r.polygon_number, r["class"], r.lat, r.lon, r.reject_reason) for r in got] == [
        (1, "Rice", 45.1, 71.2, None), (2, "Unknown", 46.0, 72.0, None), (3, "Unknown", 45.1, 71.2, None), (4, "Unknown", 45.0, 500.0, "COORDINATE_OUT_OF_RANGE")]
    (tmp_path / "d.csv").write_text("Polygon Number,Latitude\n1,2\n")
    with pytest.raises(FL.MissingColumns, match="d.csv"):
        FL.read_fields_csv(spark, str(tmp_path))
