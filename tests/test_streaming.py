"""Streams equal their batch forms, whatever the order of files, and go on where they stopped."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldstack.sources import driver as D
from fieldstack.streaming import generations as G
from fieldstack.streaming import jobs as SJ


@pytest.fixture
def events(spark, tmp_path):
    """The events in four files, the latest first; later calls add more."""
    from scales import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    n = ev.count()
    parts = [ev.where(F.col("event_id").between(n * k // 4, n * (k + 1) // 4 - 1)) for k in range(4)]
    assert sum(p.count() for p in parts) == n
    src = tmp_path / "events.parquet"

    def add(k):
        parts[k].coalesce(1).write.parquet(str(src / f"{9 - k}"))
    return ev, str(src), add, (str(tmp_path / "ckpt"), str(tmp_path / "out"))


def counts(rows):
    return {(r.window_start.date(), r.status): r.n for r in rows.collect()}


def test_files_in_reverse_time_order_all_count(spark, events):
    ev, src, add, paths = events
    for k in (3, 2, 1, 0):
        add(k)
    runs = D.runs_from_events(ev)
    want = {(r.d, r.status): r.n for r in runs.groupBy(F.col("ts").cast("date").alias("d"), "status").agg(F.count("*").alias("n")).collect()}
    stream = SJ.file_stream(spark, src, ev.schema, max_files=1)
    assert counts(SJ.stream_progress(spark, D.runs_from_events(stream), *paths)) == want
    keys = SJ.stream_dedup(spark, D.runs_from_events(stream), paths[0] + "2", paths[1] + "2")
    assert sorted(r[0] for r in keys.collect()) == sorted(r[0] for r in runs.select("polygon_number").distinct().collect())


def test_second_call_reads_new_files_alone(spark, events):
    ev, src, add, paths = events
    add(3)
    stream = SJ.file_stream(spark, src, ev.schema)
    one = SJ.stream_progress(spark, D.runs_from_events(stream), *paths)
    first = one.agg(F.sum("n")).first()[0]
    for k in (0, 1):
        add(k)
    two = SJ.stream_progress(spark, D.runs_from_events(SJ.file_stream(spark, src, ev.schema)), *paths)
    total = spark.read.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src).count()
    assert two.agg(F.sum("n")).first()[0] == total > first
    table = SJ._progress_table(spark, paths[1])
    assert [r[-1] for r in table.partitions()] == ["0", "1"] or len(table.partitions()) >= 2


def test_resume_reads_the_ledger_for_each_batch(spark, tmp_path):
    src, paths = tmp_path / "req.parquet", (str(tmp_path / "ckpt"), str(tmp_path / "out"))
    done = []
    schema = "output_id string, status string"

    def ledger():
        return spark.createDataFrame(done, schema)
    for i, ids in enumerate((["a", "b"], ["c", "d"])):
        spark.createDataFrame([(x, "OK") for x in ids], schema).coalesce(1).write.parquet(str(src / str(i)))
        got = SJ.stream_resume(spark, SJ.file_stream(spark, str(src)), ledger, *paths)
        done += [("b", "SUCCESS"), ("d", "SKIPPED"), ("c", "FAILED")]
    assert sorted(r.output_id for r in got.collect()) == ["a", "b", "c"]


def test_before_the_first_file(spark, tmp_path):
    (tmp_path / "empty.parquet").mkdir()
    schema = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").schema
    stream = SJ.file_stream(spark, str(tmp_path / "empty.parquet"), schema)
    assert SJ.stream_progress(spark, D.runs_from_events(stream), str(tmp_path / "c"), str(tmp_path / "o")).collect() == []


def test_late_row_of_another_year(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    src = str(tmp_path / "ev.parquet")
    for i, year in enumerate((2025, 1999)):
        spark.createDataFrame([(i, dt.datetime(year, 1, 1), 7 + i, "x", 1.0)], schema).write.parquet(f"{src}/{i}")
    got = SJ.stream_progress(spark, D.runs_from_events(SJ.file_stream(spark, src, max_files=1)), str(tmp_path / "c"), str(tmp_path / "o"))
    assert got.agg(F.sum("n")).first()[0] == 2


RUNS = "ts timestamp_ntz, status string, polygon_number int"


def run_table(rows, spark):
    return spark.createDataFrame(rows, RUNS)


def by_day(rows):
    out = {}
    for ts, status, _ in rows:
        out[ts.date(), status] = out.get((ts.date(), status), 0) + 1
    return out


def test_state_is_bounded_and_late_rows_count(spark, tmp_path):
    """14 days, a file each, every third file with rows of the first days: closed windows leave the store, late rows are added."""
    rng = __import__("random").Random(5)
    src, everything, states = str(tmp_path / "runs"), [], []
    for i in range(14):
        day = dt.datetime(2025, 3, 1) + dt.timedelta(days=i)
        rows = [(day + dt.timedelta(minutes=rng.randrange(1440)), rng.choice(["SUCCESS", "FAILED", None]), rng.randrange(99)) for _ in range(20)]
        if i % 3 == 2:
            rows += [(dt.datetime(2025, 3, 1 + k, 5), "SUCCESS", k) for k in range(4)]
        everything += rows
        run_table(rows, spark).coalesce(1).write.parquet(f"{src}/{i:02d}")
    stream = SJ.file_stream(spark, src, run_table([], spark).schema, max_files=1)
    paths = str(tmp_path / "ckpt"), str(tmp_path / "out")
    table = SJ._progress_table(spark, paths[1], 5)
    query = SJ.start(SJ.progress_stream(stream, "2 days"), paths[0], table.write, "update")
    query.awaitTermination()
    states = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(states) >= 14 and max(states) <= 4 * 3 * SJ.SALTS and states[-1] < 3 * max(states[:5])
    assert counts(SJ.current_progress(spark, paths[1])) == by_day(everything)
    assert len(table.partitions()) <= 5 + 8
    late = table.rows().where("late").agg(F.sum("n")).first()[0]
    assert late >= 8
    # a second call goes on: a new file with old, new and timeless rows
    more = [(dt.datetime(2025, 3, 1, 1), "SUCCESS", 1), (dt.datetime(2025, 4, 30), "FAILED", 1), (None, "SUCCESS", 3)]
    run_table(more, spark).coalesce(1).write.parquet(f"{src}/99")
    SJ.stream_progress(spark, SJ.file_stream(spark, src, run_table([], spark).schema), *paths)
    got = {((r.window_start.date() if r.window_start else None), r.status): r.n for r in SJ.current_progress(spark, paths[1]).collect()}
    assert got == by_day(everything + more[:2]) | {(None, "SUCCESS"): 1}


def test_dedup_of_stragglers(spark, tmp_path, monkeypatch):
    """Keys forgotten by the store are found among the written ones; null is a key; no key is written twice."""
    src, paths = str(tmp_path / "runs"), (str(tmp_path / "ckpt"), str(tmp_path / "out"))
    t = dt.datetime(2025, 1, 1)
    batches = [[1, 2, 2, None], [2, 3], [1, None, 4], [5, 1, 3], [6], [2, 6, 7]]
    for i, keys in enumerate(batches):
        run_table([(t, "x", k) for k in keys], spark).coalesce(1).write.parquet(f"{src}/{i}")
        stream = SJ.file_stream(spark, src, run_table([], spark).schema, max_files=1)
        got = SJ.stream_dedup(spark, stream, *paths, remember="1 millisecond", every=3)
        assert sorted(map(str, (r[0] for r in got.collect()))) == sorted({str(k) for b in batches[:i + 1] for k in b})


def test_generations_survive_crashes(spark, tmp_path, monkeypatch):
    """Many epochs in few partitions; after a crash at any step of a compaction, the epoch's next try loses and doubles nothing."""
    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n")).select("k", "n")

    table = G.Generations(spark, str(tmp_path / "t"), "k int, n long", merge, every=5, fan=3)
    rows = [spark.createDataFrame([(i % 2, 1)], "k int, n long").coalesce(1) for i in range(2)]
    want, crashes, listed = {}, 0, []
    steps = ["segment", "commit", "after"]

    class Crash(Exception):
        pass

    for epoch in range(40):
        m = table.manifest()
        if epoch - m.through > table.every:         # a compaction is due: crash at each of its steps first
            step = steps[crashes % 3]
            crashes += 1
            with monkeypatch.context() as patch:
                def stop(*_, real=table._commit):
                    if step == "after":
                        real(*_)
                    raise Crash

                patch.setattr(table, "_segment" if step == "segment" else "_commit", stop)
                with pytest.raises(Crash):
                    table.write(rows[epoch % 2], epoch)
        if epoch % 7 == 0:                          # written, but not committed: tried again
            table.write(rows[epoch % 2].union(rows[epoch % 2]), epoch)
        table.write(rows[epoch % 2], epoch)
        want[epoch % 2] = want.get(epoch % 2, 0) + 1
        listed.append(len(table.partitions()))
    assert {r.k: r.n for r in table.current().collect()} == want and crashes >= 5
    assert max(listed) <= 5 + 3 * 3 and len(table.unnamed()) > 0
    with pytest.raises(RuntimeError):
        table.write(rows[0], 3)
