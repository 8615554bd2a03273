"""The whole batch job over all fields at once (E1 of the survey as one Spark job).

fields -> requests -> skip finished outputs (ledger) -> time points -> granule search -> widening-window pick (checkpointed: the
outputs reuse it) -> download manifest, organised layout, band completeness -> pixel windows, clip, resample, stack -> one ledger row
for each field.

An output is a field with its dates (``output_id``). Re-running with the same folder resumes: finished outputs are logged as SKIPPED, failed ones
are tried again. A field that stands in the input twice is processed until it succeeds once; later rows are SKIPPED. Each run writes its own
partitions; ``read_outputs`` gives the rows of the run that holds each output now.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.constants import BANDS, MAX_RESULTS_DOWNLOAD, WINDOWS
from fieldstack.operators import assemble as AS
from fieldstack.operators import granules as GR
from fieldstack.operators import organize as OG
from fieldstack.operators import search as SR
from fieldstack.operators import windows as WN
from fieldstack.operators.ledger import finished, resolve_duplicates, run_summary
from fieldstack.plans.requests import batch_position, explode_time_points, order_and_limit, plan_requests
from fieldstack.session import materialize
from fieldstack.sinks import writers as W

KEYS = ["polygon_number", "output_id", "input_pos"]     # a request: two rows of one field are two requests


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_ledger(spark: SparkSession, out_root: str) -> DataFrame | None:
    """The ledger, or None before the first run. A ledger that can't be read is an error."""
    path = f"{out_root.rstrip('/')}/ledger"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_outputs(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """Current rows of ``manifest``, ``organized_table`` or ``stack``."""
    root = out_root.rstrip("/")
    return W.current_rows(spark.read.parquet(f"{root}/{name}"), spark.read.parquet(f"{root}/ledger")).drop("bucket")


def run_batch(spark: SparkSession, fields: DataFrame, granules: DataFrame, files: DataFrame,
              out_root: str, half_size: float, cell: float, units_per_degree: float = 1.0,
              bands=BANDS, cloud_max: float = 30, as_of: str | None = None,
              max_results: int | None = MAX_RESULTS_DOWNLOAD, batch_id: str | None = None,
              run_id: str | None = None, run_ts: dt.datetime | None = None, rasters: DataFrame | None = None,
              px: float = 30.0, chunk: int = 8, position: Column | None = None) -> DataFrame:
    """Run the batch; returns the summary of this run (one row).

    ``run_id`` names this run's partitions (re-running with the same id replaces them); ``run_ts`` is its time in the ledger.
    ``rasters``: chunks (granule_key, band, crow, ccol, values) of the granules' rasters; with them a field succeeds when its stack is
    assembled, without them when all bands are there. ``position``: the order of rows in the batch (default: as in the input)."""
    began = time.monotonic()
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    batch_id = batch_id or run_ts.date().isoformat()
    run_id = run_id or f"{batch_id}-{uuid.uuid4().hex[:12]}"
    root, keys, at = out_root.rstrip("/"), KEYS, [*KEYS, "time_idx"]
    planned = plan_requests(fields, half_size=half_size, units_per_degree=units_per_degree)
    planned = planned.withColumn("batch_pos", position if position is not None else F.col("input_pos"))
    ledger = read_ledger(spark, root)
    if ledger is not None:      # this run's own rows, of an execution that it repeats, don't count
        done = finished(ledger.where(F.col("run_id") != run_id)).select("output_id").distinct().withColumn("done", F.lit(True))
        planned = planned.join(done, "output_id", "left")
    else:
        planned = planned.withColumn("done", F.lit(None).cast("boolean"))
    planned = materialize(planned)
    requests = planned.where("done is null").drop("done")
    n_buckets = W.buckets_for(planned.count())

    tp = explode_time_points(requests, keys=keys)
    # without a cap every pair counts
    first = {"max_results": max_results, "windows": WINDOWS, "wanted": SR.wanted_granules(files, list(bands))} if max_results is not None else {}
    pairs = SR.search_granules(tp, granules, cloud_min=0, cloud_max=cloud_max, cell=cell, request_keys=at, **first)
    picks = materialize(SR.adaptive_pick_banded(pairs, files, list(bands), max_results=max_results, request_keys=at))
    status = SR.pick_status(tp, picks, as_of=as_of, request_keys=at)
    complete = OG.granule_band_completeness(picks, files, list(bands), keys=at)
    grid = win = None
    if rasters is not None:
        grids = WN.granule_grids(granules.join(picks.select("granule_key").distinct(), "granule_key", "left_semi"), px, units_per_degree)
        win = materialize(WN.field_windows(picks, grids, requests, px, units_per_degree, tuple(keys)))
        grid = WN.grid_status(win, tuple(keys))
    outcome = field_outcomes(requests, status, complete, grid, keys)
    skipped = planned.where("done").select(*keys, F.lit("SKIPPED").alias("status"), F.lit("output exists").alias("message"))
    rows = outcome.unionByName(skipped).join(planned.select(*keys, "batch_pos"), keys)
    rows = (rows.withColumns({"ts": F.lit(run_ts).cast("timestamp_ntz"), "event_id": F.col("batch_pos"),
                              "batch_id": F.lit(batch_id).cast("date")}))
    rows = resolve_duplicates(rows, key="output_id")
    again = (F.col("effective_status") == "SKIPPED") & (F.col("status") != "SKIPPED")
    rows = materialize(rows.withColumns({"message": F.when(again, "output exists").otherwise(F.col("message")),
                                         "status": F.col("effective_status")}).drop("effective_status", "batch_pos"))

    worked = rows.where("status <> 'SKIPPED'").select(*keys)
    mine = picks.join(worked, keys, "left_semi")
    manifest = GR.download_manifest(mine, files, list(bands), f"{root}/downloads", request_keys=tuple(at))
    W.write_manifest(manifest, f"{root}/manifest", n_buckets, run_id)
    organized = OG.organized_path(OG.first_file_per_band(manifest, ["granule_id", "file_name"], keys=(*at, "band")), f"{root}/organized")
    W.write_organized(organized, f"{root}/organized_table", n_buckets, run_id)
    if rasters is not None:
        good = rows.where("status = 'SUCCESS'").select(*keys)
        stack = AS.field_stacks(win.join(good, keys, "left_semi"), rasters.where(F.col("band").isin(list(bands))), chunk,
                                tuple(keys), bands=bands)
        W.write_stack(stack, f"{root}/stack", n_buckets, run_id, field="polygon_number")
    # one job does all fields at once: its time is shared out among those that it processed
    n = worked.count()
    took = int((time.monotonic() - began) * 100)
    share = F.when(F.col("status") != "SKIPPED", F.lit(max(1, took // n) if n else 0)).otherwise(0).cast("long")
    W.append_ledger(rows.withColumns({"duration_cs": share, "run_id": F.lit(run_id)}), f"{root}/ledger")
    return run_summary(spark.read.parquet(f"{root}/ledger").where(F.col("run_id") == F.lit(run_id)))


def field_outcomes(requests: DataFrame, status: DataFrame, complete: DataFrame, grid: DataFrame | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """One outcome per request: SUCCESS when every time point found a granule and all bands (and, given ``grid``, the dates share
    a grid that the field lies on), else FAILED with the first problem ('t1: NO_DATA', 't0: MISSING_BANDS', 'GRID_MISMATCH');
    invalid requests fail with their validation status. Aggregates only, no window."""
    keys = keys or ["polygon_number"]
    per_tp = (status.join(complete.select(*keys, "time_idx", "missing"), [*keys, "time_idx"], "left")
                    .withColumn("problem", F.when(F.col("status") != "OK", F.col("status"))
                                           .when(F.col("missing") != "", F.lit("MISSING_BANDS"))))
    per_field = per_tp.groupBy(*keys).agg(
        F.count_if(F.col("problem").isNotNull()).alias("n_bad"),
        F.min(F.struct(F.col("problem").isNull(), "time_idx", "problem")).alias("first_bad"))
    usable = F.lit(True)
    if grid is not None:
        per_field = per_field.join(grid.select(*keys, F.col("status").alias("grid")), keys, "left")
        usable = F.col("grid").isin("OK", "PARTIAL", "FULL_EXTENT")
    bad = F.col("n_bad") > 0
    ok = per_field.select(
        *keys,
        F.when(~bad & usable, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(bad, F.concat(F.lit("t"), F.col("first_bad.time_idx").cast("string"), F.lit(": "), F.col("first_bad.problem")))
         .when(~usable, F.col("grid") if grid is not None else F.lit(None)).otherwise("ok").alias("message"))
    invalid = (requests.where(F.col("status") != "OK")
                       .select(*keys, F.lit("FAILED").alias("status"), F.col("status").alias("message")))
    return ok.unionByName(invalid)


def run_from_csv(spark: SparkSession, csv_path: str, start: str, end: str, granules: DataFrame,
                 files: DataFrame, out_root: str, half_size_deg: float = 0.01, cell_deg: float = 1.0,
                 order: str = "forward", limit: int | None = None, seed: int = 42, **kw) -> DataFrame:
    """The original batch entry point as one job: a field CSV (Polygon Number, Class,
    Y Coordinate, X Coordinate) and one date range for all fields, coordinates in degrees.
    Rejected rows are written next to the outputs; returns the run summary. The order says which rows a limit keeps
    and which of two rows of a field comes first; nothing is sorted for it unless there is a limit."""
    from fieldstack.sources.fields import cast_fields, read_fields_csv, split_valid  # noqa: PLC0415
    valid, rejected = split_valid(cast_fields(read_fields_csv(spark, csv_path)))
    rejected.write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/rejected")
    fields = (valid if limit is None else order_and_limit(valid, order, limit, seed)).withColumns(
        {"start_date": F.lit(start).cast("date"), "end_date": F.lit(end).cast("date")})
    return run_batch(spark, fields, granules, files, out_root, half_size=half_size_deg, cell=cell_deg,
                     units_per_degree=1.0, position=batch_position(order, seed), **kw)
