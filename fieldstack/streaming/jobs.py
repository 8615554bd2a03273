"""Incremental forms of the batch jobs (T1-T3) with Structured Streaming.

Every job takes its checkpoint and output paths, so a later call with the same paths goes on after the last committed micro-batch
and reads new files alone. Results are tables of generations (``generations.py``): a micro-batch that is replayed after a failure replaces its
rows, and readers meet a bounded number of partitions however many micro-batches there were.

* T1 keeps no state: a request is pending or not by the ledger of the moment.
* T2 keeps the counts of open event-time windows in the state store. The watermark closes windows, and state goes with them; rows that arrive
  later are no reason to lose them: they go to the table as additions of their own, and reading adds them exactly.
* T3 keeps the fields seen of late in the state store (by arrival, so no row is ever too late) and resolves those that it has forgotten
  against the fields written before. The table holds every field once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from fieldstack.operators.ledger import finished
from fieldstack.streaming.generations import Generations

MAX_FILES = 1000        # files in a micro-batch
SALTS = 8               # parts that a window and status are counted in
DAY_MS = 86_400_000
NO_DAY = -1 << 31      # of rows without a time: closed from the start


def file_stream(spark: SparkSession, path: str, schema: StructType | None = None, max_files: int = MAX_FILES) -> DataFrame:
    """Stream of a Parquet table: a folder of part files (nested ones too), or a single file."""
    schema = schema or spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    folder, _, name = path.rstrip("/").rpartition("/")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run what there is of ``stream`` and stop."""
    start(stream, checkpoint, each, mode).awaitTermination()


def start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """The running query. Micro-batches without rows are switched off for it: state that can go waits for the next rows,
    while its timeouts would keep a query with such micro-batches busy for ever."""
    spark, name = stream.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return (stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before)


def _ddl(stream: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)


# ---- T1

def stream_resume(spark: SparkSession, requests_stream: DataFrame, ledger: Callable[[], DataFrame], checkpoint: str, out: str,
                  key: str = "output_id") -> DataFrame:
    """Incoming requests minus those already finished. ``ledger`` is called for each micro-batch, so outputs finished
    meanwhile are left out too. Returns all pending requests found so far."""
    table = Generations(spark, out, _ddl(requests_stream))

    def pending(batch: DataFrame, epoch: int) -> None:
        table.write(batch.join(finished(ledger()).select(key), key, "left_anti").select(*requests_stream.columns), epoch)

    _run(requests_stream, checkpoint, pending)
    return table.current()


# ---- T2

PROGRESS = "day int, status string, salt int, n long, late boolean"


def _progress_table(spark: SparkSession, out: str, every: int = 50) -> Generations:
    def merge(rows: DataFrame) -> DataFrame:
        """Totals grow, so the largest is the last; additions are summed."""
        n = F.when(F.col("late"), F.sum("n")).otherwise(F.max("n")).alias("n")
        return rows.groupBy("day", "status", "salt", "late").agg(n).select("day", "status", "salt", "n", "late")

    return Generations(spark, out, PROGRESS, merge, every)


def _count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A part of a window and status: its new total, or what came after the window was closed."""
    day, status, salt = key
    closed = (int(day) + 1) * DAY_MS <= state.getCurrentWatermarkMs()
    if state.hasTimedOut:
        if closed:
            state.remove()
        else:
            state.setTimeoutDuration(1)         # look again with the next micro-batch
        return
    n = sum(len(b) for b in batches)
    if closed:
        if state.exists:
            state.remove()
    else:
        n += state.get[0] if state.exists else 0
        state.update((n,))
        state.setTimeoutDuration(1)
    yield pd.DataFrame({"day": [day], "status": [status], "salt": [salt], "n": [n], "late": [closed]})


def progress_stream(ledger_stream: DataFrame, delay: str) -> DataFrame:
    """Counts of the stream's windows as they change. A window is a day of the rows' own time, which has no zone: its fields are
    read, not converted. Only the state of windows that the watermark has not passed is kept."""
    day = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    seconds = day.cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in ledger_stream.columns]), F.lit(SALTS)).cast("int")
    rows = ledger_stream.select(F.coalesce(day, F.lit(NO_DAY)).alias("day"), "status", salt.alias("salt"), F.timestamp_seconds(seconds).alias("at"))
    return rows.withWatermark("at", delay).groupBy("day", "status", "salt").applyInPandasWithState(
        _count, PROGRESS, "n long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def stream_progress(spark: SparkSession, ledger_stream: DataFrame, checkpoint: str, out: str, delay: str = "2 days",
                    every: int = 50) -> DataFrame:
    """Live counts per (day, status); see ``current_progress``. ``delay``: how far behind the latest row a window stays open."""
    table = _progress_table(spark, out, every)
    _run(progress_stream(ledger_stream, delay), checkpoint, lambda batch, epoch: table.write(batch, epoch), "update")
    return current_progress(spark, out)


def current_progress(spark: SparkSession, out: str) -> DataFrame:
    """Counts over all micro-batches so far: the last totals of windows, and what came late."""
    start = F.expr(f"cast(date_add(date'1970-01-01', nullif(day, {NO_DAY})) as timestamp_ntz)").alias("window_start")
    return (_progress_table(spark, out).current().groupBy("day", "status").agg(F.sum("n").alias("n"))
            .select(start, "status", "n").withColumn("window_end", F.col("window_start") + F.expr("interval 1 day"))
            .select("window_start", "window_end", "status", "n"))


# ---- T3

def stream_dedup(spark: SparkSession, ledger_stream: DataFrame, checkpoint: str, out: str, key: str = "polygon_number",
                 remember: str = "7 days", every: int = 50) -> DataFrame:
    """Every field once, however far apart its rows arrive. The state store drops fields seen within ``remember``
    (of arrival, which never runs late); fields that it has forgotten are found among those written before."""
    kind = f"`{key}` {ledger_stream.schema[key].dataType.simpleString()}"
    table = Generations(spark, out, kind, every=every)
    fresh = (ledger_stream.select(key, F.current_timestamp().alias("_arrived")).withWatermark("_arrived", remember)
             .dropDuplicatesWithinWatermark([key]).select(key))

    def unseen(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        # the few candidates go to the written fields, not these to them
        known = table.rows(before=epoch).join(batch.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left_semi")
        known = known.withColumnRenamed(key, "_k")
        table.write(batch.join(known, F.col(key).eqNullSafe(F.col("_k")), "left_anti"), epoch)
        batch.unpersist()

    _run(fresh, checkpoint, unseen)
    return table.current()
