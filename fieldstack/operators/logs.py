"""Run-log parsing and reports.

Lines look like ``2025-08-13 22:16:41,171 - INFO - text``; a line without that prefix
continues the previous record. Record boundaries need line order, so lines carry an
order key; the continuation lookup is a chunked last-seen scan (``scan.last_seen``), not
a window over a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.operators.scan import last_seen, next_value

HEAD = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) - ([A-Z]+) - (.*)$"
ATTEMPT = r"Attempt (\d+)/(\d+): \D*(\d+) day window \((\d{4}-\d{2}-\d{2}),(\d{4}-\d{2}-\d{2})\)"


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """Log files -> (file, block, pos, line). ``(block, pos)`` orders the lines of a file:
    ``block`` is the split offset, ``pos`` increases within a split."""
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"),
                    F.col("value").alias("line")))


def split_head(lines: DataFrame) -> DataFrame:
    ts_txt = F.regexp_extract("line", HEAD, 1)
    is_head = ts_txt != ""
    return lines.select(
        "*",
        is_head.alias("is_head"),
        F.when(is_head, F.to_timestamp_ntz(ts_txt, F.lit("yyyy-MM-dd HH:mm:ss,SSS"))).alias("line_ts"),
        F.when(is_head, F.regexp_extract("line", HEAD, 2)).alias("line_level"),
        F.when(is_head, F.regexp_extract("line", HEAD, 3)).alias("line_msg"),
    )


def parse_records(lines: DataFrame, order: list[str], chunk: Column, file_col: str = "file") -> DataFrame:
    """Lines -> records(file, record_key, ts, level, message, n_lines). Lines before the
    first timestamped line of a file form no record (their key is NULL) and are dropped."""
    x = split_head(lines)
    key = F.when(F.col("is_head"), F.struct(*[F.col(c) for c in order]))
    x = last_seen(x, [file_col], order, chunk, key, "record_key")
    rec = (x.where(F.col("record_key").isNotNull())
            .groupBy(file_col, "record_key")
            .agg(F.max("line_ts").alias("ts"), F.max("line_level").alias("level"),
                 F.max("line_msg").alias("message"), F.count("*").alias("n_lines")))
    return rec


def level_counts(lines: DataFrame) -> DataFrame:
    """Timestamped lines by level; untimestamped lines under 'other'."""
    x = split_head(lines)
    return (x.groupBy(F.coalesce(F.col("line_level"), F.lit("other")).alias("level"))
             .agg(F.count("*").alias("n")))


def record_steps(records: DataFrame, chunk: Column, file_col: str = "file") -> DataFrame:
    """Time from each record to the next one in the same file (ms), chunked lead."""
    x = next_value(records, [file_col], ["record_key"], chunk, F.col("ts"), "next_ts")
    return x.withColumn("step_ms", F.timestamp_diff("MILLISECOND", F.col("ts"), F.col("next_ts")))


def attempts(records: DataFrame) -> DataFrame:
    """'Attempt k/n: +-w day window (a,b)' records -> attempt, of, window, start, end."""
    m = F.col("message")
    x = records.where(F.regexp_extract(m, ATTEMPT, 1) != "")
    return x.select("*",
                    F.regexp_extract(m, ATTEMPT, 1).cast("int").alias("attempt"),
                    F.regexp_extract(m, ATTEMPT, 2).cast("int").alias("of"),
                    F.regexp_extract(m, ATTEMPT, 3).cast("int").alias("window_days"),
                    F.to_date(F.regexp_extract(m, ATTEMPT, 4)).alias("window_start"),
                    F.to_date(F.regexp_extract(m, ATTEMPT, 5)).alias("window_end"))


TIME_POINT = r"Downloading data for t(\d+): (\d{4}-\d{2}-\d{2})"
COMPLETED = r"Download completed for t(\d+) with \D*(\d+) day window"


def attempt_summary(records: DataFrame, chunk: Column, file_col: str = "file") -> DataFrame:
    """Per (log file, time point): number of search attempts, the last window tried, and
    the window of the successful download (NULL if none). Attempt records belong to the
    latest preceding 'Downloading data for t{i}' record (chunked last-seen scan)."""
    m = F.col("message")
    marker = F.regexp_extract(m, TIME_POINT, 1) != ""
    key = F.when(marker, F.struct(F.col("record_key").alias("k"),
                                  F.regexp_extract(m, TIME_POINT, 1).cast("int").alias("time_idx"),
                                  F.to_date(F.regexp_extract(m, TIME_POINT, 2)).alias("t_date")))
    x = last_seen(records, [file_col], ["record_key"], chunk, key, "tp")
    att = attempts(x).where(F.col("tp").isNotNull())
    per_tp = att.groupBy(file_col, F.col("tp.time_idx").alias("time_idx"), F.col("tp.t_date").alias("t_date")).agg(
        F.count("*").alias("n_attempts"),
        F.max_by("window_days", "record_key").alias("last_window"))
    done = (records.where(F.regexp_extract(m, COMPLETED, 1) != "")
                   .groupBy(file_col, F.regexp_extract(m, COMPLETED, 1).cast("int").alias("time_idx"))
                   .agg(F.max(F.regexp_extract(m, COMPLETED, 2).cast("int")).alias("completed_window")))
    return per_tp.join(done, [file_col, "time_idx"], "left")
