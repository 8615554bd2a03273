"""Run ledger: resume, duplicates, outcome counters, progress/ETA, report
(J4, J5, A9, A10, W3, W4, P12, L5, U3, K8, F8).

Ledger rows: (batch_id, polygon_number, ts, event_id, status, duration_cs, message)
with status SUCCESS / SKIPPED / FAILED / ERROR (an unexpected error: counted as failed but
not as processed, as in the original counters) and durations in integer centiseconds, so every
rate and ETA below is computed in exact integer arithmetic (half-up rounding).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstack.constants import REPORT_TOP
from fieldstack.operators.scan import running_sums

ORDER = ["ts", "event_id"]


def _half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half-up for non-negative integers; NULL when den = 0."""
    return F.when(den != 0, F.floor((num * 2 + den) / (den * 2)).cast("long"))


def ledger_union(successes: DataFrame, failures: DataFrame) -> DataFrame:
    """One ledger from the success list and the failure list (columns by name)."""
    return successes.unionByName(failures, allowMissingColumns=True)


def finished(ledger: DataFrame) -> DataFrame:
    """Rows whose output exists."""
    return ledger.where(F.col("status").isin("SUCCESS", "SKIPPED"))


def resume_pending(requests: DataFrame, ledger: DataFrame, key: str = "output_id") -> DataFrame:
    """Requests whose output (field and dates) does not exist yet: left-anti join against finished rows."""
    return requests.join(finished(ledger).select(key), key, "left_anti")


def resolve_duplicates(ledger: DataFrame, key: str = "polygon_number") -> DataFrame:
    """Effective status with in-batch duplicates: a row after the first finished row
    (SUCCESS or SKIPPED) of the same field finds its output and is SKIPPED; rows before
    keep their own outcome (a failed first attempt is tried again).

    No window over the field: the first finished position per field is a partial
    aggregate, joined back (a hot field is one small row on the build side)."""
    pos = F.struct(*[F.col(c) for c in ORDER])
    first_done = (ledger.where(F.col("status").isin("SUCCESS", "SKIPPED"))
                        .groupBy("batch_id", key).agg(F.min(pos).alias("first_done")))
    j = ledger.join(first_done, ["batch_id", key], "left")
    after = F.col("first_done").isNotNull() & (pos > F.col("first_done"))
    return (j.withColumn("effective_status", F.when(after, "SKIPPED").otherwise(F.col("status")))
             .drop("first_done"))


def run_summary(ledger: DataFrame, part: list[str] = ["batch_id"]) -> DataFrame:
    """Counters and rates per batch (all algebraic, partial aggregation)."""
    s = F.col("status")
    agg = ledger.groupBy(*part).agg(
        F.count("*").alias("total"),
        F.count_if(s != "ERROR").alias("processed"),
        F.count_if(s == "SUCCESS").alias("success"),
        F.count_if(s == "SKIPPED").alias("skipped"),
        F.count_if(s.isin("FAILED", "ERROR")).alias("failed"),
        F.sum("duration_cs").alias("total_cs"),
    )
    p, t = F.col("processed"), F.col("total_cs")
    return agg.select(
        *part, "total", "processed", "success", "skipped", "failed", "total_cs",
        (_half_up_div((F.col("success") + F.col("skipped")) * 1000, p) / 10.0).alias("success_rate_pct"),
        F.when(p != 0, F.floor(t / p).cast("long")).alias("avg_cs"),
        (_half_up_div(p * 3_600_000, t) / 10.0).alias("fields_per_hour"),
    )


def eta_text(remaining_cs: Column) -> Column:
    """'Ns' under a minute, 'N.Nm' under an hour, else 'N.Nh' (half-up)."""
    r = remaining_cs
    secs = F.floor((r + 50) / 100).cast("long")
    tenth_m = F.floor((r + 300) / 600).cast("long")
    tenth_h = F.floor((r + 18000) / 36000).cast("long")

    def tenths(t):
        return F.concat(F.floor(t / 10).cast("long").cast("string"), F.lit("."), (t % 10).cast("string"))
    return (F.when(r.isNull(), F.lit("calculating..."))
             .when(r < 6000, F.concat(secs.cast("string"), F.lit("s")))
             .when(r < 360000, F.concat(tenths(tenth_m), F.lit("m")))
             .otherwise(F.concat(tenths(tenth_h), F.lit("h"))))


def run_progress(ledger: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Per processed row: position, running success/failed/skipped counts, % done,
    elapsed time and ETA, in ledger order within each batch (chunked prefix scan)."""
    chunk = chunk if chunk is not None else F.date_trunc("minute", F.col("ts"))
    s = F.col("status")
    x = running_sums(ledger, ["batch_id"], ORDER, chunk, {
        "seq": F.lit(1).cast("long"),
        "n_success": F.when(s == "SUCCESS", 1).otherwise(0).cast("long"),
        "n_failed": F.when(s.isin("FAILED", "ERROR"), 1).otherwise(0).cast("long"),
        "n_skipped": F.when(s == "SKIPPED", 1).otherwise(0).cast("long"),
        "elapsed_cs": F.col("duration_cs"),
    })
    total = F.col("_total_seq")
    remaining = F.floor(F.col("elapsed_cs") * (total - F.col("seq")) / F.col("seq")).cast("long")
    return x.select(
        "batch_id", "seq", "polygon_number", "status", "n_success", "n_failed", "n_skipped",
        total.alias("total"),
        (_half_up_div(F.col("seq") * 1000, total) / 10.0).alias("pct_done"),
        "elapsed_cs", remaining.alias("remaining_cs"), eta_text(remaining).alias("eta"),
    )


def report_top(ledger: DataFrame, n: int = REPORT_TOP) -> DataFrame:
    """First ``n`` successes (incl. skipped) and first ``n`` failures per batch, with the
    'and N more' count. row_number <= n is planned as a window group limit, so each
    task forwards at most n rows per group to the shuffle."""
    kind = F.when(F.col("status").isin("FAILED", "ERROR"), "failed").otherwise("successful")
    x = ledger.withColumn("list", kind)
    w = Window.partitionBy("batch_id", "list").orderBy(*ORDER)
    top = x.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    counts = x.groupBy("batch_id", "list").agg(F.count("*").alias("n_list"))
    return (top.join(counts, ["batch_id", "list"])
               .select("batch_id", "list", F.col("rank").cast("long").alias("rank"), "polygon_number",
                       "message", F.greatest(F.col("n_list") - n, F.lit(0)).alias("n_more")))


# ---- failure classification (ordered rules over message text) ----------------------

def classify_failure(text: Column) -> Column:
    """Ordered rules: timeout -> TIMEOUT (stop); 'No data found' / 'No granules selected'
    -> NO_DATA (retry wider window); authentication -> AUTH_FAILED (stop); future + date
    -> FUTURE_DATE (stop); anything else -> OTHER (retry)."""
    low = F.lower(text)
    return (F.when(F.instr(low, "timed out") > 0, "TIMEOUT")
             .when((F.instr(text, "No data found") > 0) | (F.instr(text, "No granules selected") > 0), "NO_DATA")
             .when((F.instr(text, "Authentication failed") > 0) | (F.instr(low, "authentication") > 0),
                   "AUTH_FAILED")
             .when((F.instr(low, "future") > 0) & (F.instr(low, "date") > 0), "FUTURE_DATE")
             .otherwise("OTHER"))


def failure_retry(kind: Column) -> Column:
    return kind.isin("NO_DATA", "OTHER")
