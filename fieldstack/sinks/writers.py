"""Sinks (K2, K3, K4, K8): Parquet tables partitioned by run and by a hash bucket of the field.

A run writes its own partitions and no others, so a resumed run can't touch what an earlier one finished, and re-executing a run
replaces its own rows (dynamic partition overwrite). Which run holds the current rows of a field is resolved on read, by the
ledger (``current_rows``).

Rows are rebalanced by bucket: how many tasks write is up to the data's size (AQE joins small buckets into a task and splits large ones), and
the number of buckets follows the number of fields (``buckets_for``), so neither tasks nor files are fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS_PER_BUCKET = 1024


def buckets_for(n_fields: int, per_bucket: int = FIELDS_PER_BUCKET) -> int:
    return max(1, -(-n_fields // per_bucket))


def field_bucket(col: str, n: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int")


def _writer(df: DataFrame, mode: str):
    return (df.write.mode(mode).option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic"))


def _write_bucketed(df: DataFrame, path: str, field: str, n_buckets: int, run_id: str | None, sort: list[str] | None = None,
                    options: dict | None = None) -> None:
    out = df.withColumn("bucket", field_bucket(field, n_buckets))
    parts = ["bucket"]
    if run_id is not None:
        out, parts = out.withColumn("run_id", F.lit(run_id)), ["run_id", "bucket"]
    out = out.hint("rebalance", F.col("bucket"))
    if sort:
        out = out.sortWithinPartitions("bucket", *sort)
    _writer(out, "overwrite").options(**(options or {})).partitionBy(*parts).parquet(path)


def write_manifest(manifest: DataFrame, path: str, n_buckets: int = 1, run_id: str | None = None) -> None:
    """Download manifest: one row for each file to fetch."""
    _write_bucketed(manifest, path, "polygon_number", n_buckets, run_id)


def write_organized(organized: DataFrame, path: str, n_buckets: int = 1, run_id: str | None = None) -> None:
    """Organised layout: one row for each (field, time, band)."""
    _write_bucketed(organized, path, "polygon_number", n_buckets, run_id)


def write_stack(stack: DataFrame, path: str, n_buckets: int = 1, run_id: str | None = None, field: str = "field_id") -> None:
    """Wide stack, sorted by field, row and column inside each file, so that reading one field prunes partitions and
    row groups."""
    _write_bucketed(stack, path, field, n_buckets, run_id, [field, "row", "col"])


def write_chunk_stack(wide: DataFrame, path: str, chunk: int, n_buckets: int = 1, run_id: str | None = None, field: str = "field_id",
                      group_bytes: int = 8 << 20) -> None:
    """A stack as raster chunks (``field``, crow, ccol, an array for each label) with the rows and columns that each covers, in row groups of
    ``group_bytes``: a window reads its bucket and, by the groups' statistics, the few groups that it touches (``assemble.read_window``).
    Chunks lie along a Z-order curve inside a field, so a group covers a compact piece of it in both directions."""
    first = {"row_first": F.col("crow") * chunk, "col_first": F.col("ccol") * chunk}
    out = wide.withColumns(first).withColumns({"row_last": F.col("row_first") + chunk - 1, "col_last": F.col("col_first") + chunk - 1})
    bit = lambda c, i: F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long")), i)      # noqa: E731
    z = F.lit(0).cast("long")
    for i in range(24):      # 2^24 chunks in a direction
        z = z + F.shiftleft(bit(F.col("crow").cast("long"), i), i + 1) + F.shiftleft(bit(F.col("ccol").cast("long"), i), i)
    out = out.withColumn("zorder", z)
    _write_bucketed(out, path, field, n_buckets, run_id, [field, "zorder"], {"parquet.block.size": group_bytes})


def append_ledger(ledger: DataFrame, path: str, run_col: str = "run_id") -> None:
    """Add one run's rows to the ledger; a re-executed run replaces its own."""
    _writer(ledger, "overwrite").partitionBy(run_col).parquet(path)


def current_rows(rows: DataFrame, ledger: DataFrame, key: str = "output_id") -> DataFrame:
    """Rows of the run that holds each output now: the last one that processed it (a skipped one wrote nothing)."""
    done = ledger.where("status <> 'SKIPPED'").groupBy(key).agg(F.max_by("run_id", F.struct("ts", "run_id")).alias("run_id"))
    return rows.join(done, [key, "run_id"], "left_semi")
