"""Field table scan and validation.

A CSV is read with every column as a string, so a bad cell never fails the load; each
row is then cast with ``try_cast`` and routed to ``valid`` or ``rejected(reason)`` by a
single CASE. Missing required columns fail the whole load, as in the original.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ["Polygon Number", "Y Coordinate", "X Coordinate"]
OPTIONAL_CLASS = "Class"
UNKNOWN_CLASS = "Unknown"
MAX_HEADERS = 1000      # different ones


class MissingColumns(ValueError):
    pass


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, header): the first line of every file that has one."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("pos"), F.col("value"))
    first = lines.where("block = 0 and trim(value) <> ''").groupBy("source_file").agg(F.min_by("value", "pos").alias("header"))
    return first.withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", ""))


def read_fields_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw field rows (all strings) with ``input_pos``, the position in input order.

    ``path`` is a file, a folder or a glob. Every file's columns are found by the names in its own header, whatever their
    order; a file without a required column fails the load, a missing class is null. The distinct headers (few, however many
    files there are) are read by the driver and become positions; only if they differ, rows look up their file's.

    ``input_pos`` combines the file's split offset with the row's position inside the
    split, so it is ordered within a file without a global sort or a single task."""
    headers = _headers(spark, path)
    kinds = headers.groupBy("header").agg(F.min("source_file").alias("file")).limit(MAX_HEADERS + 1).collect()
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers in {path}")
    names = {r.header: next(csv.reader([r.header])) for r in kinds}
    bad = {r.file: missing for r in kinds if (missing := [c for c in REQUIRED if c not in names[r.header]])}
    if bad or not kinds:
        raise MissingColumns(f"missing required columns: {bad or REQUIRED}")
    width = max(map(len, names.values()))
    schema = ", ".join(f"c{i} string" for i in range(width))
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    rows = raw.select("*", F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("input_pos"))
    if len(names) > 1:
        rows = rows.join(headers.withColumnRenamed("source_file", "_file"), F.col("source_file") == F.col("_file"))

    def column(name: str):
        """The column called ``name`` in the row's file."""
        found = F.lit(None).cast("string")
        for header, columns in names.items():
            if name in columns:
                here = F.col(f"c{columns.index(name)}")
                found = here if len(names) == 1 else F.when(F.col("header") == header, here).otherwise(found)
        return found

    return rows.select(column("Polygon Number").alias("polygon_raw"), column(OPTIONAL_CLASS).alias("class"), column("Y Coordinate").alias("lat_raw"),
                       column("X Coordinate").alias("lon_raw"), "source_file", "input_pos")


def coordinate_ok(lat: Column, lon: Column, units_per_degree: float = 1.0) -> Column:
    """Inclusive lat/lon range test; NaN and NULL fail."""
    u = units_per_degree
    return (F.coalesce(lat.between(-90 * u, 90 * u), F.lit(False))
            & F.coalesce(lon.between(-180 * u, 180 * u), F.lit(False)))


def reject_reason(polygon: Column, lat: Column, lon: Column, units_per_degree: float = 1.0) -> Column:
    return (F.when(polygon.isNull(), "BAD_POLYGON_NUMBER")
             .when(lat.isNull() | lon.isNull(), "BAD_COORDINATE")
             .when(~coordinate_ok(lat, lon, units_per_degree), "COORDINATE_OUT_OF_RANGE"))


def cast_fields(raw: DataFrame) -> DataFrame:
    """String rows -> typed rows plus ``reject_reason`` (NULL for valid rows)."""
    poly = F.trim("polygon_raw").try_cast("double").try_cast("int")     # "1.0" is polygon 1
    lat = (F.trim("lat_raw")).try_cast("double")
    lon = (F.trim("lon_raw")).try_cast("double")
    typed = raw.select(poly.alias("polygon_number"),
                       F.coalesce(F.col("class"), F.lit(UNKNOWN_CLASS)).alias("class"),
                       lat.alias("lat"), lon.alias("lon"), "input_pos")
    return typed.withColumn("reject_reason",
                            reject_reason(F.col("polygon_number"), F.col("lat"), F.col("lon")))


def split_valid(typed: DataFrame, units_per_degree: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by one CASE; the same plan feeds both outputs."""
    if "reject_reason" not in typed.columns:
        typed = typed.withColumn("reject_reason", reject_reason(
            F.col("polygon_number"), F.col("lat"), F.col("lon"), units_per_degree))
    valid = typed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = typed.where(F.col("reject_reason").isNotNull())
    return valid, rejected


def with_default_class(fields: DataFrame) -> DataFrame:
    return fields.withColumn("class", F.coalesce(F.col("class"), F.lit(UNKNOWN_CLASS)))
