"""Coordinate files (S3, K1): two corner lines per region, any other line is a comment.

    sw <lat>,<lon>
    ne <lat>,<lon>

The last occurrence of a corner wins; a region without both corners gets status
MISSING_CORNER instead of failing the load. Many files are read in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORNER = r"^(sw|ne) +(-?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)\s*,\s*(-?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)$"


def read_region_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files -> (region, pos, line); region = file path, pos orders lines in a file."""
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("region"),
                    F.struct(F.col("_metadata.file_block_start"),
                             F.monotonically_increasing_id()).alias("pos"),
                    F.col("value").alias("line")))


def parse_regions(lines: DataFrame, region_col: str = "region", pos_col: str = "pos") -> DataFrame:
    """(region, pos, line) -> (region, sw_lat, sw_lon, ne_lat, ne_lon, status)."""
    t = F.trim(F.col("line"))
    corner = F.regexp_extract(t, CORNER, 1)
    x = lines.select(region_col, pos_col, corner.alias("corner"),
                     (F.regexp_extract(t, CORNER, 2)).try_cast("double").alias("lat"),
                     (F.regexp_extract(t, CORNER, 3)).try_cast("double").alias("lon"))
    sw, ne = F.col("corner") == "sw", F.col("corner") == "ne"
    last = lambda cond, c: F.max_by(F.when(cond, F.col(c)), F.when(cond, F.col(pos_col)))
    agg = x.groupBy(region_col).agg(last(sw, "lat").alias("sw_lat"), last(sw, "lon").alias("sw_lon"),
                                    last(ne, "lat").alias("ne_lat"), last(ne, "lon").alias("ne_lon"))
    ok = F.col("sw_lat").isNotNull() & F.col("ne_lat").isNotNull()
    return agg.withColumn("status", F.when(ok, "OK").otherwise("MISSING_CORNER"))


def region_lines(boxes: DataFrame, region_col: str, lat_txt: dict[str, Column]) -> DataFrame:
    """Boxes -> coordinate-file lines (comment, sw, ne) with an order column ``pos``.
    ``lat_txt`` maps 'sw_lat', 'sw_lon', 'ne_lat', 'ne_lon' to text columns."""
    lines = F.array(
        F.concat(F.lit("# region "), F.col(region_col).cast("string")),
        F.concat(F.lit("sw "), lat_txt["sw_lat"], F.lit(","), lat_txt["sw_lon"]),
        F.concat(F.lit("ne "), lat_txt["ne_lat"], F.lit(","), lat_txt["ne_lon"]),
    )
    return boxes.select(F.col(region_col).alias("region"), F.posexplode(lines).alias("pos", "line"))


def write_regions(lines: DataFrame, path: str) -> None:
    """One text file per region under ``path/region=<id>/`` (lines in ``pos`` order)."""
    (lines.repartition("region").sortWithinPartitions("region", "pos")
          .select("region", "line").write.mode("overwrite").partitionBy("region").text(path))
