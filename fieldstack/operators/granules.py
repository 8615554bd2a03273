"""Granule files: names, band filter, grouping, download manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstack.functions.names import (band_of_name, file_name, granule_id_from_name,
                                        granule_parts, name_has_band)


def parse_file_urls(files: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds file_name, parsed granule id and layer code to a table of file URLs."""
    name = file_name(F.col(url_col))
    return (files.withColumn("file_name", name)
                 .withColumn("parsed_granule_id", granule_id_from_name(F.col("file_name")))
                 .withColumn("layer", band_of_name(F.col("file_name"))))


def with_granule_parts(granules: DataFrame, id_col: str = "granule_id") -> DataFrame:
    p = granule_parts(F.col(id_col))
    return granules.select("*", p.product.alias("product"), p.sensor.alias("sensor"),
                           p.tile.alias("tile_code"), p.acquired_at.alias("parsed_acquired_at"),
                           p.version.alias("version"))


def filter_bands(files: DataFrame, bands: list[str], name_col: str = "file_name") -> DataFrame:
    """Keep files whose name contains '.{band}.' for a requested band (empty = all)."""
    return files.where(name_has_band(F.col(name_col), bands))


def group_by_granule(files: DataFrame, key: str = "granule_id") -> DataFrame:
    """One row per granule: file count and the distinct layers it has (comma list, sorted).
    Groups are bounded by the layers of one granule, and counts combine map-side."""
    return (files.groupBy(key)
                 .agg(F.count("*").alias("n_files"),
                      F.array_join(F.sort_array(F.collect_set("band")), ",").alias("bands")))


def download_manifest(picks: DataFrame, files: DataFrame, bands: list[str], out_root: str,
                      request_keys=("polygon_number", "time_idx")) -> DataFrame:
    """Selected granule x its band-filtered files -> one row per file to fetch, with the
    target path ``{out}/{polygon}/t{i}/{granule_id}/{file}``. Equi-join on granule_key;
    the bytes themselves are not moved here."""
    f = filter_bands(files.withColumn("file_name", file_name(F.col("url"))), bands)
    j = picks.select(*request_keys, "granule_key").join(
        f.select("granule_key", "granule_id", "band", "url", "file_name"), "granule_key")
    target = F.concat_ws("/", F.lit(out_root.rstrip("/")), F.col("polygon_number").cast("string"),
                         F.concat(F.lit("t"), F.col("time_idx").cast("string")),
                         F.col("granule_id"), F.col("file_name"))
    return j.select(*request_keys, "granule_key", "granule_id", "band", "url", "file_name",
                    target.alias("target_path"))
