"""Organise downloaded files per (field, time, band) and check completeness
(S6, S7, A2, A3, U1, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstack.constants import BANDS


def first_file_per_band(manifest: DataFrame, order_cols: list[str],
                        keys=("polygon_number", "time_idx", "band")) -> DataFrame:
    """One file per (field, time, band): the minimum by ``order_cols`` (deterministic
    stand-in for directory walk order). ``min(struct)`` is a partial aggregate."""
    order = F.struct(*[F.col(c) for c in order_cols], F.col("url"))
    return (manifest.groupBy(*keys)
                    .agg(F.min(order).alias("first"), F.count("*").alias("n_candidates"))
                    .select(*keys, F.col("first.url").alias("url"), "n_candidates"))


def organized_path(df: DataFrame, out_root: str) -> DataFrame:
    """Layout ``{out}/{polygon}/t{i}/{band}.tif``."""
    return df.withColumn("organized_path", F.concat_ws(
        "/", F.lit(out_root.rstrip("/")), F.col("polygon_number").cast("string"),
        F.concat(F.lit("t"), F.col("time_idx").cast("string")),
        F.concat(F.col("band"), F.lit(".tif"))))


def band_completeness(wanted: DataFrame, organized: DataFrame, bands: list[str] = BANDS,
                      keys=("polygon_number", "time_idx")) -> DataFrame:
    """Requested minus found bands for every (field, time) in ``wanted``: status COMPLETE
    or MISSING_BANDS. A time point with no file at all is MISSING_BANDS with all bands."""
    keys = list(keys)
    found = organized.groupBy(*keys).agg(F.collect_set("band").alias("found"))
    j = wanted.select(*keys).join(found, keys, "left")
    have = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    req = F.array(*[F.lit(b) for b in bands])
    missing = F.array_join(F.array_except(req, have), ",")
    out = j.select(*keys, missing.alias("missing"),
                   F.size(F.array_intersect(req, have)).alias("n_found"))
    return out.withColumn("status", F.when(F.col("missing") == "", "COMPLETE")
                                     .otherwise("MISSING_BANDS"))


def tif_listing(paths: DataFrame, path_col: str = "path", tiff: bool = False) -> DataFrame:
    """Keep raster files: names that end in '.tif', with ``tiff`` also '.tiff' (what ``prefer_tiff`` chooses from)."""
    name = F.col(path_col)
    return paths.where(name.endswith(".tif") | name.endswith(".tiff") if tiff else name.endswith(".tif"))


def scan_tif_tree(spark, root: str, tiff: bool = False) -> DataFrame:
    """Recursive listing of '*.tif' (with ``tiff`` also '*.tiff') files under ``root`` (path and length only; the
    content column is pruned, so no bytes are read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.{tif,tiff}" if tiff else "*.tif").load(root).select("path", "length"))


def prefer_tiff(listing: DataFrame, bands: list[str] = BANDS, folder_col: str = "folder",
                path_col: str = "path") -> DataFrame:
    """Per (folder, band): the first '*{band}.tiff' file, else the first '*{band}.tif'."""
    pattern = "(" + "|".join(bands) + r")\.(tiff?)$"
    x = listing.select(folder_col, path_col,
                       F.regexp_extract(F.col(path_col), pattern, 1).alias("band"),
                       F.regexp_extract(F.col(path_col), pattern, 2).alias("ext"))
    x = x.where(F.col("band") != "").withColumn("rank_ext", F.when(F.col("ext") == "tiff", 0).otherwise(1))
    return (x.groupBy(folder_col, "band")
             .agg(F.min(F.struct("rank_ext", path_col)).alias("m"))
             .select(folder_col, "band", F.col(f"m.{path_col}").alias(path_col)))


def granule_band_completeness(picks: DataFrame, files: DataFrame, bands: list[str] = BANDS,
                              keys=("polygon_number", "time_idx")) -> DataFrame:
    """Same result as ``band_completeness`` without organising files first: the band set
    of each granule (a bounded collect_set, combined map-side) joined once to the picks."""
    keys = list(keys)
    sets = (files.where(F.col("band").isin(list(bands)))
                 .groupBy("granule_key").agg(F.collect_set("band").alias("found")))
    j = picks.select(*keys, "granule_key").join(sets, "granule_key", "left")
    have = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    req = F.array(*[F.lit(b) for b in bands])
    missing = F.array_join(F.array_except(req, have), ",")
    return j.select(*keys, missing.alias("missing"),
                    F.size(F.array_intersect(req, have)).alias("n_found"),
                    F.when(missing == "", "COMPLETE").otherwise("MISSING_BANDS").alias("status"))
