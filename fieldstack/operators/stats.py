"""Band statistics.

Every aggregate here is either algebraic (min, max, sum, count, sum of squares: combined
map-side, so a hot field costs no more than any other) or an exact percentile whose
state is a value->count map: pixels are 16-bit, so the state of one group is bounded by
65,536 entries however many pixels the group holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstack.constants import NODATA, STRETCH_HIGH, STRETCH_LOW

BAND_KEYS = ["field_id", "time_idx", "band"]


def band_stats(pixels: DataFrame, keys=BAND_KEYS, valid_only: bool = False, digits: int = 4) -> DataFrame:
    """min, max, mean, population std and percentage of non-nodata pixels per band.
    Nodata (0) is included by default, as in the original viewer."""
    src = pixels.where(F.col("value") != NODATA) if valid_only else pixels
    v = F.col("value")
    return src.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.round(F.avg(v), digits).alias("mean"),
        F.round(F.stddev_pop(v), digits).alias("std"),
        F.round(F.avg(F.when(v != NODATA, 100.0).otherwise(0.0)), digits).alias("valid_pct"),
    )


def band_percentiles(pixels: DataFrame, keys=BAND_KEYS, low: float = STRETCH_LOW,
                     high: float = STRETCH_HIGH, digits: int = 4, exact: bool = True) -> DataFrame:
    """Exact linear-interpolation percentiles (numpy's default) per band; ``exact=False``
    uses ``percentile_approx`` for unbounded value domains."""
    v = F.col("value")
    if exact:
        p = F.percentile(v, F.array(F.lit(low), F.lit(high)))
    else:
        p = F.percentile_approx(v, [low, high], 10000).cast("array<double>")
    return (pixels.groupBy(*keys).agg(p.alias("p"))
                  .select(*keys, F.round(F.col("p")[0], digits).alias("p_low"),
                          F.round(F.col("p")[1], digits).alias("p_high")))


def band_histogram(pixels: DataFrame, keys=BAND_KEYS, dense: bool = True) -> DataFrame:
    """Unit-wide buckets from min-0.5 to max+0.5 per band, zero buckets included.

    Counts per (band, value) are a partial aggregation; the dense range per band is
    ``sequence(min, max)`` (at most 65,536 values for 16-bit data), left-joined to them.
    ``dense=False`` keeps only non-empty buckets (output bounded by distinct values)."""
    keys = list(keys)
    counts = pixels.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    if not dense:
        w = Window.partitionBy(*keys)
        return counts.select(*keys, (F.col("value") - F.min("value").over(w)).alias("bucket"), "value", "n")
    return dense_histogram(counts, keys)


def dense_histogram(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Buckets of ``band_histogram`` from the counts (``keys``, value, n)."""
    ranges = counts.groupBy(*keys).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    dense = ranges.select(*keys, "vmin", F.explode(F.sequence("vmin", "vmax")).alias("value"))
    out = dense.join(counts, keys + ["value"], "left")
    return out.select(*keys, (F.col("value") - F.col("vmin")).alias("bucket"), "value",
                      F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def stretch_expr(v, lo, hi):
    """Linear min/max stretch clipped to [0, 1]; a flat band (hi == lo) maps above to 1,
    below to 0 and equal to NULL (the original yields NaN there)."""
    ratio = (v - lo) / (hi - lo)
    return (F.when(hi == lo, F.when(v > lo, 1.0).when(v < lo, 0.0))
             .otherwise(F.when(ratio < 0, 0.0).when(ratio > 1, 1.0).otherwise(ratio)))


def band_stretch(pixels: DataFrame, percentiles: DataFrame, keys=BAND_KEYS, digits: int = 4) -> DataFrame:
    """Pixels with their stretched value, using the band's own 2/98 percentiles.
    Equi-join on the band key; AQE broadcasts the percentile table when it is small."""
    j = pixels.join(percentiles, list(keys))
    return j.withColumn("stretched", F.round(stretch_expr(F.col("value"), F.col("p_low"),
                                                          F.col("p_high")), digits))
