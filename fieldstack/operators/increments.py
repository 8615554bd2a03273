"""Band statistics of a growing pixel table (A4, A5, A7): a persisted count of every value, to which new batches are added.

Pixels are 16-bit, so a band's counts are at most 65,536 rows however many pixels it has, and counts of different batches add up exactly:
statistics and percentiles of the whole come from the counts alone, and pixels once counted are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.constants import NODATA, STRETCH_HIGH, STRETCH_LOW
from fieldstack.operators.stats import BAND_KEYS, dense_histogram
from fieldstack.streaming.generations import Generations

SCHEMA = "field_id long, time_idx int, band string, value int, n long"


def band_counts(pixels: DataFrame, keys=BAND_KEYS) -> DataFrame:
    """(``keys``, value, n) of pixels, or of raster chunks with an array ``values``."""
    if "values" in pixels.columns:
        pixels = pixels.select(*keys, F.explode("values").alias("value"))
    return pixels.groupBy(*keys, "value").agg(F.count("*").alias("n"))


def merge_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*BAND_KEYS, "value").agg(F.sum("n").alias("n"))


def stats_of_counts(counts: DataFrame, keys=BAND_KEYS, digits: int = 4) -> DataFrame:
    """``stats.band_stats`` from counts. Sums are exact integers, so they don't depend on how the pixels came in batches."""
    v, n = F.col("value"), F.col("n")
    many = n.cast("decimal(20,0)")      # sums of squares outgrow a long
    wide = lambda c: F.sum((many * c.cast("decimal(10,0)")).cast("decimal(38,0)"))      # noqa: E731
    got = counts.groupBy(*keys).agg(
        F.sum(n).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), wide(v).alias("_s"),
        wide(v.cast("long") * v).alias("_q"), F.sum(F.when(v != NODATA, n).otherwise(0)).alias("_valid"))
    total = F.col("n").cast("decimal(20,0)")
    spread = (total * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")      # n^2 times the variance
    num = F.col("n").cast("double")
    return got.select(*keys, "n", "min", "max", F.round(F.col("_s").cast("double") / num, digits).alias("mean"),
                      F.round(F.sqrt(spread) / num, digits).alias("std"), F.round(F.col("_valid") * 100.0 / num, digits).alias("valid_pct"))


def percentiles_of_counts(counts: DataFrame, keys=BAND_KEYS, low: float = STRETCH_LOW, high: float = STRETCH_HIGH,
                          digits: int = 4) -> DataFrame:
    """``stats.band_percentiles`` from counts."""
    p = F.percentile(F.col("value"), F.array(F.lit(low), F.lit(high)), F.col("n"))
    return counts.groupBy(*keys).agg(p.alias("p")).select(
        *keys, F.round(F.col("p")[0], digits).alias("p_low"), F.round(F.col("p")[1], digits).alias("p_high"))


def histogram_of_counts(counts: DataFrame, keys=BAND_KEYS) -> DataFrame:
    """``stats.band_histogram`` from counts."""
    return dense_histogram(counts, list(keys))


class BandCounts:
    """Counts kept at ``path`` of a pixel table partitioned by an integer column ``batch``.

    A batch must not change once it is counted, and batches must be counted in rising order. The rows of one ``update`` are one epoch, named
    by its last batch; an update that was interrupted is repeated up to that batch before newer ones are looked at, so that nothing is
    counted twice or left out. One update at a time."""

    def __init__(self, spark: SparkSession, path: str, every: int = 50, fan: int = 8):
        self.spark = spark
        self.table = Generations(spark, path, SCHEMA, merge_counts, every, fan)

    def counted(self) -> int:
        """The last batch that is counted; -1 if none is."""
        return self._state()[0]

    def _state(self) -> tuple[int, int | None]:
        whole, broken = self.table.epochs()
        return whole, broken

    def update(self, source: str, batch: str = "batch") -> list[int]:
        """Count the batches of the table at ``source`` that aren't counted yet, reading their partitions only; returns them."""
        rows = self.spark.read.parquet(source)
        # partition values alone: as many as there are batches
        there = sorted(r[0] for r in rows.select(F.col(batch).cast("long")).distinct().collect())
        done: list[int] = []
        while True:
            last, broken = self._state()
            new = [b for b in there if b > last and (broken is None or b <= broken)]
            if not new:
                return done
            # a range on the partition column: only the new folders are read
            self.table.write(merge_counts(band_counts(rows.where(F.col(batch).between(new[0], new[-1])))), new[-1])
            done += new

    def counts(self) -> DataFrame:
        """(field_id, time_idx, band, value, n) of all batches counted."""
        return merge_counts(self.table.rows(before=self.counted() + 1))
