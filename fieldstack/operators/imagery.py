"""Composites and change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstack.constants import BANDS, CHANGE_BAND_INDEX, COMPOSITE_PRESETS, NINE_BANDS

PIXEL_KEYS = ["field_id", "row", "col"]


def presets(available_bands=BANDS) -> list[tuple[str, list[str], bool]]:
    """(name, [red, green, blue] band codes, available) with bands addressed by name;
    a preset is available only when the data has all three of its bands."""
    out = []
    for name, idx in COMPOSITE_PRESETS:
        codes = [NINE_BANDS[i] for i in idx]
        out.append((name, codes, all(c in available_bands for c in codes)))
    return out


def preset_bands(spark) -> DataFrame:
    """The presets as a lookup table (preset, channel, band): 15 rows."""
    rows = [(n, ch, b) for n, codes, _ in presets(NINE_BANDS) for ch, b in zip("rgb", codes)]
    return spark.createDataFrame(rows, "preset string, channel string, band string")


def preset_availability(chunks: DataFrame, lookup: DataFrame, keys=("field_id", "time_idx")) -> DataFrame:
    """Which presets a date's bands allow: the bands there are meet the lookup table, which is broadcast (its size is that of
    a constant)."""
    have = chunks.select(*keys, "band").distinct().join(F.broadcast(lookup), "band")
    return (have.groupBy(*keys, "preset").agg(F.count("*").alias("n_channels"),
                                             F.array_join(F.sort_array(F.collect_set("band")), ",").alias("bands"))
            .withColumn("available", F.col("n_channels") == 3))


def composites(stretched: DataFrame, available_bands=BANDS) -> DataFrame:
    """Per pixel and date, r/g/b of every available preset from stretched values.
    One pivot of the date's bands (declared list), then a constant-size explode."""
    wide = (stretched.groupBy(*PIXEL_KEYS, "time_idx")
                     .pivot("band", list(available_bands)).agg(F.max("stretched")))
    items = [F.struct(F.lit(n).alias("preset"), F.col(c[0]).alias("r"), F.col(c[1]).alias("g"),
                      F.col(c[2]).alias("b"))
             for n, c, a in presets(available_bands) if a]
    return wide.select(*PIXEL_KEYS, "time_idx", F.explode(F.array(*items)).alias("c")) \
               .select(*PIXEL_KEYS, "time_idx", "c.preset", "c.r", "c.g", "c.b")


def change_detect(pixels: DataFrame, band: str = BANDS[CHANGE_BAND_INDEX], n_times: int = 3,
                  wrap_u16: bool = False) -> DataFrame:
    """Per pixel of one band: differences between dates (t1-t0, t2-t1, t2-t0), signed;
    ``wrap_u16`` reproduces unsigned 16-bit wrap-around (100 - 300 -> 65336)."""
    wide = (pixels.where(F.col("band") == band)
                  .groupBy(*PIXEL_KEYS).pivot("time_idx", list(range(n_times))).agg(F.max("value")))
    t = [F.col(str(i)) for i in range(n_times)]
    d = (lambda x: F.pmod(x, F.lit(65536))) if wrap_u16 else (lambda x: x)
    return wide.select(*PIXEL_KEYS, t[0].alias("v0"), t[1].alias("v1"), t[2].alias("v2"),
                       d(t[1] - t[0]).alias("d10"), d(t[2] - t[1]).alias("d21"), d(t[2] - t[0]).alias("d20"))


def change_range(changes: DataFrame) -> DataFrame:
    """Per field: common display range over the dates and the largest absolute change."""
    return changes.groupBy("field_id").agg(
        F.least(F.min("v0"), F.min("v1"), F.min("v2")).alias("vmin"),
        F.greatest(F.max("v0"), F.max("v1"), F.max("v2")).alias("vmax"),
        F.greatest(F.max(F.abs("d10")), F.max(F.abs("d21")), F.max(F.abs("d20"))).alias("diff_max"))


def change_lag(pixels: DataFrame, wrap_u16: bool = False) -> DataFrame:
    """Difference to the previous date for every band and pixel (any number of dates).
    The window is partitioned by pixel, so a partition holds one value per date."""
    w = Window.partitionBy("field_id", "band", "row", "col").orderBy("time_idx")
    d = F.col("value") - F.lag("value").over(w)
    if wrap_u16:
        d = F.pmod(d, F.lit(65536))
    return pixels.withColumn("diff_prev", d).where(F.col("diff_prev").isNotNull())
