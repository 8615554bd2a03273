"""File-name and granule-name helpers (P7, P8, P9, P11, F4) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldstack.functions.dates import parse_doy_ntz

from fieldstack.constants import NON_SPECTRAL

# suffix that marks a band or mask layer at the end of a file name (without ".tif")
BAND_SUFFIX = r"\.(B[^.]{0,3}|" + "|".join(NON_SPECTRAL) + r")$"


def file_name(url: Column) -> Column:
    """Last path segment when the string is a URL (contains 'http'), else the whole string."""
    return F.when(F.instr(url, "http") > 0, F.element_at(F.split(url, "/"), -1)).otherwise(url)


def granule_id_from_name(name: Column) -> Column:
    """Strip one trailing '.tif', then one band/mask suffix; other names are kept whole."""
    stem = F.regexp_replace(name, r"\.tif$", "")
    return F.regexp_replace(stem, BAND_SUFFIX, "")


def band_of_name(name: Column) -> Column:
    """The layer code of a granule file name ('B04', 'Fmask'), else NULL."""
    stem = F.regexp_replace(name, r"\.tif$", "")
    code = F.regexp_extract(stem, BAND_SUFFIX, 1)
    return F.when(code != "", code)


def granule_parts(granule_id: Column) -> Column:
    """'HLS.S30.T42UXB.2025188T061639.v2.0' -> struct(product, sensor, tile, acquired_at, version)."""
    p = F.split(granule_id, r"\.")
    return F.struct(
        F.element_at(p, 1).alias("product"),
        F.element_at(p, 2).alias("sensor"),
        F.element_at(p, 3).alias("tile"),
        parse_doy_ntz(F.element_at(p, 4)).alias("acquired_at"),
        F.concat_ws(".", F.element_at(p, 5), F.element_at(p, 6)).alias("version"),
    )


def name_has_band(name: Column, bands: list[str]) -> Column:
    """True when the file name contains '.{band}.' for any requested band; an empty band
    list keeps every file."""
    if not bands:
        return F.lit(True)
    return F.exists(F.array(*[F.lit(b) for b in bands]),
                    lambda b: F.instr(name, F.concat(F.lit("."), b, F.lit("."))) > 0)


def band_label(time_idx: Column, band: Column) -> Column:
    """Stack band name 't{time}_{band}'."""
    return F.concat(F.lit("t"), time_idx.cast("string"), F.lit("_"), band)
