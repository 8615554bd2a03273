"""Field boxes as pixel windows of granule rasters.

A granule's raster is the UTM envelope of its footprint, snapped outward to the pixel size. Footprints repeat, so
their envelopes are computed once for each distinct (footprint, zone); a field's once for each zone that its dates' granules lie in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstack.functions import geo as GE

BOX = ["west", "south", "east", "north"]
MAX_COORDINATE = 1e12    # in metres or units of a degree; none is as large


def _footprint_grids(granules: DataFrame, px: float, units_per_degree: float) -> DataFrame:
    """(west, south, east, north, zone, x0, y0, x1, y1) of each distinct footprint."""
    deg = lambda c: F.col(c) / units_per_degree      # noqa: E731
    zone = GE.utm_zone((F.col("west") + F.col("east")) / 2 / units_per_degree)
    shape = granules.select(*BOX, zone.alias("zone")).distinct()
    env = GE.with_envelope(shape, deg("west"), deg("south"), deg("east"), deg("north"), F.col("zone"), "env")
    return env.select(*BOX, "zone", (F.floor(F.col("env.minx") / px) * px).alias("x0"),
                      (F.ceil(F.col("env.maxy") / px) * px).alias("y0"), (F.ceil(F.col("env.maxx") / px) * px).alias("x1"),
                      (F.floor(F.col("env.miny") / px) * px).alias("y1"))


def granule_grids(granules: DataFrame, px: float, units_per_degree: float = 1.0) -> DataFrame:
    """(granule_key, tile, zone, x0, y0, x1, y1): each granule's raster grid; north-up, origin (x0, y0)."""
    return granules.select("granule_key", "tile", *BOX).join(_footprint_grids(granules, px, units_per_degree), BOX).drop(*BOX)


def raster_bounds(granules: DataFrame, px: float, units_per_degree: float = 1.0) -> DataFrame:
    """(granule_key, tile, zone, west, south, east, north): the full extent of each granule's raster in degrees. A footprint's is computed
    once; the join is on footprints, because null filters on the grid's own columns would compute the envelope again."""
    shapes = GE.degree_bounds(_footprint_grids(granules, px, units_per_degree), F.col("x0"), F.col("y1"), F.col("x1"), F.col("y0"),
                              F.col("zone"), [*BOX, "zone"], "deg")
    return granules.select("granule_key", "tile", *BOX).join(shapes, BOX).select(
        "granule_key", "tile", "zone", *[F.col(f"deg.{c}").alias(c) for c in BOX])


def field_polygons(picks: DataFrame, grids: DataFrame, requests: DataFrame, units_per_degree: float = 1.0,
                   keys: tuple[str, ...] = ("polygon_number",)) -> DataFrame:
    """For every pick the field box as a polygon in its granule's zone (``keys``, time_idx, granule_key, x0, y0, x1, y1, polygon): a degree
    box stands askew in UTM, so its envelope holds pixels that the field doesn't."""
    deg = lambda c: F.col(c) / units_per_degree      # noqa: E731
    return (picks.select(*keys, "time_idx", "granule_key").join(grids, "granule_key").join(requests.select(*keys, *BOX), list(keys))
            .select(*keys, "time_idx", "granule_key", "x0", "y0", "x1", "y1",
                    GE.box_polygon(deg("west"), deg("south"), deg("east"), deg("north"), F.col("zone")).alias("polygon")))


def field_windows(picks: DataFrame, grids: DataFrame, requests: DataFrame, px: float, units_per_degree: float = 1.0,
                  keys: tuple[str, ...] = ("polygon_number",)) -> DataFrame:
    """For every pick (``keys``, time_idx, granule_key) the field's fractional window in the granule's raster, its truncated size and a
    status: OUTSIDE, EMPTY (no whole pixel), PARTIAL (reaches over the edge), OK or, for a box that is missing or that doesn't project to
    finite metres, FULL_EXTENT: the window is the whole raster."""
    j = (picks.select(*keys, "time_idx", "granule_key").join(grids, "granule_key")
         .join(requests.select(*keys, *BOX), list(keys)))
    deg = lambda c: F.col(c) / units_per_degree      # noqa: E731
    # a field's dates share its box, and mostly the zone: one envelope for each
    boxes = j.select(*keys, "zone", *BOX).distinct()
    env = GE.utm_envelope(boxes, deg("west"), deg("south"), deg("east"), deg("north"), F.col("zone"), keys=[*keys, "zone"], out="fenv")
    x = j.join(env.select(*keys, "zone", "fenv"), [*keys, "zone"])
    # null and NaN aren't below the bound, which no coordinate reaches; a least value alone would pass over a missing side
    finite = [F.coalesce(F.abs(F.col(c)) < MAX_COORDINATE, F.lit(False)) for c in (*BOX, "fenv.minx", "fenv.miny", "fenv.maxx", "fenv.maxy")]
    usable = reduce(lambda a, b: a & b, finite)
    whole = F.struct(F.col("x0").alias("minx"), F.col("y1").alias("miny"), F.col("x1").alias("maxx"), F.col("y0").alias("maxy"))
    x = x.withColumn("usable", usable).withColumn("fenv", F.when(F.col("usable"), F.col("fenv")).otherwise(whole))
    f, win = F.col("fenv"), GE.pixel_window(F.col("fenv"), F.col("x0"), F.col("y0"), px)
    outside = (f.maxx <= F.col("x0")) | (f.minx >= F.col("x1")) | (f.maxy <= F.col("y1")) | (f.miny >= F.col("y0"))
    partial = (f.minx < F.col("x0")) | (f.maxx > F.col("x1")) | (f.miny < F.col("y1")) | (f.maxy > F.col("y0"))
    status = (F.when(~F.col("usable"), "FULL_EXTENT").when(outside, "OUTSIDE").when((win.out_width <= 0) | (win.out_height <= 0), "EMPTY")
              .when(partial, "PARTIAL").otherwise("OK"))
    return x.select(*keys, "time_idx", "granule_key", "tile", "zone", "x0", "y0", "x1", "y1",
                    *[win[c].alias(c) for c in ("col_off", "row_off", "width", "height", "out_width", "out_height")],
                    status.alias("status"))


def grid_status(windows: DataFrame, keys: tuple[str, ...] = ("polygon_number",)) -> DataFrame:
    """Per field: do all dates share one grid (zone, origin and extent), and is its window usable? GRID_MISMATCH, then OUTSIDE,
    EMPTY, PARTIAL or OK: the first that holds for any date."""
    grid = F.struct("zone", "x0", "y0", "x1", "y1")
    worst = F.min(F.when(F.col("status") == "OUTSIDE", 1).when(F.col("status") == "EMPTY", 2)
                  .when(F.col("status") == "PARTIAL", 3).when(F.col("status") == "FULL_EXTENT", 4).otherwise(5))
    names = F.array(*[F.lit(s) for s in ("OUTSIDE", "EMPTY", "PARTIAL", "FULL_EXTENT", "OK")])
    agg = windows.groupBy(*keys).agg(F.count("*").alias("n_dates"), F.size(F.collect_set(grid)).alias("n_grids"), worst.alias("w"))
    return agg.select(*keys, "n_dates", F.col("n_grids").cast("long").alias("n_grids"), F.when(
        F.col("n_grids") > 1, "GRID_MISMATCH").otherwise(F.get(names, F.col("w") - 1)).alias("status"))


def _steps(off: Column, size: Column, chunk: int) -> Column:
    return F.sequence(F.floor(F.greatest(off, F.lit(0.0)) / chunk), F.floor(F.greatest(off + size, F.lit(0.0)) / chunk))


def window_chunks(windows: DataFrame, chunk: int) -> DataFrame:
    """Each usable window once for every raster chunk (crow, ccol) that it touches."""
    return (windows.where(F.col("status").isin("OK", "PARTIAL", "FULL_EXTENT"))
            .withColumn("crow", F.explode(_steps(F.col("row_off"), F.col("height"), chunk)))
            .withColumn("ccol", F.explode(_steps(F.col("col_off"), F.col("width"), chunk))))
