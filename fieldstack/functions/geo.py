"""Geometry as Column math.

Boxes are always STRUCT<west, south, east, north> in one unit (degrees, or integer
micro-degrees for the driver tables). The WGS84 -> UTM projection is the published
Krueger n-series (transverse Mercator to sixth order in n, here third order, which is
sub-millimetre inside a zone), written with built-in functions so it stays in codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldstack.constants import UTM_FALSE_EASTING, UTM_FALSE_NORTHING_SOUTH, UTM_K0, WGS84_A, WGS84_F


def bbox_around(lat: Column, lon: Column, half: float | Column) -> Column:
    """Square box centred on a point; no clamping at the poles or the antimeridian."""
    h = half if isinstance(half, Column) else F.lit(half)
    return F.struct((lon - h).alias("west"), (lat - h).alias("south"),
                    (lon + h).alias("east"), (lat + h).alias("north"))


def bbox_from_corners(sw_lat: Column, sw_lon: Column, ne_lat: Column, ne_lon: Column) -> Column:
    """(west, south, east, north) from two corners given in either order (swaps repaired)."""
    return F.struct(F.least(sw_lon, ne_lon).alias("west"), F.least(sw_lat, ne_lat).alias("south"),
                    F.greatest(sw_lon, ne_lon).alias("east"), F.greatest(sw_lat, ne_lat).alias("north"))


def bbox_from_text(text: Column) -> Column:
    """'minx,miny,maxx,maxy' -> box; NULL unless exactly four numbers parse."""
    nums = F.transform(F.split(F.trim(text), r"\s*,\s*"), lambda s: (s).try_cast("double"))
    ok = (F.size(nums) == 4) & F.forall(nums, lambda x: x.isNotNull())
    return F.when(ok, F.struct(F.element_at(nums, 1).alias("west"), F.element_at(nums, 2).alias("south"),
                               F.element_at(nums, 3).alias("east"), F.element_at(nums, 4).alias("north")))


def utm_zone(lon_deg: Column) -> Column:
    return (F.floor((lon_deg + 180) / 6) % 60 + 1).cast("int")


_N = WGS84_F / (2 - WGS84_F)
_A = WGS84_A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_ALPHA = [
    _N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16,
    13 * _N ** 2 / 48 - 3 * _N ** 3 / 5,
    61 * _N ** 3 / 240,
]
_C = 2 * math.sqrt(_N) / (1 + _N)
# the way back, to fourth order in n: third order alone would be off by 3e-9 degrees
_BETA = [
    _N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96 - _N ** 4 / 360,
    _N ** 2 / 48 + _N ** 3 / 15 - 437 * _N ** 4 / 1440,
    17 * _N ** 3 / 480 - 37 * _N ** 4 / 840,
    4397 * _N ** 4 / 161280,
]
_DELTA = [
    2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3 + 116 * _N ** 4 / 45,
    7 * _N ** 2 / 3 - 8 * _N ** 3 / 5 - 227 * _N ** 4 / 45,
    56 * _N ** 3 / 15 - 136 * _N ** 4 / 35,
    4279 * _N ** 4 / 630,
]


def to_utm(lat_deg: Column, lon_deg: Column, zone: Column, north: Column | bool = True) -> Column:
    """WGS84 degrees -> struct(x, y) metres in the given UTM zone."""
    xi, eta = _transverse(_conformal(lat_deg), _from_meridian(lon_deg, zone))
    return _metres(xi, eta, north)


def _conformal(lat_deg: Column) -> Column:
    sphi = F.sin(F.radians(lat_deg))
    return F.sinh(F.atanh(sphi) - _C * F.atanh(_C * sphi))


def _from_meridian(lon_deg: Column, zone: Column) -> Column:
    return F.radians(lon_deg - (zone * 6 - 183))


def _transverse(t: Column, dlam: Column) -> tuple[Column, Column]:
    return F.atan2(t, F.cos(dlam)), F.atanh(F.sin(dlam) / F.sqrt(1 + t * t))


def _metres(xi: Column, eta: Column, north: Column | bool) -> Column:
    e_sum, n_sum = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        e_sum = e_sum + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n_sum = n_sum + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    north_c = north if isinstance(north, Column) else F.lit(bool(north))
    y0 = F.when(north_c, F.lit(0.0)).otherwise(F.lit(UTM_FALSE_NORTHING_SOUTH))
    return F.struct((UTM_FALSE_EASTING + UTM_K0 * _A * e_sum).alias("x"),
                    (y0 + UTM_K0 * _A * n_sum).alias("y"))


def from_utm(x: Column, y: Column, zone: Column, north: Column | bool = True) -> Column:
    """UTM metres -> struct(lat, lon) in WGS84 degrees; the inverse of ``to_utm``."""
    north_c = north if isinstance(north, Column) else F.lit(bool(north))
    y0 = F.when(north_c, F.lit(0.0)).otherwise(F.lit(UTM_FALSE_NORTHING_SOUTH))
    xi, eta = (y - y0) / (UTM_K0 * _A), (x - UTM_FALSE_EASTING) / (UTM_K0 * _A)
    xi_s, eta_s = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi_s = xi_s - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_s = eta_s - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_s) / F.cosh(eta_s))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.struct(F.degrees(phi).alias("lat"),
                    (zone * 6 - 183 + F.degrees(F.atan2(F.sinh(eta_s), F.cos(xi_s)))).alias("lon"))


def box_polygon(west: Column, south: Column, east: Column, north: Column, zone: Column, north_hemisphere: Column | bool = True) -> Column:
    """The corners of a degree box in UTM, counterclockwise from the south-west: array of struct(x, y)."""
    corners = [(south, west), (south, east), (north, east), (north, west)]
    return F.array(*[to_utm(lat, lon, zone, north_hemisphere) for lat, lon in corners])


def bbox_to_utm(box: Column, zone: Column, north: Column | bool = True, densify: int = 21) -> Column:
    """Envelope in UTM of a degree box: each edge sampled at ``densify + 2`` points."""
    n = densify + 1
    steps = F.sequence(F.lit(0), F.lit(n))
    w, s, e, nn = box.west, box.south, box.east, box.north

    def edge(lat_fn, lon_fn):
        return F.transform(steps, lambda i: to_utm(lat_fn(i), lon_fn(i), zone, north))

    frac = lambda i: i.cast("double") / n
    pts = F.flatten(F.array(
        edge(lambda i: s, lambda i: w + (e - w) * frac(i)),
        edge(lambda i: nn, lambda i: w + (e - w) * frac(i)),
        edge(lambda i: s + (nn - s) * frac(i), lambda i: w),
        edge(lambda i: s + (nn - s) * frac(i), lambda i: e),
    ))
    xs = F.transform(pts, lambda p: p.x)
    ys = F.transform(pts, lambda p: p.y)
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def pixel_window(env: Column, x0: Column, y0: Column, px: Column | float) -> Column:
    """Fractional window of an envelope in a north-up grid with origin (x0, y0) (top-left)
    and square pixel size ``px``; output sizes are truncated to int."""
    p = px if isinstance(px, Column) else F.lit(float(px))
    col_off = (env.minx - x0) / p
    row_off = (y0 - env.maxy) / p
    width = (env.maxx - env.minx) / p
    height = (env.maxy - env.miny) / p
    return F.struct(col_off.alias("col_off"), row_off.alias("row_off"),
                    width.alias("width"), height.alias("height"),
                    width.cast("int").alias("out_width"), height.cast("int").alias("out_height"))


def with_envelope(df, west: Column, south: Column, east: Column, north: Column, zone: Column, out: str,
                  densify: int = 21, north_hemisphere: Column | bool = True):
    """``df`` plus struct column ``out``, the UTM envelope of each row's box; no shuffle. A lambda computes every term where it is named,
    so each step of the projection is a lambda of its own: a term is computed once for a point, a parallel's or meridian's once for an edge."""
    n = densify + 1
    along = lambda lo, hi: F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: lo + (hi - lo) * (i.cast("double") / n))
    staged = df.withColumns({"_w": west, "_s": south, "_e": east, "_n": north, "_z": zone})
    lat = lambda a: F.transform(a, _conformal)      # noqa: E731
    lon = lambda a: F.transform(a, lambda x: _from_meridian(x, F.col("_z")))      # noqa: E731

    def point(t, dlam):
        xi, eta = _transverse(t, dlam)
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    staged = staged.withColumns({"_lats": lat(along(F.col("_s"), F.col("_n"))), "_lons": lon(along(F.col("_w"), F.col("_e")))})
    level = F.transform(lat(F.array("_s", "_n")), lambda t: F.transform("_lons", lambda dlam: point(t, dlam)))
    upright = F.transform(lon(F.array("_w", "_e")), lambda dlam: F.transform("_lats", lambda t: point(t, dlam)))
    metres = F.transform(F.flatten(F.concat(level, upright)), lambda p: _metres(p.xi, p.eta, north_hemisphere))
    staged = staged.withColumn("_pts", metres).withColumns({"_xs": F.col("_pts.x"), "_ys": F.col("_pts.y")})
    env = F.struct(F.array_min("_xs").alias("minx"), F.array_min("_ys").alias("miny"),
                   F.array_max("_xs").alias("maxx"), F.array_max("_ys").alias("maxy"))
    return staged.withColumn(out, env).drop("_w", "_s", "_e", "_n", "_z", "_lons", "_lats", "_pts", "_xs", "_ys")


def degree_bounds(df, x0: Column, y1: Column, x1: Column, y0: Column, zone: Column, keys: list[str], out: str, densify: int = 21,
                  north_hemisphere: bool = True):
    """``keys`` plus struct column ``out`` (west, south, east, north): the degree bounds of each row's UTM box (left x0, bottom y1, right x1,
    top y0), each edge sampled at ``densify + 2`` points. ``keys`` must identify a row. Points are rows here, as in ``utm_envelope``: the
    inverse repeats its terms, which generated code computes once and a lambda every time."""
    n = densify + 1
    pts = df.select(*keys, x0.alias("_l"), y1.alias("_b"), x1.alias("_r"), y0.alias("_t"), zone.alias("_z"),
                    F.explode(F.sequence(F.lit(0), F.lit(4 * (n + 1) - 1))).alias("_k"))
    edge, frac = F.floor(F.col("_k") / (n + 1)), (F.col("_k") % (n + 1)).cast("double") / n
    across, upward = F.col("_l") + (F.col("_r") - F.col("_l")) * frac, F.col("_b") + (F.col("_t") - F.col("_b")) * frac
    pts = pts.select(*keys, "_z", F.when(edge <= 1, across).when(edge == 2, F.col("_l")).otherwise(F.col("_r")).alias("_x"),
                     F.when(edge == 0, F.col("_b")).when(edge == 1, F.col("_t")).otherwise(upward).alias("_y"))
    at = pts.select(*keys, from_utm(F.col("_x"), F.col("_y"), F.col("_z"), north_hemisphere).alias("_p"))
    return at.groupBy(*keys).agg(F.struct(F.min("_p.lon").alias("west"), F.min("_p.lat").alias("south"),
                                          F.max("_p.lon").alias("east"), F.max("_p.lat").alias("north")).alias(out))


def utm_envelope(df, west: Column, south: Column, east: Column, north: Column, zone: Column,
                 keys: list[str], out: str = "env", densify: int = 21, north_hemisphere: bool = True):
    """DataFrame form of ``bbox_to_utm`` for large inputs: the edge points become rows
    (explode), the projection runs as plain codegen'd columns, and min/max per box is a
    grouped aggregate on ``keys`` (which must identify a row). Exploded rows of one box
    are adjacent in one task, so the partial aggregate leaves one row per box before the
    shuffle. Adds struct column ``out``."""
    n = densify + 1
    cols = [c for c in df.columns if c not in keys]
    pts = df.select("*", west.alias("_w"), south.alias("_s"), east.alias("_e"), north.alias("_n"),
                    zone.alias("_z"), F.explode(F.sequence(F.lit(0), F.lit(4 * (n + 1) - 1))).alias("_k"))
    edge = F.floor(F.col("_k") / (n + 1))
    frac = (F.col("_k") % (n + 1)).cast("double") / n
    lat = (F.when(edge == 0, F.col("_s")).when(edge == 1, F.col("_n"))
            .otherwise(F.col("_s") + (F.col("_n") - F.col("_s")) * frac))
    lon = (F.when(edge <= 1, F.col("_w") + (F.col("_e") - F.col("_w")) * frac)
            .when(edge == 2, F.col("_w")).otherwise(F.col("_e")))
    pts = pts.withColumn("_xy", to_utm(lat, lon, F.col("_z"), north_hemisphere))
    keep = [F.first(c).alias(c) for c in cols]
    return pts.groupBy(*keys).agg(
        *keep,
        F.struct(F.min("_xy.x").alias("minx"), F.min("_xy.y").alias("miny"),
                 F.max("_xy.x").alias("maxx"), F.max("_xy.y").alias("maxy")).alias(out))
