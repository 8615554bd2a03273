"""SQL text of the UTM projection, for the DuckDB twins of the geometry queries.

The constants are written out here, not taken from the code under test: eccentricity, the radius of the rectifying sphere and
the first three coefficients of the transverse Mercator series for WGS84 (four for the inverse). Results are compared after rounding to 1 cm.
"""

# WGS84 (a = 6378137 m, 1/f = 298.257223563), UTM.
UTM_FALSE_EASTING = 500000.0
UTM_K0 = 0.9996
ECCENTRICITY = 0.08181919084262149
RADIUS = 6367449.145823415
ALPHA = [0.0008377318188192541, 7.608496958699166e-07, 1.2034877875966646e-09]


def utm_xy_sql(lat: str, lon: str, zone: str) -> tuple[str, str]:
    phi = f"radians({lat})"
    dlam = f"radians(({lon}) - (({zone}) * 6 - 183))"
    t = f"sinh(atanh(sin({phi})) - {ECCENTRICITY!r}::DOUBLE * atanh({ECCENTRICITY!r}::DOUBLE * sin({phi})))"
    xi = f"atan2({t}, cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1 + ({t}) * ({t})))"
    e_sum, n_sum = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        e_sum = f"({e_sum}) + {a!r}::DOUBLE * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
        n_sum = f"({n_sum}) + {a!r}::DOUBLE * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
    x = f"({UTM_FALSE_EASTING!r}::DOUBLE + {UTM_K0!r}::DOUBLE * {RADIUS!r}::DOUBLE * ({e_sum}))"
    y = f"(0.0 + {UTM_K0!r}::DOUBLE * {RADIUS!r}::DOUBLE * ({n_sum}))"
    return x, y


# Coefficients of the inverse series for WGS84 (rectifying to conformal, conformal to geodetic latitude).
BETA = [0.0008377321640600574, 5.905869567933988e-08, 1.6734888803548486e-10, 2.1677377630220362e-13]
DELTA = [0.003356551469125213, 6.571873083960133e-06, 1.76465640047585e-08, 5.4004820816935436e-11]


def lat_lon_sql(x: str, y: str, zone: str) -> tuple[str, str]:
    """Degrees (lat, lon) of UTM metres on the northern half."""
    scale = f"({UTM_K0!r}::DOUBLE * {RADIUS!r}::DOUBLE)"
    xi, eta = f"(({y}) / {scale})", f"((({x}) - {UTM_FALSE_EASTING!r}::DOUBLE) / {scale})"
    sx = " + ".join(f"{b!r}::DOUBLE * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in enumerate(BETA, start=1))
    se = " + ".join(f"{b!r}::DOUBLE * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in enumerate(BETA, start=1))
    xi_s, eta_s = f"({xi} - ({sx}))", f"({eta} - ({se}))"
    chi = f"asin(sin({xi_s}) / cosh({eta_s}))"
    lat = f"{chi} + " + " + ".join(f"{d!r}::DOUBLE * sin({2 * j} * {chi})" for j, d in enumerate(DELTA, start=1))
    return f"degrees({lat})", f"(({zone}) * 6 - 183 + degrees(atan2(sinh({eta_s}), cos({xi_s}))))"


def degree_bounds_cte(name: str, src: str, densify: int = 21) -> str:
    """CTE ``name`` with zone, x0, y0, x1, y1 + west, south, east, north from ``src``; each edge sampled at densify + 2 points."""
    n = densify + 1
    f = f"(i / {float(n)!r})"
    edges = [(f"x0 + (x1 - x0) * {f}", "y1"), (f"x0 + (x1 - x0) * {f}", "y0"),
             ("x0", f"y1 + (y0 - y1) * {f}"), ("x1", f"y1 + (y0 - y1) * {f}")]
    parts = []
    for x, y in edges:
        lat, lon = lat_lon_sql("x", "y", "zone")
        parts.append(f"SELECT zone, x0, y0, x1, y1, {lat} AS lat, {lon} AS lon "
                     f"FROM (SELECT *, {x} AS x, {y} AS y FROM {src} CROSS JOIN range(0, {n + 1}) AS r(i))")
    return (f"{name} AS (SELECT zone, x0, y0, x1, y1, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north "
            f"FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)")


def envelope_cte(name: str, src: str, keys: list[str], densify: int = 21) -> str:
    """CTE ``name`` with keys + minx, miny, maxx, maxy from ``src`` having keys, w, s, e, n
    (degrees) and zone; each edge sampled at densify + 2 points (northern hemisphere)."""
    n = densify + 1
    k = ", ".join(keys)
    f = f"(i / {float(n)!r})"
    edges = [("s", f"w + (e - w) * {f}"), ("n", f"w + (e - w) * {f}"),
             (f"s + (n - s) * {f}", "w"), (f"s + (n - s) * {f}", "e")]
    parts = []
    for lat, lon in edges:
        x, y = utm_xy_sql(lat, lon, "zone")
        parts.append(f"SELECT {k}, {x} AS x, {y} AS y FROM {src} CROSS JOIN range(0, {n + 1}) AS r(i)")
    union = " UNION ALL ".join(parts)
    return (f"{name} AS (SELECT {k}, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy "
            f"FROM ({union}) GROUP BY {k})")
