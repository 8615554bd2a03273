"""Assembly on the first date's grid, against plain rules over every output pixel."""

import math

import pytest
from pyspark.sql import functions as F

from fieldstack.functions import geo as GE
from fieldstack.operators import assemble as AS
from fieldstack.operators import warp as WP
from fieldstack.operators import windows as WN

PX, CHUNK, SIDE = 100.0, 8, 48
WINDOW = ("polygon_number long, time_idx int, granule_key long, tile string, zone int, x0 double, y0 double, x1 double, y1 double, "
          "col_off double, row_off double, width double, height double, out_width int, out_height int, status string")


def window(field, t, granule, zone, x0, y0, off=(3.3, 2.6), size=(20.7, 17.4), status="OK"):
    return (field, t, granule, f"T{granule}", zone, x0, y0, x0 + SIDE * PX, y0 - SIDE * PX, off[0], off[1], size[0], size[1], int(size[0]),
            int(size[1]), status)


def value(granule, band, r, c):
    return granule * 10_000 + "B02B03".index(band) * 1000 + r * SIDE + c


def chunks(spark, granules, bands=("B02", "B03"), skip=()):
    rows = [(g, b, cr, cc, [value(g, b, cr * CHUNK + i // CHUNK, cc * CHUNK + i % CHUNK) for i in range(CHUNK * CHUNK)])
            for g in granules for b in bands for cr in range(SIDE // CHUNK) for cc in range(SIDE // CHUNK)
            if (g, b) not in skip and (g, cr, cc) not in skip]
    return spark.createDataFrame(rows, "granule_key long, band string, crow long, ccol long, values array<int>")


def moved(spark, points, zone_from, zone_to):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    ll = df.select("x", "y", GE.from_utm(F.col("x"), F.col("y"), F.lit(zone_from)).alias("ll"))
    got = ll.select("x", "y", GE.to_utm(F.col("ll.lat"), F.col("ll.lon"), F.lit(zone_to)).alias("p")).collect()
    return {(r.x, r.y): (r.p.x, r.p.y) for r in got}


def plain(spark, first, other, n_bands=2):
    """{(row, col): [values of the first date, of the other]} by the centre rule."""
    _, _, g0, _, z0, x0, y0, _, _, co, ro, w, h, ow, oh, _ = first
    centres = {(r, c): (x0 + (co + (c + 0.5) * (w / ow)) * PX, y0 - (ro + (r + 0.5) * (h / oh)) * PX) for r in range(oh) for c in range(ow)}
    out = {}
    for _, _, g, _, z, gx, gy, *_ in (first, other):
        there = {p: p for p in centres.values()} if z == z0 else moved(spark, centres.values(), z0, z)
        for at, p in centres.items():
            x, y = there[p]
            c, r = math.floor((x - gx) / PX), math.floor((gy - y) / PX)
            ok = 0 <= r < SIDE and 0 <= c < SIDE
            out.setdefault(at, []).extend(value(g, b, r, c) if ok else 0 for b in ("B02", "B03"))
    return out


def warped(spark, windows, ch):
    df = WP.warped_stacks(spark.createDataFrame(windows, WINDOW), ch, PX, CHUNK, n_times=2, bands=["B02", "B03"])
    got = {}
    for r in df.collect():
        assert (r.row, r.col) not in got.get(r.polygon_number, {})
        got.setdefault(r.polygon_number, {})[r.row, r.col] = [r.t0_B02, r.t0_B03, r.t1_B02, r.t1_B03]
    return got


def test_two_zones_by_the_centre_rule(spark):
    """Rasters on both sides of a zone's edge: the second is turned against the first, and part of the window lies outside it."""
    x, y = 744000.0, 4500000.0      # near 72 degrees east, in zone 42
    far = list(moved(spark, [(x, y)], 42, 43).values())[0]
    first = window(1, 0, 1, 42, x, y)
    near = window(1, 1, 2, 43, round(far[0] / PX) * PX, round(far[1] / PX) * PX + 400)
    shifted = window(2, 1, 2, 43, round(far[0] / PX) * PX + 1500, round(far[1] / PX) * PX)
    other = window(2, 0, 1, 42, x, y)
    got = warped(spark, [near, first, other, shifted], chunks(spark, [1, 2]))
    assert got[1] == plain(spark, first, near)
    assert got[2] == plain(spark, other, shifted)
    assert any(v[2] == 0 for v in got[2].values()) and any(v[2] for v in got[2].values())


def test_one_zone_and_shifted_origin(spark):
    first, other = window(1, 0, 1, 42, 500000.0, 4500000.0), window(1, 1, 2, 42, 500700.0, 4499800.0)
    assert warped(spark, [first, other], chunks(spark, [1, 2]))[1] == plain(spark, first, other)


def test_shared_grid_is_the_plain_stack(spark):
    rows = [window(1, t, t + 1, 42, 500000.0, 4500000.0) for t in range(2)]
    df = spark.createDataFrame(rows, WINDOW)
    want = AS.field_stacks(df, chunks(spark, [1, 2]), CHUNK, n_times=2, bands=["B02", "B03"])
    want = {(r.row, r.col): [r.t0_B02, r.t0_B03, r.t1_B02, r.t1_B03] for r in want.collect()}
    assert warped(spark, rows, chunks(spark, [1, 2]))[1] == want


@pytest.mark.parametrize("status", ["OUTSIDE", "EMPTY"])
def test_no_usable_first_window(spark, status):
    rows = [window(1, 0, 1, 42, 500000.0, 4500000.0, status=status), window(1, 1, 2, 42, 500000.0, 4500000.0)]
    assert warped(spark, rows, chunks(spark, [1, 2])) == {}


def test_missing_bands_chunks_dates_and_tables(spark):
    rows = [window(1, 0, 1, 42, 500000.0, 4500000.0), window(1, 1, 2, 42, 500000.0, 4500000.0), window(2, 1, 2, 42, 500000.0, 4500000.0)]
    got = warped(spark, rows, chunks(spark, [1, 2], skip={(2, "B03"), (1, 1, 1)}))
    assert all(v[3] is None and v[2] is not None for v in got[1].values())       # a band without a file
    assert all(v[0] is None and v[1] is None for v in got[2].values())           # a date without a granule; the next one's grid holds
    gone = [at for at, v in got[1].items() if v[0] == 0]                         # a chunk that isn't there
    full = plain(spark, rows[0], rows[1])
    at_chunk = lambda v: (v % 10_000 // SIDE // CHUNK, v % 10_000 % SIDE // CHUNK)      # noqa: E731
    assert set(gone) == {at for at, v in full.items() if at_chunk(v[0]) == (1, 1)}
    assert len(gone) < len(got[1])
    assert warped(spark, [], chunks(spark, [1])) == {}
    assert all(set(v) == {0} for v in warped(spark, rows[:2], chunks(spark, [1]).limit(0))[1].values())


def test_lists_stay_within_a_chunk(spark):
    rows = [window(1, 0, 1, 42, 500000.0, 4500000.0, size=(40.9, 40.2)), window(1, 1, 2, 42, 500300.0, 4500000.0)]
    cells = WP.source_cells(spark.createDataFrame(rows, WINDOW), PX, CHUNK, ["polygon_number"])
    sizes = [len(r.cells) for r in cells.collect()]
    assert max(sizes) <= CHUNK * CHUNK and sum(sizes) == 2 * 40 * 40
    assert WN.grid_status(spark.createDataFrame(rows, WINDOW)).first().status == "GRID_MISMATCH"
