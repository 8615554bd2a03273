"""A field's window lies beside its chunks before pixels unfold: only chunk rows that it touches cross a shuffle, and no pixels."""

import math

from fieldstack.operators import assemble as AS
from test_warp import CHUNK, SIDE, WINDOW, chunks, value, window

SHAPES = {1: ((3.3, 2.6), (20.7, 17.4)), 2: ((0.0, 7.9), (3.2, 8.2)), 3: ((41.5, 40.25), (9.5, 12.75)), 4: ((-2.5, -3.5), (7.0, 6.0))}


def plain(off, size):
    """{(row, col): [(source row, source column)]} of a window's output pixels that lie in the raster."""
    n_col, n_row = int(size[0]), int(size[1])
    at = [(r, c, math.floor(off[1] + (r + 0.5) * size[1] / n_row), math.floor(off[0] + (c + 0.5) * size[0] / n_col))
          for r in range(n_row) for c in range(n_col)]
    return {(r, c): (sr, sc) for r, c, sr, sc in at if 0 <= sr < SIDE and 0 <= sc < SIDE}


def test_stacks_equal_the_plain_rule_and_no_pixel_is_shuffled(spark):
    rows = [window(f, t, t + 1, 30, 0.0, 0.0, off, size, "OK") for f, (off, size) in SHAPES.items() for t in (0, 1)]
    rows += [window(None, 0, 1, 30, 0.0, 0.0), rows[0]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = AS.field_stacks(spark.createDataFrame(rows, WINDOW), chunks(spark, [1, 2], skip=[(2, "B03")]), CHUNK, n_times=2, bands=["B02", "B03"])
        seen = {}
        for r in got.collect():
            assert seen.setdefault((r.polygon_number, r.row, r.col), (r.t0_B02, r.t0_B03, r.t1_B02, r.t1_B03)) is not None
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    u16 = lambda v: min(v, 65535)      # noqa: E731
    assert seen == {(f, r, c): (u16(value(1, "B02", sr, sc)), u16(value(1, "B03", sr, sc)), u16(value(2, "B02", sr, sc)), None)
                    for f, (off, size) in SHAPES.items() for (r, c), (sr, sc) in plain(off, size).items()}
    final = plan.split("== Initial Plan ==")[0]
    assert "posexplode" in final and "Exchange" not in final[:final.index("posexplode")]
    assert "slice(" in plan
