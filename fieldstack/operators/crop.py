"""Crop rasters by a geometry (K6): the outer pixel window of a convex polygon, nodata where a pixel's centre lies outside.

The polygon is scan-converted: on each pixel row the line through the centres cuts a convex polygon in one interval, so a mask is a first
and a last column for each row, never a list of pixels. A centre on the boundary counts as inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outer_window(polygon: Column, x0: Column, y0: Column, x1: Column, y1: Column, px: float) -> Column:
    """struct(row_first, row_last, col_first, col_last): the raster's pixels that the polygon's bounds touch, cut to the raster (x0, y0 top
    left, x1, y1 bottom right). The last is below the first where they don't meet, and for an empty or missing polygon."""
    xs, ys = F.transform(polygon, lambda p: p.x), F.transform(polygon, lambda p: p.y)
    low = lambda v: F.greatest(F.floor(v / px), F.lit(0).cast("long"))                                      # noqa: E731
    high = lambda v, size: F.least(F.ceil(v / px), F.round(size / px).cast("long")) - 1                     # noqa: E731
    return F.struct(F.coalesce(low(y0 - F.array_max(ys)), F.lit(0).cast("long")).alias("row_first"),
                    F.coalesce(high(y0 - F.array_min(ys), y0 - y1), F.lit(-1).cast("long")).alias("row_last"),
                    F.coalesce(low(F.array_min(xs) - x0), F.lit(0).cast("long")).alias("col_first"),
                    F.coalesce(high(F.array_max(xs) - x0, x1 - x0), F.lit(-1).cast("long")).alias("col_last"))


def row_spans(polygon: Column, window: Column, x0: Column, y0: Column, px: float) -> Column:
    """One struct(first, last) for each row of ``window``: the columns whose centres lie in the convex polygon (nulls: none)."""
    n = F.size(polygon)
    edges = F.transform(polygon, lambda p, i: F.struct(p.alias("a"), F.element_at(polygon, (i + 1) % n + 1).alias("b")))

    def cut(e: Column, y: Column) -> Column:
        meets = (y >= F.least(e.a.y, e.b.y)) & (y <= F.greatest(e.a.y, e.b.y)) & (e.a.y != e.b.y)
        return F.when(meets, e.a.x + (y - e.a.y) / (e.b.y - e.a.y) * (e.b.x - e.a.x))

    def span(row: Column) -> Column:
        xs = F.transform(edges, lambda e: cut(e, y0 - (row + 0.5) * px))
        return F.struct(F.ceil((F.array_min(xs) - x0) / px - 0.5).alias("first"), F.floor((F.array_max(xs) - x0) / px - 0.5).alias("last"))

    return F.transform(F.sequence(window.row_first, window.row_last), span)


def clip_geometry(fields: DataFrame, chunks: DataFrame, chunk: int, px: float, keys: list[str], nodata: int = 0) -> DataFrame:
    """Pixels (``keys``, band, height, width, row, col, inside, value) of every field's cropped raster; row and col count from the crop's corner.

    ``fields``: keys, granule_key, the raster's x0, y0, x1, y1 and ``polygon``, an array of struct(x, y) in the raster's metres, convex, in
    either direction. ``chunks``: raster chunks (granule_key, band, crow, ccol, values). A field that its raster doesn't hold gives no rows,
    and neither does a chunk that isn't there. A field meets only the chunks that it touches, and only pixels of its window unfold."""
    at = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    f = fields.select(*keys, "granule_key", "x0", "y0", "polygon", outer_window(F.col("polygon"), *at, px).alias("win"))
    w = F.col("win")
    f = f.where((w.row_first <= w.row_last) & (w.col_first <= w.col_last)).withColumn(
        "spans", row_spans(F.col("polygon"), w, F.col("x0"), F.col("y0"), px)).drop("polygon", "x0", "y0")
    tiles = lambda lo, hi: F.explode(F.sequence(F.floor(lo / chunk), F.floor(hi / chunk)))      # noqa: E731
    met = (f.withColumn("crow", tiles(w.row_first, w.row_last)).withColumn("ccol", tiles(w.col_first, w.col_last))
           .join(chunks.select("granule_key", "band", "crow", "ccol", "values"), ["granule_key", "crow", "ccol"]))
    px_rows = met.select(*keys, "band", "win", "spans", "crow", "ccol", F.posexplode("values").alias("pos", "raw")).select(
        *keys, "band", "win", "spans", "raw", (F.col("crow") * chunk + F.floor(F.col("pos") / chunk)).alias("r"),
        (F.col("ccol") * chunk + F.col("pos") % chunk).alias("c"))
    kept = px_rows.where(F.col("r").between(w.row_first, w.row_last) & F.col("c").between(w.col_first, w.col_last))
    span = F.get(F.col("spans"), (F.col("r") - w.row_first).cast("int"))
    inside = F.coalesce(F.col("c").between(span.first, span.last), F.lit(False))
    return kept.select(*keys, "band", (w.row_last - w.row_first + 1).alias("height"), (w.col_last - w.col_first + 1).alias("width"),
                       (F.col("r") - w.row_first).alias("row"), (F.col("c") - w.col_first).alias("col"), inside.alias("inside"),
                       F.when(inside, F.col("raw")).otherwise(F.lit(nodata)).alias("value"))
