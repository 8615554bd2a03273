"""Assembly on the first date's grid (J7, A12): fields whose dates lie on different grids, by a nearest-neighbour warp.

The window of a field's first date says where the output pixels lie. For every other date the centre of an output pixel goes back to
degrees and on into that date's zone, and takes the source pixel it falls in. Output pixels are dealt into blocks; those of one block that
read one source chunk are one row with a list of places, so lists and arrays cross the shuffles, not pixels, and a list holds at most
``chunk`` x ``chunk`` places however large the field is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstack.constants import BANDS, N_TIME_POINTS, NODATA
from fieldstack.functions import geo as GE
from fieldstack.operators.assemble import clamp_u16, stack_chunks

USABLE = ("OK", "PARTIAL", "FULL_EXTENT")


def source_cells(windows: DataFrame, px: float, chunk: int, keys: list[str]) -> DataFrame:
    """For every output pixel and date the source pixel: (``keys``, time_idx, granule_key, brow, bcol, crow, ccol, cells), where cells lists
    struct(row, col, pos): places of the output block (brow, bcol) and their position in the date's raster chunk (crow, ccol). A place outside
    the date's raster is listed under chunk (-1, -1). ``windows``: ``windows.field_windows``."""
    ref = windows.groupBy(*keys).agg(F.min_by(F.struct(
        "zone", "x0", "y0", "col_off", "row_off", "width", "height", "out_width", "out_height", "status"), "time_idx").alias("ref"))
    r = F.col("ref")
    j = windows.select(*keys, "time_idx", "granule_key", "zone", "x0", "y0", "x1", "y1").join(ref, keys).where(
        r.status.isin(*USABLE) & (r.out_width > 0) & (r.out_height > 0))
    at = (j.withColumn("row", F.explode(F.sequence(F.lit(0), r.out_height - 1)))
          .withColumn("col", F.explode(F.sequence(F.lit(0), r.out_width - 1))))
    at = at.withColumns({"x": r.x0 + (r.col_off + (F.col("col") + 0.5) * (r.width / r.out_width)) * px,
                         "y": r.y0 - (r.row_off + (F.col("row") + 0.5) * (r.height / r.out_height)) * px})
    at = at.withColumn("ll", GE.from_utm(F.col("x"), F.col("y"), r.zone))
    at = at.withColumn("xy", GE.to_utm(F.col("ll.lat"), F.col("ll.lon"), F.col("zone")))
    same = F.col("zone") == r.zone
    at = at.withColumns({"sx": F.when(same, F.col("x")).otherwise(F.col("xy.x")), "sy": F.when(same, F.col("y")).otherwise(F.col("xy.y"))})
    at = at.withColumns({"sc": F.floor((F.col("sx") - F.col("x0")) / px), "sr": F.floor((F.col("y0") - F.col("sy")) / px)})
    inside = (F.col("sc").between(0, F.round((F.col("x1") - F.col("x0")) / px) - 1)
              & F.col("sr").between(0, F.round((F.col("y0") - F.col("y1")) / px) - 1))
    # never null, so that the join doesn't ask for that and compute the projection a second time
    part = lambda c: F.coalesce(F.when(inside, F.floor(F.col(c) / chunk)), F.lit(-1).cast("long"))      # noqa: E731
    block = lambda c: F.floor(F.col(c) / chunk)                                                         # noqa: E731
    cells = at.select(*keys, "time_idx", "granule_key", block("row").alias("brow"), block("col").alias("bcol"), part("sr").alias("crow"),
                      part("sc").alias("ccol"), F.struct("row", "col", (F.pmod("sr", F.lit(chunk)) * chunk + F.pmod("sc", F.lit(chunk)))
                                                         .cast("int").alias("pos")).alias("cell"))
    return cells.groupBy(*keys, "time_idx", "granule_key", "brow", "bcol", "crow", "ccol").agg(F.collect_list("cell").alias("cells"))


def warped_stacks(windows: DataFrame, chunks: DataFrame, px: float, chunk: int, keys: tuple[str, ...] = ("polygon_number",),
                  n_times: int = N_TIME_POINTS, bands=BANDS, nodata: int = NODATA) -> DataFrame:
    """The stack (``keys``, row, col, labels) of every field on its first date's grid, values clamped to uint16.

    ``chunks``: raster chunks (granule_key, band, crow, ccol, values). A place outside a date's raster, or in a chunk that isn't there, holds
    ``nodata`` in all bands of the date; a band that the chunk lacks, and a date without a granule, is null. A field whose first date has no
    usable window gives no rows. Where all dates share a grid the result is ``assemble.field_stacks``, but for windows over the edge."""
    keys = list(keys)
    place = ["granule_key", "crow", "ccol"]
    wide = stack_chunks(chunks.withColumnRenamed("band", "label"), list(bands), place).withColumn("there", F.lit(True))
    met = source_cells(windows, px, chunk, keys).join(wide, place, "left")
    take = lambda cell, b: F.when(F.col("there"), F.get(F.col(b), cell.pos)).otherwise(F.lit(nodata))
    values = F.transform("cells", lambda c: F.struct(c.row.alias("row"), c.col.alias("col"), *[take(c, b).alias(b) for b in bands]))
    # the dates of a block come together as lists; its pixels are grouped where they then lie
    blocks = met.select(*keys, "brow", "bcol", "time_idx", values.alias("cells")).repartition(*[F.col(c) for c in (*keys, "brow", "bcol")])
    px_rows = blocks.select(*keys, "brow", "bcol", "time_idx", F.explode("cells").alias("v"))
    return px_rows.groupBy(*keys, "brow", "bcol", F.col("v.row").alias("row"), F.col("v.col").alias("col")).agg(
        *[F.max(F.when(F.col("time_idx") == t, clamp_u16(F.col(f"v.{b}")))).alias(f"t{t}_{b}") for t in range(n_times) for b in bands]
    ).drop("brow", "bcol")
