"""Stack assembly.

Pixels stay in long form (field_id, time_idx, band, row, col, value) until the sink;
the wide stack is one ``pivot`` with a declared label list (no extra job to discover
the labels). Groups are single pixels (at most one value per label), so no group can
grow with the data. Completeness is decided on the tiny per-band key set, not on pixels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstack.constants import BANDS, N_TIME_POINTS, PIXEL_MAX, PIXEL_MIN
from fieldstack.functions.names import band_label

PIXEL_KEYS = ["field_id", "row", "col"]


def stack_labels(n_times: int = N_TIME_POINTS, bands=BANDS) -> list[str]:
    return [f"t{t}_{b}" for t in range(n_times) for b in bands]


def period_labels(periods: list[str], bands=BANDS) -> list[str]:
    return [f"{p}_{b}" for p in periods for b in bands]


def clamp_u16(v):
    """uint16 sink range; negatives become nodata 0."""
    return F.when(v < PIXEL_MIN, F.lit(PIXEL_MIN)).when(v > PIXEL_MAX, F.lit(PIXEL_MAX)).otherwise(v)


def stack_status(pixels: DataFrame, n_times: int = N_TIME_POINTS, bands=BANDS) -> DataFrame:
    """Per field: READY when all n_times x bands labels exist, else MISSING_BANDS with the
    missing labels (the original refuses to assemble such a field)."""
    labels = stack_labels(n_times, bands)
    have = (pixels.select("field_id", band_label(F.col("time_idx"), F.col("band")).alias("label"))
                  .groupBy("field_id").agg(F.collect_set("label").alias("have")))
    missing = F.array_except(F.array(*[F.lit(x) for x in labels]), F.col("have"))
    return have.select("field_id", F.size(F.array_intersect(F.array(*[F.lit(x) for x in labels]),
                                                            F.col("have"))).alias("n_bands"),
                       F.array_join(missing, ",").alias("missing"),
                       F.when(F.size(missing) == 0, "READY").otherwise("MISSING_BANDS").alias("status"))


def assemble_stack(pixels: DataFrame, n_times: int = N_TIME_POINTS, bands=BANDS,
                   complete_only: bool = True) -> DataFrame:
    """Wide stack (field_id, row, col, t0_B02 ... t{n-1}_B12), values clamped to uint16."""
    labels = stack_labels(n_times, bands)
    long = pixels.select(*PIXEL_KEYS, band_label(F.col("time_idx"), F.col("band")).alias("label"),
                         clamp_u16(F.col("value")).alias("value"))
    if complete_only:
        ready = stack_status(pixels, n_times, bands).where(F.col("status") == "READY").select("field_id")
        long = long.join(ready, "field_id", "left_semi")
    return long.groupBy(*PIXEL_KEYS).pivot("label", labels).agg(F.max("value"))


def stack_chunks(chunks: DataFrame, labels: list[str], keys: list[str]) -> DataFrame:
    """Raster chunks (``keys``, label, values) -> one row per chunk with an array for each label (null if it has none). Whole
    arrays cross the shuffle, not pixels; a group holds at most one array for each label."""
    got = chunks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("label", "values"))).alias("got"))
    pick = lambda name: F.get(F.filter("got", lambda x: x.label == name), F.lit(0)).values      # noqa: E731
    return got.select(*keys, *[pick(x).alias(x) for x in labels])


def chunk_pixels(wide: DataFrame, labels: list[str], chunk: int, keys: list[str], first_row=0) -> DataFrame:
    """Chunk rows -> pixels (``keys`` without crow and ccol, row, col, labels), clamped to uint16. ``first_row``: the chunk's row that the
    arrays begin with."""
    rest = [k for k in keys if k not in ("crow", "ccol")]
    zipped = wide.select(*keys, F.posexplode(F.arrays_zip(*[F.coalesce(F.col(x), F.array().cast("array<int>")).alias(x) for x in labels]))
                         .alias("pos", "v"))
    return zipped.select(*rest, (F.col("crow") * chunk + first_row + F.floor(F.col("pos") / chunk)).cast("int").alias("row"),
                         (F.col("ccol") * chunk + F.col("pos") % chunk).cast("int").alias("col"),
                         *[clamp_u16(F.col(f"v.{x}")).alias(x) for x in labels])


def assemble_from_chunks(chunks: DataFrame, chunk: int, n_times: int = N_TIME_POINTS, bands=BANDS, labels: list[str] | None = None,
                         complete_only: bool = True) -> DataFrame:
    """``assemble_stack`` of chunk rows (field_id, time_idx, band, crow, ccol, values): pivots arrays, then unfolds pixels."""
    labels = labels or stack_labels(n_times, bands)
    if complete_only:    # decided on keys alone: the arrays aren't read for it
        ready = stack_status(chunks, n_times, bands).where(F.col("status") == "READY").select("field_id")
        chunks = chunks.join(ready, "field_id", "left_semi")
    if "label" not in chunks.columns:
        chunks = chunks.withColumn("label", band_label(F.col("time_idx"), F.col("band")))
    keys = ["field_id", "crow", "ccol"]
    return chunk_pixels(stack_chunks(chunks, labels, keys), labels, chunk, keys)


def field_stacks(windows: DataFrame, chunks: DataFrame, chunk: int, keys: tuple[str, ...] = ("polygon_number",),
                 n_times: int = N_TIME_POINTS, bands=BANDS) -> DataFrame:
    """Clip, resample and assemble in one plan: the stack (``keys``, row, col, labels) of every field whose dates share a grid.

    ``windows``: ``windows.field_windows`` of those fields. ``chunks``: raster chunks (granule_key, band, crow, ccol, values). Each window
    meets the chunks it touches; the dates' arrays are laid side by side and only then unfolded, resampled (output pixel j takes source
    pixel floor(off + (j + 0.5) * size / int(size))) and clipped."""
    from fieldstack.operators.windows import window_chunks  # noqa: PLC0415
    labels = stack_labels(n_times, bands)
    shape = ["col_off", "row_off", "width", "height"]    # alike for all dates of a field on one grid, so every chunk has it
    frame = F.min(F.struct(*shape)).over(Window.partitionBy(*keys))
    framed = windows.dropna(subset=list(keys)).withColumn("frame", frame)
    # of a chunk's array only the rows that the frame touches cross the shuffle
    first = F.greatest(F.floor("row_off") - F.col("crow") * chunk, F.lit(0)).cast("int")
    last = (F.floor(F.col("row_off") + F.col("height")) - F.col("crow") * chunk).cast("int")
    met = (window_chunks(framed, chunk).select(*keys, "time_idx", "granule_key", "crow", "ccol", "frame.*")
           .join(chunks, ["granule_key", "crow", "ccol"])
           .withColumn("values", F.slice("values", first * chunk + 1, F.greatest(last - first + 1, F.lit(0)) * chunk))
           .withColumn("label", band_label(F.col("time_idx"), F.col("band"))))
    at = [*keys, *shape, "crow", "ccol"]
    px = chunk_pixels(stack_chunks(met, labels, at), labels, chunk, at, first)
    return _resampled(px, list(keys))


def assemble_named_periods(pixels: DataFrame, periods: list[str], bands=BANDS, chunk: int = 8) -> DataFrame:
    """N-period stack; period i of ``periods`` is time index i and names its bands. A pixel of a time index
    without a name is an error, raised when the stack is computed."""
    labels = period_labels(periods, bands)
    names = F.array(*[F.lit(p) for p in periods])
    name = F.when(F.col("time_idx").between(0, len(periods) - 1), F.get(names, F.col("time_idx"))).otherwise(
        F.raise_error(F.concat(F.lit("no period is named for time index "), F.col("time_idx"))))
    if "values" in pixels.columns:      # raster chunks
        named = pixels.withColumn("label", F.concat(name, F.lit("_"), F.col("band")))
        return assemble_from_chunks(named, chunk, labels=labels, complete_only=False)
    long = pixels.select(
        *PIXEL_KEYS,
        F.concat(name, F.lit("_"), F.col("band")).alias("label"),
        clamp_u16(F.col("value")).alias("value"))
    return long.groupBy(*PIXEL_KEYS).pivot("label", labels).agg(F.max("value"))


def clip_window(pixels: DataFrame, row_min: int, row_max: int, col_min: int, col_max: int) -> DataFrame:
    """Pixels inside an inclusive row/col window; rows re-based to the window origin.
    With chunk files sorted by (row, col) the predicate skips row groups."""
    return (pixels.where(F.col("row").between(row_min, row_max) & F.col("col").between(col_min, col_max))
                  .withColumn("row", F.col("row") - row_min)
                  .withColumn("col", F.col("col") - col_min))


def training_rows(stack: DataFrame, fields: DataFrame, n_times: int = N_TIME_POINTS, bands=BANDS,
                  as_array: bool = True) -> DataFrame:
    """One ML row per pixel: the stack's values as a feature vector plus the field class."""
    labels = stack_labels(n_times, bands)
    feats = F.array(*[F.col(c) for c in labels])
    if not as_array:
        feats = F.array_join(feats.cast("array<string>"), ",")
    j = stack.join(fields.select(F.col("polygon_number").alias("field_id"), "class"), "field_id")
    return j.select(*PIXEL_KEYS, "class", feats.alias("features"))


def grid_check(picks: DataFrame, granules: DataFrame, zone_of) -> DataFrame:
    """Per field: do all dates come from one tile (one grid)? ``zone_of`` maps a granule
    row to its UTM zone column. GRID_MISMATCH when tiles differ."""
    g = granules.select("granule_key", "tile", zone_of.alias("zone"))
    j = picks.select("polygon_number", "granule_key").join(g, "granule_key")
    # a field has a handful of dates, so the distinct sets are tiny: collect_set avoids the
    # Expand + double aggregation that two count_distinct aggregates plan into
    agg = j.groupBy("polygon_number").agg(F.count("*").alias("n_dates"),
                                          F.size(F.collect_set("tile")).cast("long").alias("n_tiles"),
                                          F.size(F.collect_set("zone")).cast("long").alias("n_zones"))
    return agg.withColumn("status", F.when(F.col("n_tiles") == 1, "OK").otherwise("GRID_MISMATCH"))


def resample_window(pixels: DataFrame, windows: DataFrame, keys=("field_id",)) -> DataFrame:
    """Clip to a fractional pixel window and resample to its truncated size (nearest):
    output pixel j takes source pixel floor(off + (j + 0.5) * size / int(size)).

    ``windows``: keys + col_off, row_off, width, height (fractional, source pixels).
    The output is never larger than the window (scale >= 1), so every source pixel
    feeds at most one output pixel: the resample is a projection and a filter on the
    pixel table, joined once to the per-field window (one row per field)."""
    keys = list(keys)
    return _resampled(pixels.join(windows.select(*keys, "col_off", "row_off", "width", "height"), keys), keys)


def _resampled(framed: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels that have their window beside them, resampled to it."""
    shape = ["col_off", "row_off", "width", "height"]
    j = (framed.withColumn("out_w", F.col("width").cast("int")).withColumn("out_h", F.col("height").cast("int"))
         .where((F.col("out_w") > 0) & (F.col("out_h") > 0)))

    def target(src, off, size, n):
        s = size / n
        k = F.ceil((src - off) / s - 0.5)
        ok = (k >= 0) & (k < n) & (F.floor(off + (k + 0.5) * s) == src)
        return k.cast("int"), ok

    oc, okc = target(F.col("col"), F.col("col_off"), F.col("width"), F.col("out_w"))
    orow, okr = target(F.col("row"), F.col("row_off"), F.col("height"), F.col("out_h"))
    return (j.withColumn("out_col", oc).withColumn("out_row", orow)
             .where(okc & okr)
             .select(*keys, *[c for c in framed.columns if c not in keys + ["row", "col"] + shape],
                     F.col("out_row").alias("row"), F.col("out_col").alias("col")))


def read_window(spark, path: str, chunk: int, rows: tuple[int, int], cols: tuple[int, int], labels: list[str],
                field_ids: list | None = None, n_buckets: int | None = None) -> DataFrame:
    """Pixels (field_id, row, col, ``labels``) of an inclusive window of the fields in a stack written by ``sinks.writers.write_chunk_stack``.
    The window's limits are predicates on stored columns, so groups of chunks outside it are skipped by their statistics; pixels unfold
    after that. Only the arrays of ``labels`` are read."""
    df = read_stack(spark, path, field_ids, n_buckets).where(
        (F.col("row_last") >= rows[0]) & (F.col("row_first") <= rows[1]) & (F.col("col_last") >= cols[0]) & (F.col("col_first") <= cols[1]))
    px = chunk_pixels(df.select("field_id", "crow", "ccol", *labels), labels, chunk, ["field_id", "crow", "ccol"])
    return px.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def read_stack(spark, path: str, field_ids: list | None = None, n_buckets: int | None = None) -> DataFrame:
    """Read a stack written by ``sinks.writers.write_stack``. With ``field_ids`` and the
    writer's ``n_buckets`` the bucket predicate is a list of constant hashes that Catalyst
    folds, so only the matching bucket folders are listed and read."""
    df = spark.read.parquet(path)
    if field_ids:
        if n_buckets:
            buckets = [F.pmod(F.xxhash64(F.lit(int(f)).cast("long")), F.lit(n_buckets)).cast("int")
                       for f in field_ids]
            df = df.where(F.col("bucket").isin(*buckets))
        df = df.where(F.col("field_id").isin([int(f) for f in field_ids]))
    return df.drop("bucket") if "bucket" in df.columns else df


def stack_to_pixels(stack: DataFrame, n_times: int = N_TIME_POINTS, bands=BANDS) -> DataFrame:
    """Wide stack -> long pixels (field_id, time_idx, band, row, col, value) with
    ``unpivot``; the inverse of ``assemble_stack`` for complete fields."""
    labels = stack_labels(n_times, bands)
    long = stack.unpivot(PIXEL_KEYS, labels, "label", "value")
    parts = F.split(F.col("label"), "_")
    return long.select(
        "field_id",
        F.substring(F.element_at(parts, 1), 2, 4).cast("int").alias("time_idx"),
        F.element_at(parts, 2).alias("band"), "row", "col", "value")
