"""Named queries over the driver tables, each with its DuckDB twin.

``QUERIES[name]`` is a callable ``(spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the
equivalent SQL over the driver's raw tables. Column names are aliased identically on both
sides. Every query reads whole tables; nothing is sampled or capped unless the cap is the
operator itself (a listing limit, a top-10 report).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.constants import BANDS, MAX_RESULTS_DOWNLOAD, WINDOWS
from fieldstack.plans import fixture_sql as S
from fieldstack.plans.fixture_sql import with_
from fieldstack.plans.requests import explode_time_points, plan_requests, validate_options
from fieldstack.sources import driver as D
from fieldstack.session import checkpoint_dir
from fieldstack.sources.fields import cast_fields, read_fields_csv, split_valid, with_default_class
from fieldstack.operators import search as SR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared plan pieces --------------------------------------------------------------

def valid_fields(spark, sf):
    valid, _ = split_valid(D.fields_raw(spark, sf), D.UNITS_PER_DEGREE)
    return with_default_class(valid)


def requests(spark, sf):
    return plan_requests(valid_fields(spark, sf), half_size=D.HALF_SIZE,
                         units_per_degree=D.UNITS_PER_DEGREE, keep_pos=False)


def time_points(spark, sf):
    return explode_time_points(requests(spark, sf))


def pairs(spark, sf, window_days=30, points=None, **first):
    return SR.search_granules(points if points is not None else time_points(spark, sf), D.granules(spark, sf), window_days=window_days,
                              cloud_min=0, cloud_max=30, cell=D.GRANULE_SIZE, **first)


def picks(spark, sf, max_results=MAX_RESULTS_DOWNLOAD):
    """The widening search: per window the first ``max_results`` granules, those with a requested band."""
    f = D.file_bands(spark, sf)
    found = pairs(spark, sf, max_results=max_results, windows=WINDOWS, wanted=SR.wanted_granules(f, BANDS))
    return SR.adaptive_pick_banded(found, f, BANDS, max_results=max_results)


AS_OF = "1997-10-01"     # the day the searches are made: some of the fixture's dates lie ahead
BASE = (S.FIELDS, S.VALID_FIELDS, S.REQUESTS, S.TIME_POINTS, S.GRANULES)


# ---- 1. fields and requests ------------------------------------------------------------

@query("fields_load", with_(S.FIELDS, S.VALID_FIELDS) + "SELECT * FROM valid_fields")
def q_fields_load(spark, sf):
    return valid_fields(spark, sf)


@query("fields_rejects", with_(S.FIELDS) + """
SELECT polygon_number, lat, lon, 'COORDINATE_OUT_OF_RANGE' AS reject_reason FROM fields
WHERE NOT (lat BETWEEN -90000000 AND 90000000 AND lon BETWEEN -180000000 AND 180000000)""")
def q_fields_rejects(spark, sf):
    _, rejected = split_valid(D.fields_raw(spark, sf), D.UNITS_PER_DEGREE)
    return rejected.select("polygon_number", "lat", "lon", "reject_reason")


CSV_COLUMNS = [["Polygon Number", "Class", "Y Coordinate", "X Coordinate"],      # of each folder's files: any order, more columns, no class
               ["X Coordinate", "Remark", "Class", "Y Coordinate", "Polygon Number"], ["Y Coordinate", "X Coordinate", "Polygon Number"]]


@query("fields_csv", with_(S.FIELDS) + """
SELECT CAST(polygon_number AS INTEGER) AS polygon_number, CASE WHEN polygon_number % 3 = 2 THEN 'Unknown' ELSE coalesce(class, 'Unknown') END AS class,
       lat, lon, CASE WHEN NOT (lat BETWEEN -90000000 AND 90000000 AND lon BETWEEN -180000000 AND 180000000) THEN 'COORDINATE_OUT_OF_RANGE' END AS reject_reason
FROM fields""")
def q_fields_csv(spark, sf):
    """The customers as CSV files of three layouts, read back by the names in their headers."""
    folder = f"{checkpoint_dir(spark)}/fields-csv-{uuid.uuid4().hex}"
    degrees = lambda c: (F.col(c) / 1_000_000).cast("decimal(10,6)").cast("string")
    rows = D.fields_raw(spark, sf).select("polygon_number", F.col("polygon_number").cast("string").alias("Polygon Number"), F.col("class").alias("Class"),
                                          degrees("lat").alias("Y Coordinate"), degrees("lon").alias("X Coordinate"), F.lit('a, "b"').alias("Remark"))
    for i, columns in enumerate(CSV_COLUMNS):
        rows.where(F.col("polygon_number") % 3 == i).select(*columns).write.option("header", True).csv(f"{folder}/{i}")
    units = lambda c: F.round(F.col(c) * 1_000_000).cast("long").alias(c)               # noqa: E731
    return cast_fields(read_fields_csv(spark, f"{folder}/*")).select("polygon_number", "class", units("lat"), units("lon"), "reject_reason")


@query("field_bbox", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS)
       + "SELECT polygon_number, west, south, east, north FROM requests")
def q_field_bbox(spark, sf):
    return requests(spark, sf).select("polygon_number", "west", "south", "east", "north")


@query("request_plan", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS) + "SELECT * FROM requests")
def q_request_plan(spark, sf):
    return requests(spark, sf)


@query("request_validate", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS)
       + "SELECT status, count(*) AS n FROM requests GROUP BY status")
def q_request_validate(spark, sf):
    return requests(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


# option texts of every kind, dealt out by the field's number
OPTIONS = {"start_text": ["1996-03-01", "1996-3-1", "1996-02-30", "2000-01-01", "1996-03-01", "1996-03-01", "1996-03-01"],
           "end_text": ["1996-09-01"] * 7, "order_text": ["forward", "random", "backward", "forward", "sideways", "Backward", "random"],
           "limit_text": [None, "10", "10", None, "10", "0", "7"], "half_text": ["0.05", "0.05", "0.05", "0.05", "0.05", "0.05", "1.5"]}
OPTION_STATUS = ["OK", "INVALID_DATE", "INVALID_DATE", "INVALID_RANGE", "INVALID_ORDER", "INVALID_LIMIT", "INVALID_BBOX_SIZE"]


@query("request_options", with_(S.FIELDS, S.VALID_FIELDS) + f"""
SELECT polygon_number, {OPTION_STATUS!r}[CAST(polygon_number % 7 AS INTEGER) + 1] AS status FROM valid_fields""")
def q_request_options(spark, sf):
    i = (F.col("polygon_number") % 7).cast("int")
    texts = {c: F.get(F.array(*[F.lit(x).cast("string") for x in v]), i) for c, v in OPTIONS.items()}
    return validate_options(valid_fields(spark, sf).withColumns(texts)).select("polygon_number", "status")


@query("time_points", with_(*BASE[:4]) + "SELECT polygon_number, time_idx, t_date FROM time_points")
def q_time_points(spark, sf):
    return time_points(spark, sf).select("polygon_number", "time_idx", "t_date")


@query("search_windows", with_(*BASE[:4]) + """
SELECT polygon_number, time_idx, t_date, CAST(w.attempt AS INTEGER) AS attempt, CAST(w.window_days AS INTEGER) AS window_days,
       t_date - CAST(w.window_days AS INTEGER) AS window_start, t_date + CAST(w.window_days AS INTEGER) AS window_end,
       CASE WHEN t_date - 3 > date '1997-10-01' THEN 'FUTURE_DATE' ELSE 'PENDING' END AS status
FROM time_points CROSS JOIN (VALUES (1, 3), (2, 7), (3, 14), (4, 30)) AS w(attempt, window_days)
WHERE w.attempt = 1 OR t_date - 3 <= date '1997-10-01'""")
def q_search_windows(spark, sf):
    return SR.search_windows(time_points(spark, sf), as_of=AS_OF)


# ---- 2. granule search and the adaptive window -------------------------------------------

@query("granule_search", with_(*BASE, S.PAIRS) + "SELECT * FROM pairs")
def q_granule_search(spark, sf):
    return pairs(spark, sf)


@query("adaptive_window", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + "SELECT * FROM picks")
def q_adaptive_window(spark, sf):
    return picks(spark, sf)


@query("adaptive_window_status", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + """
SELECT tp.polygon_number, tp.time_idx, tp.t_date,
       CASE WHEN tp.t_date - 3 > date '1997-10-01' THEN 'FUTURE_DATE'
            WHEN p.granule_key IS NULL THEN 'NO_DATA' ELSE 'OK' END AS status,
       p.window_days, p.attempt, p.granule_key, p.granule_id
FROM time_points tp LEFT JOIN picks p
  ON p.polygon_number = tp.polygon_number AND p.time_idx = tp.time_idx AND tp.t_date - 3 <= date '1997-10-01'""")
def q_adaptive_window_status(spark, sf):
    return SR.pick_status(time_points(spark, sf), picks(spark, sf), as_of=AS_OF)


@query("granule_listing", with_(*BASE, S.PAIRS) + """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY polygon_number, time_idx ORDER BY acquired_at, granule_id) AS ordinal
  FROM pairs) WHERE ordinal <= 10""")
def q_granule_listing(spark, sf):
    return SR.granule_listing(pairs(spark, sf, max_results=10, windows=[30]), max_results=10).withColumn(
        "ordinal", F.col("ordinal").cast("long"))


# ---- 3. granule files --------------------------------------------------------------------

from fieldstack.operators import granules as GR  # noqa: E402
from fieldstack.operators import organize as OG  # noqa: E402

OUT_ROOT = "/data/fields"


def files(spark, sf):
    return D.granule_files(spark, sf)


def band_files(spark, sf):
    f = files(spark, sf).withColumn("file_name", F.element_at(F.split("url", "/"), -1))
    return GR.filter_bands(f, BANDS)


def manifest(spark, sf):
    return GR.download_manifest(picks(spark, sf), files(spark, sf), BANDS, OUT_ROOT)


FILE_NAME_SQL = "CASE WHEN strpos(url, 'http') > 0 THEN string_split(url, '/')[-1] ELSE url END"
BAND_FILTER_SQL = " OR ".join(f"strpos(file_name, '.{b}.') > 0" for b in BANDS)
BAND_FILES = f"""
band_files AS (
  SELECT * FROM (SELECT *, {FILE_NAME_SQL} AS file_name FROM granule_files) WHERE {BAND_FILTER_SQL})"""
MANIFEST = f"""
manifest AS (
  SELECT p.polygon_number, p.time_idx, p.granule_key, f.granule_id, f.band, f.url, f.file_name,
         '{OUT_ROOT}/' || CAST(p.polygon_number AS VARCHAR) || '/t' || CAST(p.time_idx AS VARCHAR) || '/'
           || f.granule_id || '/' || f.file_name AS target_path,
         f.l_suppkey, f.l_partkey, f.l_extendedprice
  FROM picks p JOIN band_files f ON p.granule_key = f.granule_key)"""
ORGANIZED = """
organized AS (
  SELECT polygon_number, time_idx, band, arg_min(url, (l_suppkey, l_partkey, l_extendedprice, url)) AS url,
         count(*) AS n_candidates
  FROM manifest GROUP BY polygon_number, time_idx, band)"""
BAND_LIST_SQL = "[" + ",".join(f"'{b}'" for b in BANDS) + "]"


@query("granule_id_extract", with_(S.GRANULES, S.FILES) + rf"""
SELECT granule_key, granule_id, url, file_name,
       regexp_replace(regexp_replace(file_name, '\.tif$', ''), '\.(B[^.]{{0,3}}|Fmask|VAA|VZA|SAA|SZA)$', '') AS parsed_granule_id,
       nullif(regexp_extract(regexp_replace(file_name, '\.tif$', ''), '\.(B[^.]{{0,3}}|Fmask|VAA|VZA|SAA|SZA)$', 1), '') AS layer
FROM (SELECT *, {FILE_NAME_SQL} AS file_name FROM granule_files)""")
def q_granule_id_extract(spark, sf):
    return GR.parse_file_urls(files(spark, sf)).select(
        "granule_key", "granule_id", "url", "file_name", "parsed_granule_id", "layer")


@query("granule_parts", with_(S.GRANULES) + r"""
SELECT granule_key, granule_id, split_part(granule_id, '.', 1) AS product, split_part(granule_id, '.', 2) AS sensor,
       split_part(granule_id, '.', 3) AS tile_code,
       strptime(split_part(granule_id, '.', 4), '%Y%jT%H%M%S') AS parsed_acquired_at,
       split_part(granule_id, '.', 5) || '.' || split_part(granule_id, '.', 6) AS version,
       acquired_at
FROM granules""")
def q_granule_parts(spark, sf):
    return GR.with_granule_parts(D.granules(spark, sf)).select(
        "granule_key", "granule_id", "product", "sensor", "tile_code", "parsed_acquired_at",
        "version", "acquired_at")


@query("band_filter", with_(S.GRANULES, S.FILES, BAND_FILES)
       + "SELECT granule_key, band, url, file_name FROM band_files")
def q_band_filter(spark, sf):
    return band_files(spark, sf).select("granule_key", "band", "url", "file_name")


@query("granule_groups", with_(S.GRANULES, S.FILES, BAND_FILES) + """
SELECT granule_id, count(*) AS n_files, array_to_string(list_sort(list_distinct(list(band))), ',') AS bands
FROM band_files GROUP BY granule_id""")
def q_granule_groups(spark, sf):
    return GR.group_by_granule(band_files(spark, sf))


@query("download_manifest", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, BAND_FILES, MANIFEST) + """
SELECT polygon_number, time_idx, granule_key, granule_id, band, url, file_name, target_path FROM manifest""")
def q_download_manifest(spark, sf):
    return manifest(spark, sf)


@query("organize_bands", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, BAND_FILES, MANIFEST, ORGANIZED) + f"""
SELECT polygon_number, time_idx, band, url, n_candidates,
       '{OUT_ROOT}/' || CAST(polygon_number AS VARCHAR) || '/t' || CAST(time_idx AS VARCHAR) || '/' || band || '.tif' AS organized_path
FROM organized""")
def q_organize_bands(spark, sf):
    return organize(spark, sf)


def organize(spark, sf, pk=None):
    f = files(spark, sf)
    p = (pk if pk is not None else picks(spark, sf)).select("polygon_number", "time_idx", "granule_key")
    fm = GR.filter_bands(f.withColumn("file_name", F.element_at(F.split("url", "/"), -1)), BANDS)
    m = p.join(fm, "granule_key")
    first = OG.first_file_per_band(m, ["l_suppkey", "l_partkey", "l_extendedprice"])
    return OG.organized_path(first, OUT_ROOT)


@query("missing_bands", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, BAND_FILES, MANIFEST, ORGANIZED) + f"""
SELECT p.polygon_number, p.time_idx,
       array_to_string(list_filter({BAND_LIST_SQL}, lambda x: NOT list_contains(coalesce(o.found, []), x)), ',') AS missing,
       CAST(len(list_filter({BAND_LIST_SQL}, lambda x: list_contains(coalesce(o.found, []), x))) AS INTEGER) AS n_found,
       CASE WHEN len(list_filter({BAND_LIST_SQL}, lambda x: NOT list_contains(coalesce(o.found, []), x))) = 0
            THEN 'COMPLETE' ELSE 'MISSING_BANDS' END AS status
FROM picks p LEFT JOIN (SELECT polygon_number, time_idx, list(band) AS found FROM organized
                        GROUP BY polygon_number, time_idx) o USING (polygon_number, time_idx)""")
def q_missing_bands(spark, sf):
    return OG.granule_band_completeness(picks(spark, sf), files(spark, sf), BANDS)


# ---- 4. pixels, stacks, statistics, imagery ----------------------------------------------

from fieldstack.operators import assemble as AS  # noqa: E402
from fieldstack.operators import imagery as IM  # noqa: E402
from fieldstack.operators import stats as ST  # noqa: E402

LABELS = AS.stack_labels()
PERIODS = ["spring", "summer", "autumn"]
PCT = """
pct AS (
  SELECT field_id, time_idx, band, round(quantile_cont(value, 0.02), 4) AS p_low,
         round(quantile_cont(value, 0.98), 4) AS p_high
  FROM pixels GROUP BY field_id, time_idx, band)"""
STRETCHED = """
stretched AS (
  SELECT x.*, pct.p_low, pct.p_high,
         round(CASE WHEN p_high = p_low THEN (CASE WHEN value > p_low THEN 1.0 WHEN value < p_low THEN 0.0 END)
                    ELSE (CASE WHEN (value - p_low) / (p_high - p_low) < 0 THEN 0.0
                               WHEN (value - p_low) / (p_high - p_low) > 1 THEN 1.0
                               ELSE (value - p_low) / (p_high - p_low) END) END, 4) AS stretched
  FROM pixels x JOIN pct USING (field_id, time_idx, band))"""


def _pivot_sql(labels_expr: list[tuple[str, str]], src: str, keys: str = "field_id, row, col") -> str:
    cols = ",\n  ".join(f"max(CASE WHEN {cond} THEN value END) AS {name}" for name, cond in labels_expr)
    return f"SELECT {keys},\n  {cols}\nFROM {src} GROUP BY {keys}"


_STACK_COND = [(f"t{t}_{b}", f"time_idx = {t} AND band = '{b}'") for t in range(3) for b in BANDS]
_PERIOD_COND = [(f"{p}_{b}", f"time_idx = {i} AND band = '{b}'") for i, p in enumerate(PERIODS) for b in BANDS]
LABEL_LIST_SQL = "[" + ",".join(f"'{x}'" for x in LABELS) + "]"
STACK_STATUS = f"""
have AS (SELECT field_id, list(DISTINCT 't' || CAST(time_idx AS VARCHAR) || '_' || band) AS have
         FROM pixels GROUP BY field_id),
stack_status AS (
  SELECT field_id,
         CAST(len(list_filter({LABEL_LIST_SQL}, lambda x: list_contains(have, x))) AS INTEGER) AS n_bands,
         array_to_string(list_filter({LABEL_LIST_SQL}, lambda x: NOT list_contains(have, x)), ',') AS missing,
         CASE WHEN len(list_filter({LABEL_LIST_SQL}, lambda x: NOT list_contains(have, x))) = 0
              THEN 'READY' ELSE 'MISSING_BANDS' END AS status
  FROM have)"""
STACK = f"""
stack AS (
  {_pivot_sql(_STACK_COND, "(SELECT * FROM pixels WHERE field_id IN (SELECT field_id FROM stack_status WHERE status = 'READY'))")})"""


def px(spark, sf):
    return D.pixels(spark, sf)


def stretched(spark, sf):
    p = px(spark, sf)
    return ST.band_stretch(p, ST.band_percentiles(p))


@query("pixels_scan", with_(S.PIXELS) + "SELECT * FROM pixels")
def q_pixels_scan(spark, sf):
    return px(spark, sf)


@query("band_stats", with_(S.PIXELS) + """
SELECT field_id, time_idx, band, count(*) AS n, min(value) AS min, max(value) AS max,
       round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
       round(avg(CASE WHEN value <> 0 THEN 100.0 ELSE 0.0 END), 4) AS valid_pct
FROM pixels GROUP BY field_id, time_idx, band""")
def q_band_stats(spark, sf):
    return ST.band_stats(px(spark, sf))


@query("band_percentiles", with_(S.PIXELS, PCT) + "SELECT * FROM pct")
def q_band_percentiles(spark, sf):
    return ST.band_percentiles(px(spark, sf))


@query("band_histogram", with_(S.PIXELS) + """
, counts AS (SELECT field_id, time_idx, band, value, count(*) AS n FROM pixels GROUP BY field_id, time_idx, band, value),
ranges AS (SELECT field_id, time_idx, band, min(value) AS vmin, max(value) AS vmax FROM counts GROUP BY field_id, time_idx, band),
dense AS (SELECT field_id, time_idx, band, vmin, CAST(unnest(range(vmin, vmax + 1)) AS INTEGER) AS value FROM ranges)
SELECT d.field_id, d.time_idx, d.band, CAST(d.value - d.vmin AS INTEGER) AS bucket, d.value, coalesce(c.n, 0) AS n
FROM dense d LEFT JOIN counts c USING (field_id, time_idx, band, value)""".replace("\n, counts", ", counts", 1))
def q_band_histogram(spark, sf):
    return ST.band_histogram(px(spark, sf))


@query("band_stretch", with_(S.PIXELS, PCT, STRETCHED) + "SELECT * FROM stretched")
def q_band_stretch(spark, sf):
    return stretched(spark, sf)


_COMP_COND = [(b, f"band = '{b}'") for b in BANDS]
_COMP_WIDE = ("wide AS (" + _pivot_sql(_COMP_COND, "stretched", "field_id, row, col, time_idx")
              .replace("THEN value END", "THEN stretched END") + ")")
_COMP_SEL = " UNION ALL ".join(
    f"SELECT field_id, row, col, time_idx, '{n}' AS preset, {c[0]} AS r, {c[1]} AS g, {c[2]} AS b FROM wide"
    for n, c, a in IM.presets() if a)


@query("composites", with_(S.PIXELS, PCT, STRETCHED, _COMP_WIDE) + _COMP_SEL)
def q_composites(spark, sf):
    return IM.composites(stretched(spark, sf))


_PRESET_VALUES = ", ".join(f"('{n}', '{b}')" for n, codes, _ in IM.presets() for b in codes)


@query("preset_availability", with_(S.PIXELS) + f"""
, have AS (SELECT DISTINCT field_id, time_idx, band FROM pixels)
SELECT field_id, time_idx, preset, count(*) AS n_channels, string_agg(DISTINCT band, ',' ORDER BY band) AS bands, count(*) = 3 AS available
FROM have JOIN (VALUES {_PRESET_VALUES}) AS l(preset, b) ON band = b
GROUP BY field_id, time_idx, preset""".replace("\n, have AS", ", have AS", 1))
def q_preset_availability(spark, sf):
    return IM.preset_availability(D.pixel_chunks(spark, sf), IM.preset_bands(spark))


_CHANGE = """
change AS (
  SELECT field_id, row, col, v0, v1, v2, v1 - v0 AS d10, v2 - v1 AS d21, v2 - v0 AS d20 FROM (
    SELECT field_id, row, col, max(CASE WHEN time_idx = 0 THEN value END) AS v0,
           max(CASE WHEN time_idx = 1 THEN value END) AS v1, max(CASE WHEN time_idx = 2 THEN value END) AS v2
    FROM pixels WHERE band = 'B8A' GROUP BY field_id, row, col))"""


@query("change_detect", with_(S.PIXELS, _CHANGE) + "SELECT * FROM change")
def q_change_detect(spark, sf):
    return IM.change_detect(px(spark, sf))


@query("change_range", with_(S.PIXELS, _CHANGE) + """
SELECT field_id, least(min(v0), min(v1), min(v2)) AS vmin, greatest(max(v0), max(v1), max(v2)) AS vmax,
       greatest(max(abs(d10)), max(abs(d21)), max(abs(d20))) AS diff_max
FROM change GROUP BY field_id""")
def q_change_range(spark, sf):
    return IM.change_range(IM.change_detect(px(spark, sf)))


@query("change_lag", with_(S.PIXELS) + """
SELECT * FROM (
  SELECT *, value - lag(value) OVER (PARTITION BY field_id, band, row, col ORDER BY time_idx) AS diff_prev
  FROM pixels) WHERE diff_prev IS NOT NULL""")
def q_change_lag(spark, sf):
    return IM.change_lag(px(spark, sf))


@query("stack_status", with_(S.PIXELS, STACK_STATUS) + "SELECT * FROM stack_status")
def q_stack_status(spark, sf):
    return AS.stack_status(px(spark, sf))


@query("stack_assemble", with_(S.PIXELS, STACK_STATUS, STACK) + "SELECT * FROM stack")
def q_stack_assemble(spark, sf):
    return AS.assemble_from_chunks(D.pixel_chunks(spark, sf), D.CHUNK)


@query("stack_named_periods", with_(S.PIXELS) + _pivot_sql(_PERIOD_COND, "pixels"))
def q_stack_named_periods(spark, sf):
    return AS.assemble_named_periods(D.pixel_chunks(spark, sf), PERIODS)


@query("clip_pixels", with_(S.PIXELS) + """
SELECT field_id, time_idx, band, row - 1 AS row, col - 1 AS col, value FROM pixels
WHERE row BETWEEN 1 AND 6 AND col BETWEEN 1 AND 6""")
def q_clip_pixels(spark, sf):
    return AS.clip_window(px(spark, sf), 1, 6, 1, 6)


@query("training_rows", with_(S.PIXELS, STACK_STATUS, STACK, S.FIELDS, S.VALID_FIELDS) + f"""
SELECT s.field_id, s.row, s.col, f.class,
       array_to_string([{", ".join("s." + x for x in LABELS)}], ',') AS features
FROM stack s JOIN valid_fields f ON s.field_id = f.polygon_number""")
def q_training_rows(spark, sf):
    return AS.training_rows(AS.assemble_from_chunks(D.pixel_chunks(spark, sf), D.CHUNK), valid_fields(spark, sf), as_array=False)


@query("grid_check", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + """
SELECT p.polygon_number, count(*) AS n_dates, count(DISTINCT g.tile) AS n_tiles,
       count(DISTINCT CAST(floor((g.west / 1000000.0 + 180) / 6) % 60 + 1 AS INTEGER)) AS n_zones,
       CASE WHEN count(DISTINCT g.tile) = 1 THEN 'OK' ELSE 'GRID_MISMATCH' END AS status
FROM picks p JOIN granules g USING (granule_key) GROUP BY p.polygon_number""")
def q_grid_check(spark, sf):
    from fieldstack.functions.geo import utm_zone
    return AS.grid_check(picks(spark, sf), D.granules(spark, sf),
                         utm_zone(F.col("west") / D.UNITS_PER_DEGREE))


# ---- 5. field order, ledger, logs ---------------------------------------------------------

from fieldstack.functions.dates import date_spec, date_text  # noqa: E402
from fieldstack.operators import ledger as LG  # noqa: E402
from fieldstack.operators import logs as LO  # noqa: E402
from fieldstack.plans.requests import order_and_limit, split_fields  # noqa: E402

SHUFFLE_SQL = "((polygon_number % 2147483647) * 48271 + 42) % 2147483647"


@query("class_distribution", with_(S.FIELDS, S.VALID_FIELDS)
       + "SELECT class, count(*) AS n FROM valid_fields GROUP BY class")
def q_class_distribution(spark, sf):
    return valid_fields(spark, sf).groupBy("class").agg(F.count("*").alias("n"))


@query("fields_order_limit", with_(S.FIELDS, S.VALID_FIELDS)
       + "SELECT * FROM valid_fields ORDER BY input_pos DESC LIMIT 100")
def q_fields_order_limit(spark, sf):
    return order_and_limit(valid_fields(spark, sf), "backward", 100)


@query("fields_sample", with_(S.FIELDS, S.VALID_FIELDS)
       + f"SELECT * FROM valid_fields ORDER BY {SHUFFLE_SQL}, input_pos LIMIT 100")
def q_fields_sample(spark, sf):
    return order_and_limit(valid_fields(spark, sf), "random", 100, seed=42)


@query("fields_split", with_(S.FIELDS, S.VALID_FIELDS)
       + f"SELECT *, CAST({SHUFFLE_SQL} % 2 AS INTEGER) AS part FROM valid_fields")
def q_fields_split(spark, sf):
    return split_fields(valid_fields(spark, sf), 2)


def ledger(spark, sf):
    return D.runs(spark, sf)


@query("run_ledger", with_(S.RUNS) + "SELECT * FROM runs")
def q_run_ledger(spark, sf):
    finished = F.coalesce(F.col("status").isin("SUCCESS", "SKIPPED"), F.lit(False))
    return LG.ledger_union(ledger(spark, sf).where(finished), ledger(spark, sf).where(~finished))


@query("run_summary", with_(S.RUNS) + """
SELECT batch_id, total, processed, success, skipped, failed, total_cs,
       CASE WHEN processed <> 0 THEN CAST(floor(((success + skipped) * 1000 * 2 + processed) / (processed * 2.0)) AS BIGINT) / 10.0 END AS success_rate_pct,
       CASE WHEN processed <> 0 THEN CAST(floor(total_cs / processed) AS BIGINT) END AS avg_cs,
       CASE WHEN total_cs <> 0 THEN CAST(floor((processed * 3600000 * 2 + total_cs) / (total_cs * 2.0)) AS BIGINT) / 10.0 END AS fields_per_hour
FROM (SELECT batch_id, count(*) AS total, CAST(count_if(status <> 'ERROR') AS BIGINT) AS processed,
             CAST(count_if(status = 'SUCCESS') AS BIGINT) AS success,
             CAST(count_if(status = 'SKIPPED') AS BIGINT) AS skipped,
             CAST(count_if(status IN ('FAILED', 'ERROR')) AS BIGINT) AS failed,
             CAST(sum(duration_cs) AS BIGINT) AS total_cs
      FROM runs GROUP BY batch_id)""")
def q_run_summary(spark, sf):
    return LG.run_summary(ledger(spark, sf))


def _eta_sql(r: str) -> str:
    def tenths(t):
        return f"CAST(CAST(floor(({t}) / 10) AS BIGINT) AS VARCHAR) || '.' || CAST(({t}) % 10 AS VARCHAR)"
    tm = f"CAST(floor(({r} + 300) / 600) AS BIGINT)"
    th = f"CAST(floor(({r} + 18000) / 36000) AS BIGINT)"
    return (f"CASE WHEN {r} IS NULL THEN 'calculating...' "
            f"WHEN {r} < 6000 THEN CAST(CAST(floor(({r} + 50) / 100) AS BIGINT) AS VARCHAR) || 's' "
            f"WHEN {r} < 360000 THEN {tenths(tm)} || 'm' ELSE {tenths(th)} || 'h' END")


@query("run_progress", with_(S.RUNS) + f"""
, prog AS (
  SELECT batch_id, polygon_number, status, ts, event_id,
         CAST(count(*) OVER w AS BIGINT) AS seq,
         CAST(sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_success,
         CAST(sum(CASE WHEN status IN ('FAILED', 'ERROR') THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_failed,
         CAST(sum(CASE WHEN status = 'SKIPPED' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_skipped,
         CAST(sum(duration_cs) OVER w AS BIGINT) AS elapsed_cs,
         CAST(count(*) OVER (PARTITION BY batch_id) AS BIGINT) AS total
  FROM runs WINDOW w AS (PARTITION BY batch_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
prog2 AS (SELECT *, CAST(floor(elapsed_cs * (total - seq) / seq) AS BIGINT) AS remaining_cs FROM prog)
SELECT batch_id, seq, polygon_number, status, n_success, n_failed, n_skipped, total,
       CAST(floor((seq * 1000 * 2 + total) / (total * 2.0)) AS BIGINT) / 10.0 AS pct_done,
       elapsed_cs, remaining_cs, {_eta_sql("remaining_cs")} AS eta
FROM prog2""".replace("\n, prog AS", ", prog AS", 1))
def q_run_progress(spark, sf):
    return LG.run_progress(ledger(spark, sf))


@query("run_report_top", with_(S.RUNS) + """
, x AS (SELECT *, CASE WHEN status IN ('FAILED', 'ERROR') THEN 'failed' ELSE 'successful' END AS list FROM runs),
r AS (SELECT *, row_number() OVER (PARTITION BY batch_id, list ORDER BY ts, event_id) AS rank,
             count(*) OVER (PARTITION BY batch_id, list) AS n_list FROM x)
SELECT batch_id, list, rank, polygon_number, message, greatest(n_list - 10, 0) AS n_more
FROM r WHERE rank <= 10""".replace("\n, x AS", ", x AS", 1))
def q_run_report_top(spark, sf):
    return LG.report_top(ledger(spark, sf))


def run_outputs(spark, sf):
    """The ledger with the outputs it is about: an even event's run did the field's dates, an odd one's another season."""
    other = F.concat_ws("_", F.col("polygon_number").cast("string"), F.lit("1990-01-01"), F.lit("1990-06-30"))
    named = requests(spark, sf).select("polygon_number", "output_id")
    return (ledger(spark, sf).join(named, "polygon_number")
            .withColumn("output_id", F.when(F.col("event_id") % 2 == 0, F.col("output_id")).otherwise(other)))


RESUME_SQL = """FROM requests q
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.polygon_number = q.polygon_number AND r.event_id % 2 = 0
                  AND r.status IN ('SUCCESS', 'SKIPPED'))"""


@query("resume_antijoin", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS, S.RUNS) + "SELECT * " + RESUME_SQL)
def q_resume_antijoin(spark, sf):
    return LG.resume_pending(requests(spark, sf), run_outputs(spark, sf))


@query("duplicate_fields", with_(S.RUNS) + """
SELECT *, CASE WHEN coalesce(bool_or(status IN ('SUCCESS', 'SKIPPED')) OVER (
                  PARTITION BY batch_id, polygon_number ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
               THEN 'SKIPPED' ELSE status END AS effective_status
FROM runs""")
def q_duplicate_fields(spark, sf):
    return LG.resolve_duplicates(ledger(spark, sf))


def log_lines(spark, sf):
    return D.log_lines(spark, sf)


LOG_ORDER = ["pos_a", "pos_b", "pos_c"]


def log_records(spark, sf):
    return LO.parse_records(log_lines(spark, sf), LOG_ORDER, F.date_trunc("minute", F.col("pos_a")))


LOG_RECORDS = """
log_records AS (
  SELECT 'run.log' AS file, date_trunc('millisecond', ts) AS ts, event_id,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
         event_type || ' field ' || CAST(user_id AS VARCHAR) AS message,
         CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS n_lines, ts AS ts_full
  FROM events)"""


@query("log_parse", with_(LOG_RECORDS) + "SELECT file, ts, level, message, CAST(n_lines AS BIGINT) AS n_lines FROM log_records")
def q_log_parse(spark, sf):
    return log_records(spark, sf).select("file", "ts", "level", "message", "n_lines")


@query("log_levels", """
SELECT level, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level FROM events
  UNION ALL SELECT 'other' FROM events WHERE event_id % 10 = 0) GROUP BY level""")
def q_log_levels(spark, sf):
    return LO.level_counts(log_lines(spark, sf))


@query("log_steps", with_(LOG_RECORDS) + """
SELECT file, ts, level, message,
       date_diff('millisecond', ts, lead(ts) OVER (ORDER BY ts_full, event_id)) AS step_ms
FROM log_records""")
def q_log_steps(spark, sf):
    rec = log_records(spark, sf)
    steps = LO.record_steps(rec, F.date_trunc("minute", F.col("record_key.pos_a")))
    return steps.select("file", "ts", "level", "message", "step_ms")


@query("log_attempts", with_(LOG_RECORDS) + """
SELECT CAST(regexp_extract(message, 'field (\\d+)$', 1) AS BIGINT) AS polygon_number, count(*) AS n_records,
       CAST(count_if(level = 'ERROR') AS BIGINT) AS n_errors, min(ts) AS first_ts, max(ts) AS last_ts
FROM log_records GROUP BY 1""")
def q_log_attempts(spark, sf):
    rec = log_records(spark, sf)
    return (rec.groupBy(F.regexp_extract("message", r"field (\d+)$", 1).cast("long").alias("polygon_number"))
               .agg(F.count("*").alias("n_records"), F.count_if(F.col("level") == "ERROR").alias("n_errors"),
                    F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


# error texts of every kind, dealt out by the event's number
FAILURE_TEXTS = ["Search timed out after 600 s", "No data found for the window", "No granules selected",
                 "Authentication failed", "start date lies in the future", "unexpected response"]


@query("failure_classify", with_(LOG_RECORDS) + f"""
, texts AS (SELECT ts, level, message || ': ' || {FAILURE_TEXTS!r}[CAST(event_id % 6 AS INTEGER) + 1] AS message
            FROM log_records WHERE level = 'ERROR'),
kinds AS (
SELECT ts, level, message,
       CASE WHEN strpos(lower(message), 'timed out') > 0 THEN 'TIMEOUT'
            WHEN strpos(message, 'No data found') > 0 OR strpos(message, 'No granules selected') > 0 THEN 'NO_DATA'
            WHEN strpos(message, 'Authentication failed') > 0 OR strpos(lower(message), 'authentication') > 0 THEN 'AUTH_FAILED'
            WHEN strpos(lower(message), 'future') > 0 AND strpos(lower(message), 'date') > 0 THEN 'FUTURE_DATE'
            ELSE 'OTHER' END AS kind
FROM texts)
SELECT *, kind IN ('NO_DATA', 'OTHER') AS retry FROM kinds""".replace("\n, texts AS", ", texts AS", 1))
def q_failure_classify(spark, sf):
    rec = log_records(spark, sf).where(F.col("level") == "ERROR")
    text = F.element_at(F.array(*map(F.lit, FAILURE_TEXTS)), (F.col("record_key.pos_b") % 6 + 1).cast("int"))
    return (rec.select("ts", "level", F.concat("message", F.lit(": "), text).alias("message"))
            .withColumn("kind", LG.classify_failure(F.col("message")))
            .withColumn("retry", LG.failure_retry(F.col("kind"))))


WINDOWS_LIST = [3, 7, 14, 30]


@query("search_attempts", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + """
SELECT CAST(tp.polygon_number AS VARCHAR) AS file, tp.time_idx, tp.t_date, CAST(coalesce(p.attempt, 4) AS BIGINT) AS n_attempts,
       coalesce(p.window_days, 30) AS last_window, p.window_days AS completed_window
FROM time_points tp LEFT JOIN picks p USING (polygon_number, time_idx)""")
def q_search_attempts(spark, sf):
    """The run log that each field's search writes (a file for each field), and what is read back from it."""
    st = SR.pick_status(time_points(spark, sf), picks(spark, sf))
    tried = F.slice(F.array(*map(F.lit, WINDOWS_LIST)), 1, F.coalesce("attempt", F.lit(4)))
    tp = F.concat(F.lit("t"), F.col("time_idx").cast("string"))

    def attempt(w, i):
        return F.concat(F.lit("   Attempt "), (i + 1).cast("string"), F.lit("/4: +-"), w.cast("string"), F.lit(" day window ("),
                        date_text(F.date_sub("t_date", w)), F.lit(","), date_text(F.date_add("t_date", w)), F.lit(")"))
    done = F.when(F.col("window_days").isNotNull(), F.array(F.concat(
        F.lit("Download completed for "), tp, F.lit(" with +-"), F.col("window_days").cast("string"), F.lit(" day window")))).otherwise(
        F.array(F.lit("giving up")))
    text = F.concat(F.array(F.concat(F.lit("Downloading data for "), tp, F.lit(": "), date_text(F.col("t_date")))),
                    F.transform(tried, attempt), done)
    lines = st.select(F.col("polygon_number").cast("string").alias("file"), F.col("time_idx").alias("pos_a"),
                      F.posexplode(text).alias("pos_b", "message"))
    lines = lines.select("file", "pos_a", "pos_b", F.lit(0).alias("pos_c"),
                         F.concat(F.lit("2025-01-01 10:00:00,000 - INFO - "), "message").alias("line"))
    rec = LO.parse_records(lines, LOG_ORDER, F.col("pos_a"))
    return LO.attempt_summary(rec, F.col("record_key.pos_a"))


# ---- 6. geometry, coordinate files, dates --------------------------------------------------

from fieldstack.functions import geo as GE  # noqa: E402
from fieldstack.operators import windows as WN  # noqa: E402
from fieldstack.session import checkpoint_dir, materialize  # noqa: E402
from fieldstack.operators import crop as CR  # noqa: E402
from fieldstack.operators import warp as WP  # noqa: E402
from fieldstack.plans.geo_sql import degree_bounds_cte, envelope_cte, lat_lon_sql, utm_xy_sql  # noqa: E402
from fieldstack.sources import regions as RG  # noqa: E402

PX = 30.0  # metres per pixel
DEG = float(D.UNITS_PER_DEGREE)


def _deg(c):
    return F.col(c) / DEG


def _box_deg(prefix=""):
    return F.struct(_deg(prefix + "west").alias("west"), _deg(prefix + "south").alias("south"),
                    _deg(prefix + "east").alias("east"), _deg(prefix + "north").alias("north"))


@query("bbox_normalize", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS) + """
SELECT polygon_number, least(a_lon, b_lon) AS west, least(a_lat, b_lat) AS south,
       greatest(a_lon, b_lon) AS east, greatest(a_lat, b_lat) AS north,
       CAST(string_split(txt, ',')[1] AS DOUBLE) AS t_west, CAST(string_split(txt, ',')[2] AS DOUBLE) AS t_south,
       CAST(string_split(txt, ',')[3] AS DOUBLE) AS t_east, CAST(string_split(txt, ',')[4] AS DOUBLE) AS t_north
FROM (SELECT polygon_number,
             CASE WHEN polygon_number % 2 = 1 THEN north ELSE south END AS a_lat,
             CASE WHEN polygon_number % 2 = 1 THEN east ELSE west END AS a_lon,
             CASE WHEN polygon_number % 2 = 1 THEN south ELSE north END AS b_lat,
             CASE WHEN polygon_number % 2 = 1 THEN west ELSE east END AS b_lon,
             CAST(west AS VARCHAR) || ', ' || CAST(south AS VARCHAR) || ',' || CAST(east AS VARCHAR) || ' ,' || CAST(north AS VARCHAR) AS txt
      FROM requests)""")
def q_bbox_normalize(spark, sf):
    r = requests(spark, sf)
    odd = F.col("polygon_number") % 2 == 1   # odd ids list their corners swapped (ne first)
    pick = lambda a, b: F.when(odd, F.col(a)).otherwise(F.col(b))
    box = GE.bbox_from_corners(pick("north", "south"), pick("east", "west"),
                               pick("south", "north"), pick("west", "east"))
    txt = F.concat(F.col("west").cast("string"), F.lit(", "), F.col("south").cast("string"), F.lit(","),
                   F.col("east").cast("string"), F.lit(" ,"), F.col("north").cast("string"))
    t = GE.bbox_from_text(txt)
    return r.select("polygon_number", box.west.alias("west"), box.south.alias("south"),
                    box.east.alias("east"), box.north.alias("north"),
                    t.west.alias("t_west"), t.south.alias("t_south"), t.east.alias("t_east"),
                    t.north.alias("t_north"))


def utm_envelopes(spark, sf):
    r = requests(spark, sf).where(F.col("status") == "OK").select(
        "polygon_number", "west", "south", "east", "north", GE.utm_zone(_deg("lon")).alias("zone"))
    r = r.repartition(*r.columns)      # a field's row is small and its projection long: few scan splits would be few tasks
    return GE.with_envelope(r, _deg("west"), _deg("south"), _deg("east"), _deg("north"), F.col("zone"), "env")


@query("bbox_to_utm", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS) + """
, src AS (SELECT polygon_number, west / 1000000.0 AS w, south / 1000000.0 AS s, east / 1000000.0 AS e,
                 north / 1000000.0 AS n, CAST(floor((lon / 1000000.0 + 180) / 6) % 60 + 1 AS INTEGER) AS zone
          FROM requests WHERE status = 'OK'),
""" + envelope_cte("env", "src", ["polygon_number", "zone"]) + """
SELECT polygon_number, zone, round(minx, 2) AS minx, round(miny, 2) AS miny, round(maxx, 2) AS maxx,
       round(maxy, 2) AS maxy, CAST(trunc((maxx - minx) / 30.0) AS INTEGER) AS width_px,
       CAST(trunc((maxy - miny) / 30.0) AS INTEGER) AS height_px
FROM env""".replace("\n, src AS", ", src AS", 1))
def q_bbox_to_utm(spark, sf):
    e = utm_envelopes(spark, sf)
    return e.select("polygon_number", "zone",
                    F.round("env.minx", 2).alias("minx"), F.round("env.miny", 2).alias("miny"),
                    F.round("env.maxx", 2).alias("maxx"), F.round("env.maxy", 2).alias("maxy"),
                    ((F.col("env.maxx") - F.col("env.minx")) / PX).cast("int").alias("width_px"),
                    ((F.col("env.maxy") - F.col("env.miny")) / PX).cast("int").alias("height_px"))


def pixel_windows(spark, sf, px=PX):
    """For every pick: the field box as a pixel window of the picked granule's raster."""
    grids = WN.granule_grids(D.granules(spark, sf), px, D.UNITS_PER_DEGREE)
    return WN.field_windows(picks(spark, sf), grids, requests(spark, sf), px, D.UNITS_PER_DEGREE)


@query("pixel_window", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + """
, j AS (SELECT p.polygon_number, p.time_idx, p.granule_key,
               CAST(floor(((g.west + g.east) / 2 / 1000000.0 + 180) / 6) % 60 + 1 AS INTEGER) AS zone,
               g.west / 1000000.0 AS gw, g.south / 1000000.0 AS gs, g.east / 1000000.0 AS ge, g.north / 1000000.0 AS gn,
               q.west / 1000000.0 AS fw, q.south / 1000000.0 AS fs, q.east / 1000000.0 AS fe, q.north / 1000000.0 AS fn
        FROM picks p JOIN granules g USING (granule_key) JOIN requests q USING (polygon_number)),
gsrc AS (SELECT polygon_number, time_idx, granule_key, zone, gw AS w, gs AS s, ge AS e, gn AS n FROM j),
fsrc AS (SELECT polygon_number, time_idx, granule_key, zone, fw AS w, fs AS s, fe AS e, fn AS n FROM j),
""" + envelope_cte("genv", "gsrc", ["polygon_number", "time_idx", "granule_key", "zone"]) + ",\n"
       + envelope_cte("fenv", "fsrc", ["polygon_number", "time_idx", "granule_key", "zone"]) + """,
w AS (SELECT f.*, floor(g.minx / 30.0) * 30.0 AS x0, ceil(g.maxy / 30.0) * 30.0 AS y0,
             ceil(g.maxx / 30.0) * 30.0 AS x1, floor(g.miny / 30.0) * 30.0 AS y1
      FROM fenv f JOIN genv g USING (polygon_number, time_idx, granule_key, zone))
SELECT polygon_number, time_idx, granule_key, zone, round((minx - x0) / 30.0, 2) AS col_off,
       round((y0 - maxy) / 30.0, 2) AS row_off, CAST(trunc((maxx - minx) / 30.0) AS INTEGER) AS out_width,
       CAST(trunc((maxy - miny) / 30.0) AS INTEGER) AS out_height,
       CASE WHEN maxx <= x0 OR minx >= x1 OR maxy <= y1 OR miny >= y0 THEN 'OUTSIDE'
            WHEN trunc((maxx - minx) / 30.0) <= 0 OR trunc((maxy - miny) / 30.0) <= 0 THEN 'EMPTY'
            WHEN minx < x0 OR maxx > x1 OR miny < y1 OR maxy > y0 THEN 'PARTIAL' ELSE 'OK' END AS status
FROM w""".replace("\n, j AS", ", j AS", 1))
def q_pixel_window(spark, sf):
    return pixel_windows(spark, sf).select(
        "polygon_number", "time_idx", "granule_key", "zone", F.round("col_off", 2).alias("col_off"),
        F.round("row_off", 2).alias("row_off"), "out_width", "out_height", "status")


# fields clipped out of coarse rasters (a pixel of 3 km, 6 x 6 chunks of 8 x 8 pixels), from the window to the stack
COARSE = 3000.0
WINDOWS_SQL = """
j AS (SELECT p.polygon_number, p.time_idx, p.granule_key,
             CAST(floor(((g.west + g.east) / 2 / 1000000.0 + 180) / 6) % 60 + 1 AS INTEGER) AS zone,
             g.west / 1000000.0 AS gw, g.south / 1000000.0 AS gs, g.east / 1000000.0 AS ge, g.north / 1000000.0 AS gn,
             q.west / 1000000.0 AS fw, q.south / 1000000.0 AS fs, q.east / 1000000.0 AS fe, q.north / 1000000.0 AS fn
      FROM picks p JOIN granules g USING (granule_key) JOIN requests q USING (polygon_number)),
gsrc AS (SELECT polygon_number, time_idx, granule_key, zone, gw AS w, gs AS s, ge AS e, gn AS n FROM j),
fsrc AS (SELECT polygon_number, time_idx, granule_key, zone, fw AS w, fs AS s, fe AS e, fn AS n FROM j),
""" + envelope_cte("genv", "gsrc", ["polygon_number", "time_idx", "granule_key", "zone"]) + ",\n" + envelope_cte(
    "fenv", "fsrc", ["polygon_number", "time_idx", "granule_key", "zone"]) + f""",
w0 AS (SELECT f.*, floor(g.minx / {COARSE}) * {COARSE} AS x0, ceil(g.maxy / {COARSE}) * {COARSE} AS y0,
              ceil(g.maxx / {COARSE}) * {COARSE} AS x1, floor(g.miny / {COARSE}) * {COARSE} AS y1
       FROM fenv f JOIN genv g USING (polygon_number, time_idx, granule_key, zone)),
w AS (SELECT *, (minx - x0) / {COARSE} AS col_off, (y0 - maxy) / {COARSE} AS row_off, (maxx - minx) / {COARSE} AS width,
             (maxy - miny) / {COARSE} AS height, CAST(trunc((maxx - minx) / {COARSE}) AS INTEGER) AS ow,
             CAST(trunc((maxy - miny) / {COARSE}) AS INTEGER) AS oh,
             CASE WHEN maxx <= x0 OR minx >= x1 OR maxy <= y1 OR miny >= y0 THEN 1
                  WHEN trunc((maxx - minx) / {COARSE}) <= 0 OR trunc((maxy - miny) / {COARSE}) <= 0 THEN 2
                  WHEN minx < x0 OR maxx > x1 OR miny < y1 OR maxy > y0 THEN 3 ELSE 4 END AS worst
      FROM w0),
gridded AS (SELECT polygon_number, count(*) AS n_dates, count(DISTINCT (zone, x0, y0, x1, y1)) AS n_grids,
                   CASE WHEN count(DISTINCT (zone, x0, y0, x1, y1)) > 1 THEN 'GRID_MISMATCH'
                        ELSE ['OUTSIDE', 'EMPTY', 'PARTIAL', 'OK'][min(worst)] END AS status
            FROM w GROUP BY polygon_number)"""


@query("field_grid_status", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, WINDOWS_SQL) + "SELECT * FROM gridded")
def q_field_grid_status(spark, sf):
    return WN.grid_status(pixel_windows(spark, sf, COARSE))


_FIELD_COND = ",\n  ".join(f"max(CASE WHEN time_idx = {t} AND band = '{b}' THEN value END) AS t{t}_{b}" for t in range(3) for b in BANDS)


@query("field_stack", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, WINDOWS_SQL) + f"""
, have AS (SELECT DISTINCT granule_key, band FROM granule_files WHERE band IN ({", ".join(f"'{b}'" for b in BANDS)})),
cells AS (
  SELECT w.polygon_number, w.time_idx, have.band, r.i AS row, c.i AS col,
         CAST(floor(w.row_off + (r.i + 0.5) * (w.height / w.oh)) AS BIGINT) AS sr,
         CAST(floor(w.col_off + (c.i + 0.5) * (w.width / w.ow)) AS BIGINT) AS sc, w.granule_key
  FROM w JOIN gridded g ON g.polygon_number = w.polygon_number AND g.status IN ('OK', 'PARTIAL')
  JOIN have ON have.granule_key = w.granule_key
  JOIN range(0, 40) AS r(i) ON r.i < w.oh JOIN range(0, 40) AS c(i) ON c.i < w.ow),
vals AS (
  SELECT cells.*, CAST(floor(CAST(e.embedding[(sr % 8) * 8 + sc % 8 + 1] AS DOUBLE) * 1000) AS INTEGER) + 1000 AS raw
  FROM cells JOIN embeddings e ON sr BETWEEN 0 AND 47 AND sc BETWEEN 0 AND 47 AND e.vec_id =
    ((granule_key * 6 + list_position(['B02','B03','B04','B8A','B11','B12'], band) - 1) * 36 + (sr // 8) * 6 + sc // 8) % (SELECT count(*) FROM embeddings))
SELECT polygon_number, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  {_FIELD_COND}
FROM (SELECT *, greatest(0, least(65535, raw)) AS value FROM vals) GROUP BY ALL""".replace("\n, have AS", ", have AS", 1))
def q_field_stack(spark, sf):
    win = materialize(pixel_windows(spark, sf, COARSE))     # used three times
    good = WN.grid_status(win).where(F.col("status").isin("OK", "PARTIAL", "FULL_EXTENT")).select("polygon_number")
    win = win.join(good, "polygon_number", "left_semi")
    return AS.field_stacks(win, D.raster_chunks(spark, sf, win), D.CHUNK)


_REF = ("zone", "x0", "y0", "col_off", "row_off", "width", "height", "ow", "oh")
_LAT, _LON = lat_lon_sql("x", "y", "r_zone")
_SX, _SY = utm_xy_sql("lat", "lon", "zone")


@query("field_stack_warped", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, WINDOWS_SQL) + f"""
, first_date AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY polygon_number ORDER BY time_idx) = 1),
dates AS (SELECT w.polygon_number, w.time_idx, w.granule_key, w.zone, w.x0, w.y0, w.x1, w.y1, {", ".join(f"f.{c} AS r_{c}" for c in _REF)}
          FROM w JOIN first_date f USING (polygon_number) JOIN gridded g USING (polygon_number)
          WHERE g.status = 'GRID_MISMATCH' AND f.worst IN (3, 4)),
places AS (SELECT dates.*, r.i AS row, c.i AS col, r_x0 + (r_col_off + (c.i + 0.5) * (r_width / r_ow)) * {COARSE} AS x,
                  r_y0 - (r_row_off + (r.i + 0.5) * (r_height / r_oh)) * {COARSE} AS y
           FROM dates JOIN range(0, 40) AS r(i) ON r.i < r_oh JOIN range(0, 40) AS c(i) ON c.i < r_ow),
degrees_ AS (SELECT *, {_LAT} AS lat, {_LON} AS lon FROM places),
metres AS (SELECT *, CASE WHEN zone = r_zone THEN x ELSE {_SX} END AS sx, CASE WHEN zone = r_zone THEN y ELSE {_SY} END AS sy FROM degrees_),
src AS (SELECT *, CAST(floor((sx - x0) / {COARSE}) AS BIGINT) AS sc, CAST(floor((y0 - sy) / {COARSE}) AS BIGINT) AS sr,
               CAST(round((x1 - x0) / {COARSE}) AS BIGINT) AS nc, CAST(round((y0 - y1) / {COARSE}) AS BIGINT) AS nr FROM metres),
cut AS (SELECT *, sc >= 0 AND sc < nc AND sr >= 0 AND sr < nr AND sc < 48 AND sr < 48
                  AND granule_key IN (SELECT granule_key FROM granule_files WHERE band <> 'Fmask') AS inside FROM src),
by_band AS (SELECT cut.*, b.band, list_position(['B02','B03','B04','B8A','B11','B12'], b.band) - 1 AS bi
           FROM cut CROSS JOIN (SELECT unnest(['B02','B03','B04','B8A','B11','B12']) AS band) b),
have AS (SELECT DISTINCT granule_key, band FROM granule_files),
vals AS (SELECT b.*, CASE WHEN NOT inside THEN 0 WHEN h.band IS NOT NULL THEN greatest(0, least(65535,
                CAST(floor(CAST(e.embedding[(sr % 8) * 8 + sc % 8 + 1] AS DOUBLE) * 1000) AS INTEGER) + 1000)) END AS value
         FROM by_band b LEFT JOIN have h ON h.granule_key = b.granule_key AND h.band = b.band
         LEFT JOIN embeddings e ON b.inside AND e.vec_id =
           ((b.granule_key * 6 + b.bi) * 36 + (sr // 8) * 6 + sc // 8) % (SELECT count(*) FROM embeddings))
SELECT polygon_number, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
  {_FIELD_COND}
FROM vals GROUP BY ALL""")
def q_field_stack_warped(spark, sf):
    """Fields whose dates lie on different grids, assembled on the first date's."""
    win = materialize(pixel_windows(spark, sf, COARSE))     # used three times
    mixed = WN.grid_status(win).where(F.col("status") == "GRID_MISMATCH").select("polygon_number")
    win = win.join(mixed, "polygon_number", "left_semi")
    return WP.warped_stacks(win, D.raster_chunks(spark, sf, win), COARSE, D.CHUNK)


GRIDS_SQL = """
footprints AS (SELECT DISTINCT west, south, east, north, CAST(floor(((west + east) / 2 / 1000000.0 + 180) / 6) % 60 + 1 AS INTEGER) AS zone
               FROM granules),
fsides AS (SELECT *, west / 1000000.0 AS w, south / 1000000.0 AS s, east / 1000000.0 AS e, north / 1000000.0 AS n FROM footprints),
""" + envelope_cte("footenv", "fsides", ["west", "south", "east", "north", "zone"]) + """,
grids AS (SELECT g.granule_key, g.tile, v.zone, floor(minx / {px}) * {px} AS x0, ceil(maxy / {px}) * {px} AS y0, ceil(maxx / {px}) * {px} AS x1,
                 floor(miny / {px}) * {px} AS y1 FROM granules g JOIN footenv v USING (west, south, east, north))"""


@query("raster_bounds", with_(S.GRANULES, GRIDS_SQL.replace("{px}", str(PX))) + """
, shapes AS (SELECT DISTINCT zone, x0, y0, x1, y1 FROM grids),
""" + degree_bounds_cte("deg", "shapes") + """
SELECT g.granule_key, g.tile, zone, round(d.west, 6) AS west, round(d.south, 6) AS south, round(d.east, 6) AS east,
       round(d.north, 6) AS north
FROM grids g JOIN deg d USING (zone, x0, y0, x1, y1)""")
def q_raster_bounds(spark, sf):
    bounds = WN.raster_bounds(D.granules(spark, sf), PX, D.UNITS_PER_DEGREE)
    return bounds.select("granule_key", "tile", "zone", *[F.round(c, 6).alias(c) for c in WN.BOX])


@query("full_extent_window", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, WINDOWS_SQL) + """
SELECT w.polygon_number, w.time_idx, w.granule_key, w.zone,
       CASE WHEN r.class = 'Unknown' THEN 0.0 ELSE round(w.col_off, 2) + 0.0 END AS col_off,
       CASE WHEN r.class = 'Unknown' THEN 0.0 ELSE round(w.row_off, 2) + 0.0 END AS row_off,
       CASE WHEN r.class = 'Unknown' THEN CAST(round((x1 - x0) / 3000.0) AS INTEGER) ELSE ow END AS out_width,
       CASE WHEN r.class = 'Unknown' THEN CAST(round((y0 - y1) / 3000.0) AS INTEGER) ELSE oh END AS out_height,
       CASE WHEN r.class = 'Unknown' THEN 'FULL_EXTENT' ELSE ['OUTSIDE', 'EMPTY', 'PARTIAL', 'OK'][worst] END AS status
FROM w JOIN requests r USING (polygon_number)""")
def q_full_extent_window(spark, sf):
    """Fields without a class have lost their box (fixture choice): their rasters are taken whole."""
    grids = WN.granule_grids(D.granules(spark, sf), COARSE, D.UNITS_PER_DEGREE)
    boxes = requests(spark, sf).select("polygon_number", *[F.when(F.col("class") != "Unknown", F.col(c)).alias(c) for c in WN.BOX])
    return WN.field_windows(picks(spark, sf), grids, boxes, COARSE, D.UNITS_PER_DEGREE).select(
        "polygon_number", "time_idx", "granule_key", "zone", F.round("col_off", 2).alias("col_off"),
        F.round("row_off", 2).alias("row_off"), "out_width", "out_height", "status")


def _corners_sql():
    out = []
    for i, (lat, lon) in enumerate((("south", "west"), ("south", "east"), ("north", "east"), ("north", "west"))):
        x, y = utm_xy_sql(f"r.{lat} / 1000000.0", f"r.{lon} / 1000000.0", "g.zone")
        out.append(f"{x} AS px{i}, {y} AS py{i}")
    return ", ".join(out)


_SIDES = [(i, (i + 1) % 4) for i in range(4)]     # counterclockwise, so the inside is on the left of each
_INSIDE = " AND ".join(f"(px{j} - px{i}) * (cy - py{i}) - (py{j} - py{i}) * (cx - px{i}) >= 0" for i, j in _SIDES)


@query("clip_geometry", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, GRIDS_SQL.replace("{px}", str(COARSE))) + f"""
, poly AS (SELECT p.polygon_number, p.time_idx, p.granule_key, g.x0, g.y0, g.x1, g.y1, {_corners_sql()}
         FROM picks p JOIN grids g USING (granule_key) JOIN requests r USING (polygon_number)),
outline AS (SELECT *, greatest(0, CAST(floor((y0 - greatest(py0, py1, py2, py3)) / {COARSE}) AS BIGINT)) AS r0,
               least(CAST(ceil((y0 - least(py0, py1, py2, py3)) / {COARSE}) AS BIGINT), CAST(round((y0 - y1) / {COARSE}) AS BIGINT)) AS r1,
               greatest(0, CAST(floor((least(px0, px1, px2, px3) - x0) / {COARSE}) AS BIGINT)) AS c0,
               least(CAST(ceil((greatest(px0, px1, px2, px3) - x0) / {COARSE}) AS BIGINT), CAST(round((x1 - x0) / {COARSE}) AS BIGINT)) AS c1
        FROM poly),
have AS (SELECT DISTINCT granule_key, band FROM granule_files WHERE band IN ({", ".join(f"'{b}'" for b in BANDS)})),
cells AS (SELECT outline.*, have.band, r.i AS r, c.i AS c, x0 + (c.i + 0.5) * {COARSE} AS cx, y0 - (r.i + 0.5) * {COARSE} AS cy
          FROM outline JOIN have USING (granule_key) JOIN range(0, 48) AS r(i) ON r.i >= r0 AND r.i < r1
          JOIN range(0, 48) AS c(i) ON c.i >= c0 AND c.i < c1),
vals AS (SELECT cells.*, {_INSIDE} AS inside,
                CAST(floor(CAST(e.embedding[(r % 8) * 8 + c % 8 + 1] AS DOUBLE) * 1000) AS INTEGER) + 1000 AS raw
         FROM cells JOIN embeddings e ON e.vec_id =
           ((granule_key * 6 + list_position(['B02','B03','B04','B8A','B11','B12'], band) - 1) * 36 + (r // 8) * 6 + c // 8)
           % (SELECT count(*) FROM embeddings))
SELECT polygon_number, time_idx, band, r1 - r0 AS height, c1 - c0 AS width, count(*) AS n_pixels,
       count(*) FILTER (inside) AS n_inside,
       CAST(sum(CASE WHEN inside THEN raw * ((r - r0) * (c1 - c0) + c - c0 + 1) ELSE 0 END) AS BIGINT) AS checksum
FROM vals GROUP BY ALL""")
def q_clip_geometry(spark, sf):
    """Every picked raster cropped by its field's box: size of the crop, pixels inside, and their values weighted by their place."""
    grids = WN.granule_grids(D.granules(spark, sf), COARSE, D.UNITS_PER_DEGREE)
    poly = materialize(WN.field_polygons(picks(spark, sf), grids, requests(spark, sf), D.UNITS_PER_DEGREE))     # used twice
    pixels = CR.clip_geometry(poly, D.raster_chunks(spark, sf, poly), D.CHUNK, COARSE, ["polygon_number", "time_idx"])
    place = F.col("row") * F.col("width") + F.col("col") + 1
    return pixels.groupBy("polygon_number", "time_idx", "band", "height", "width").agg(
        F.count("*").alias("n_pixels"), F.count_if("inside").alias("n_inside"), F.sum(F.col("value") * place).alias("checksum"))


def _deg_txt(c):
    """micro-degrees -> exact decimal text with six places."""
    return (F.col(c) / F.lit(DEG)).cast("decimal(12,6)").cast("string")


def region_text(spark, sf):
    r = requests(spark, sf)
    return RG.region_lines(r, "polygon_number", {"sw_lat": _deg_txt("south"), "sw_lon": _deg_txt("west"),
                                                 "ne_lat": _deg_txt("north"), "ne_lon": _deg_txt("east")})


_DEG_TXT = "CAST(CAST({c} AS DECIMAL(18,0)) / 1000000 AS DECIMAL(12,6))"


# files as people write them: a corner corrected further down, a corner left out, comments alone
@query("regions_parse", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS) + f"""
, c AS (SELECT polygon_number, polygon_number % 13 = 0 AS bare, polygon_number % 11 = 0 AS half,
               CAST(CAST({_DEG_TXT.format(c="south")} AS VARCHAR) AS DOUBLE) AS s, CAST(CAST({_DEG_TXT.format(c="west")} AS VARCHAR) AS DOUBLE) AS w,
               CAST(CAST({_DEG_TXT.format(c="north")} AS VARCHAR) AS DOUBLE) AS n, CAST(CAST({_DEG_TXT.format(c="east")} AS VARCHAR) AS DOUBLE) AS e
        FROM requests)
SELECT CAST(polygon_number AS VARCHAR) AS region, CASE WHEN NOT bare THEN s END AS sw_lat, CASE WHEN NOT bare THEN w END AS sw_lon,
       CASE WHEN NOT bare AND NOT half THEN n END AS ne_lat, CASE WHEN NOT bare AND NOT half THEN e END AS ne_lon,
       CASE WHEN bare OR half THEN 'MISSING_CORNER' ELSE 'OK' END AS status
FROM c""".replace("\n, c AS", ", c AS", 1))
def q_regions_parse(spark, sf):
    lines = region_text(spark, sf)
    wrong = lines.where("pos = 1 and region % 7 = 0").withColumns({"pos": F.lit(-1), "line": F.lit("sw 1.5,-2.5")})
    kept = lines.where("not (region % 13 = 0 and pos > 0) and not (region % 11 = 0 and pos = 2)").unionByName(
        wrong.where("region % 13 <> 0"))
    return RG.parse_regions(kept.withColumn("region", F.col("region").cast("string")))


@query("regions_roundtrip", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS)
       + "SELECT polygon_number, true AS roundtrip_ok FROM requests")
def q_regions_roundtrip(spark, sf):
    parsed = RG.parse_regions(region_text(spark, sf)).withColumnRenamed("region", "polygon_number")
    back = lambda c: F.round(F.col(c) * DEG).cast("long")
    j = requests(spark, sf).join(parsed, "polygon_number", "left")
    ok = ((back("sw_lat") == F.col("south")) & (back("sw_lon") == F.col("west"))
          & (back("ne_lat") == F.col("north")) & (back("ne_lon") == F.col("east")))
    return j.select("polygon_number", F.coalesce(ok, F.lit(False)).alias("roundtrip_ok"))


@query("date_spec", with_(*BASE[:4]) + """
SELECT polygon_number, time_idx, 'range' AS kind, strftime(t_date - 3, '%Y-%m-%d') || ', ' || strftime(t_date + 3, '%Y-%m-%d') AS spec,
       t_date - 3 AS start, t_date + 3 AS "end" FROM time_points
UNION ALL
SELECT polygon_number, time_idx, 'single', strftime(t_date, '%Y-%m-%d'), t_date, t_date FROM time_points""")
def q_date_spec(spark, sf):
    tp = time_points(spark, sf)
    rng = tp.select("polygon_number", "time_idx", F.lit("range").alias("kind"),
                    F.concat(date_text(F.date_sub("t_date", 3)), F.lit(", "),
                             date_text(F.date_add("t_date", 3))).alias("spec"))
    one = tp.select("polygon_number", "time_idx", F.lit("single").alias("kind"),
                    date_text(F.col("t_date")).alias("spec"))
    x = rng.unionByName(one)
    d = date_spec(F.col("spec"))
    return x.select("polygon_number", "time_idx", "kind", "spec", d.start.alias("start"), d.end.alias("end"))


# ---- 7. search guards, selection, banded window, file listings -----------------------------

GUARD_WINDOW = 14


def alike(spark, sf):
    """Time points that find the same granules, and those that are searched for them."""
    tp = time_points(spark, sf)
    members = SR.alike(tp, D.granules(spark, sf), GUARD_WINDOW, D.GRANULE_SIZE)
    return members, SR.representatives(tp, members)


LISTED = f"""
listed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY polygon_number, time_idx ORDER BY acquired_at, granule_id) AS rn
                          FROM pairs WHERE abs(day_diff) <= {GUARD_WINDOW})
           WHERE rn <= {S.MAX_RESULTS} AND granule_key IN (
             SELECT granule_key FROM granule_files WHERE band IN ({", ".join(f"'{b}'" for b in BANDS)})))"""


def listed(spark, sf, points):
    """What a search of one window lists: its first granules that have a requested band."""
    f = files(spark, sf)
    found = pairs(spark, sf, window_days=GUARD_WINDOW, points=points, max_results=MAX_RESULTS_DOWNLOAD, wanted=SR.wanted_granules(f, BANDS))
    return SR.with_requested_band(found, f, BANDS, max_results=MAX_RESULTS_DOWNLOAD)


@query("granule_guard", with_(*BASE, S.PAIRS, S.FILES, LISTED) + """
SELECT polygon_number, time_idx, count(*) AS n_granules,
       CASE WHEN count(*) > 3 THEN 'TOO_MANY_GRANULES' ELSE 'OK' END AS status
FROM listed GROUP BY polygon_number, time_idx""")
def q_granule_guard(spark, sf):
    members, points = alike(spark, sf)
    return SR.for_members(SR.granule_guard(listed(spark, sf, points)), members)


SELECT_ORDINALS = [1, 3]


@query("granule_select", with_(*BASE, S.PAIRS, S.FILES, LISTED) + """
, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY polygon_number, time_idx ORDER BY acquired_at, granule_id) AS ordinal
  FROM listed),
lim AS (SELECT *, max(ordinal) OVER (PARTITION BY polygon_number, time_idx) AS n FROM numbered)
SELECT polygon_number, time_idx, granule_id, ordinal,
       CASE WHEN 1 > n OR 3 > n THEN 'INVALID_SELECTION' ELSE 'OK' END AS status,
       (NOT (1 > n OR 3 > n)) AND ordinal IN (1, 3) AS selected
FROM lim""".replace("\n, numbered AS", ", numbered AS", 1))
def q_granule_select(spark, sf):
    members, points = alike(spark, sf)
    out = SR.granule_select(SR.granule_listing(listed(spark, sf, points)), SELECT_ORDINALS)
    return SR.for_members(out, members).select("polygon_number", "time_idx", "granule_id",
                      F.col("ordinal").cast("long").alias("ordinal"), "status", "selected")


@query("adaptive_window_banded", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + "SELECT * FROM picks")
def q_adaptive_window_banded(spark, sf):
    return picks(spark, sf)


CAP = 2


@query("adaptive_window_capped", with_(*BASE, S.PAIRS, S.FILES, S.PICKS.replace(f"rn <= {S.MAX_RESULTS}", f"rn <= {CAP}"))
       + "SELECT * FROM picks")
def q_adaptive_window_capped(spark, sf):
    """The same search when the catalogue returns two granules at most: the cap binds."""
    return picks(spark, sf, max_results=CAP)


@query("file_manifest", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + f"""
SELECT path, regexp_replace(path, '/[^/]*$', '') AS folder FROM (
  SELECT '{OUT_ROOT}/' || CAST(p.polygon_number AS VARCHAR) || '/t' || CAST(p.time_idx AS VARCHAR) || '/'
         || f.granule_id || '/' || string_split(f.url, '/')[-1] AS path
  FROM picks p JOIN granule_files f ON p.granule_key = f.granule_key) WHERE suffix(path, '.tif')""")
def q_file_manifest(spark, sf):
    return listing(spark, sf)


def listing(spark, sf):
    """Every downloaded file path of the picks (all layers), as a file walk would list it."""
    m = GR.download_manifest(picks(spark, sf), files(spark, sf), [], OUT_ROOT)
    paths = m.select(F.col("target_path").alias("path"))
    return OG.tif_listing(paths).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))


# a third of the rasters were saved as .tiff; where a band has both, that one is taken
@query("band_files_preferred", with_(*BASE, S.PAIRS, S.FILES, S.PICKS) + f"""
SELECT folder, band, arg_min(path, (ext <> 'tiff', path)) AS path FROM (
  SELECT path, regexp_replace(path, '/[^/]*$', '') AS folder,
         regexp_extract(path, '({"|".join(BANDS)})\\.(tiff?)$', 1) AS band,
         regexp_extract(path, '({"|".join(BANDS)})\\.(tiff?)$', 2) AS ext FROM (
    SELECT '{OUT_ROOT}/' || CAST(p.polygon_number AS VARCHAR) || '/t' || CAST(p.time_idx AS VARCHAR) || '/'
           || f.granule_id || '/' || string_split(f.url, '/')[-1] || CASE WHEN f.l_suppkey % 3 = 0 THEN 'f' ELSE '' END AS path
    FROM picks p JOIN granule_files f ON p.granule_key = f.granule_key))
WHERE band <> '' GROUP BY folder, band""")
def q_band_files_preferred(spark, sf):
    f = files(spark, sf).withColumn("url", F.concat("url", F.when(F.col("l_suppkey") % 3 == 0, "f").otherwise("")))
    paths = GR.download_manifest(picks(spark, sf), f, [], OUT_ROOT).select(F.col("target_path").alias("path"))
    listed_ = OG.tif_listing(paths, tiff=True).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    return OG.prefer_tiff(listed_, BANDS)


# ---- 8. streaming (each checked against its batch equivalent) ------------------------------

from fieldstack.plans.requests import plan_requests as _plan  # noqa: E402
from fieldstack.streaming import jobs as SJ  # noqa: E402


def stream_paths(spark, name):
    """(checkpoint, output) folders of one query's own; a job names lasting ones."""
    base = f"{checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    return f"{base}/checkpoint", f"{base}/out"


@query("stream_resume", with_(S.FIELDS, S.VALID_FIELDS, S.REQUESTS, S.RUNS) + "SELECT polygon_number, status, output_id " + RESUME_SQL)
def q_stream_resume(spark, sf):
    cust = SJ.file_stream(spark, f"{sf}/customer.parquet")
    valid, _ = split_valid(D.fields_from_customer(cust), D.UNITS_PER_DEGREE)
    req = _plan(with_default_class(valid), half_size=D.HALF_SIZE, units_per_degree=D.UNITS_PER_DEGREE, keep_pos=False)
    return SJ.stream_resume(spark, req.select("polygon_number", "status", "output_id"), lambda: run_outputs(spark, sf),
                            *stream_paths(spark, "resume"))


@query("stream_progress", with_(S.RUNS) + """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, status, count(*) AS n
FROM runs GROUP BY 1, 2, 3""")
def q_stream_progress(spark, sf):
    ev = SJ.file_stream(spark, f"{sf}/events.parquet")
    return SJ.stream_progress(spark, D.runs_from_events(ev), *stream_paths(spark, "progress"))


@query("stream_dedup", with_(S.RUNS) + "SELECT DISTINCT polygon_number FROM runs")
def q_stream_dedup(spark, sf):
    ev = SJ.file_stream(spark, f"{sf}/events.parquet")
    return SJ.stream_dedup(spark, D.runs_from_events(ev), *stream_paths(spark, "dedup"))


# ---- 9. statistics over the large pixel table (bench) --------------------------------------

@query("band_stats_large", with_(S.PIXELS_LARGE) + """
SELECT field_id, time_idx, band, count(*) AS n, min(value) AS min, max(value) AS max,
       round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
       round(avg(CASE WHEN value <> 0 THEN 100.0 ELSE 0.0 END), 4) AS valid_pct
FROM pixels_large GROUP BY field_id, time_idx, band""")
def q_band_stats_large(spark, sf):
    return ST.band_stats(D.pixels_large(spark, sf))


@query("band_percentiles_large", with_(S.PIXELS_LARGE) + """
SELECT field_id, time_idx, band, round(quantile_cont(value, 0.02), 4) AS p_low,
       round(quantile_cont(value, 0.98), 4) AS p_high
FROM pixels_large GROUP BY field_id, time_idx, band""")
def q_band_percentiles_large(spark, sf):
    return ST.band_percentiles(D.pixels_large(spark, sf))


# ---- 10. clip + nearest resample to a fractional window (D12, K5) ---------------------------

RESAMPLE = dict(col_off=0.5, row_off=0.25, width=7.3, height=6.9)   # a fixed window parameter


@query("resample_window", with_(S.PIXELS) + f"""
, w AS (SELECT {RESAMPLE['col_off']} AS col_off, {RESAMPLE['row_off']} AS row_off,
               {RESAMPLE['width']} AS width, {RESAMPLE['height']} AS height,
               CAST(trunc({RESAMPLE['width']}) AS INTEGER) AS out_w, CAST(trunc({RESAMPLE['height']}) AS INTEGER) AS out_h),
o AS (SELECT p.*, w.*, CAST(ceil((p.col - w.col_off) / (w.width / w.out_w) - 0.5) AS INTEGER) AS oc,
             CAST(ceil((p.row - w.row_off) / (w.height / w.out_h) - 0.5) AS INTEGER) AS orow
      FROM pixels p CROSS JOIN w)
SELECT field_id, time_idx, band, value, orow AS row, oc AS col FROM o
WHERE oc >= 0 AND oc < out_w AND floor(col_off + (oc + 0.5) * (width / out_w)) = col
  AND orow >= 0 AND orow < out_h AND floor(row_off + (orow + 0.5) * (height / out_h)) = row""".replace("\n, w AS", ", w AS", 1))
def q_resample_window(spark, sf):
    p = px(spark, sf)
    # one window row per field, derived from the pixel table itself
    w = p.select("field_id").distinct().select(
        "field_id", *[F.lit(float(v)).alias(k) for k, v in RESAMPLE.items()])
    return AS.resample_window(p, w)


# ---- 11. per-field outcome of the batch job (E1) ---------------------------------------------

from fieldstack.plans.batch import field_outcomes  # noqa: E402


@query("field_outcomes", with_(*BASE, S.PAIRS, S.FILES, S.PICKS, BAND_FILES) + f"""
, found AS (SELECT p.polygon_number, p.time_idx, list(DISTINCT f.band) AS have
            FROM picks p JOIN band_files f ON p.granule_key = f.granule_key GROUP BY 1, 2),
tp AS (SELECT t.polygon_number, t.time_idx,
              CASE WHEN b.granule_key IS NULL THEN 'NO_DATA'
                   WHEN len(list_filter({BAND_LIST_SQL}, lambda x: NOT list_contains(coalesce(f.have, []), x))) > 0
                   THEN 'MISSING_BANDS' END AS problem
       FROM time_points t LEFT JOIN picks b USING (polygon_number, time_idx)
       LEFT JOIN found f USING (polygon_number, time_idx)),
agg AS (SELECT polygon_number, count(problem) AS n_bad,
               arg_min(time_idx, CASE WHEN problem IS NULL THEN 1 ELSE 0 END * 10 + time_idx) AS bad_t,
               arg_min(problem, CASE WHEN problem IS NULL THEN 1 ELSE 0 END * 10 + time_idx) AS bad_p
        FROM tp GROUP BY polygon_number)
SELECT polygon_number, CASE WHEN n_bad = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN n_bad = 0 THEN 'ok' ELSE 't' || CAST(bad_t AS VARCHAR) || ': ' || bad_p END AS message
FROM agg
UNION ALL
SELECT polygon_number, 'FAILED', status FROM requests WHERE status <> 'OK'""".replace("\n, found AS", ", found AS", 1))
def q_field_outcomes(spark, sf):
    p = materialize(picks(spark, sf))      # used twice
    complete = OG.granule_band_completeness(p, files(spark, sf), BANDS)
    return field_outcomes(requests(spark, sf), SR.pick_status(time_points(spark, sf), p), complete)


# ---- 12. stored tables that are read in part ---------------------------------------------------

from fieldstack.operators import increments as IN  # noqa: E402
from fieldstack.sinks import writers as WR  # noqa: E402
from fieldstack.sources import granule_store as GS  # noqa: E402

BATCHES = 4      # the pixel table arrives in four batches


def store_path(spark, name):
    return f"{checkpoint_dir(spark)}/stores/{name}-{uuid.uuid4().hex}"


def batch_counts(spark, sf):
    """Counts of the large pixel table, added in three updates (two batches, then one, then one)."""
    source, store = store_path(spark, "pixels"), IN.BandCounts(spark, store_path(spark, "counts"))
    rows = D.pixels_large(spark, sf).withColumn("batch", F.col("value") % BATCHES)
    for some in ((0, 1), (2,), (3,)):
        rows.where(F.col("batch").isin(*some)).write.mode("append").partitionBy("batch").parquet(source)
        store.update(source)
    return store.counts()


@query("band_stats_incremental", with_(S.PIXELS_LARGE) + """
SELECT field_id, time_idx, band, count(*) AS n, min(value) AS min, max(value) AS max,
       round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
       round(avg(CASE WHEN value <> 0 THEN 100.0 ELSE 0.0 END), 4) AS valid_pct,
       round(quantile_cont(value, 0.02), 4) AS p_low, round(quantile_cont(value, 0.98), 4) AS p_high
FROM pixels_large GROUP BY field_id, time_idx, band""")
def q_band_stats_incremental(spark, sf):
    counts = materialize(batch_counts(spark, sf))      # used twice
    return IN.stats_of_counts(counts).join(IN.percentiles_of_counts(counts), ST.BAND_KEYS)


WINDOW_ROWS, WINDOW_COLS = (5, 17), (10, 20)      # a fixed window parameter
_MOSAIC_COND = ",\n  ".join(
    f"max(CASE WHEN vec_id % 18 = {t * len(BANDS) + i} THEN value END) AS t{t}_{b}" for t in range(3) for i, b in enumerate(BANDS))


@query("stack_window", f"""
WITH px AS (
  SELECT vec_id, vec_id // 162 AS field_id, CAST((vec_id // 18 % 9) // 3 * 8 + (p.pos - 1) // 8 AS INTEGER) AS row,
         CAST((vec_id // 18 % 9) % 3 * 8 + (p.pos - 1) % 8 AS INTEGER) AS col,
         greatest(0, least(65535, CAST(floor(CAST(embedding[p.pos] AS DOUBLE) * 1000) AS INTEGER) + 1000)) AS value
  FROM embeddings CROSS JOIN range(1, 65) AS p(pos) WHERE p.pos <= len(embedding))
SELECT field_id, row, col,
  {_MOSAIC_COND}
FROM px WHERE row BETWEEN {WINDOW_ROWS[0]} AND {WINDOW_ROWS[1]} AND col BETWEEN {WINDOW_COLS[0]} AND {WINDOW_COLS[1]}
GROUP BY field_id, row, col""")
def q_stack_window(spark, sf):
    """A window of every mosaic, read back from stacks stored as chunks."""
    path = store_path(spark, "stack")
    wide = AS.stack_chunks(D.mosaic_chunks(spark, sf), LABELS, ["field_id", "crow", "ccol"])
    WR.write_chunk_stack(wide, path, D.CHUNK, n_buckets=4)
    return AS.read_window(spark, path, D.CHUNK, WINDOW_ROWS, WINDOW_COLS, LABELS)


CATALOGUE = GS.Layout(cell=D.GRANULE_SIZE, slab_bins=6, block_cells=10, buckets=4)


@query("granule_search_stored", ORACLE["granule_search"])
def q_granule_search_stored(spark, sf):
    """``granule_search`` over the catalogue as a stored table."""
    name = f"catalogue_{uuid.uuid4().hex}"
    layout = GS.layout_for(D.granules(spark, sf), CATALOGUE)
    GS.write_catalogue(D.granules(spark, sf), name, layout, store_path(spark, "catalogue"))
    return GS.search_catalogue(time_points(spark, sf), spark, name, layout)
