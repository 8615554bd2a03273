"""DuckDB twins of the driver-table adapters (``fieldstack.sources.driver``).

Each constant is one CTE body; oracle queries are built by joining them with ``with_``.
They restate the same integer formulas in plain SQL so the test driver can check every
Spark query against an independent engine.
"""

FIELDS = """
fields AS (
  SELECT c_custkey AS polygon_number,
         CASE WHEN c_nationkey = 24 THEN NULL ELSE c_mktsegment END AS class,
         CAST(CASE WHEN c_custkey % 97 = 0 THEN 95000000
              ELSE 40000000 + (c_custkey * 7919 % 10000) * 1000 END AS BIGINT) AS lat,
         CAST(70000000 + (c_custkey * 104729 % 15000) * 1000 AS BIGINT) AS lon,
         date '1996-01-01' + CAST(c_custkey % 700 AS INTEGER) AS start_date,
         date '1996-01-01' + CAST(c_custkey % 700 AS INTEGER) + CAST(1 + c_custkey % 200 AS INTEGER) AS end_date,
         c_custkey AS input_pos
  FROM customer)"""

VALID_FIELDS = """
valid_fields AS (
  SELECT polygon_number, coalesce(class, 'Unknown') AS class, lat, lon, start_date, end_date, input_pos
  FROM fields
  WHERE lat BETWEEN -90000000 AND 90000000 AND lon BETWEEN -180000000 AND 180000000)"""

REQUESTS = """
requests AS (
  SELECT polygon_number, class, lat, lon, start_date, end_date,
         lon - 50000 AS west, lat - 50000 AS south, lon + 50000 AS east, lat + 50000 AS north,
         CAST(end_date - start_date AS INTEGER) AS days,
         CASE WHEN start_date IS NULL OR end_date IS NULL THEN 'INVALID_DATE'
              WHEN end_date - start_date < 2 THEN 'INVALID_RANGE' ELSE 'OK' END AS status,
         CAST(polygon_number AS VARCHAR) || '_' || strftime(start_date, '%Y-%m-%d') || '_'
           || strftime(end_date, '%Y-%m-%d') AS output_id
  FROM valid_fields)"""

TIME_POINTS = """
time_points AS (
  SELECT polygon_number, CAST(i AS INTEGER) AS time_idx,
         start_date + CAST(floor(days * i / 2.0) AS INTEGER) AS t_date,
         west, south, east, north
  FROM requests CROSS JOIN range(3) AS r(i)
  WHERE status = 'OK')"""

GRANULES = """
granules AS (
  SELECT o_orderkey AS granule_key,
         'HLS.S30.T' || lpad(CAST(o_custkey % 150 AS VARCHAR), 5, '0') || '.'
           || strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400),
                       '%Y%jT%H%M%S') || '.v2.0' AS granule_id,
         'T' || lpad(CAST(o_custkey % 150 AS VARCHAR), 5, '0') AS tile,
         CAST(o_orderdate AS DATE) AS acquired,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS acquired_at,
         o_orderkey * 37 % 101 AS cloud_pct,
         CAST(70000000 + (o_custkey // 10 % 15) * 1000000 AS BIGINT) AS west,
         CAST(40000000 + (o_custkey % 10) * 1000000 AS BIGINT) AS south,
         CAST(70000000 + (o_custkey // 10 % 15) * 1000000 + 1000000 AS BIGINT) AS east,
         CAST(40000000 + (o_custkey % 10) * 1000000 + 1000000 AS BIGINT) AS north
  FROM orders)"""

PAIRS = """
pairs AS (
  SELECT tp.polygon_number, tp.time_idx, tp.t_date, g.granule_key, g.granule_id, g.acquired,
         g.acquired_at, g.cloud_pct, CAST(g.acquired - tp.t_date AS INTEGER) AS day_diff
  FROM time_points tp JOIN granules g
    ON abs(g.acquired - tp.t_date) <= 30 AND g.cloud_pct BETWEEN 0 AND 30
   AND tp.west <= g.east AND g.west <= tp.east AND tp.south <= g.north AND g.south <= tp.north)"""

MAX_RESULTS = 50     # granules that one search returns at most

# a window succeeds if one of its first MAX_RESULTS granules has a file of a requested band
PICKS = f"""
win AS (SELECT p.*, w.window_days FROM pairs p JOIN (VALUES (3), (7), (14), (30)) AS w(window_days)
          ON abs(p.day_diff) <= w.window_days),
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY polygon_number, time_idx, window_days
                                                       ORDER BY acquired_at, granule_id) AS rn FROM win)
           WHERE rn <= {MAX_RESULTS}),
banded AS (SELECT * FROM capped c WHERE EXISTS (
             SELECT 1 FROM granule_files f WHERE f.granule_key = c.granule_key
               AND f.band IN ('B02', 'B03', 'B04', 'B8A', 'B11', 'B12'))),
best AS (SELECT *, row_number() OVER (PARTITION BY polygon_number, time_idx ORDER BY window_days, acquired_at, granule_id) AS pick
         FROM banded),
picks AS (SELECT polygon_number, time_idx, t_date, CAST(window_days AS INTEGER) AS window_days,
                 CAST(CASE window_days WHEN 3 THEN 1 WHEN 7 THEN 2 WHEN 14 THEN 3 ELSE 4 END AS INTEGER) AS attempt,
                 granule_key, granule_id, acquired, day_diff
          FROM best WHERE pick = 1)"""

FILES = """
granule_files AS (
  SELECT g.granule_key, g.granule_id, g.acquired_at,
         (['B02','B03','B04','B8A','B11','B12','Fmask'])[l.l_linenumber] AS band,
         'https://data.example/' || g.granule_id || '/' || g.granule_id || '.'
           || (['B02','B03','B04','B8A','B11','B12','Fmask'])[l.l_linenumber] || '.tif' AS url,
         l.l_suppkey, l.l_partkey, l.l_extendedprice
  FROM lineitem l JOIN granules g ON l.l_orderkey = g.granule_key)"""

PIXELS = """
pixels AS (
  SELECT vec_id // 18 AS field_id, CAST((vec_id % 18) // 6 AS INTEGER) AS time_idx,
         (['B02','B03','B04','B8A','B11','B12'])[CAST(vec_id % 18 % 6 AS INTEGER) + 1] AS band,
         CAST((p.pos - 1) // 8 AS INTEGER) AS row, CAST((p.pos - 1) % 8 AS INTEGER) AS col,
         CAST(floor(CAST(embedding[p.pos] AS DOUBLE) * 1000) AS INTEGER) + 1000 AS value
  FROM embeddings CROSS JOIN range(1, 65) AS p(pos)
  WHERE p.pos <= len(embedding))"""

PIXELS_LARGE = """
pixels_large AS (
  SELECT l_suppkey AS field_id, CAST(l_linenumber % 3 AS INTEGER) AS time_idx,
         (['B02','B03','B04','B8A','B11','B12'])[CAST(l_partkey % 6 AS INTEGER) + 1] AS band,
         CAST(floor(l_extendedprice / 2) AS INTEGER) AS value
  FROM lineitem)"""

RUNS = """
runs AS (
  SELECT user_id AS polygon_number, ts, CAST(round(value * 100) AS BIGINT) AS duration_cs,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
         CAST(ts AS DATE) AS batch_id, event_id, event_type AS message
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
