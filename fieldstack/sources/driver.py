"""Driver tables -> domain tables.

The test driver ships TPC-H-like tables; these functions derive the domain tables of the
pipeline from them with fixed integer formulas, so that every query has an exact DuckDB
twin. Coordinates are integer micro-degrees (``UNITS_PER_DEGREE``), pixels are integers.
Only the columns a formula needs are selected, so parquet scans stay pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.constants import BANDS
from fieldstack.functions.dates import ntz_doy_text, ntz_text

UNITS_PER_DEGREE = 1_000_000
HALF_SIZE = 50_000           # 0.05 degree box half-width
GRANULE_SIZE = 1_000_000     # 1 degree granule footprint
FILE_LAYERS = BANDS + ["Fmask"]   # l_linenumber 1..7 -> layer
URL_ROOT = "https://data.example/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; how it is split is up to ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fields_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> fields(polygon_number, class, lat, lon, start_date, end_date, input_pos)."""
    return fields_from_customer(table(spark, sf_dir, "customer"))


def fields_from_customer(customer: DataFrame) -> DataFrame:
    """Row-wise field derivation; works on batch and streaming DataFrames alike."""
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    start = F.date_add(F.lit("1996-01-01").cast("date"), (key % 700).cast("int"))
    return c.select(
        key.alias("polygon_number"),
        F.when(F.col("c_nationkey") == 24, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("class"),
        F.when(key % 97 == 0, F.lit(95_000_000).cast("long"))
         .otherwise(40_000_000 + (key * 7919 % 10_000) * 1000).alias("lat"),
        (70_000_000 + (key * 104_729 % 15_000) * 1000).alias("lon"),
        start.alias("start_date"),
        F.date_add(start, (1 + key % 200).cast("int")).alias("end_date"),
        key.alias("input_pos"),
    )


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> granules(granule_key, granule_id, tile, acquired, acquired_at, cloud_pct,
    west, south, east, north)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    acquired = F.col("o_orderdate").cast("date")
    ts = (acquired.cast("timestamp_ntz")
          + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 86400).cast("decimal(18,6)")))
    tile = F.concat(F.lit("T"), F.lpad((cust % 150).cast("string"), 5, "0"))
    south = 40_000_000 + (cust % 10) * 1_000_000
    west = 70_000_000 + (F.floor(cust / 10) % 15) * 1_000_000
    return o.select(
        key.alias("granule_key"),
        F.concat(F.lit("HLS.S30."), tile, F.lit("."),
                 ntz_doy_text(ts), F.lit(".v2.0")).alias("granule_id"),
        tile.alias("tile"),
        acquired.alias("acquired"),
        ts.alias("acquired_at"),
        (key * 37 % 101).alias("cloud_pct"),
        west.alias("west"),
        south.alias("south"),
        (west + GRANULE_SIZE).alias("east"),
        (south + GRANULE_SIZE).alias("north"),
    )


def _layer() -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in FILE_LAYERS]), F.col("l_linenumber"))


def file_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> (granule_key, band) of every file: those of ``granule_files``, and of granules that no row of orders describes."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("granule_key"), _layer().alias("band"))


def granule_files(spark: SparkSession, sf_dir: str, granule_df: DataFrame | None = None) -> DataFrame:
    """lineitem x granules -> granule_files(granule_key, granule_id, acquired_at, band, url,
    tiebreak columns). One row per lineitem; duplicates of (granule, band) are real."""
    g = granule_df if granule_df is not None else granules(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")
    j = li.join(g.select("granule_key", "granule_id", "acquired_at"),
                li.l_orderkey == g.granule_key)
    band = _layer()
    return j.select(
        "granule_key", "granule_id", "acquired_at",
        band.alias("band"),
        F.concat(F.lit(URL_ROOT), F.col("granule_id"), F.lit("/"), F.col("granule_id"),
                 F.lit("."), band, F.lit(".tif")).alias("url"),
        "l_suppkey", "l_partkey", "l_extendedprice",
    )


def pixel_value_from_float(x: Column) -> Column:
    return (F.floor(x.cast("double") * 1000).cast("int") + 1000)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings (64 floats = one 8x8 chunk) -> pixels(field_id, time_idx, band, row, col, value)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    bands = F.array(*[F.lit(b) for b in BANDS])
    k = F.col("vec_id") % 18
    x = e.select(
        F.floor(F.col("vec_id") / 18).alias("field_id"),
        F.floor(k / 6).cast("int").alias("time_idx"),
        F.element_at(bands, (k % 6 + 1).cast("int")).alias("band"),
        F.posexplode("embedding").alias("pos", "v"),
    )
    return x.select(
        "field_id", "time_idx", "band",
        F.floor(F.col("pos") / 8).cast("int").alias("row"),
        (F.col("pos") % 8).cast("int").alias("col"),
        pixel_value_from_float(F.col("v")).alias("value"),
    )


CHUNK = 8            # rows and columns of a raster chunk (64 values)
RASTER_CHUNKS = 6    # a granule's raster has 6 x 6 chunks


def _pixel_values(vec: Column) -> Column:
    return F.transform(vec, pixel_value_from_float)


def pixel_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> raster chunks(field_id, time_idx, band, crow, ccol, values); the pixels of ``pixels`` before unfolding."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    k = F.col("vec_id") % 18
    zero = F.lit(0).cast("long")
    return e.select(
        F.floor(F.col("vec_id") / 18).alias("field_id"), F.floor(k / 6).cast("int").alias("time_idx"),
        F.element_at(F.array(*[F.lit(b) for b in BANDS]), (k % 6 + 1).cast("int")).alias("band"),
        zero.alias("crow"), zero.alias("ccol"), _pixel_values(F.col("embedding")).alias("values"))


MOSAIC_CHUNKS = 3    # a mosaic has 3 x 3 chunks


def mosaic_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> chunks of larger fields (field_id, label, crow, ccol, values): field = vec_id div 162, place = vec_id div 18 mod 9 (row by
    row), label = the vec_id mod 18th of the stack."""
    from fieldstack.operators.assemble import stack_labels  # noqa: PLC0415
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    side = MOSAIC_CHUNKS
    place = F.floor(F.col("vec_id") / 18) % (side * side)
    return e.select(
        F.floor(F.col("vec_id") / (18 * side * side)).alias("field_id"), F.floor(place / side).alias("crow"), (place % side).alias("ccol"),
        F.element_at(F.array(*[F.lit(x) for x in stack_labels()]), (F.col("vec_id") % 18 + 1).cast("int")).alias("label"),
        _pixel_values(F.col("embedding")).alias("values"))


def raster_chunks(spark: SparkSession, sf_dir: str, wanted: DataFrame) -> DataFrame:
    """(granule_key, band, crow, ccol, values) of the ``wanted`` granules' band files. A chunk's values are the embedding numbered
    ((granule_key * 6 + band) * 36 + crow * 6 + ccol) mod the number of embeddings."""
    n = RASTER_CHUNKS
    e = table(spark, sf_dir, "embeddings")
    n_values = max(e.count(), 1)
    have = (granule_files(spark, sf_dir).where(F.col("band").isin(BANDS)).select("granule_key", "band").distinct()
            .join(wanted.select("granule_key").distinct(), "granule_key", "left_semi"))
    b = F.array_position(F.array(*[F.lit(x) for x in BANDS]), F.col("band")) - 1
    axis = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    places = (have.withColumn("crow", F.explode(axis)).withColumn("ccol", F.explode(axis))
              .withColumn("vec_id", ((F.col("granule_key") * 6 + b) * (n * n) + F.col("crow") * n + F.col("ccol")) % n_values))
    e = e.select("vec_id", _pixel_values(F.col("embedding")).alias("values"))
    return places.join(e, "vec_id").drop("vec_id")


def pixels_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> pixels(field_id, time_idx, band, value) for the statistics bench."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_partkey", "l_extendedprice")
    bands = F.array(*[F.lit(b) for b in BANDS])
    return li.select(
        F.col("l_suppkey").alias("field_id"),
        (F.col("l_linenumber") % 3).cast("int").alias("time_idx"),
        F.element_at(bands, (F.col("l_partkey") % 6 + 1).cast("int")).alias("band"),
        F.floor(F.col("l_extendedprice") / 2).cast("int").alias("value"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> run ledger rows(polygon_number, ts, duration_cs, status, batch_id, event_id)."""
    return runs_from_events(table(spark, sf_dir, "events"))


def runs_from_events(events: DataFrame) -> DataFrame:
    """Row-wise ledger derivation; works on batch and streaming DataFrames alike."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    status = (F.when(F.col("event_type") == "error", "FAILED")
               .when(F.col("event_type") == "signup", "SKIPPED")
               .otherwise("SUCCESS"))
    return ev.select(
        F.col("user_id").alias("polygon_number"),
        "ts",
        F.round(F.col("value") * 100).cast("long").alias("duration_cs"),
        status.alias("status"),
        F.col("ts").cast("date").alias("batch_id"),
        "event_id",
        F.col("event_type").alias("message"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> run-log text lines(file, pos_a, pos_b, line); a second untimestamped line
    follows every event whose id is a multiple of 10. (pos_a, pos_b) orders lines."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    level = (F.when(F.col("event_type") == "error", "ERROR")
              .when(F.col("event_type") == "signup", "WARNING")
              .otherwise("INFO"))
    head = F.concat(ntz_text(F.col("ts")), F.lit(" - "), level, F.lit(" - "),
                    F.col("event_type"), F.lit(" field "), F.col("user_id").cast("string"))
    extra = F.concat(F.lit("   detail for event "), F.col("event_id").cast("string"))
    lines = F.when(F.col("event_id") % 10 == 0, F.array(head, extra)).otherwise(F.array(head))
    return ev.select(
        F.lit("run.log").alias("file"),
        F.col("ts").alias("pos_a"),
        F.col("event_id").alias("pos_b"),
        F.posexplode(lines).alias("pos_c", "line"),
    )
