"""Request planning: field -> box -> validation -> time points.

Bad requests become rows with a status, never exceptions, so one bad field cannot stop
a batch of millions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstack.constants import N_TIME_POINTS
from fieldstack.functions.dates import date_text, time_points as time_points_expr
from fieldstack.functions.geo import bbox_around

ORDERS = ("forward", "backward", "random")


def plan_requests(fields: DataFrame, half_size: float, n_points: int = N_TIME_POINTS,
                  min_days: int = 2, max_half_degrees: float = 1.0,
                  units_per_degree: float = 1.0, keep_pos: bool = True) -> DataFrame:
    """One row per field: (input_pos if there is one), box, validated date range, status and output id.

    Status: OK, INVALID_DATE (missing date), INVALID_RANGE (start >= end, or fewer than
    ``min_days`` days, too short for three distinct points), INVALID_BBOX_SIZE (half size
    not in (0, max])."""
    days = F.datediff("end_date", "start_date")
    hs_deg = half_size / units_per_degree
    status = (F.when(F.col("start_date").isNull() | F.col("end_date").isNull(), "INVALID_DATE")
               .when(F.lit(not (0 < hs_deg <= max_half_degrees)), "INVALID_BBOX_SIZE")
               .when(days < min_days, "INVALID_RANGE")
               .otherwise("OK"))
    box = bbox_around(F.col("lat"), F.col("lon"), half_size)
    extra = ["input_pos"] if "input_pos" in fields.columns and keep_pos else []
    return fields.select(
        *extra, "polygon_number", "class", "lat", "lon", "start_date", "end_date",
        box.west.alias("west"), box.south.alias("south"),
        box.east.alias("east"), box.north.alias("north"),
        days.alias("days"), status.alias("status"),
        F.concat_ws("_", F.col("polygon_number").cast("string"),
                    date_text(F.col("start_date")),
                    date_text(F.col("end_date"))).alias("output_id"),
    )


def validate_options(options: DataFrame, max_half_degrees: float = 1.0) -> DataFrame:
    """Batch options as texts (start_text, end_text, order_text, limit_text, half_text) plus a status: the first of INVALID_DATE (not
    YYYY-MM-DD, or no day of the calendar), INVALID_RANGE (start not before end), INVALID_ORDER, INVALID_LIMIT (not a positive whole
    number; null is no limit), INVALID_BBOX_SIZE (not in (0, max]) that holds, or OK."""
    def day(c: str):
        return F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
    limit, half = F.col("limit_text").try_cast("int"), F.col("half_text").try_cast("double")
    status = (F.when(day("start_text").isNull() | day("end_text").isNull(), "INVALID_DATE")
               .when(day("start_text") >= day("end_text"), "INVALID_RANGE")
               .when(F.coalesce(~F.lower("order_text").isin(*ORDERS), F.lit(True)), "INVALID_ORDER")
               .when(F.col("limit_text").isNotNull() & (limit.isNull() | (limit <= 0)), "INVALID_LIMIT")
               .when(F.coalesce(~((half > 0) & (half <= max_half_degrees)), F.lit(True)), "INVALID_BBOX_SIZE")
               .otherwise("OK"))
    return options.withColumn("status", status)


def explode_time_points(requests: DataFrame, n_points: int = N_TIME_POINTS, keys=("polygon_number",)) -> DataFrame:
    """Valid requests -> (keys, time_idx, t_date, box)."""
    ok = requests.where(F.col("status") == "OK")
    return ok.select(
        *keys,
        F.posexplode(time_points_expr(F.col("start_date"), F.col("end_date"), n_points))
         .alias("time_idx", "t_date"),
        "west", "south", "east", "north",
    ).withColumn("time_idx", F.col("time_idx").cast("int"))


def order_and_limit(fields: DataFrame, order: str = "forward", limit: int | None = None,
                    seed: int = 42) -> DataFrame:
    """Order forward/backward by input position, or a repeatable pseudo-random order
    (hash of the id and a seed), then keep the first ``limit`` rows.

    A limit after an order is a TakeOrderedAndProject: each task keeps its own top n and
    only n rows per task reach the final merge."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    key = {"forward": F.col("input_pos").asc(),
           "backward": F.col("input_pos").desc(),
           "random": shuffle_key(F.col("polygon_number"), seed).asc()}[order]
    out = fields.orderBy(key, F.col("input_pos").asc())
    if limit is not None:
        if limit <= 0:
            raise ValueError("limit must be positive")
        out = out.limit(limit)
    return out


def batch_position(order: str = "forward", seed: int = 42):
    """A number that orders the rows of a batch as ``order_and_limit`` does."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    return {"forward": F.col("input_pos"), "backward": -F.col("input_pos"),
            "random": shuffle_key(F.col("polygon_number"), seed)}[order].cast("long")


def shuffle_key(polygon, seed: int = 42):
    """Repeatable pseudo-random order key: one Lehmer (MINSTD) step of the id and a seed,
    exact in 64-bit integers in any SQL engine."""
    m = 2147483647
    return F.pmod(F.pmod(polygon, F.lit(m)) * 48271 + seed, F.lit(m))


def split_fields(fields: DataFrame, n_parts: int, seed: int = 42) -> DataFrame:
    """Disjoint split into ``n_parts`` work lists by a hash of the id (replaces running
    two overlapping copies forward and backward)."""
    return fields.withColumn("part", F.pmod(shuffle_key(F.col("polygon_number"), seed),
                                            F.lit(n_parts)).cast("int"))
