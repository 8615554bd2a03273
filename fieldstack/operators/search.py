"""Granule search as one distributed spatio-temporal range join (S4, S5, J1, J2, J3, F3,
F5, F6, F7, L4, W1).

A box/date join has no equality key, and Spark would plan it as a cartesian product.
Both sides are therefore binned on (cell_x, cell_y, time_bin): a request row is
replicated to every grid cell its box touches and every time bin its search span
touches; a granule to every cell its footprint touches and to the one bin of its
acquisition date. The equi-join on the bins is followed by the exact predicates, and a
pair is kept only in the cell that holds the lower-left corner of the two boxes'
intersection, so no pair appears twice and no ``distinct`` is needed.

The granule side of a search for all pairs is joined in runs: rows of up to ``RUN`` granules of one footprint and
bin in order of their days. The predicates are tested once for a run, and the granules of the window are a slice of
it, so no pair is made that isn't returned.

Shuffle volume is linear in (requests x touched cells x touched bins) + (granules x
touched cells). A hot bin (many fields in one cell and month) is a skewed join key; AQE
skew-join splits the large side of such a partition, and the granule side per bin is
bounded by the revisit rate of one tile.

All pairs grow with requests times revisits. Where a search needs only its first granules, ``max_results`` finds
these without the others: see ``_first_pairs``.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstack.constants import MAX_INTERACTIVE_GRANULES, WINDOWS
from fieldstack.functions.dates import attempt_for_window, window_for_offset

REQUEST_KEYS = ["polygon_number", "time_idx"]
PAIR_ORDER = ["acquired_at", "granule_id"]   # "first" granule = earliest, then by id
BOX = ["west", "south", "east", "north"]
RUN = 256                # granules in a row of a join at most
RUN_COLUMNS = ["acquired", *PAIR_ORDER, "granule_key", "cloud_pct"]
NO_DAY = 2_147_483_647   # no date is this many days from 1970


def _epoch():
    return F.lit("1970-01-01").cast("date")


def _cells(lo, hi, cell):
    return F.sequence(F.floor(lo / cell), F.floor(hi / cell))


def search_granules(requests: DataFrame, granules: DataFrame, window_days: int = 30,
                    cloud_min: float = 0, cloud_max: float = 30, cell: float = 1.0,
                    time_bin_days: int | None = None, max_results: int | None = None,
                    request_keys: list[str] = REQUEST_KEYS,
                    hot_key_rows: int | None = 2_000_000, cloud_unit: float = 100,
                    windows: list[int] | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """All (request, granule) pairs with closed boxes intersecting, acquisition date within
    ``t_date +- window_days`` and cloud cover in [cloud_min, cloud_max].

    requests: request_keys + t_date, west, south, east, north (same unit as ``cell``).
    granules: granule_key, granule_id, acquired (date), acquired_at, cloud_pct,
              west, south, east, north.
    ``cloud_unit`` is full cover in the catalogue's unit (100: percent, 1: fraction).
    ``max_results`` keeps the first n pairs per request in catalogue order (L4).
    ``hot_key_rows``: a (cell, time bin) with more request rows than this is split into
    ceil(rows / hot_key_rows) salted sub-keys; its granules are replicated to each.
    ``windows`` (with ``max_results``): instead of numbered pairs, those that rankings of up to ``max_results`` in each of
    these windows can need (``window_days`` is not used); every pair before a needed one is there, so ranks up to
    ``max_results`` are right.
    ``wanted`` (distinct granule_key): pairs have a column ``wanted``, whether the granule is among these; with ``windows``,
    only rows up to the first wanted one of each window are needed.
    """
    validate_cloud_range(cloud_min, cloud_max, cloud_unit)
    if windows is not None and max_results is None:
        raise ValueError("windows need max_results")
    g = granules.filter(F.col("cloud_pct").between(cloud_min, cloud_max)).select(
        "granule_key", "granule_id", "acquired", "acquired_at", "cloud_pct",
        *[F.col(c).alias(f"g_{c}") for c in BOX])
    if wanted is not None:
        g = g.join(wanted.select("granule_key", F.lit(True).alias("wanted")), "granule_key", "left").withColumn(
            "wanted", F.coalesce("wanted", F.lit(False)))
    mark = ["wanted"] if wanted is not None else []
    if max_results is not None:
        pairs = _first_pairs(requests, g, windows or [window_days], max_results, cell, time_bin_days, request_keys,
                             hot_key_rows, bool(mark) and windows is not None)
        return pairs if windows is not None else granule_listing(pairs, max_results, request_keys)
    tb = int(time_bin_days or (2 * window_days + 1))
    runs = run_days(granule_runs(g.withColumn("tbin", _time_bin("acquired", tb)), mark))
    return run_pairs(_meeting(requests, runs, window_days, cell, tb, request_keys, hot_key_rows), window_days, request_keys, mark)


def granule_runs(g: DataFrame, mark: list[str] = []) -> DataFrame:
    """Granules of one footprint (g_west, g_south, g_east, g_north) and ``tbin`` in order of their days, up to ``RUN`` to a row: an array for
    each column, named in the plural. Those without a footprint or date are dropped."""
    track = [f"g_{c}" for c in BOX] + ["tbin"]
    columns = [*RUN_COLUMNS, *mark]
    # in full order, so that a row holds the same granules however often it is computed
    run = F.floor((F.row_number().over(Window.partitionBy(*track).orderBy(*columns)) - 1) / RUN)
    return (g.where(reduce(and_, [F.col(c).isNotNull() for c in track])).withColumn("run", run).groupBy(*track, "run")
             .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("granules"))
             .select(*track, *[F.col("granules")[c].alias(f"{c}s") for c in columns]))


def run_days(runs: DataFrame) -> DataFrame:
    """``runs`` with their first day, and how many of a run's granules lie before each day from the first to the one after the last."""
    gap = lambda x, i: F.array_repeat(i, F.coalesce(x - F.get("days", i - 1), F.lit(1)))      # noqa: E731
    return (runs.withColumn("days", F.transform("acquireds", lambda x: F.datediff(x, _epoch())))
                .withColumn("first_day", F.get("days", F.lit(0)))
                .withColumn("before", F.flatten(F.concat(F.transform("days", gap), F.array(F.array(F.size("days"))))))
                .drop("days"))


def run_pairs(met: DataFrame, window_days: int, request_keys: list[str], mark: list[str] = []) -> DataFrame:
    """The pairs of requests and the runs that they meet: of each run the granules from the window's first day to its last."""
    # never null; said so, or a test for null would make the arrays a second time
    before = lambda day: F.coalesce(F.get("before", F.least(F.greatest(day - F.col("first_day"), F.lit(0)), F.size("before") - 1)), F.lit(0))      # noqa: E731
    t = F.datediff("t_date", _epoch())
    met = met.withColumn("lo", before(t - window_days)).withColumn("hi", before(t + window_days + 1))
    columns = ["granule_key", "granule_id", "acquired", "acquired_at", "cloud_pct"]
    return (met.where(F.col("lo") < F.col("hi")).withColumn("i", F.explode(F.sequence("lo", F.col("hi") - 1)))
               .select(*request_keys, "t_date", *[F.get(f"{c}s", F.col("i")).alias(c) for c in [*columns, *mark]])
               .select(*request_keys, "t_date", *columns, F.datediff("acquired", "t_date").alias("day_diff"), *mark))


def _time_bin(day, tb: int):
    return F.floor(F.datediff(day, _epoch()) / tb)


def _meeting(requests: DataFrame, shapes: DataFrame, window_days: int, cell: float, tb: int, request_keys: list[str],
             hot_key_rows: int | None) -> DataFrame:
    """Requests joined with the ``shapes`` (g_west, g_south, g_east, g_north, tbin and more) whose closed box meets theirs, in
    the time bins that their widest search touches."""
    keys = ["tbin", "cx", "cy"]
    g = (shapes
         .withColumn("cx", F.explode(_cells(F.col("g_west"), F.col("g_east"), cell)))
         .withColumn("cy", F.explode(_cells(F.col("g_south"), F.col("g_north"), cell))))
    t = F.col("t_date")
    r = (requests
         .withColumn("tbin", F.explode(F.sequence(_time_bin(F.date_sub(t, window_days), tb), _time_bin(F.date_add(t, window_days), tb))))
         .withColumn("cx", F.explode(_cells(F.col("west"), F.col("east"), cell)))
         .withColumn("cy", F.explode(_cells(F.col("south"), F.col("north"), cell))))
    r = r.select(*request_keys, "t_date", *BOX, *keys)
    if hot_key_rows:
        r, g = salt_hot_keys(r, g, keys, request_keys, hot_key_rows)
        keys = keys + ["salt"]
    # the bins multiply rows after the size of the input is taken: a side that looks small isn't sent whole through the driver
    return r.hint("merge").join(g, keys).where(
        (F.col("west") <= F.col("g_east")) & (F.col("g_west") <= F.col("east"))
        & (F.col("south") <= F.col("g_north")) & (F.col("g_south") <= F.col("north"))
        # reference point: the cell holding the intersection's lower-left corner
        & (F.col("cx") == F.floor(F.greatest("west", "g_west") / cell))
        & (F.col("cy") == F.floor(F.greatest("south", "g_south") / cell)))


def _first_pairs(requests: DataFrame, g: DataFrame, windows: list[int], n: int, cell: float, time_bin_days: int | None,
                 request_keys: list[str], hot_key_rows: int | None, to_wanted: bool) -> DataFrame:
    """The pairs among the first ``n`` of each request's windows, and some more, without listing all pairs.

    Granules of one footprint and time bin are a track, numbered in catalogue order. A request meets whole tracks; how many of a
    track's granules lie before a window's first day is looked up in the track's list of days, so the window's first n are the n
    numbers that follow, and only these are fetched, from bins of n numbers. The first n of all tracks together are among the
    first n of each. ``to_wanted`` stops at a track's first wanted granule: what comes before a window's first wanted granule
    comes before the first wanted one of its own track too.

    Catalogue order is by time, the lists are by day: a granule whose time is not on its day has a track of that day alone.
    """
    ws = sorted({int(w) for w in windows})
    tb = int(time_bin_days or 4 * (2 * ws[-1] + 1))
    track = [f"g_{c}" for c in BOX] + ["tbin", "lone"]
    day = F.datediff("acquired", _epoch())
    mark = ["wanted"] if "wanted" in g.columns else []
    # ties in full order, so that numbers are the same however often they are computed
    order = Window.partitionBy(*track).orderBy(day, *PAIR_ORDER, "granule_key", "cloud_pct")
    # rows without a track meet nothing. Days are taken after the numbers: both uses of g then need the same columns of the same rows,
    # and it is dealt out once
    g = (g.withColumn("tbin", _time_bin("acquired", tb))
          .withColumn("lone", F.when(F.coalesce(F.col("acquired_at").cast("date") == F.col("acquired"), F.lit(False)), F.lit(NO_DAY)).otherwise(day))
          .where(reduce(and_, [F.col(c).isNotNull() for c in track]))
          .withColumn("pos", F.row_number().over(order))
          .withColumn("day", day))
    # a track's days: granules before each, and the first wanted number on or after it; days without granules repeat the next one's
    first_wanted = F.min(F.when(F.col("wanted"), F.col("pos"))) if to_wanted else F.lit(None).cast("int")
    in_track = Window.partitionBy(*track).orderBy("day")
    days = (g.groupBy(*track, "day").agg((F.min("pos") - 1).alias("before"), F.max("pos").alias("upto"), first_wanted.alias("w"))
            .withColumn("w", F.min("w").over(in_track.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("gap", F.coalesce(F.col("day") - F.lag("day").over(in_track), F.lit(1))))
    tracks = days.groupBy(*track).agg(F.min("day").alias("first_day"), F.max("upto").alias("total"),
                                      F.sort_array(F.collect_list(F.struct("day", "gap", "before", "w"))).alias("steps"))
    spread = lambda c: F.flatten(F.transform("steps", lambda x: F.array_repeat(x[c], x["gap"])))      # noqa: E731
    tracks = tracks.select(*track, "first_day", "total", spread("before").alias("before"), spread("w").alias("w"))
    met = _meeting(requests, tracks, ws[-1], cell, tb, request_keys, hot_key_rows)

    def at(column: str, d, beyond):
        """A list's value for day ``d``; after the track's last day ``beyond``."""
        return F.when(d - F.col("first_day") < F.size(column), F.get(F.col(column), F.greatest(d - F.col("first_day"), F.lit(0)))).otherwise(beyond)

    t = F.datediff("t_date", _epoch())
    spans = {}
    for w in ws:
        lo = at("before", t - w, F.col("total"))
        spans |= {f"lo{w}": lo, f"hi{w}": F.least(at("before", t + w + 1, F.col("total")), lo + n)}
        if to_wanted:
            spans[f"w{w}"] = at("w", t - w, F.lit(None))
    met = met.select(*request_keys, "t_date", *track, *[c.alias(k) for k, c in spans.items()])
    if to_wanted:
        met = _up_to_wanted(met, ws, n, request_keys)
    block = lambda c: F.floor((c - 1) / n)      # noqa: E731
    blocks = F.array_distinct(F.flatten(F.array(*[
        F.when(F.col(f"hi{w}") > F.col(f"lo{w}"), F.sequence(block(F.col(f"lo{w}") + 1), block(F.col(f"hi{w}")))).otherwise(F.array().cast("array<bigint>"))
        for w in ws])))
    met = met.withColumn("block", F.explode(blocks))
    found = met.join(g.withColumn("block", block(F.col("pos"))), [*track, "block"]).where(
        reduce(or_, [(F.col("pos") > F.col(f"lo{w}")) & (F.col("pos") <= F.col(f"hi{w}")) for w in ws]))
    return found.select(*request_keys, "t_date", "granule_key", "granule_id", "acquired", "acquired_at", "cloud_pct",
                        F.datediff("acquired", "t_date").alias("day_diff"), *mark)


def _up_to_wanted(met: DataFrame, ws: list[int], n: int, request_keys: list[str]) -> DataFrame:
    """Spans of ``met`` (lo, hi and the first wanted number of each window) cut to what a pick can need, before any granule is fetched.

    A window's first wanted granule has at most those before it that come before the first wanted one of their own track: where these
    are fewer than ``n`` in all, the window succeeds, and no wider one is tried. Ranks run over all rows of a request's keys: where
    these have several dates, one date's rows count for the other's, and nothing is cut."""
    same = Window.partitionBy(*request_keys)
    met = met.where(F.col(f"hi{ws[-1]}") > F.col(f"lo{ws[-1]}"))
    has = lambda w: F.coalesce(F.col(f"w{w}") <= F.col(f"hi{w}"), F.lit(False))      # noqa: E731
    before = lambda w: F.when(has(w), F.col(f"w{w}") - 1).otherwise(F.col(f"hi{w}")) - F.col(f"lo{w}")      # noqa: E731
    met = met.withColumns({"several": F.min("t_date").over(same) != F.max("t_date").over(same)} | {
        f"sure{w}": F.max(has(w)).over(same) & (F.sum(before(w)).over(same) < n) for w in ws[:-1]})
    cut = {}
    for i, w in enumerate(ws):
        hi = F.least(f"hi{w}", f"w{w}")      # least passes over nulls
        if i:
            hi = F.when(reduce(or_, [F.col(f"sure{v}") for v in ws[:i]]), F.col(f"lo{w}")).otherwise(hi)
        cut[f"hi{w}"] = F.when(F.col("several"), F.col(f"hi{w}")).otherwise(hi)
    return met.withColumns(cut).drop("several", *[f"w{w}" for w in ws], *[f"sure{w}" for w in ws[:-1]])


def alike(requests: DataFrame, granules: DataFrame, window_days: int, cell: float, request_keys: list[str] = REQUEST_KEYS,
          time_bin_days: int | None = None, hot_key_rows: int | None = 2_000_000) -> DataFrame:
    """(request_keys, rep): the keys of requests that meet any footprint of the time, and one request's keys for all that find the
    same granules: those with the same dates and the same footprints. What is derived from a search of ``rep`` holds for all."""
    tb = int(time_bin_days or 4 * (2 * window_days + 1))
    shapes = granules.select(*[F.col(c).alias(f"g_{c}") for c in BOX], _time_bin("acquired", tb).alias("tbin")).distinct()
    met = _meeting(requests, shapes, window_days, cell, tb, request_keys, hot_key_rows)
    seen = met.groupBy(*request_keys).agg(F.sort_array(F.collect_list(F.struct("t_date", "tbin", *[f"g_{c}" for c in BOX]))).alias("seen"))
    return seen.select(*request_keys, F.min(F.struct(*request_keys)).over(Window.partitionBy("seen")).alias("rep"))


def representatives(requests: DataFrame, members: DataFrame, request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """The requests that ``alike`` names."""
    named = members.where(F.col("rep") == F.struct(*request_keys)).select("rep")
    return requests.join(named, F.struct(*[requests[k] for k in request_keys]).eqNullSafe(named["rep"]), "left_semi")


def for_members(found: DataFrame, members: DataFrame, request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """Rows of the representatives, given to each request that they stand for."""
    at = found.select(F.struct(*request_keys).alias("_rep"), *[c for c in found.columns if c not in request_keys])
    return members.join(at, F.col("rep").eqNullSafe(F.col("_rep"))).drop("rep", "_rep")


def salt_hot_keys(big: DataFrame, small: DataFrame, keys: list[str], row_keys: list[str],
                  hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Split join keys that hold more than ``hot_rows`` rows of ``big`` into salted
    sub-keys; replicate the matching ``small`` rows once per salt value.

    The hot-key table is a grouped count filtered to hot keys, so it has at most
    rows(big) / hot_rows rows: that bound is what makes the broadcast safe. Keys that
    are not hot keep salt 0 and cost nothing extra."""
    hot = (big.groupBy(*keys).agg(F.count("*").alias("_n"))
              .where(F.col("_n") > hot_rows)
              .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")))
    hot = F.broadcast(hot)
    b = big.join(hot, keys, "left")
    n = F.coalesce(F.col("_salts"), F.lit(1))
    b = b.withColumn("salt", F.pmod(F.xxhash64(*[F.col(c) for c in row_keys]), n).cast("int")).drop("_salts")
    s = (small.join(hot, keys, "left")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_salts"))
    return b, s


def validate_cloud_range(lo: float, hi: float, unit_max: float = 1.0) -> None:
    """Cloud bounds are inclusive and given in the catalogue's unit (fraction: 0..1,
    percent: 0..100); min < 0, max > unit_max and min > max are rejected."""
    if lo < 0 or hi > unit_max or lo > hi:
        raise ValueError(f"invalid cloud cover range ({lo}, {hi}) for unit max {unit_max}")


def adaptive_pick(pairs: DataFrame, windows=WINDOWS,
                  request_keys: list[str] = REQUEST_KEYS, nearest: bool = False) -> DataFrame:
    """Per request the smallest window with any hit and, inside it, the first granule.

    Equivalent to trying +-3, +-7, +-14, +-30 days in turn and stopping at the first
    success, but done with one join at the widest window and one partial aggregation:
    ``min(struct(window, acquired_at, granule_id, ...))`` is combined map-side, so only
    one row per request per task crosses the shuffle.
    """
    w = window_for_offset(F.col("day_diff"), windows)
    # default: first granule in catalogue order inside the window; nearest=True prefers
    # the acquisition closest to the target date
    near = [F.abs(F.col("day_diff")).alias("_dist")] if nearest else []
    best = (pairs.where(w.isNotNull())
            .groupBy(*request_keys, "t_date")
            .agg(F.min(F.struct(w.alias("window_days"), *near, "acquired_at", "granule_id",
                                "granule_key", "acquired", "day_diff")).alias("p")))
    return best.select(*request_keys, "t_date", "p.window_days",
                       attempt_for_window(F.col("p.window_days"), windows).alias("attempt"),
                       "p.granule_key", "p.granule_id", "p.acquired", "p.day_diff")


def adaptive_pick_banded(pairs: DataFrame, files: DataFrame, bands: list[str], windows=WINDOWS,
                         max_results: int | None = None,
                         request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """Faithful form of the widening search: a window succeeds only if, among its first
    ``max_results`` granules (catalogue order), at least one has a file of a requested
    band; the pick is the first such granule.

    One pass over a request's pairs in catalogue order counts, for each window, those inside it so far: a pair's rank in every
    window that contains it. ``pairs`` may be all pairs or those that ``search_granules`` finds with ``windows``; if these
    have a column ``wanted``, ``files`` isn't read.
    """
    ws = sorted(int(x) for x in windows)
    x = pairs
    if "wanted" not in x.columns:
        wanted = wanted_granules(files, bands).withColumn("wanted", F.lit(True))
        x = x.join(wanted, "granule_key", "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    # a wider window holds more rows before the same pair, so the narrowest window that contains a pair ranks it best ...
    narrowest = lambda v: F.abs(F.col("day_diff")) <= v      # noqa: E731
    if max_results is not None:
        rank = Window.partitionBy(*request_keys).orderBy(*PAIR_ORDER, "granule_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumns({f"_rank{v}": F.count(F.when(narrowest(v), 1)).over(rank) for v in ws})
    within = lambda v: narrowest(v) & (F.col(f"_rank{v}") <= max_results) if max_results is not None else narrowest(v)      # noqa: E731
    # ... and is the only one to try: the first pair of a wider window is never better
    x = x.withColumn("window_days", F.coalesce(*[F.when(within(v), v) for v in ws])).where(F.col("wanted") & F.col("window_days").isNotNull())
    best = (x.groupBy(*request_keys, "t_date")
             .agg(F.min(F.struct("window_days", "acquired_at", "granule_id", "granule_key",
                                 "acquired", "day_diff")).alias("p")))
    return best.select(*request_keys, "t_date", "p.window_days",
                       attempt_for_window(F.col("p.window_days"), windows).alias("attempt"),
                       "p.granule_key", "p.granule_id", "p.acquired", "p.day_diff")


def wanted_granules(files: DataFrame, bands: list[str]) -> DataFrame:
    """The granules that have a file of a requested band: distinct granule_key."""
    return files.where(F.col("band").isin(bands)).select("granule_key").distinct()


def pick_status(time_points: DataFrame, picks: DataFrame, as_of=None, windows=WINDOWS,
                request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """Every time point with its outcome: OK, NO_DATA (all windows exhausted) or
    FUTURE_DATE (the narrowest window starts after ``as_of``; nothing is searched)."""
    first_w = min(int(v) for v in windows)
    tp = time_points.select(*request_keys, "t_date")
    j = tp.join(picks.drop("t_date"), request_keys, "left")
    future = (F.date_sub(F.col("t_date"), first_w) > F.lit(as_of).cast("date")
              if as_of is not None else F.lit(False))
    status = (F.when(future, "FUTURE_DATE")
               .when(F.col("granule_key").isNull(), "NO_DATA")
               .otherwise("OK"))
    keep = lambda c: F.when(~future, F.col(c))
    return j.select(*request_keys, "t_date", status.alias("status"),
                    keep("window_days").alias("window_days"), keep("attempt").alias("attempt"),
                    keep("granule_key").alias("granule_key"), keep("granule_id").alias("granule_id"))


def search_windows(time_points: DataFrame, windows=WINDOWS, as_of=None,
                   request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """The search windows a time point would try: (attempt, window_days, start, end).
    With ``as_of`` set, a time point whose narrowest window starts after it gets
    status FUTURE_DATE and no wider windows (no widening after that error)."""
    ws = sorted(int(v) for v in windows)
    x = time_points.select(*request_keys, "t_date",
                           F.posexplode(F.array(*[F.lit(v) for v in ws])).alias("pos", "window_days"))
    start = F.date_sub(F.col("t_date"), F.col("window_days"))
    future_first = (F.date_sub(F.col("t_date"), ws[0]) > F.lit(as_of).cast("date")
                    if as_of is not None else F.lit(False))
    x = x.where(~future_first | (F.col("pos") == 0))
    return x.select(*request_keys, "t_date", (F.col("pos") + 1).cast("int").alias("attempt"),
                    "window_days", start.alias("window_start"),
                    F.date_add(F.col("t_date"), F.col("window_days")).alias("window_end"),
                    F.when(future_first, "FUTURE_DATE").otherwise("PENDING").alias("status"))


def with_requested_band(pairs: DataFrame, files: DataFrame, bands: list[str], max_results: int | None = None,
                        request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """The granules a search leaves: the first ``max_results`` of a request, less those without a requested band."""
    if max_results is not None:
        pairs = granule_listing(pairs, max_results, request_keys).drop("ordinal")
    if "wanted" in pairs.columns:      # the search has looked it up
        return pairs.where("wanted").drop("wanted")
    return pairs.join(wanted_granules(files, bands), "granule_key", "left_semi")


def granule_listing(pairs: DataFrame, max_results: int | None = None,
                    request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """Numbered listing (1-based) of the granules of each request, or its first ``max_results``."""
    w = Window.partitionBy(*request_keys).orderBy(*PAIR_ORDER)
    numbered = pairs.withColumn("ordinal", F.row_number().over(w))
    return numbered if max_results is None else numbered.where(F.col("ordinal") <= max_results)


def granule_guard(groups: DataFrame, limit: int = MAX_INTERACTIVE_GRANULES,
                  request_keys: list[str] = REQUEST_KEYS) -> DataFrame:
    """Interactive mode: a request that found more than ``limit`` granules is rejected."""
    return (groups.groupBy(*request_keys)
                  .agg(F.count("*").alias("n_granules"))
                  .withColumn("status", F.when(F.col("n_granules") > limit, "TOO_MANY_GRANULES")
                                         .otherwise("OK")))


def granule_select(numbered: DataFrame, ordinals: list[int] | None, abort: bool = False) -> DataFrame:
    """Selection by 1-based ordinals: None/[] = all; out-of-range ordinals reject the
    whole selection for that request (status INVALID_SELECTION); ``abort`` selects none."""
    if abort:
        return numbered.withColumn("selected", F.lit(False)).withColumn("status", F.lit("ABORTED"))
    if not ordinals:
        return numbered.withColumn("selected", F.lit(True)).withColumn("status", F.lit("OK"))
    arr = F.array(*[F.lit(int(o)) for o in ordinals])
    keys = [c for c in REQUEST_KEYS]
    n = F.max("ordinal").over(Window.partitionBy(*keys))
    bad = F.exists(arr, lambda o: (o < 1) | (o > n))
    return (numbered.withColumn("status", F.when(bad, "INVALID_SELECTION").otherwise("OK"))
                    .withColumn("selected", (F.col("status") == "OK")
                                & F.array_contains(arr, F.col("ordinal"))))
