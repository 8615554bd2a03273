"""Date helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldstack.constants import N_TIME_POINTS, WINDOWS


def time_points(start: Column, end: Column, n: int = N_TIME_POINTS) -> Column:
    """ARRAY<DATE> of n evenly spaced dates; the fractional day is dropped (floor), the
    last point is the end date itself."""
    days = F.datediff(end, start)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.date_add(start, F.floor(days * i / (n - 1)).cast("int")),
    )


def date_spec(spec: Column) -> Column:
    """'a,b' -> struct(start=a, end=b); 'a' -> struct(a, a). Blank parts stay NULL."""
    parts = F.split(spec, ",")
    first = F.try_to_date(F.trim(F.element_at(parts, 1)))
    second = F.when(F.size(parts) >= 2, F.try_to_date(F.trim(F.element_at(parts, 2)))) \
              .otherwise(first)
    return F.struct(first.alias("start"), second.alias("end"))


def window_array(windows=WINDOWS) -> Column:
    return F.array(*[F.lit(int(w)) for w in windows])


def window_for_offset(day_diff: Column, windows=WINDOWS) -> Column:
    """Smallest window (days) that contains an offset of ``day_diff`` days, else NULL."""
    ws = sorted(int(w) for w in windows)
    expr = F.lit(None).cast("int")
    for w in reversed(ws):
        expr = F.when(F.abs(day_diff) <= w, F.lit(w)).otherwise(expr)
    return expr


def attempt_for_window(window: Column, windows=WINDOWS) -> Column:
    """1-based attempt number of a window size."""
    return F.array_position(window_array(windows), window).cast("int")


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(ts_ntz: Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ -> TIMESTAMP instant read as UTC, independent of the
    session time zone (event-time watermarks need TIMESTAMP)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts_ntz))


def instant_to_ntz(ts: Column) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch_ntz())


# ---- time-zone-free text for dates and TIMESTAMP_NTZ ----------------------------------
# date_format() casts TIMESTAMP_NTZ through the session time zone, which moves wall-clock
# times that fall in a daylight-saving gap; these build the text from the fields instead.

def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def date_text(d: Column) -> Column:
    """DATE -> 'yyyy-MM-dd'."""
    return F.concat_ws("-", _pad(F.year(d), 4), _pad(F.month(d), 2), _pad(F.dayofmonth(d), 2))


def ntz_millis(ts: Column) -> Column:
    return (F.floor(F.extract(F.lit("SECOND"), ts) * 1000) % 1000).cast("int")


def ntz_text(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> 'yyyy-MM-dd HH:mm:ss,SSS' (log style)."""
    return F.concat(date_text(ts.cast("date")), F.lit(" "), _pad(F.hour(ts), 2), F.lit(":"),
                    _pad(F.minute(ts), 2), F.lit(":"), _pad(F.floor(F.second(ts)), 2), F.lit(","),
                    _pad(ntz_millis(ts), 3))


def ntz_doy_text(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> 'yyyyDDD'T'HHmmss' (granule-name style)."""
    return F.concat(_pad(F.year(ts), 4), _pad(F.dayofyear(ts), 3), F.lit("T"), _pad(F.hour(ts), 2),
                    _pad(F.minute(ts), 2), _pad(F.floor(F.second(ts)), 2))


def parse_doy_ntz(text: Column) -> Column:
    """'yyyyDDD'T'HHmmss' -> TIMESTAMP_NTZ (NULL if malformed)."""
    ok = text.rlike(r"^\d{7}T\d{6}$")
    return F.when(ok, F.to_timestamp_ntz(text, F.lit("yyyyDDD'T'HHmmss")))
