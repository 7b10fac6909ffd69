"""Market time: New York local time, sessions, minute grids. No function reads the clock; times are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKET_ZONE = "America/New_York"
#: Minutes of the local day at which sessions begin and end (fixed values of the exchange calendar).
PRE_OPEN, OPEN, CLOSE, POST_CLOSE = 4 * 60, 9 * 60 + 30, 16 * 60, 20 * 60


def local_time(ts: Column, zone: str = MARKET_ZONE) -> Column:
    """UTC timestamp without zone to local wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def utc_time(local: Column, zone: str = MARKET_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local.cast("timestamp_ntz"))


def trade_date(ts: Column) -> Column:
    return local_time(ts).cast("date")


def minute_of_day(ts: Column) -> Column:
    local = local_time(ts)
    return F.hour(local) * 60 + F.minute(local)


def session_label(ts: Column) -> Column:
    """premarket, regular, postmarket or overnight, by New York wall time."""
    m = minute_of_day(ts)
    return (
        F.when((m >= PRE_OPEN) & (m < OPEN), "premarket").when((m >= OPEN) & (m < CLOSE), "regular")
        .when((m >= CLOSE) & (m < POST_CLOSE), "postmarket").otherwise("overnight")
    )


def in_session(ts: Column, mode: str = "all", start: int | None = None, end: int | None = None, weekdays_only: bool = False) -> Column:
    """Whether a time lies in the chosen session; a custom window (minutes of day) may cross midnight, equal ends mean always."""
    m = minute_of_day(ts)
    if mode == "all":
        ok = F.lit(True)
    elif mode == "regular":
        ok = (m >= OPEN) & (m < CLOSE)
    elif mode == "extended":
        ok = (m >= PRE_OPEN) & (m < POST_CLOSE)
    elif mode == "custom":
        ok = (m >= start) & (m < end) if start < end else (m >= start) | (m < end) if start > end else F.lit(True)
    else:
        raise ValueError(f"unknown session mode {mode!r}")
    return ok & (F.weekday(local_time(ts)) < 5) if weekdays_only else ok


def clock_grid(dates: DataFrame, minutes: list[int], date_col: str = "trade_date") -> DataFrame:
    """Every date with each local minute, as UTC timestamps: bars are met by an equality join, not by time-zone maths per row."""
    at = dates.select(date_col, F.explode(F.array(*[F.lit(m) for m in minutes])).alias("minute"))
    local = F.col(date_col).cast("timestamp_ntz") + F.make_dt_interval(mins="minute")
    return at.withColumn("clock_ts", utc_time(local))


def rfc3339(text: Column) -> Column:
    """RFC 3339 text with up to nanoseconds as a UTC timestamp, cut to microseconds; null if malformed."""
    cut = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.to_timestamp_ntz(F.date_format(F.try_to_timestamp(cut).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


#: The minute of the New York day after which its session is complete; the scan's window in London; when outcomes may be taken.
COMPLETE_MINUTE, SCAN_ZONE, SCAN_WINDOW, CAPTURE_MINUTE = 20 * 60 + 15, "Europe/London", (22 * 60 + 45, 23 * 60 + 5), 18 * 60 + 30


def complete_date(now: Column) -> Column:
    """The latest New York date whose whole session can be known at this time."""
    return F.date_sub(trade_date(now), F.when(minute_of_day(now) >= COMPLETE_MINUTE, 0).otherwise(1))


def scan_due(now: Column, last: Column) -> Column:
    """Whether the daily scan is to run: a London weekday, inside the window (its last minute's beginning included), not yet run that date (last: null for never)."""
    local = local_time(now, SCAN_ZONE)
    seconds = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    exact = F.date_format(local, "SSSSSS") == "000000"
    inside = (seconds >= SCAN_WINDOW[0] * 60) & ((seconds < SCAN_WINDOW[1] * 60) | ((seconds == SCAN_WINDOW[1] * 60) & exact))
    return (F.weekday(local) < 5) & inside & ~last.eqNullSafe(local.cast("date"))


def capture_due(now: Column, last: Column) -> Column:
    """Whether outcomes are to be taken: a New York weekday, after the session, not yet that date."""
    return (F.weekday(local_time(now)) < 5) & (minute_of_day(now) >= CAPTURE_MINUTE) & ~last.eqNullSafe(trade_date(now))


def price_session(ts: Column) -> Column:
    """pre_market, regular, after_hours or closed (weekends too) by New York wall time; unknown for null."""
    m = minute_of_day(ts)
    return F.when(ts.isNull(), "unknown").when(F.weekday(local_time(ts)) >= 5, "closed").when(m < OPEN, "pre_market").when(m < CLOSE, "regular").when(m < POST_CLOSE, "after_hours").otherwise("closed")
