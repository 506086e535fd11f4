"""Ratios, roundings and time expressions; all native, none raises under ANSI."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def range_pct(low: Column, high: Column, vwap: Column) -> Column:
    return F.round(percent(high - low, vwap), 2)


def spread_bps(spread: Column, vwap: Column) -> Column:
    return F.round(ratio(spread, vwap) * 10_000, 1)


def width_micros(duration: str) -> Column:
    """Length of a duration such as ``5 minutes``; folded to a constant."""
    if re.search(r"month|year", duration, re.IGNORECASE):
        raise ValueError(f"{duration!r} has no fixed length; use days or shorter units")
    return F.unix_micros(F.expr(f"TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL '{duration}'"))


def window_start(event_time: Column, duration: str) -> Column:
    """Start of the epoch-aligned tumbling window that holds ``event_time``.

    Equals ``window(event_time, duration).start``; as plain arithmetic it adds no
    filter of its own and nothing to compute per row but one remainder.
    """
    micros = F.unix_micros(event_time)
    return F.timestamp_micros(micros - F.pmod(micros, width_micros(duration)))


def window_end(start: Column, duration: str) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + width_micros(duration))


def utc_date(event_time: Column) -> Column:
    """The UTC calendar date, whatever zone the session has."""
    micros = F.unix_micros(event_time)
    days = (micros - F.pmod(micros, F.lit(DAY_MICROS))) / DAY_MICROS
    return F.date_from_unix_date(days.cast("int"))


def in_regular_session(event_time: Column, zone: str = "America/New_York") -> Column:
    """Monday to Friday, 09:30:00 to 16:00:00 local, both ends included."""
    local = F.from_utc_timestamp(event_time, zone)
    minute_of_day = F.pmod(F.unix_micros(local), F.lit(DAY_MICROS)) / 60_000_000
    return F.weekday(local).between(0, 4) & minute_of_day.between(9 * 60 + 30, 16 * 60)
