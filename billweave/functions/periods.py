"""Billing months as ``yyyy-MM`` text, and their timestamps."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month text format, the month text of a manifest without a start, valid month text.
PERIOD_FORMAT = "yyyy-MM"
UNKNOWN_PERIOD = "unknown"
VALID_PERIOD = r"^\d{4}-(0[1-9]|1[0-2])$"


def period_of(ts: Column) -> Column:
    return F.date_format(ts, PERIOD_FORMAT)


def period_text(year: Column, month: Column) -> Column:
    """The same text from year and month numbers."""
    return F.format_string("%04d-%02d", year, month)


def manifest_period(start: Column) -> Column:
    """Month of a manifest start such as ``20250901T000000.000Z`` or ``2025-09-01``."""
    compact = F.concat_ws("-", F.substring(start, 1, 4), F.substring(start, 5, 2))
    return (
        F.when(start.isNull() | (start == ""), F.lit(UNKNOWN_PERIOD))
        .when(start.rlike("^[0-9]{6}"), compact)
        .otherwise(F.substring(start, 1, 7))
    )


def period_start(period: Column) -> Column:
    """First instant of a month, without zone."""
    return F.to_timestamp_ntz(F.concat(period, F.lit("-01")), F.lit("yyyy-MM-dd"))


def period_end(period: Column) -> Column:
    return F.add_months(period_start(period).cast("date"), 1).cast("timestamp_ntz")


def month_floor(ts: Column) -> Column:
    """First instant of a timestamp's month. ``trunc`` gives a date, so no zone comes in."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def is_valid_period(period: Column) -> Column:
    return period.rlike(VALID_PERIOD)


def check_period(period: str | None) -> None:
    if period is not None and not re.match(VALID_PERIOD, period):
        raise ValueError(f"month must be YYYY-MM, got {period!r}")


def in_range(period: Column, start: str | None = None, end: str | None = None) -> Column:
    """Months from ``start`` to ``end``, both included, either open."""
    check_period(start)
    check_period(end)
    bounds = [period >= start] if start else []
    bounds += [period <= end] if end else []
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def in_month(ts: Column, period: str) -> Column:
    """Half-open timestamp range of one month; both bounds reach the Parquet scan."""
    check_period(period)
    first = F.lit(period)
    return (ts >= period_start(first)) & (ts < period_end(first))


def utc_wall_time(ts: Column) -> Column:
    """Zoned timestamp -> UTC time without zone, whatever the session's zone."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)
