"""Time arithmetic on TIMESTAMP_NTZ columns.

Everything here reads the clock of the local timestamp, so no result depends on
the session time zone, and all of it runs in generated code.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_day(ts: Column | str) -> Column:
    """The date of a timestamp."""
    return F.to_date(_col(ts))


def second_number(ts: Column | str) -> Column:
    """Whole seconds from 1970-01-01 to the second that contains ``ts``.

    ``unix_timestamp`` reads a local timestamp's own clock with one division, but
    rounds toward 1970. Earlier instants are put together from calendar fields.
    """
    ts = _col(ts)
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    from_fields = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.when(ts < _ntz(datetime(1970, 1, 1)), from_fields).otherwise(F.unix_timestamp(ts))


def minute_number(ts: Column | str) -> Column:
    """Whole minutes from 1970-01-01 to the minute that contains ``ts``."""
    return F.floor(second_number(ts) / 60)


def boundary_minutes(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``, signed.

    10:00:59 to 10:01:00 is 1, and 10:00:00 to 10:00:59 is 0. ``timestampdiff``
    counts elapsed whole minutes instead and gives 0 for the first.
    """
    return minute_number(end) - minute_number(start)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``, signed."""
    return second_number(end) - second_number(start)


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in fractional minutes, from whole seconds."""
    return elapsed_seconds(start, end) / F.lit(60.0)


def calendar_parts(ts: Column | str, *, day: bool = False, prefix: str = "pickup") -> list[Column]:
    """Year, month and hour columns (and day of month on request)."""
    ts = _col(ts)
    parts = [F.year(ts).alias(f"{prefix}_year"), F.month(ts).alias(f"{prefix}_month")]
    if day:
        parts.append(F.dayofmonth(ts).alias(f"{prefix}_day"))
    return [*parts, F.hour(ts).alias(f"{prefix}_hour")]


def month_start(ts: Column | str) -> Column:
    """First instant of the month, TIMESTAMP_NTZ (``date_trunc`` would return a zoned one)."""
    return F.trunc(F.to_date(_col(ts)), "MM").cast("timestamp_ntz")


def _instant(value: date | datetime | str) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day)


def _ntz(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def half_open(
    ts: Column | str,
    start: date | datetime | str,
    end: date | datetime | str,
    *,
    year: Column | str | None = None,
    month: Column | str | None = None,
) -> Column:
    """``start <= ts < end``.

    Spark prunes partitions only on predicates over partition columns. Where the
    data is partitioned by the year and month of ``ts``, pass those columns and
    the implied predicates on them are added.
    """
    start, end = _instant(start), _instant(end)
    ts = _col(ts)
    inside = (ts >= _ntz(start)) & (ts < _ntz(end))
    last = max(end - timedelta(microseconds=1), start)
    if year is not None:
        inside &= _col(year).between(start.year, last.year)
        if month is not None:
            months = _col(year) * 12 + _col(month)
            inside &= months.between(start.year * 12 + start.month, last.year * 12 + last.month)
    return inside


def on_day(
    ts: Column | str,
    day: date | str,
    *,
    year: Column | str | None = None,
    month: Column | str | None = None,
) -> Column:
    """``ts`` falls on ``day``, as a range that can be pushed into the scan."""
    first = _instant(day)
    return half_open(ts, first, first + timedelta(days=1), year=year, month=month)
