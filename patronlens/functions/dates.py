"""Periods, cutoffs and day arithmetic on timestamps without time zone.

All expressions avoid the session time zone: they work on dates, intervals and NTZ casts."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, functions as F

_MONTH_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?:[ T]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?\s*$"


def parse_timestamp(text: Column) -> Column:
    """Month-first dates with optional time, else ISO; day-first only where month-first is
    impossible. Null when nothing fits."""
    time = F.concat(F.lit(" "), F.coalesce(
        F.nullif(F.regexp_extract(text, _MONTH_FIRST, 4), F.lit("")), F.lit("0:00")))
    first, second, year = (F.regexp_extract(text, _MONTH_FIRST, i) for i in (1, 2, 3))
    slashed = F.coalesce(
        F.concat_ws("", F.concat_ws("-", year, first, second), time).try_cast("timestamp_ntz"),
        F.concat_ws("", F.concat_ws("-", year, second, first), time).try_cast("timestamp_ntz"))
    return F.when(text.contains("/"), slashed).otherwise(F.trim(text).try_cast("timestamp_ntz"))


def period_name(year: int, month: int) -> str:
    return f"{year}-{month:02d}"


def period_end(period: str) -> dt.date:
    year, month = (int(part) for part in period.split("-"))
    return dt.date(year, month, calendar.monthrange(year, month)[1])


def cutoff(period: str, inclusive_end: bool = False) -> dt.datetime:
    """Last instant that belongs to the period: month-end midnight, so sales later on the
    last day fall into the next period; with `inclusive_end` the whole last day."""
    moment = dt.time.max if inclusive_end else dt.time.min
    return dt.datetime.combine(period_end(period), moment)


def period_range(first: str, last: str) -> list[str]:
    year, month = (int(part) for part in first.split("-"))
    periods = []
    while period_name(year, month) <= last:
        periods.append(period_name(year, month))
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return periods


def timestamp_literal(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def entry_period(ts: Column, inclusive_end: bool = False) -> Column:
    """'yyyy-MM' of the first month whose cutoff is not before `ts`."""
    if inclusive_end:
        day = ts.cast("date")
    else:
        # one day minus a microsecond carries everything past month-end midnight over
        day = (ts + F.expr("interval '1' day - interval '0.000001' second")).cast("date")
    return F.substring(day.cast("string"), 1, 7)


def month_name(ts: Column) -> Column:
    return F.substring(ts.cast("date").cast("string"), 1, 7)


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Number of whole 24-hour days, floored (an hour short of a day counts as less)."""
    def time_of_day(ts: Column) -> Column:
        return ts - ts.cast("date").cast("timestamp_ntz")
    return (F.datediff(later.cast("date"), earlier.cast("date"))
            - (time_of_day(later) < time_of_day(earlier)).cast("int"))


def date_key(ts: Column) -> Column:
    day = ts.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
