"""Time expressions. Differences are in whole units, cut toward zero."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """``end - start`` in whole ``unit``s, so 47 hours are 1 day and -47 hours are -1 day."""
    return F.timestamp_diff(unit, start, end)


def sunday_week(ts: Column) -> Column:
    """First day of the week, weeks starting on Sunday."""
    return F.date_sub(F.date_trunc("week", F.date_add(ts.cast("date"), 1)).cast("date"), 1)


def month(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("date")


def quarter_start(ts: Column) -> Column:
    return F.date_trunc("quarter", ts).cast("date")


def calendar(ts: Column) -> dict[str, Column]:
    """Week, month and month end of a time."""
    return {
        "visit_week": sunday_week(ts),
        "visit_month": month(ts),
        "visit_month_end": F.last_day(ts.cast("date")),
    }


def previous_quarter_start(run_date: dt.date) -> dt.date:
    first = 3 * ((run_date.month - 1) // 3) + 1
    year, first = (run_date.year, first - 3) if first > 3 else (run_date.year - 1, 10)
    return dt.date(year, first, 1)


def rolling_window(ts: str, run_date: dt.date) -> Column:
    """From the start of the quarter before ``run_date`` until the day before yesterday, inclusive.

    Both bounds are plain literals compared with the raw column, so they reach the scan.
    """
    start = previous_quarter_start(run_date)
    end = run_date - dt.timedelta(days=1)
    return (F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp"))


def on_day(ts: str, day: dt.date) -> Column:
    nxt = day + dt.timedelta(days=1)
    return (F.col(ts) >= F.lit(day).cast("timestamp")) & (F.col(ts) < F.lit(nxt).cast("timestamp"))


def within_days_of(later: Column, earlier: Column, days: int) -> Column:
    """``later`` falls at most ``days`` calendar days after ``earlier``."""
    return F.date_sub(later.cast("date"), days) <= earlier.cast("date")


def same_quarter(a: Column, b: Column) -> Column:
    return (F.quarter(a) == F.quarter(b)) & (F.year(a) == F.year(b))
