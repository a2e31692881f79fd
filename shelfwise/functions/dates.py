"""Date windows relative to an explicit ``as_of`` date (the reference's "today")."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_col(as_of) -> Column:
    """``as_of`` as a DATE literal; ``None`` means the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else F.lit(as_of)


def trailing_days(date_col: Column, as_of, days: int) -> Column:
    """``as_of - days <= date <= as_of`` (inclusive lower bound: days + 1 dates)."""
    a = as_of_col(as_of)
    return (date_col >= F.date_sub(a, days)) & (date_col <= a)


def last_n_days(date_col: Column, as_of, days: int) -> Column:
    """Exactly ``days`` dates ending at ``as_of`` (the BI "period ending" form)."""
    a = as_of_col(as_of)
    return (date_col > F.date_sub(a, days)) & (date_col <= a)


def trailing_months(date_col: Column, as_of, months: int, whole_months: bool = False) -> Column:
    """``add_months(as_of, -months) <= date <= as_of``; short months clamp.

    The cut-off falls mid-month, so the first month bucket is partial;
    ``whole_months=True`` starts at the first day of the cut-off's month.
    """
    a = as_of_col(as_of)
    start = F.add_months(a, -months)
    if whole_months:
        start = F.trunc(start, "month")
    return (date_col >= start) & (date_col <= a)


def last_n_months(date_col: Column, as_of, months: int) -> Column:
    """``add_months(as_of, -months) < date <= as_of`` (period ending at as_of)."""
    a = as_of_col(as_of)
    return (date_col > F.add_months(a, -months)) & (date_col <= a)


def year_to_date(date_col: Column, as_of) -> Column:
    a = as_of_col(as_of)
    return (date_col >= F.trunc(a, "year")) & (date_col <= a)


def up_to(date_col: Column, as_of) -> Column:
    return date_col <= as_of_col(as_of)


def month_start(date_col: Column) -> Column:
    """First day of the month, as DATE (``trunc``; ``date_trunc`` would give a timestamp)."""
    return F.trunc(date_col, "month")


def month_number(date_col: Column) -> Column:
    """Months since year 0: consecutive months differ by exactly 1."""
    return F.year(date_col) * 12 + F.month(date_col) - 1


def date_range(date_col: Column, start=None, end=None) -> Column:
    """Optional slicer ``start <= date <= end``; ``None`` bounds are open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (date_col >= as_of_col(start))
    if end is not None:
        cond = cond & (date_col <= as_of_col(end))
    return cond
