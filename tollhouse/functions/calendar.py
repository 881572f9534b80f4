"""Week arithmetic.

Charges are keyed by the Monday week of the year (``%W``: days before the first Monday are week 0).
Credits cover Sunday to Saturday of the Sunday week (``%U``) with the same number. ``weekofyear``
is the ISO week and agrees with neither.

The column versions work on any number of rows; the plain Python versions handle the short list of
weeks or days a report is asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Week = tuple[int, int]


# -- columns ---------------------------------------------------------------------------------------

def monday_week(day: Column) -> Column:
    """Number of the Monday week a date falls in."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def sunday_week(day: Column) -> Column:
    """Number of the Sunday week a date falls in."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def _before_new_year(year: Column) -> Column:
    return F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1)


def week_tuesday(year: Column, week: Column) -> Column:
    """The Tuesday that stands for a Monday week in week arithmetic."""
    first_monday = F.next_day(_before_new_year(year), "MON")
    return F.date_add(first_monday, ((week - 1) * 7 + 1).cast("int"))


def shifted_week(year: Column, week: Column, by: int) -> tuple[Column, Column]:
    """(year, week) ``by`` weeks later; earlier if negative."""
    day = F.date_add(week_tuesday(year, week), 7 * by)
    return F.year(day), monday_week(day)


def sunday_week_start(year: Column, week: Column) -> Column:
    """First day (Sunday) of a Sunday week; its last day is six days later."""
    first_sunday = F.next_day(_before_new_year(year), "SUN")
    return F.date_add(first_sunday, ((week - 1) * 7).cast("int"))


# -- plain Python ----------------------------------------------------------------------------------

def week_key(day: dt.date) -> Week:
    return day.year, int(day.strftime("%W"))


def _first(year: int, weekday: int) -> dt.date:
    start = dt.date(year, 1, 1)
    return start + dt.timedelta(days=(weekday - start.weekday()) % 7)


def tuesday(week: Week) -> dt.date:
    return _first(week[0], 0) + dt.timedelta(days=(week[1] - 1) * 7 + 1)


def shift(week: Week, by: int) -> Week:
    return week_key(tuesday(week) + dt.timedelta(days=7 * by))


def span(last: Week, n: int) -> list[Week]:
    """The ``n`` weeks ending with ``last``, oldest first."""
    return [shift(last, -back) for back in range(n - 1, -1, -1)]


def sunday_week_days(week: Week) -> list[dt.date]:
    """The seven days, Sunday first, of the Sunday week with this number."""
    start = _first(week[0], 6) + dt.timedelta(days=(week[1] - 1) * 7)
    return [start + dt.timedelta(days=i) for i in range(7)]


def day_range(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def last_week(as_of: dt.date) -> Week:
    """The week before the one ``as_of`` falls in: the default report week."""
    return shift(week_key(as_of), -1)


def last_days(as_of: dt.date, n: int = 7) -> list[dt.date]:
    """The ``n`` days before ``as_of``, latest first."""
    return [as_of - dt.timedelta(days=i) for i in range(1, n + 1)]


def check_near(days: Iterable[dt.date], as_of: dt.date, limit: int) -> None:
    """Reject dates more than ``limit`` days away from ``as_of``."""
    far = [d for d in days if abs((as_of - d).days) > limit]
    if far:
        raise ValueError(f"dates more than {limit} days from {as_of}: {', '.join(map(str, far[:5]))}")
