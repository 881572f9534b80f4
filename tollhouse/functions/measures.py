"""Sums and roundings shared by the reports.

Money stays decimal until the last step, so totals do not depend on the order of addition; reports
hand out doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: weeks per month.
WEEKS_PER_MONTH = Decimal("4.345238")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(amount: Column | str, when: Column | None = None) -> Column:
    """Sum, zero where nothing qualifies."""
    value = col(amount)
    if when is not None:
        value = F.when(when, value)
    return F.coalesce(F.sum(value), F.lit(0))


def usage_total(usage: Column | str = "usage_value", when: Column | None = None) -> Column:
    """Sum of usage: added as decimals, so that it does not depend on the order of addition, and given as a double."""
    value = col(usage).cast("decimal(18,6)")
    if when is not None:
        value = F.when(when, value)
    return F.sum(value).cast("double")


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def as_double(amount: Column | str, scale: int = 2) -> Column:
    return F.round(col(amount), scale).cast("double")


def doubles(df, *names: str, scale: int = 2):
    """Turn the named decimal columns into doubles, rounded to ``scale``."""
    return df.withColumns({n: as_double(n, scale) for n in names})


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in doubles; NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def external() -> Column:
    return F.col("is_internal_flag") == "N"


def internal() -> Column:
    return F.col("is_internal_flag") == "Y"


def weeks_back(n: int) -> Column:
    """Rows spread over report weeks: those ``n`` weeks before theirs."""
    return F.col("back") == n


days_back = weeks_back
