"""Weekly and daily rows, less the test accounts, and the sums most reports start from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import usage_total
from tollhouse.functions.text import rest
from tollhouse.operators.accounts import without
from tollhouse.operators.periods import in_days, in_weeks
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables


def week_calendar(df: DataFrame, day: str) -> DataFrame:
    """The distinct days of a table with their weeks, the weeks next to them and the Sunday-week range."""
    days = df.select(F.to_date(day).alias("day")).distinct()
    year, week = F.year("day"), calendar.monday_week(F.col("day"))
    dated = days.select("day", year.alias("year"), week.alias("week"), calendar.sunday_week(F.col("day")).alias("sunday_week"))
    before = calendar.shifted_week(F.col("year"), F.col("week"), -1)
    after = calendar.shifted_week(F.col("year"), F.col("week"), 1)
    start = calendar.sunday_week_start(F.col("year"), F.col("week"))
    return dated.select(
        "*",
        before[0].alias("previous_year"),
        before[1].alias("previous_week"),
        after[0].alias("next_year"),
        after[1].alias("next_week"),
        start.alias("range_start"),
        F.date_add(start, 6).alias("range_end"),
    )


def weekly_charges(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Charge lines of the weeks."""
    return without(in_weeks(t.weekly_charges, weeks), t.test_accounts)


def account_charges(t: Tables, weeks: Sequence[Week], *keys: str, where: Column | None = None) -> DataFrame:
    """Charges per (year, week, account_id, *keys), summed before the test accounts are taken out."""
    rows = in_weeks(t.weekly_charges, weeks)
    if where is not None:
        rows = rows.where(where)
    sums = rows.groupBy("year", "week", "account_id", *keys).agg(F.sum("billed_amount").alias("billed_amount"))
    return without(sums, t.test_accounts)


def charged_accounts(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Accounts with a charge line in the week, as (year, week, account_id)."""
    seen = in_weeks(t.weekly_charges, weeks).select("year", "week", "account_id").distinct()
    return without(seen, t.test_accounts)


METERING_KEYS = ("year", "week", "account_id", "is_internal_flag", "usage_resource", "usage_type", "region")


def metering_lines(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Usage summed per account, resource, usage type and region (and operation, for service B), test accounts included."""
    rows = in_weeks(t.weekly_metering, weeks)
    if profile.metering_instances_only:
        rows = rows.where(F.col("usage_type").contains(profile.instance_token))
    keys = [*METERING_KEYS, *(["operation"] if profile.metering_by_operation else [])]
    return rows.groupBy(*keys).agg(usage_total().alias("sum_usage_value"))


def weekly_metering(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """The same without the test accounts."""
    return without(metering_lines(t, weeks, profile), t.test_accounts)


def weekly_usage_by_domain(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Usage summed per account, resource and region."""
    keys = [k for k in METERING_KEYS if k != "usage_type"]
    return in_weeks(t.weekly_metering, weeks).groupBy(*keys).agg(usage_total().alias("sum_usage_value"))


def daily_charges(t: Tables, days: Sequence[dt.date]) -> DataFrame:
    return in_days(t.daily_charges, "computation_date", days)


def daily_metering(t: Tables, days: Sequence[dt.date]) -> DataFrame:
    return in_days(t.daily_metering, "request_day", days)


def price_list(prices: DataFrame) -> DataFrame:
    """Wide price list (three key columns, one column per region) as one row per region."""
    keys, regions = prices.columns[:3], prices.columns[3:]
    return prices.unpivot(keys, regions, "region", "price")


def price_plan(t: Tables, plan: int) -> DataFrame:
    """(usage_type, price) of one plan."""
    return t.price_plan.where(F.col("plan_id") == plan).select("usage_type", F.col("price_unit").alias("price"))


def instance_type() -> Column:
    return rest(F.col("usage_type"), ":")
