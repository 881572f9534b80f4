"""What the free allowance costs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week, day_range
from tollhouse.functions.measures import as_double, external, ratio, total, usage_total
from tollhouse.functions.text import matches
from tollhouse.operators.accounts import without
from tollhouse.operators.periods import in_days, in_weeks, one_row_per_week
from tollhouse.plans.extracts import daily_charges, price_list, price_plan
from tollhouse.profiles import FREE_OFFERING, FREE_OFFERINGS
from tollhouse.sources.tables import Tables

Month = tuple[int, int]
# Free hours per week, price over cost.
FREE_HOURS = 24 * 7
MARKUP = 1.4
PUBLIC_PLAN = 2


def _hours() -> Column:
    return F.col("usage_value").cast("decimal(18,2)")


def freetier_daily_cost(t: Tables, days: Sequence[dt.date], plan: int = PUBLIC_PLAN) -> DataFrame:
    """External revenue per day, cost of the free small instances, and what the next size would cost."""
    # "." is any character when searching and a dot when replacing
    free = matches(F.col("usage_type"), "t2.micro") & (F.col("offering_id") == FREE_OFFERING) & (F.col("price_per_unit") == 0)
    rows = daily_charges(t, days).where(external())
    sums = rows.groupBy("computation_date", "usage_type").agg(
        total("billed_amount").alias("revenue"), total(_hours(), F.coalesce(free, F.lit(False))).alias("hours")
    )
    bigger = F.replace(F.col("usage_type"), F.lit("t2.micro"), F.lit("t2.small"))
    price = price_plan(t, plan)
    priced = (
        sums.withColumn("bigger_type", bigger)
        .join(price.withColumnRenamed("price", "now"), "usage_type", "left")
        .join(price.select(F.col("usage_type").alias("bigger_type"), F.col("price").alias("then")), "bigger_type", "left")
    )
    daily = priced.groupBy("computation_date").agg(
        as_double(F.sum("revenue")).alias("revenue"),
        (as_double(total(F.col("hours") * F.col("now")), 4) / MARKUP).alias("current_cost"),
        (as_double(total(F.col("hours") * F.col("then")), 4) / MARKUP).alias("new_cost"),
        F.count_if((F.col("hours") > 0) & (F.col("now").isNull() | F.col("then").isNull())).alias("unpriced_rows"),
    )
    return daily.withColumn("ratio", ratio(F.col("current_cost"), F.col("revenue")))


def freetier_track(t: Tables, days: Sequence[dt.date], plan: int = PUBLIC_PLAN) -> DataFrame:
    """Billed amount and free cost per day of both small instance types."""
    rows = daily_charges(t, days).where(external() & F.col("offering_id").isin(*FREE_OFFERINGS))
    sums = rows.groupBy("computation_date", "usage_type").agg(
        total("billed_amount").alias("billed"), total(_hours(), F.col("price_per_unit") == 0).alias("hours")
    )
    priced = sums.join(price_plan(t, plan), "usage_type", "left")
    small = matches(F.col("usage_type"), "t2.small|t2.micro")
    aggs = [F.count_if(small & (F.col("hours") > 0) & F.col("price").isNull()).alias("unpriced_rows")]
    for name, pattern in {"t2_small": "t2.small", "t2_micro": "t2.micro"}.items():
        here = matches(F.col("usage_type"), pattern)
        aggs += [
            as_double(total("billed", here)).alias(f"{name}_bill"),
            (as_double(total(F.col("hours") * F.col("price"), here), 4) / MARKUP).alias(f"{name}_cost"),
        ]
    return priced.groupBy("computation_date").agg(*aggs)


def _month_days(months: Sequence[Month]) -> list[dt.date]:
    ends = [(dt.date(y, m, 1), dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)) for y, m in months]
    return [d for first, last in ends for d in day_range(first, last)]


def freetier_month_rows(t: Tables, months: Sequence[Month]) -> DataFrame:
    """External charge lines of the smallest instance that cost nothing, by month."""
    month = F.date_format("computation_date", "yyyy-MM")
    free = external() & F.col("usage_type").contains("t2.micro") & (F.col("billed_amount") == 0)
    rows = in_days(t.daily_charges, "computation_date", _month_days(months)).where(free).withColumn("month", month)
    return without(rows, t.test_accounts).select(
        "month", "account_id", "is_internal_flag", as_double("billed_amount").alias("billed_amount"), "usage_type", "usage_value",
        as_double("price_per_unit", 4).alias("price_per_unit"), "region", "credit_id", "charge_item_desc",
    )


def freetier_month_cost(t: Tables, months: Sequence[Month], instance: str = "t2.micro") -> DataFrame:
    """Those hours at the regional price; regions without a price do not count and are numbered in ``unpriced_rows``."""
    rows = freetier_month_rows(t, months).where(F.col("region").isNotNull())
    hours = rows.groupBy("month", "region").agg(usage_total().cast("decimal(20,2)").alias("hours"))
    prices = price_list(t.price_wide).where((F.col("usage_type") == instance) & F.col("price").isNotNull())
    priced = hours.join(prices.select("region", "price"), "region", "left").groupBy("month")
    return priced.agg(as_double(total(F.col("hours") * F.col("price")), 4).alias("cost"), F.count_if(F.col("price").isNull()).alias("unpriced_rows"))


def monthly_revenue(t: Tables, months: Sequence[Month] | None = None) -> DataFrame:
    """External revenue by month, of the given months or of all."""
    month = F.date_format("computation_date", "yyyy-MM").alias("month")
    rows = t.daily_charges if months is None else in_days(t.daily_charges, "computation_date", _month_days(months))
    return rows.where(external()).groupBy(month).agg(as_double(F.sum("billed_amount")).alias("revenue"))


def freetier_month_report(t: Tables, months: Sequence[Month]) -> DataFrame:
    """Cost of the free hours next to the month's revenue."""
    return freetier_month_cost(t, months).join(monthly_revenue(t, months), "month", "left")


def freetier_members(t: Tables) -> DataFrame:
    """Accounts in the free tier and the weeks they were."""
    return t.free_tier.select("account_id", "year", "week")


def t2small_free_cost(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Hours of free-tier accounts on the second-smallest instance, up to a full week each, at what they pay.

    A region with several unit prices counts once per price.
    """
    members = in_weeks(t.free_tier, weeks).select("year", "week", "account_id").distinct()
    keys = ["year", "week", "account_id", "region"]
    rows = in_weeks(t.weekly_charges, weeks).where(external() & F.col("usage_type").contains("t2.small"))
    sums = rows.groupBy(*keys, "price_per_unit").agg(usage_total().alias("usage"))
    free = sums.join(members, ["year", "week", "account_id"], "left_semi")
    prices = free.select("year", "week", "region", "price_per_unit").distinct().groupBy("year", "week", "region")
    prices = prices.agg(F.sum("price_per_unit").alias("price"), F.count_if(F.col("price_per_unit").isNull()).alias("unpriced"))
    used = free.groupBy(*keys).agg(F.least(usage_total("usage"), F.lit(float(FREE_HOURS))).cast("decimal(18,2)").alias("free_amount"))
    # hours are added up per region before they meet its few prices; accounts are counted apart
    hours = used.groupBy("year", "week", "region").agg(F.sum("free_amount").alias("hours"))
    cost = hours.join(prices, ["year", "week", "region"]).groupBy("year", "week")
    cost = cost.agg(as_double(F.sum(F.col("hours") * F.col("price")), 4).alias("cost"), F.sum("unpriced").alias("unpriced_rows"))
    users = free.where(F.col("region").isNotNull()).select("year", "week", "account_id").distinct()
    users = users.groupBy("year", "week").agg(F.count(F.lit(1)).alias("t2small_user_count"))
    weekly = cost.join(users, ["year", "week"])
    counts = members.groupBy("year", "week").agg(F.count(F.lit(1)).alias("freetier_count"))
    return one_row_per_week(counts.join(weekly, ["year", "week"], "left"), weeks)
