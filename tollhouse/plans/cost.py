"""What running the service costs, by component.

The product's own usage is small once it is summed by usage type. Each usage type is then offered
to every component it belongs to, brought into the shape of the price list, and priced in one join.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import WEEKS_PER_MONTH, as_double, ratio, total, usage_total
from tollhouse.functions.text import HOME_REGION, head, matches, region, rest
from tollhouse.operators.accounts import without
from tollhouse.operators.periods import in_weeks, one_row_per_week
from tollhouse.plans.extracts import price_list
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables

WEEK = ("year", "week")
# Product codes whose usage is priced, and those charged at half of what is billed.
COMPUTE, OBJECTS, TABLES = "AmazonEC2", "AmazonS3", "AmazonDynamoDB"
HALF_BILLED = {"swf_cost": "AmazonSWF", "cf_cost": "AmazonCloudFront", "r53_cost": "AmazonRoute53"}
# Shares of billed amount, of the priced components, and of revenue.
BILLED_SHARE, BANDWIDTH_SHARE, SALES_SHARE = Decimal("0.5"), Decimal("0.11"), Decimal("0.043")
BANDWIDTH_OVER = ("ec2_cost", "ebs_cost", "elb_cost", "monitor_cost", "s3_cost")


def _dashed(usage: Column) -> tuple[Column, Column]:
    """``<region>-<type>``; in the home region the whole text is the type."""
    code = region(head(usage, "-"))
    return code, F.when(code == HOME_REGION, usage).otherwise(rest(usage, "-"))


def _components(profile: ServiceProfile) -> dict[str, tuple[Column, Column, Column]]:
    """Component -> (does a usage type belong to it, its region, its type in the price list)."""
    usage, product = F.col("usage_type"), F.col("client_product_code")
    place, kind = head(usage, ":"), rest(usage, ":")
    if profile.default_compute_type:
        kind_of_box = F.when(kind == "", profile.default_compute_type).otherwise(kind)
    else:
        kind_of_box = kind
    box_region = region(F.when(rest(place, "-") == "", "").otherwise(head(place, "-")))
    code, dashed = _dashed(usage)
    monitored = F.replace(dashed, F.lit(profile.monitor_prefix), F.lit("")) if profile.monitor_prefix else dashed
    # Usage-type patterns of the components.
    parts = {
        "ec2_cost": ((product == COMPUTE) & matches(usage, "BoxUsage"), box_region, kind_of_box),
        "ebs_cost": ((product == COMPUTE) & matches(usage, "VolumeUsage"), region(head(place, "-")), kind),
        "elb_cost": ((product == COMPUTE) & matches(usage, "LoadBalancer|DataProcessing-Bytes"), code, dashed),
        "monitor_cost": (matches(usage, "MonitorUsage"), code, monitored),
        "s3_cost": (product == OBJECTS, code, dashed),
        "dynamo_cost": (product == TABLES, code, dashed),
    }
    if not profile.full_cost_model:
        del parts["ebs_cost"]
    return parts


def _priced(usage: DataFrame, t: Tables, profile: ServiceProfile) -> DataFrame:
    """One row per (week, usage type, component) with its price, if there is one."""
    offers = [
        F.when(belongs, F.struct(F.lit(name).alias("component"), where.alias("region"), kind.alias("priced_type")))
        for name, (belongs, where, kind) in _components(profile).items()
    ]
    rows = usage.select("*", F.inline(F.filter(F.array(*offers), lambda x: x.isNotNull()))).alias("u")
    prices = price_list(t.price_wide).alias("p")
    same = (
        F.col("u.region").eqNullSafe(F.col("p.region"))
        & F.col("u.priced_type").eqNullSafe(F.col("p.usage_type"))
        & F.col("u.client_product_code").eqNullSafe(F.col("p.client_product_code"))
    )
    return rows.join(prices, same, "left").select("u.*", "p.price")


def _weekly_cost(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """All components in decimals, and the revenue of the week."""
    rows = in_weeks(t.product_weekly_charges, weeks).dropna(subset=["client_product_code", "usage_type", "usage_value", "billed_amount"])
    usage = rows.groupBy("year", "week", "client_product_code", "usage_type").agg(
        usage_total().cast("decimal(20,2)").alias("usage_value"), F.sum("billed_amount").alias("billed_amount")
    )
    usage = t.shared(usage)
    cost = F.col("price") * F.col("usage_value")
    names = list(_components(profile))
    priced = _priced(usage, t, profile).groupBy(*WEEK).agg(
        *[total(cost, F.col("component") == n).alias(n) for n in names],
        F.count(F.when(F.col("price").isNull(), 1)).alias("unpriced_rows"),
    )
    code, amount = F.col("client_product_code"), F.col("usage_value")
    volume = {
        "ebs_volume": (code == COMPUTE) & matches(F.col("usage_type"), "VolumeUsage"),
        "s3_volume": (code == OBJECTS) & matches(F.col("usage_type"), "TimedStorage"),
    }
    direct = usage.groupBy(*WEEK).agg(
        *[(total(amount, c).cast("decimal(24,2)") * F.lit(WEEKS_PER_MONTH)).alias(n) for n, c in volume.items()],
        *[(total("billed_amount", code == c) * F.lit(BILLED_SHARE)).alias(n) for n, c in HALF_BILLED.items()],
    )
    per_account = in_weeks(t.weekly_charges, weeks).groupBy("year", "week", "account_id").agg(F.sum("billed_amount").alias("billed_amount"))
    revenue = without(per_account, t.test_accounts).groupBy(*WEEK).agg(total("billed_amount").alias("revenue"))
    weekly = one_row_per_week(priced.join(direct, list(WEEK), "full").join(revenue, list(WEEK), "full"), weeks)
    if not profile.full_cost_model:
        return weekly.drop(*volume, *HALF_BILLED)
    over = sum((F.col(n) for n in BANDWIDTH_OVER[1:]), F.col(BANDWIDTH_OVER[0]))
    return weekly.withColumns(
        {
            "band_cost": over.cast("decimal(30,6)") * F.lit(BANDWIDTH_SHARE),
            "sales_cost": F.col("revenue").cast("decimal(30,2)") * F.lit(SALES_SHARE),
        }
    )


def product_cost(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Cost by component. ``unpriced_rows`` counts usage types that no price was found for."""
    weekly = _weekly_cost(t, weeks, profile).drop("revenue")
    amounts = [c for c in weekly.columns if c not in ("year", "week", "unpriced_rows")]
    return weekly.withColumns({c: as_double(c, 4) for c in amounts})


def cost_margin(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Total cost, and the part of revenue left after it."""
    weekly = _weekly_cost(t, weeks, profile)
    costs = [F.col(c).cast("decimal(26,8)") for c in weekly.columns if c.endswith("_cost")]
    weekly = weekly.withColumn("overall_cost", as_double(sum(costs[1:], costs[0]), 4))
    share = ratio(F.col("overall_cost"), as_double("revenue"))
    return weekly.select("year", "week", "overall_cost", (1 - share).alias("overall_margin"))


def cost_breakdown_history(t: Tables, last: Week, profile: ServiceProfile, n: int = 10) -> DataFrame:
    """The components of the ``n`` weeks ending with ``last``."""
    return product_cost(t, calendar.span(last, n), profile)
