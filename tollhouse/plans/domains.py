"""Counts and sums over resources, instance types and regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import as_double, count_if, external, internal, ratio, total, usage_total
from tollhouse.functions.text import matches
from tollhouse.operators.accounts import only, only_in_weeks, with_company, without
from tollhouse.operators.periods import earlier_weeks, in_weeks, one_row_per_week, spread_weeks
from tollhouse.plans.directory import lab_accounts, payer_map
from tollhouse.plans.extracts import account_charges, charged_accounts, instance_type, weekly_metering
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables

WEEK = ("year", "week")


def _charged_metering(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, *keys: str) -> DataFrame:
    """Usage per (week, account, flag, *keys) of accounts that were charged that week."""
    rows = in_weeks(t.weekly_metering, weeks).where(F.col("usage_type").contains(profile.instance_token))
    rows = rows.withColumn("instance_type", instance_type())
    usage = rows.groupBy("year", "week", "account_id", "is_internal_flag", *keys).agg(usage_total().alias("sum_usage_value"))
    # charged accounts hold no test accounts
    charged = t.shared(charged_accounts(t, weeks), placed=True)
    return only_in_weeks(usage, charged) if t.keeps else only(usage, charged, ("year", "week", "account_id"))


def domain_counts(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Resources of external and internal accounts; external customers with one and with several.

    Where a resource belongs to several accounts, service A gives it to the least account id.
    """
    used = without(_charged_metering(t, weeks, profile, "usage_resource"), lab_accounts(t, profile))
    keys = [*WEEK, "is_internal_flag"]
    n = F.col("n")
    if profile.domains_per_account:
        # count the rows of each resource and of each account in one go
        # (rows without a resource count as one resource, and as nobody's)
        resource = F.struct(F.lit("resource").alias("kind"), F.col("usage_resource").alias("key"))
        account = F.struct(F.lit("account").alias("kind"), F.col("account_id").alias("key"))
        tagged = F.when(F.col("usage_resource").isNull(), F.array(resource)).otherwise(F.array(resource, account))
        counted = used.select(*keys, F.inline(tagged)).groupBy(*keys, "kind", "key").agg(F.count(F.lit(1)).alias("n"))
        is_resource, is_customer, size = F.col("kind") == "resource", F.col("kind") == "account", F.lit(1)
    else:
        # ids are compared as numbers: the least of texts would need a sort of the large table
        owned = used.groupBy(*keys, "usage_resource").agg(F.min(F.col("account_id").cast("bigint")).alias("account"))
        nobody = F.when(F.col("usage_resource").isNotNull(), F.col("account"))
        counted = owned.groupBy(*keys, nobody.alias("account")).agg(F.count(F.lit(1)).alias("n"))
        is_resource, is_customer, size = F.lit(True), F.col("account").isNotNull(), n
    weekly = counted.groupBy(*WEEK).agg(
        total(size, external() & is_resource).alias("external_domain_count"),
        total(size, internal() & is_resource).alias("internal_domain_count"),
        count_if(external() & is_customer & (n == 1)).alias("one_domain_customer_count"),
        count_if(external() & is_customer & (n > 1)).alias("multi_domain_customer_count"),
    )
    return one_row_per_week(weekly, weeks)


def metering_sums(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Usage of charged accounts per region and instance type: what hours and customers are both read from."""
    return t.shared(_charged_metering(t, weeks, profile, "region", "instance_type"))


def revenue_sums(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """External amounts per region and usage type: what both revenues below are read from."""
    sums = account_charges(t, weeks, "region", "usage_type", where=external() & F.col("billed_amount").isNotNull())
    return t.shared(sums.groupBy("year", "week", "region", "usage_type").agg(F.sum("billed_amount").alias("billed_amount")))


def instance_hours(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External hours by instance type."""
    usage = metering_sums(t, weeks, profile).where(external())
    return usage.groupBy("year", "week", "instance_type").agg(usage_total("sum_usage_value").alias("hours"))


def instance_revenue(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External billed amount by instance type."""
    sums = revenue_sums(t, weeks).where(matches(F.col("usage_type"), profile.instance_token)).withColumn("instance_type", instance_type())
    return sums.groupBy("year", "week", "instance_type").agg(as_double(F.sum("billed_amount")).alias("revenue"))


def region_customers(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Distinct external accounts by region."""
    usage = metering_sums(t, weeks, profile).where(external() & F.col("region").isNotNull())
    usage = usage.select("year", "week", "account_id", "region").distinct()
    return usage.groupBy("year", "week", "region").agg(F.count(F.lit(1)).alias("customer_count"))


def region_revenue(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """External billed amount by region."""
    sums = revenue_sums(t, weeks).where(F.col("region").isNotNull())
    return sums.groupBy("year", "week", "region").agg(as_double(F.sum("billed_amount")).alias("revenue"))


def domain_diff(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """External resources per company and region, this week against last."""
    seen = in_weeks(t.weekly_metering, earlier_weeks(weeks, (0, 1))).where(external())
    seen = seen.select("year", "week", "account_id", "region", "usage_resource").distinct()
    counted = seen.groupBy("year", "week", "account_id", "region").agg(F.count(F.lit(1)).alias("n"))
    now, before = F.when(F.col("back") == 0, F.col("n")), F.when(F.col("back") == 1, F.col("n"))
    spread = spread_weeks(counted, weeks, (0, 1)).groupBy("year", "week", "account_id", "region")
    both = spread.agg(F.coalesce(F.sum(before), F.lit(0)).alias("d1"), F.coalesce(F.sum(now), F.lit(0)).alias("d2"))
    named = with_company(both, payer_map(t)).where(F.col("company").isNotNull() & F.col("region").isNotNull())
    return named.groupBy("year", "week", "company", "region").agg(
        F.sum(F.col("d2") - F.col("d1")).alias("diff"), F.sum("d1").alias("d1"), F.sum("d2").alias("d2")
    )


def customer_diff(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """New less lost external accounts per payer company."""
    new = in_weeks(t.new_active_customers, weeks).where(external()).select("year", "week", "account_id", F.lit(1).alias("n"))
    lost = in_weeks(t.new_inactive_customers, weeks).where(external()).select("year", "week", "account_id", F.lit(-1).alias("n"))
    payers = payer_map(t)
    own = payers.select("account_id", F.coalesce("payer_account_id", "account_id").alias("payer"))
    changes = new.union(lost).join(own, "account_id").groupBy("year", "week", F.col("payer").alias("account_id"))
    named = with_company(changes.agg(F.sum("n").alias("diff")), payers).where(F.col("company").isNotNull())
    return named.groupBy("year", "week", "company").agg(F.sum("diff").alias("diff"))


def domain_usage(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Hours per resource and instance type."""
    rows = in_weeks(t.weekly_metering, weeks).where(F.col("usage_type").contains(profile.instance_token))
    sums = rows.groupBy("year", "week", "usage_resource", "usage_type").agg(usage_total().alias("hours"))
    return sums.withColumn("instance_type", instance_type())


def new_domains(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Metering rows of resources that were not metered the week before."""
    metering = weekly_metering(t, earlier_weeks(weeks, (0, 1)), profile)
    before = spread_weeks(metering.select("year", "week", "usage_resource").distinct(), weeks, (1,)).drop("back").alias("b")
    now = in_weeks(metering, weeks).alias("n")
    # rows without a resource are not new if there were such rows before
    same = [F.col(f"n.{c}") == F.col(f"b.{c}") for c in WEEK]
    return now.join(before, [*same, F.col("n.usage_resource").eqNullSafe(F.col("b.usage_resource"))], "left_anti")


def new_domain_shares(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """New resources by instance type: how many, and which part of the week's."""
    seen = new_domains(t, weeks, profile).select("year", "week", "usage_resource", "usage_type").distinct()
    counts = seen.groupBy("year", "week", instance_type().alias("instance_type")).agg(F.count(F.lit(1)).alias("domain_count"))
    totals = counts.groupBy(*WEEK).agg(F.sum("domain_count").alias("_all"))
    return counts.join(totals, list(WEEK)).withColumn("pct", ratio(F.col("domain_count"), F.col("_all"))).drop("_all")


def new_domain_mix(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """The same with a pair of columns per week."""
    labels = [f"{y}_{w:02d}" for y, w in weeks]
    shares = new_domain_shares(t, weeks, profile).withColumn("label", F.format_string("%d_%02d", "year", "week"))
    wide = shares.groupBy("instance_type").pivot("label", labels)
    wide = wide.agg(F.max("domain_count").alias("domain_count"), F.max("pct").alias("pct"))
    renamed = [F.col(f"{label}_{m}").alias(f"{m}_{label}") for label in labels for m in ("domain_count", "pct")]
    return wide.select("instance_type", *renamed)
