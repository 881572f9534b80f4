"""Who the customers are, who pays for them, and who is left out of the counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.text import matches
from tollhouse.operators.periods import in_weeks
from tollhouse.profiles import CUSTOMER_OFFERINGS, SUBSCRIPTION_OFFERINGS, ServiceProfile
from tollhouse.sources import runs
from tollhouse.sources.tables import Tables


def _flag() -> Column:
    return F.when(F.col("internal") == "external", "N").otherwise("Y")


def metered_accounts(t: Tables) -> DataFrame:
    """Accounts that were ever metered: from the stored weekly lists, if there are any, else from all of the metering."""
    source = t["metered_accounts"] if "metered_accounts" in t else t.weekly_metering
    return source.select("account_id").distinct()


def store_metered_accounts(t: Tables, weeks: Sequence[Week], path: str) -> Tables:
    """Adds the weeks that ``path`` lacks to its lists of metered accounts, reading the metering of these weeks only, and
    returns the tables with the whole of the lists. Weeks without metering are known, too, and not read twice."""
    lists = lambda todo: in_weeks(t.weekly_metering, todo).select("year", "week", "account_id").distinct()
    runs.read_through(t.spark, path, "metered_accounts", weeks, lists)
    return t.replace(metered_accounts=runs.published(t.spark, path, "metered_accounts"))


def customer_directory(t: Tables) -> DataFrame:
    """Every metered account with its payer and company, and every payer as a row of its own.

    An account that pays for itself has no payer here. A stored copy, put into the tables under the
    name ``customer_directory``, is used instead of the metering scan.
    """
    if "customer_directory" in t:
        return t["customer_directory"]
    metered = metered_accounts(t)
    dim = t.accounts.select("account_id", "payer_account_id", "company", _flag().alias("is_internal_flag"))
    known = dim.join(metered, "account_id", "left_semi")
    payers = dim.select(
        F.col("account_id").alias("payer_account_id"),
        F.col("company").alias("payer_company"),
        F.col("is_internal_flag").alias("payer_flag"),
    )
    children = known.select(
        "account_id",
        F.when(F.col("account_id") != F.col("payer_account_id"), F.col("payer_account_id")).alias("payer_account_id"),
        "company",
        "is_internal_flag",
    )
    paying = (
        known.where(F.col("payer_account_id").isNotNull())
        .select("payer_account_id")
        .distinct()
        .join(payers, "payer_account_id", "left")
        .select(
            F.col("payer_account_id").alias("account_id"),
            F.lit(None).cast("string").alias("payer_account_id"),
            F.col("payer_company").alias("company"),
            F.col("payer_flag").alias("is_internal_flag"),
        )
    )
    return children.unionByName(paying).distinct()


def payer_map(t: Tables) -> DataFrame:
    """The directory with one row per account, so that joining it cannot multiply revenue.

    A stored copy is taken from the tables, under the name ``payer_map``.
    """
    if "payer_map" in t:
        return t["payer_map"]
    if "customer_directory" in t:
        return t["customer_directory"].groupBy("account_id").agg(
            F.max("payer_account_id").alias("payer_account_id"),
            F.min("company").alias("company"),
            F.max("is_internal_flag").alias("is_internal_flag"),
        )
    # the account dimension has one row per account already: keep metered accounts and their payers
    metered = metered_accounts(t).withColumn("is_metered", F.lit(True))
    dim = t.accounts.select("account_id", "payer_account_id", "company", _flag().alias("is_internal_flag"))
    dim = dim.join(metered, "account_id", "left")
    other = F.when(F.col("is_metered") & (F.col("account_id") != F.col("payer_account_id")), F.col("payer_account_id"))
    dim = dim.withColumn("payer_account_id", other)
    paying = dim.where(other.isNotNull()).select(F.col("payer_account_id").alias("account_id")).distinct()
    listed = dim.join(paying.withColumn("is_payer", F.lit(True)), "account_id", "left")
    return listed.where(F.col("is_metered") | F.col("is_payer")).drop("is_metered", "is_payer")


def _subscribed(t: Tables, as_of: dt.date, grace_days: int, offerings: Sequence[str]) -> DataFrame:
    since = F.date_sub(F.lit(as_of), grace_days)
    live = F.col("end_date").isNull() | (F.col("end_date") >= since)
    return t.subscriptions.where(F.col("offering_id").isin(*offerings) & live).select("account_id").distinct()


def customer_directory_legacy(
    t: Tables, as_of: dt.date, grace_days: int = 9, offerings: Sequence[str] = SUBSCRIPTION_OFFERINGS
) -> DataFrame:
    """Accounts with a subscription that is live or ended within ``grace_days``, company or mail domain."""
    live = _subscribed(t, as_of, grace_days, offerings)
    return t.accounts.join(live, "account_id", "left_semi").select(
        "account_id",
        "payer_account_id",
        F.coalesce("company", F.concat(F.lit("e-mail Domain:"), "email_domain")).alias("company"),
        _flag().alias("is_internal_flag"),
    )


def payer_directory(
    t: Tables, as_of: dt.date, grace_days: int = 9, offerings: Sequence[str] = SUBSCRIPTION_OFFERINGS
) -> DataFrame:
    """Every account under a payer that has a subscribed account."""
    payer = F.coalesce("payer_account_id", "account_id")
    accounts = t.accounts.withColumn("payer_account_id", payer)
    paying = accounts.join(_subscribed(t, as_of, grace_days, offerings), "account_id", "left_semi")
    return accounts.join(paying.select("payer_account_id").distinct(), "payer_account_id", "left_semi").select(
        "account_id", "payer_account_id", "company", _flag().alias("is_internal_flag")
    )


def offering_accounts(t: Tables, weeks: Sequence[Week], offerings: Sequence[str] = CUSTOMER_OFFERINGS) -> DataFrame:
    """Distinct accounts per week and offering."""
    rows = in_weeks(t.weekly_charges, weeks).where(F.col("offering_id").isin(*offerings))
    return rows.select("year", "week", "account_id", "is_internal_flag", "offering_id").distinct()


def customer_offering(t: Tables, weeks: Sequence[Week], offerings: Sequence[str] = CUSTOMER_OFFERINGS) -> DataFrame:
    """The directory with the offerings each account was charged under."""
    directory = customer_directory(t).select("account_id", "payer_account_id", "company")
    return directory.join(offering_accounts(t, weeks, offerings), "account_id", "left")


def lab_accounts(t: Tables, profile: ServiceProfile) -> DataFrame:
    """Accounts of training labs, known by their company name."""
    lab = matches(F.col("company"), profile.required("lab_pattern"), ignore_case=True)
    return payer_map(t).where(lab).select("account_id")


def excluded_accounts(t: Tables, profile: ServiceProfile) -> DataFrame:
    """Accounts left out of the counts and why."""
    test = t.test_accounts.select("account_id", F.lit("test").alias("reason"))
    lab = lab_accounts(t, profile).withColumn("reason", F.lit("lab"))
    return test.unionByName(lab).distinct()
