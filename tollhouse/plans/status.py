"""Suspended accounts and the resources they keep running; resources found exposed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import as_double, count_if, external, internal, total
from tollhouse.functions.text import account_id, head, matches, rest
from tollhouse.operators.accounts import marked, only, without
from tollhouse.operators.periods import in_weeks, one_row_per_week
from tollhouse.plans.directory import lab_accounts
from tollhouse.plans.extracts import charged_accounts, instance_type, metering_lines, price_list
from tollhouse.profiles import SUBSCRIPTION_OFFERINGS, ServiceProfile
from tollhouse.sources.tables import Tables

SUSPENDED, ACTIVE = "Suspended", "Active"


def account_status(t: Tables, as_of: dt.date, accounts: DataFrame | None = None) -> DataFrame:
    """Current status of every account, or of the given ones, and since when it is suspended.

    Suspended since the later of the first suspension and the end of the last active period (an
    open one counts as ending today); unknown if there was no suspension.
    """
    status = F.col("account_status_code")
    active_end = F.when(status == ACTIVE, F.coalesce("end_effective_date", F.lit(as_of)))
    first_stop = F.when(status == SUSPENDED, F.col("start_effective_date"))
    current = F.when(F.col("current_record_flag") == "Y", status)
    history = t.account_history if accounts is None else only(t.account_history, accounts)
    # an account has a few statuses; the greatest text of a set needs no sorted aggregate
    known = history.groupBy("account_id").agg(
        F.array_max(F.collect_set(current)).alias("account_status_code"),
        F.max(active_end).alias("last_active"),
        F.min(first_stop).alias("first_suspended"),
    )
    # greatest() skips NULL, so an account that was never active falls back to its first suspension
    since = F.when(F.col("first_suspended").isNotNull(), F.greatest("last_active", "first_suspended"))
    dated = known.where(F.col("account_status_code").isNotNull()).withColumn("suspended_date", since)
    return dated.select(
        "account_id", "account_status_code", "suspended_date", F.datediff(F.lit(as_of), "suspended_date").alias("suspended_days")
    )


def subscription_status(t: Tables, as_of: dt.date, offerings: Sequence[str] = SUBSCRIPTION_OFFERINGS) -> DataFrame:
    """Last end of each account's subscriptions; open ones do not count."""
    ended = t.subscriptions.where(F.col("offering_id").isin(*offerings) & F.col("end_date").isNotNull())
    last = ended.groupBy("account_id").agg(F.max("end_date").alias("subscription_end_date"))
    return last.withColumn("unsubscribed_days", F.datediff(F.lit(as_of), "subscription_end_date"))


def _suspended(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, as_of: dt.date) -> DataFrame:
    metering = metering_lines(t, weeks, profile).where(matches(F.col("usage_type"), profile.instance_token))
    # few accounts are not charged: the others go first
    idle = metering.join(charged_accounts(t, weeks), ["year", "week", "account_id"], "left_anti")
    idle = t.shared(without(without(idle, t.test_accounts), lab_accounts(t, profile)))
    typed = idle.withColumn("usage_type", instance_type())
    prices = price_list(t.price_wide).select("usage_type", "region", "price")
    priced = typed.join(prices, ["usage_type", "region"], "left").withColumn("cost", F.col("price") * F.col("sum_usage_value").cast("decimal(18,2)"))
    stopped = account_status(t, as_of, idle.select("account_id").distinct()).where(F.col("account_status_code") == SUSPENDED)
    return priced.join(stopped, "account_id")


def suspended_domains(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, as_of: dt.date) -> DataFrame:
    """Metered instances of suspended accounts without charges, priced, with the end of their subscription."""
    rows = _suspended(t, weeks, profile, as_of).join(subscription_status(t, as_of), "account_id", "left")
    return rows.withColumns({"price": as_double("price", 4), "cost": as_double("cost", 4)})


def suspended_trend(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, as_of: dt.date) -> DataFrame:
    """Suspended accounts' resources and their cost per week."""
    rows = _suspended(t, weeks, profile, as_of)
    resources = rows.groupBy("year", "week", "is_internal_flag", "account_id", "usage_resource").agg(
        F.sum("cost").alias("cost"), F.count_if(F.col("price").isNull()).alias("unpriced")
    )
    weekly = resources.groupBy("year", "week").agg(
        count_if(internal()).alias("internal_count"),
        count_if(external()).alias("external_count"),
        as_double(total("cost", internal()), 4).alias("internal_cost"),
        as_double(total("cost", external()), 4).alias("external_cost"),
        total("unpriced").alias("unpriced_rows"),
    )
    return one_row_per_week(weekly, weeks)


# -- exposed resources -----------------------------------------------------------------------------

def exposed_domains(t: Tables, weeks: Sequence[Week], as_of: dt.date) -> DataFrame:
    """Exposed resources with the account's status, flag, support contract and whether it was hit.

    A stored copy is taken from the tables, under the name ``exposed_found``.
    """
    if "exposed_found" in t:
        return t["exposed_found"]
    found = t.exposed_domains.select(
        account_id(head(F.col("domain"), ":")).alias("account_id"), rest(F.col("domain"), ":").alias("domain_name"), "region"
    )
    flags = in_weeks(t.weekly_charges, weeks).select("account_id", "is_internal_flag").distinct()
    support = t.support_contracts.select("account_id", "product_name")
    full = (
        found.join(account_status(t, as_of, found).select("account_id", "account_status_code"), "account_id", "left")
        .join(flags, "account_id", "left")
        .join(support, "account_id", "left")
    )
    # Fixed value: format of a resource name.
    arn = F.concat(F.lit("arn:aws:es:"), "region", F.lit(":"), "account_id", F.lit(":domain/"), "domain_name")
    hit = t.impacted_accounts.where(~matches(F.col("account_id"), "arn"))
    return marked(full, hit, "hit").select(
        "account_id", "domain_name", "region", "account_status_code", "is_internal_flag", arn.alias("arn"),
        "product_name", F.when(F.col("hit"), "Y").alias("impacted"),
    )


def exposed_stats(t: Tables, weeks: Sequence[Week], as_of: dt.date) -> DataFrame:
    """How many resources are exposed, of suspended accounts, and active and external."""
    status = F.col("account_status_code")
    return exposed_domains(t, weeks, as_of).agg(
        F.count(F.lit(1)).alias("exposed"),
        count_if(status == SUSPENDED).alias("suspended"),
        count_if((status == ACTIVE) & external()).alias("active_external"),
    )


def exposed_unsupported(t: Tables, weeks: Sequence[Week], as_of: dt.date) -> DataFrame:
    """Exposed resources of active external accounts without any support contract."""
    active = exposed_domains(t, weeks, as_of).where(external() & (F.col("account_status_code") == ACTIVE))
    return without(active, t.support_contracts).withColumn("arn", F.trim("arn"))


def exposed_by_account(t: Tables, weeks: Sequence[Week], as_of: dt.date) -> DataFrame:
    """The unsupported resources not hit yet, a row for each."""
    return exposed_unsupported(t, weeks, as_of).where(F.col("impacted").isNull()).select("account_id", "arn")


#: Bytes of one value of joined names, about: the last name of a value may go beyond.
JOINED_BYTES = 1 << 16


def exposed_joined(t: Tables, weeks: Sequence[Week], as_of: dt.date, digits: int = 1, most: int = JOINED_BYTES) -> DataFrame:
    """The same joined by ``|``, in values of bounded size: an account's names are told apart by the first hexadecimal digits of
    their MD5 (``part``) and, in its order, cut where the bytes so far reach a multiple of ``most`` (``piece``, from 0).

    The bytes before a name are those of the buckets before its own, of which a part has 4,096, and of the names before it in
    its bucket, so that no group holds more than a small share of a large account.
    """
    names = exposed_by_account(t, weeks, as_of).withColumn("_hash", F.md5(F.col("arn").cast("binary")))
    names = names.withColumns(
        {"part": F.substring("_hash", 1, digits), "_bucket": F.substring("_hash", digits + 1, 3), "_bytes": (F.octet_length("arn") + 1).cast("long")}
    )
    so_far = (Window.unboundedPreceding, -1)
    part = ["account_id", "part"]
    buckets = names.groupBy(*part, "_bucket").agg(F.sum("_bytes").alias("_all"))
    before = F.sum("_all").over(Window.partitionBy(*part).orderBy("_bucket").rowsBetween(*so_far))
    starts = buckets.select(*part, "_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.sum("_bytes").over(Window.partitionBy(*part, "_bucket").orderBy("_hash", "arn").rowsBetween(*so_far))
    placed = names.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(starts, [*part, "_bucket"])
    pieces = placed.groupBy(*part, F.floor((F.col("_start") + F.col("_inside")) / most).cast("long").alias("piece"))
    return pieces.agg(F.array_join(F.array_sort(F.collect_list("arn")), "|").alias("arns"))
