"""Revenue by class, category, payer, size and customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import WEEKS_PER_MONTH, as_double, count_if, doubles, external, internal, total, usage_total
from tollhouse.functions.text import matches
from tollhouse.operators.accounts import to_payer, with_company, without
from tollhouse.operators.periods import earlier_weeks, in_weeks, one_row_per_week, spread_weeks
from tollhouse.operators.ranking import Ranked, ranks_among, top_k, with_rank
from tollhouse.plans.credits import credit_totals
from tollhouse.plans.directory import payer_map
from tollhouse.plans.extracts import account_charges
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables

WEEK = ("year", "week")
CHARGES = ["charge_0", "charge_1", "charge_2", "charge_3"]

# Monthly revenue from which a band starts.
BANDS = {"micro": None, "S": 100, "M": 1_000, "L": 10_000, "XL": 100_000, "above_XL": 1_000_000}


def gross() -> Column:
    """External charges before credits."""
    return external() & F.col("credit_id").isNull()


def _sums(t: Tables, weeks: Sequence[Week], **sums: Column) -> DataFrame:
    """Conditional sums of billed amounts per week: first per account, then over the real accounts."""
    amount = F.col("billed_amount")
    rows = in_weeks(t.weekly_charges, weeks).groupBy("year", "week", "account_id")
    accounts = without(rows.agg(*[total(amount, c).alias(n) for n, c in sums.items()]), t.test_accounts)
    weekly = accounts.groupBy(*WEEK).agg(*[as_double(total(n)).alias(n) for n in sums])
    return one_row_per_week(weekly, weeks)


def external_gross(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    return _sums(t, weeks, revenue_external_gross=gross())


def _categories(profile: ServiceProfile) -> dict[str, Column]:
    usage = F.col("usage_type")
    sums = {f"revenue_{n}": gross() & matches(usage, p) for n, p in profile.categories.items()}
    return sums | {f"revenue_{n}_internal": internal() & matches(usage, p) for n, p in profile.categories.items()}


def _generations(profile: ServiceProfile) -> dict[str, Column]:
    return {f"revenue_{n}": gross() & (F.col("operation") == op) for n, op in profile.generations.items()}


def revenue_metrics(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """What ``revenue_summary``, ``revenue_by_category`` and ``revenue_by_generation`` give, in one pass over the charges."""
    sums = {"revenue_external_gross": gross(), "revenue_internal": internal(), **_categories(profile), **_generations(profile)}
    both = _sums(t, weeks, **sums).join(credit_totals(t, weeks, profile.product_code), list(WEEK), "left")
    return both.join(t.goals.select("year", "week", "revenue_goal"), list(WEEK), "left")


def revenue_summary(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External revenue before credits, internal revenue, credits, refunds and the target."""
    revenue = _sums(t, weeks, revenue_external_gross=gross(), revenue_internal=internal())
    both = revenue.join(credit_totals(t, weeks, profile.product_code), list(WEEK), "left")
    return both.join(t.goals.select("year", "week", "revenue_goal"), list(WEEK), "left")


def revenue_by_category(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External (before credits) and internal revenue by usage category; categories may overlap."""
    return _sums(t, weeks, **_categories(profile))


def revenue_by_generation(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    return _sums(t, weeks, **_generations(profile))


def _payer_revenue(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    # credits count whoever received them
    rows = (external() | F.col("credit_id").isNotNull()) & F.col("billed_amount").isNotNull()
    paid = to_payer(account_charges(t, weeks, where=rows), payer_map(t))
    return t.shared(paid.groupBy("year", "week", "account_id").agg(F.sum("billed_amount").alias("billed_amount")))


def payer_revenue(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Weekly revenue per paying account."""
    return doubles(_payer_revenue(t, weeks), "billed_amount")


def size_bands(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Payers and their revenue by size, on the month their week would make."""
    monthly = F.col("billed_amount").cast("decimal(20,2)") * F.lit(WEEKS_PER_MONTH)
    band = F.lit("micro")
    for name, start in BANDS.items():
        if start is not None:
            band = F.when(F.col("monthly") >= start, name).otherwise(band)
    sized = _payer_revenue(t, weeks).withColumn("monthly", monthly).withColumn("band", band)
    aggs = []
    for name in BANDS:
        here = F.col("band") == name
        aggs += [
            count_if(here).alias(f"customer_{name}_count"),
            as_double(total("billed_amount", here)).alias(f"customer_{name}_revenue"),
        ]
    return one_row_per_week(sized.groupBy(*WEEK).agg(*aggs), weeks)


def _top_five(revenue: DataFrame, payers: DataFrame) -> DataFrame:
    top = top_k(revenue, 5, WEEK, [F.desc("billed_amount"), F.col("account_id")])
    named = with_company(top, payers)
    return doubles(named.withColumn("label", F.concat(F.lit("X"), "account_id")), "billed_amount")


def top_external(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """The five payers with most revenue."""
    return _top_five(_payer_revenue(t, weeks), payer_map(t))


def top_internal(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """The five internal accounts with most revenue."""
    rows = internal() & F.col("billed_amount").isNotNull()
    return _top_five(account_charges(t, weeks, where=rows), payer_map(t))


# -- four weeks side by side -----------------------------------------------------------------------

def reseller_label(t: Tables, profile: ServiceProfile) -> DataFrame:
    """Paying resellers labelled with the first client (by account id) that is not a reseller itself."""
    payers = payer_map(t).where(F.col("company").isNotNull())
    is_reseller = matches(F.col("company"), profile.required("reseller_pattern"), ignore_case=True)
    clients = payers.where(~is_reseller).select(F.col("payer_account_id").alias("account_id"), F.struct("account_id", "company").alias("of"))
    # a least text is found by sorting: of the clients of resellers only
    theirs = clients.join(payers.where(is_reseller).select("account_id", "company"), "account_id")
    first = theirs.groupBy("account_id", "company").agg(F.min_by("of.company", "of.account_id").alias("client"))
    return first.select("account_id", "company", "client", F.concat("company", F.lit(" - "), "client").alias("label"))


def _payer_weeks(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    payers = payer_map(t)
    offsets = range(4)
    rows = external() & F.col("billed_amount").isNotNull()
    paid = to_payer(account_charges(t, earlier_weeks(weeks, offsets), where=rows), payers)
    weekly = paid.groupBy("year", "week", "account_id").agg(F.sum("billed_amount").alias("billed_amount"))
    spread = spread_weeks(weekly, weeks, offsets).groupBy("year", "week", "account_id")
    four = spread.agg(*[total("billed_amount", F.col("back") == k).alias(f"charge_{k}") for k in offsets])
    # the payer's own payer, under the payer's company: both from one look-up
    own = payers.where(F.col("company").isNotNull()).select("account_id", "company", F.coalesce("payer_account_id", "account_id").alias("payer"))
    named = four.join(own, "account_id").drop("account_id").withColumnRenamed("payer", "account_id")
    return t.shared(named.groupBy("year", "week", "account_id", "company").agg(*[F.sum(c).alias(c) for c in CHARGES]))


def _labelled(sums: DataFrame, t: Tables, profile: ServiceProfile) -> DataFrame:
    """The same rows with resellers under their label."""
    clients = reseller_label(t, profile).select("account_id", "client")
    is_reseller = matches(F.col("company"), profile.required("reseller_pattern"), ignore_case=True) & F.col("client").isNotNull()
    label = F.when(is_reseller, F.concat("company", F.lit(" - "), "client")).otherwise(F.col("company"))
    others = [c for c in sums.columns if c not in ("year", "week", "account_id", "company")]
    return sums.join(clients, "account_id", "left").select("year", "week", "account_id", label.alias("company"), *others)


def four_week_revenue(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External revenue per payer in the week and the three before it."""
    return doubles(_labelled(_payer_weeks(t, weeks), t, profile), *CHARGES)


def top_customers(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, k: int = 100) -> DataFrame:
    """The largest payers with their rank this week and last; ranks are over all payers."""
    four = _payer_weeks(t, weeks)
    top = top_k(_labelled(four, t, profile), k, WEEK, [F.desc("charge_0"), F.col("account_id"), F.col("company")])
    top = ranks_among(top, four, {"charge_0": "rank_0", "charge_1": "rank_1"}, WEEK)
    return doubles(top, *CHARGES).select("year", "week", "position", "rank_0", "rank_1", "account_id", "company", *reversed(CHARGES))


def gainers_losers(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, k: int = 30) -> DataFrame:
    """The payers whose revenue rose and fell most against the week before."""
    four = _payer_weeks(t, weeks).withColumn("diff", F.col("charge_0") - F.col("charge_1"))
    ties = [F.col("account_id"), F.col("company")]
    # both ends in one pass: a loser's fall is its order
    sides = F.array(F.struct(F.lit("gainer").alias("section"), (-F.col("diff")).alias("_order")), F.struct(F.lit("loser").alias("section"), F.col("diff").alias("_order")))
    ends = top_k(_labelled(four, t, profile).select("*", F.inline(sides)), k, [*WEEK, "section"], [F.asc("_order"), *ties]).drop("_order")
    both = ranks_among(ends, four, {"diff": "rank"}, WEEK)
    return doubles(both, "diff", *CHARGES).select(
        "year", "week", "section", "position", "rank", "account_id", "company",
        "charge_1", "charge_0", "diff", "charge_3", "charge_2",
    )


# -- lists of customers ----------------------------------------------------------------------------

def customer_list(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """All charged accounts with what the directory knows."""
    charged = account_charges(t, weeks, where=F.col("billed_amount").isNotNull())
    listed = charged.join(payer_map(t), "account_id", "left")
    return doubles(listed, "billed_amount").select(
        "year", "week", "account_id", "is_internal_flag", "company", "billed_amount", "payer_account_id"
    )


def top_by_region(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Accounts of every region, with their resources there; external ones also with each of their support contracts."""
    charged = account_charges(t, weeks, "region", "is_internal_flag", where=F.col("region").isNotNull())
    named = with_company(charged, payer_map(t))
    contracts = t.support_contracts.where(F.col("product_name") != "NULL").select("account_id", F.col("product_name").alias("contract"))
    has_contract = (F.col("c.account_id") == F.col("n.account_id")) & (F.col("n.is_internal_flag") == "N")
    contracted = named.alias("n").join(contracts.alias("c"), has_contract, "left").select("n.*", F.col("c.contract").alias("service_contract"))
    contracted = t.shared(contracted)
    keys = ["year", "week", "account_id", "region", "is_internal_flag"]
    rows = in_weeks(t.weekly_metering, weeks).where(F.col("usage_type").contains(profile.instance_token))
    resources = t.shared(rows.select(*keys, "usage_resource").distinct())
    # an outer join could not split an account with very many resources; an inner join can
    using = contracted.join(resources, keys)
    idle = contracted.join(resources, keys, "left_anti")
    return doubles(using.unionByName(idle, allowMissingColumns=True), "billed_amount").select(
        "year", "week", "region", "is_internal_flag", "account_id", "company", "service_contract", "usage_resource", "billed_amount"
    )


def _lifetimes(t: Tables, weeks: Sequence[Week], end: str) -> DataFrame:
    """External accounts by the week of their first (``min``) or last (``max``) day."""
    lives = t.active_date.where(external()).withColumns({"year": F.col(f"{end}_request_year"), "week": F.col(f"{end}_request_week")})
    return without(in_weeks(lives, weeks), t.test_accounts)


def dropped_customers(t: Tables, weeks: Sequence[Week], ranked: Ranked = with_rank) -> DataFrame:
    """External accounts last seen in the week, ranked by what they were billed in all.

    A run that may write hands in ``ranked`` (see ``ranking.with_rank_by_ranges``); the default only plans.
    """
    lost = _lifetimes(t, weeks, "max").where(F.col("company").isNotNull())
    sums = lost.groupBy("year", "week", "account_id", "company").agg(
        F.sum("billed_amount").alias("billed_amount"),
        F.min("min_request_day").alias("min_request_day"),
        F.max("max_request_day").alias("max_request_day"),
    )
    return doubles(ranked(t.shared(sums), "billed_amount", WEEK, "rank"), "billed_amount")


def new_customers(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, ranked: Ranked = with_rank) -> DataFrame:
    """External accounts first seen in the week, with their resources, ranked by usage; for ``ranked`` see ``dropped_customers``."""
    new = _lifetimes(t, weeks, "min").select("year", "week", "account_id", "company")
    rows = in_weeks(t.weekly_metering, weeks).where(F.col("usage_type").contains(profile.instance_token))
    domains = rows.groupBy("year", "week", "account_id", "usage_resource").agg(usage_total().alias("usage"))
    usage = domains.groupBy("year", "week", "account_id").agg(
        F.count("usage_resource").alias("sum_domain_count"), F.sum(F.col("usage").cast("decimal(18,2)")).alias("sum_usage_value")
    )
    # ranked by hundredths of an hour
    both = ranked(t.shared(new.join(usage, ["year", "week", "account_id"])), "sum_usage_value", WEEK, "rank")
    return both.withColumn("sum_usage_value", F.col("sum_usage_value").cast("double"))
