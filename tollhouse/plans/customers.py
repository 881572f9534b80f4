"""Weekly customer counts: active, new, lost and converted, by three rules of who pays.

All counts come from one row per (week, account) carrying marks; the marks are collected with a
union and one aggregate, and a second aggregate counts them. There is no distinct count per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import external, internal, weeks_back
from tollhouse.operators.accounts import by_account, marked, without
from tollhouse.operators.periods import earlier_weeks, in_days, in_weeks, one_row_per_week, spread_weeks, sunday_weeks
from tollhouse.plans.directory import lab_accounts
from tollhouse.plans.extracts import account_charges, charged_accounts
from tollhouse.plans.revenue import external_gross
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables



def _marks(df: DataFrame, **marks: Column) -> DataFrame:
    """Each mark as a number, so that it can be added up (rows) or maximised (accounts)."""
    return df.select("year", "week", "account_id", *[F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in marks.items()])


def _per_account(*parts: DataFrame) -> DataFrame:
    """All marks of an account in a week: ``x`` whether, ``x_rows`` how often."""
    names = sorted({c for p in parts for c in p.columns} - {"year", "week", "account_id"})
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    aggs = [F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names]
    aggs += [F.coalesce(F.sum(n), F.lit(0)).alias(f"{n}_rows") for n in names]
    return union.groupBy("year", "week", "account_id").agg(*aggs)


def _count(df: DataFrame, weeks: Sequence[Week], **marks: Column) -> DataFrame:
    counts = df.groupBy("year", "week").agg(*[F.sum(c.cast("bigint")).alias(n) for n, c in marks.items()])
    return one_row_per_week(counts, weeks)


def _has(*names: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & ((F.col(n[1:]) == 0) if n[0] == "!" else (F.col(n) > 0))
    return cond


def _joined_and_left(t: Tables, weeks: Sequence[Week]) -> tuple[DataFrame, DataFrame]:
    new, lost = in_weeks(t.new_active_customers, weeks), in_weeks(t.new_inactive_customers, weeks)
    return _marks(new, new=external(), new_internal=internal()), _marks(lost, lost=external(), lost_internal=internal())


def _with_goals(df: DataFrame, t: Tables) -> DataFrame:
    goals = t.goals.select("year", "week", "paying_customer_goal", "active_customer_goal")
    return df.join(goals, ["year", "week"], "left")


def _revenue_marks(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    known = F.col("billed_amount").isNotNull() & F.col("is_internal_flag").isNotNull()
    charged = account_charges(t, earlier_weeks(weeks, (0, 1)), "is_internal_flag", where=known)
    charged = without(charged, lab_accounts(t, profile)).withColumn("pays", F.round("billed_amount", 2) > 0)
    pays = F.col("pays")
    charges = _marks(
        spread_weeks(charged.drop("billed_amount"), weeks, (0, 1)),
        active=weeks_back(0) & external(),
        paying=weeks_back(0) & external() & pays,
        zero=weeks_back(0) & external() & ~pays,
        internal=weeks_back(0) & internal(),
        was_paying=weeks_back(1) & external() & pays,
        was_zero=weeks_back(1) & external() & ~pays,
    )
    new, lost = (without(without(x, t.test_accounts), lab_accounts(t, profile)) for x in _joined_and_left(t, weeks))
    return _per_account(charges, new, lost)


def customer_counts(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External customers split into paying and zero-revenue by what they were billed."""
    counts = _count(
        _revenue_marks(t, weeks, profile),
        weeks,
        active_count=_has("active"),
        active_paying_count=_has("paying"),
        zero_revenue_count=_has("zero"),
        active_count_internal=_has("internal"),
        new_zerorev_active_count=_has("new", "zero"),
        new_paying_active_count=_has("new", "paying"),
        new_active_count_internal=_has("new_internal"),
        new_zerorev_inactive_count=_has("lost", "was_zero"),
        new_paying_inactive_count=_has("lost", "was_paying"),
        new_inactive_count_internal=_has("lost_internal"),
        convert_to_paying_count=_has("was_zero", "paying"),
        convert_to_zerorev_count=_has("was_paying", "zero"),
    ).withColumns(
        {
            "new_active_count": F.col("new_zerorev_active_count") + F.col("new_paying_active_count"),
            "new_inactive_count": F.col("new_zerorev_inactive_count") + F.col("new_paying_inactive_count"),
        }
    )
    return _with_goals(counts, t)


def count_reconcile(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Do the parts of the new and lost customers add up to their lists?"""
    counts = _count(
        _revenue_marks(t, weeks, profile),
        weeks,
        new_listed=F.col("new_rows"),
        new_classified=_has("new", "zero").cast("int") + _has("new", "paying").cast("int"),
        lost_listed=F.col("lost_rows"),
        lost_classified=_has("lost", "was_zero").cast("int") + _has("lost", "was_paying").cast("int"),
    )
    return counts.withColumns(
        {
            "new_agrees": F.col("new_listed") == F.col("new_classified"),
            "lost_agrees": F.col("lost_listed") == F.col("lost_classified"),
        }
    )


def _list_marks(t: Tables, listed: DataFrame, weeks: Sequence[Week]) -> DataFrame:
    """External accounts on a weekly list, this week and last."""
    listed = in_weeks(listed, earlier_weeks(weeks, (0, 1))).where(external())
    spread = spread_weeks(listed.select("year", "week", "account_id"), weeks, (0, 1))
    return _marks(spread, free=weeks_back(0), was_free=weeks_back(1))


def customer_counts_trial(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External customers split by membership of the free-trial list, and by generation."""
    charged = account_charges(t, earlier_weeks(weeks, (0, 1)), "is_internal_flag", "operation")
    charged = marked(charged, lab_accounts(t, profile), "is_lab")
    spread = spread_weeks(charged, weeks, (0, 1))
    counted = F.col("billed_amount").isNotNull() & F.col("operation").isNotNull() & ~F.col("is_lab")
    charges = _marks(
        spread,
        active=weeks_back(0) & external() & counted,
        internal=weeks_back(0) & internal() & counted,
        was_active=weeks_back(1) & external(),
        **{f"generation_{n}": weeks_back(0) & external() & counted & (F.col("operation") == op) for n, op in profile.generations.items()},
    )
    new, lost = (without(x, t.test_accounts) for x in _joined_and_left(t, weeks))
    accounts = _per_account(charges, _list_marks(t, t.free_trial, weeks), new, lost)
    counts = _count(
        accounts,
        weeks,
        active_count=_has("active"),
        **{f"customer_{n}": _has(f"generation_{n}") for n in profile.generations},
        active_paying_count=_has("active", "!free"),
        free_trial_count=F.col("free_rows"),
        active_count_internal=_has("internal"),
        new_free_active_count=_has("new", "free"),
        new_paying_active_count=_has("new", "active", "!free"),
        new_active_count_internal=_has("new_internal"),
        new_free_inactive_count=_has("lost", "was_free"),
        new_paying_inactive_count=_has("lost", "was_active", "!was_free"),
        new_inactive_count_internal=_has("lost_internal"),
        convert_to_paying_count=_has("was_free", "active", "!free"),
    ).withColumns(
        {
            "new_active_count": F.col("new_free_active_count") + F.col("new_paying_active_count"),
            "new_inactive_count": F.col("new_free_inactive_count") + F.col("new_paying_inactive_count"),
        }
    )
    return _with_goals(counts, t)


def customer_counts_freetier(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """External customers split by membership of the free tier."""
    charged = in_weeks(t.weekly_charges, weeks).groupBy("year", "week", "account_id").agg(
        F.sum("billed_amount").alias("billed_amount"),
        F.max(external()).alias("external"),
        F.max(internal()).alias("internal"),
    )
    parts = (
        _marks(charged, external=F.col("external"), internal=F.col("internal"), billed_zero=F.round("billed_amount", 2) == 0),
        _list_marks(t, t.free_tier, weeks),
        *_joined_and_left(t, weeks),
        _marks(in_weeks(t.free_to_pay, weeks), converted=F.lit(True)),
    )
    accounts = marked(_per_account(*parts), t.test_accounts, "is_test")
    real = ~F.col("is_test")
    counts = _count(
        accounts,
        weeks,
        new_free_active_count=_has("new", "free") & real,
        new_paying_active_count=_has("new", "!free") & real,
        new_active_count_internal=_has("new_internal") & real,
        new_free_inactive_count=_has("lost", "was_free"),
        new_paying_inactive_count=_has("lost", "!was_free"),
        new_inactive_count_internal=_has("lost_internal") & real,
        convert_to_paying_count=_has("converted"),
        zero_revenue_free_count=_has("free", "billed_zero"),
        active_count=_has("external") & real,
        active_count_internal=_has("internal") & real,
    ).withColumns(
        {
            "new_active_count": F.col("new_free_active_count") + F.col("new_paying_active_count"),
            "new_inactive_count": F.col("new_free_inactive_count") + F.col("new_paying_inactive_count"),
            "active_paying_count": F.col("active_count") - F.col("zero_revenue_free_count"),
        }
    )
    return _with_goals(counts, t)


def compute_adoption(t: Tables, weeks: Sequence[Week]) -> DataFrame:
    """Accounts using compute in the week before, and how many of them use this service now."""
    # What counts as compute use.
    instance_use = F.col("biz_product_name").isin("EC2 Instance Usage", "EC2 RI Leases")
    activity = t.dim_activity.where((F.col("biz_product_group") == "EC2") & instance_use)
    sound = (
        external()
        & (F.col("is_fraud_flag") == "N")
        & (F.col("account_status_code") == "Active")
    )
    days = F.broadcast(sunday_weeks(t.spark, weeks, "week_begin_date", back=1))
    wanted = [d for w in weeks for d in calendar.sunday_week_days(calendar.shift(w, -1))]
    used = (
        in_days(t.compute_fact, "week_begin_date", wanted)
        .where(F.col("is_compromised_flag") == "N")
        .join(activity, "activity_type_id", "left_semi")
        .join(days, "week_begin_date")
        .select("year", "week", "account_seq_id")
        .distinct()
        .join(t.dim_compute_accounts.where(sound), "account_seq_id")
        .select("year", "week", "account_id")
    )
    if t.keeps:
        used = by_account(used)  # as the charges are
    charged = t.shared(charged_accounts(t, weeks), placed=True)
    parts = _marks(used, compute=F.lit(True)), _marks(charged, charged=F.lit(True))
    return _count(_per_account(*parts), weeks, ec2_count=_has("compute"), es_ec2_count=_has("compute", "charged"))


def goal_lookup(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Targets of each week next to what was reached."""
    counts = customer_counts(t, weeks, profile).select("year", "week", "active_paying_count", "active_count")
    both = counts.join(external_gross(t, weeks), ["year", "week"], "left").fillna(0.0, ["revenue_external_gross"])
    goals = t.goals.select("year", "week", "paying_customer_goal", "active_customer_goal", "revenue_goal")
    return both.join(goals, ["year", "week"], "left")
