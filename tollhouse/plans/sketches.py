"""Approximate distinct accounts of any span of weeks, from one sketch per week.

Exact counts of distinct accounts over a span read the span's metering again; a sketch is a few kilobytes per week and flag,
is stored (``sinks.write_weeks``) and merges with others. The relative standard error is about 1.04 / 2 ** (LG_K / 2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.operators.periods import earlier_weeks, in_weeks, spread_weeks
from tollhouse.sources.tables import Tables

#: Logarithm of a sketch's buckets.
LG_K = 12
KEYS = ("year", "week", "is_internal_flag")


def account_sketches(t: Tables, weeks: Sequence[Week], lg_k: int = LG_K) -> DataFrame:
    """(year, week, is_internal_flag, sketch): the metered accounts of each week and flag; the tables' stored copy, under the
    name ``account_sketches``, if there is one."""
    if "account_sketches" in t:
        return in_weeks(t["account_sketches"], weeks)
    rows = in_weeks(t.weekly_metering, weeks).where(F.col("account_id").isNotNull())
    return rows.groupBy(*KEYS).agg(F.hll_sketch_agg("account_id", lg_k).alias("sketch"))


def approximate_accounts(t: Tables, weeks: Sequence[Week], n: int = 4, lg_k: int = LG_K) -> DataFrame:
    """About how many accounts of each flag were metered in the ``n`` weeks that end with each week."""
    merged = spread_weeks(account_sketches(t, earlier_weeks(weeks, range(n)), lg_k), weeks, range(n)).groupBy(*KEYS)
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("accounts"))


def account_estimates(t: Tables, weeks: Sequence[Week], n: int = 4, errors: int = 3) -> DataFrame:
    """Exact counts next to whether the estimate lies within so many standard errors."""
    seen = in_weeks(t.weekly_metering, earlier_weeks(weeks, range(n))).select(*KEYS, "account_id").dropna(subset=["account_id"]).distinct()
    spans = spread_weeks(seen, weeks, range(n)).select(*KEYS, "account_id").distinct()
    exact = spans.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("exact")).alias("e")
    a = approximate_accounts(t, weeks, n).alias("a")
    same = (F.col("a.year") == F.col("e.year")) & (F.col("a.week") == F.col("e.week")) & F.col("a.is_internal_flag").eqNullSafe(F.col("e.is_internal_flag"))
    bound = F.col("exact") * (errors * 1.04 / 2 ** (LG_K / 2)) + 1
    return exact.join(a, same).select("e.*", (F.abs(F.col("accounts") - F.col("exact")) <= bound).alias("within"))
