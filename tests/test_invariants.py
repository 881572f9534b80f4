"""Identities that hold on any data, over the smallest generated tables."""

import pytest
from pyspark.sql import functions as F

from tollhouse.sources.fixtures import SERVICE_A
from tollhouse.plans import cost, credits, domains, revenue
from tollhouse.sources.fixtures import WEEKS

A = SERVICE_A


def by_week(df, *names):
    return {(r.year, r.week): tuple(r[n] for n in names) for r in df.collect()}


def test_bands_hold_all_payer_revenue(star):
    bands = revenue.size_bands(star, WEEKS)
    totals = [c for c in bands.columns if c.endswith("_revenue")]
    got = {(r.year, r.week): sum(r[c] for c in totals) for r in bands.collect()}
    want = by_week(revenue.payer_revenue(star, WEEKS).groupBy("year", "week").agg(F.sum("billed_amount").alias("s")), "s")
    assert all(got[w] == pytest.approx(want[w][0]) for w in WEEKS)


def test_regions_hold_all_external_revenue(star):
    got = by_week(domains.region_revenue(star, WEEKS).groupBy("year", "week").agg(F.sum("revenue").alias("s")), "s")
    real = star.weekly_charges.join(star.test_accounts, "account_id", "left_anti").where("is_internal_flag = 'N'")
    want = by_week(real.groupBy("year", "week").agg(F.sum("billed_amount").cast("double").alias("s")), "s")
    assert all(got[w][0] == pytest.approx(want[w][0]) for w in WEEKS)


def test_gainers_and_losers(star):
    rows = revenue.gainers_losers(star, WEEKS, A).collect()
    assert all(r["diff"] == pytest.approx(r.charge_0 - r.charge_1) for r in rows)
    tops = [r for r in rows if r.section == "gainer" and (r.year, r.week) == (1996, 6)]
    tops.sort(key=lambda r: r.position)
    assert [r["diff"] for r in tops] == sorted((r["diff"] for r in tops), reverse=True)


def test_costs_add_up(star):
    parts = cost.product_cost(star, WEEKS, A)
    names = [c for c in parts.columns if c.endswith("_cost")]
    got = {(r.year, r.week): sum(r[c] for c in names) for r in parts.collect()}
    want = by_week(cost.cost_margin(star, WEEKS, A), "overall_cost")
    assert all(got[w] == pytest.approx(want[w][0], abs=0.01) for w in WEEKS)


def test_largest_credits_and_the_rest_are_all_credits(star):
    few = credits.credits_refunds(star, WEEKS, A.product_code, k=3)
    many = credits.credits_refunds(star, WEEKS, A.product_code, k=900)
    sums = [{(r.year, r.week, r.kind): r.s for r in x.groupBy("year", "week", "kind").agg(F.sum("billed_amount").alias("s")).collect()} for x in (few, many)]
    assert sums[0].keys() == sums[1].keys() and sums[0]
    assert all(sums[0][k] == pytest.approx(sums[1][k], abs=0.01) for k in sums[0])
