"""Reports over a handful of literal rows: the cases the generated data does not contain."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tollhouse.sources.fixtures import SERVICE_A
from tollhouse.plans import cost, credits, customers, daily, directory, domains, freetier, revenue, status

WEEK = (1996, 6)


def acct(n):
    return f"{n:012d}"


def charge(n, amount, week=6, **more):
    row = dict(year=1996, week=week, account_id=acct(n), is_internal_flag="N", billed_amount=None if amount is None else D(amount),
               usage_type="ESInstance:m3.large", region="IAD", offering_id="607996", usage_value=1.0, price_per_unit=D("0.1"))
    return row | more


def metered(n, resource="r", week=6, **more):
    row = dict(year=1996, week=week, account_id=acct(n), is_internal_flag="N", usage_value=1.0, usage_resource=resource,
               usage_type="ESInstance:m3.large", region="IAD")
    return row | more


def account(n, payer=None, company=None, internal="external"):
    return dict(account_id=acct(n), payer_account_id=payer and acct(payer), company=company or f"c{n}", internal=internal)


def test_payer_that_is_metered_too_is_one_row(tables):
    t = tables(accounts=[account(1), account(2, payer=1), account(3, payer=3)], weekly_metering=[metered(1), metered(2), metered(3)])
    rows = {r.account_id: r.payer_account_id for r in directory.payer_map(t).collect()}
    assert rows == {acct(1): None, acct(2): acct(1), acct(3): None}
    assert directory.customer_directory(t).count() == 3


def test_stored_directory_with_two_rows_per_account(tables):
    t = tables(accounts=[account(1, payer=2), account(2, payer=3), account(3)], weekly_metering=[metered(1), metered(2)])
    t = t.replace(customer_directory=directory.customer_directory(t))
    assert t.customer_directory.count() == 4  # account 2 once as child, once as payer
    rows = {r.account_id: r.payer_account_id for r in directory.payer_map(t).collect()}
    assert rows == {acct(1): acct(2), acct(2): acct(3), acct(3): None}


def test_revenue_rolls_up_two_levels_under_the_first_payers_company(tables):
    t = tables(
        accounts=[account(1, payer=2), account(2, payer=3), account(3)],
        weekly_metering=[metered(1), metered(2)],
        weekly_charges=[charge(1, "5.00"), charge(1, "7.00", week=5)],
    )
    (row,) = revenue.four_week_revenue(t, [WEEK], SERVICE_A).collect()
    assert (row.account_id, row.company, row.charge_0, row.charge_1, row.charge_2) == (acct(3), "c2", 5.0, 7.0, 0.0)


def test_band_edges(tables):
    # monthly = weekly * 4.345238: 23.0137 makes 100 and 230136.991 a million; a credit makes a payer negative
    amounts = {1: "23.01", 2: "23.02", 3: "-1.00", 4: "230136.99", 5: "230137.00", 6: None}
    t = tables(weekly_charges=[charge(n, a) for n, a in amounts.items()])
    (r,) = revenue.size_bands(t, [WEEK]).collect()
    assert (r.customer_micro_count, r.customer_S_count, r.customer_XL_count, r.customer_above_XL_count) == (2, 1, 1, 1)


def test_credits_count_as_external_whoever_has_them(tables):
    rows = [charge(1, "10.00"), charge(2, "-3.00", credit_id="x", is_internal_flag="Y"), charge(2, "4.00", is_internal_flag="Y")]
    got = {r.account_id: r.billed_amount for r in revenue.payer_revenue(tables(weekly_charges=rows), [WEEK]).collect()}
    assert got == {acct(1): 10.0, acct(2): -3.0}


def test_zero_revenue_is_decided_after_rounding_and_conversions_need_both_weeks(tables):
    t = tables(
        weekly_charges=[charge(1, "1.00"), charge(1, "0.00", week=5), charge(2, "0.00"), charge(2, "1.00", week=5), charge(3, "2.00"), charge(4, None)],
        new_active_customers=[dict(year=1996, week=6, account_id=acct(n), is_internal_flag="N") for n in (3, 4)],
        test_accounts=[],
    )
    (r,) = customers.customer_counts(t, [WEEK], SERVICE_A).collect()
    assert (r.active_count, r.active_paying_count, r.zero_revenue_count) == (3, 2, 1)
    assert (r.convert_to_paying_count, r.convert_to_zerorev_count, r.new_active_count) == (1, 1, 1)
    (r,) = customers.count_reconcile(t, [WEEK], SERVICE_A).collect()
    assert (r.new_listed, r.new_classified, r.new_agrees, r.lost_agrees) == (2, 1, False, True)


def test_week_without_data_is_a_row_of_zeros(tables):
    (r,) = customers.customer_counts(tables(), [WEEK], SERVICE_A).collect()
    assert (r.active_count, r.new_active_count, r.paying_customer_goal) == (0, 0, None)
    (r,) = domains.domain_counts(tables(), [WEEK], SERVICE_A).collect()
    assert r.external_domain_count == 0


def test_shared_resource_goes_to_the_least_account(tables):
    t = tables(
        accounts=[account(1), account(2)],
        weekly_metering=[metered(1, "a"), metered(2, "a"), metered(2, "b"), metered(2, "c")],
        weekly_charges=[charge(1, "1.00"), charge(2, "1.00")],
    )
    (r,) = domains.domain_counts(t, [WEEK], SERVICE_A).collect()
    assert (r.external_domain_count, r.one_domain_customer_count, r.multi_domain_customer_count) == (3, 1, 1)


def record(n, code, start, end=None, current="N"):
    return dict(account_id=acct(n), account_status_code=code, start_effective_date=start, end_effective_date=end, current_record_flag=current)


def test_suspension_dates(tables):
    d, as_of = dt.date, dt.date(1996, 3, 1)
    t = tables(
        account_history=[
            record(1, "Active", d(1996, 1, 1), None, "Y"),  # never suspended
            record(2, "Suspended", d(1996, 1, 5), None, "Y"),  # never active
            record(3, "Active", d(1996, 1, 1), d(1996, 2, 1)),
            record(3, "Suspended", d(1996, 1, 10), None, "Y"),  # suspended while still active
            record(4, "Suspended", d(1996, 1, 3), d(1996, 1, 9)),
            record(4, "Active", d(1996, 1, 9), None, "Y"),  # active again, open
        ]
    )
    got = {int(r.account_id): (r.account_status_code, r.suspended_date, r.suspended_days) for r in status.account_status(t, as_of).collect()}
    assert got == {
        1: ("Active", None, None),
        2: ("Suspended", d(1996, 1, 5), 56),
        3: ("Suspended", d(1996, 2, 1), 29),
        4: ("Active", as_of, 0),
    }


def test_greatest_of_several_current_statuses(tables):
    """Ties go to the greatest text; NULL is none, and an account without any status is left out."""
    day = dt.date(1996, 1, 1)
    t = tables(account_history=[
        record(1, "Suspended", day, None, "Y"), record(1, "Active", day, None, "Y"), record(1, "Zombie", day),
        record(2, None, day, None, "Y"), record(2, "Closed", day, None, "Y"), record(2, "", day, None, "Y"),
        record(3, None, day, None, "Y"), record(4, "Active", day, None, "N"),
    ])
    assert {int(r.account_id): r.account_status_code for r in status.account_status(t, day).collect()} == {1: "Suspended", 2: "Closed"}
    assert status.account_status(tables(), day).collect() == []


def test_first_client_of_a_reseller(tables):
    profile = replace(SERVICE_A, reseller_pattern="reseller")
    of = {1: (None, "Big Reseller"), 2: (1, None), 3: (1, "Third"), 4: (1, "Other reseller"), 5: (1, "Fifth"), 6: (4, "Sixth"), 7: (8, "Seventh"), 8: (None, "Plain"), 9: (None, "Lone reseller")}
    directory_rows = [dict(account_id=acct(n), payer_account_id=p and acct(p), company=c, is_internal_flag="N") for n, (p, c) in of.items()]
    t = tables()
    stored = t.spark.createDataFrame([tuple(r.values()) for r in directory_rows], "account_id string, payer_account_id string, company string, is_internal_flag string")
    got = sorted((int(r.account_id), r.label) for r in revenue.reseller_label(t.replace(payer_map=stored), profile).collect())
    assert got == [(1, "Big Reseller - Third"), (4, "Other reseller - Sixth")]


def test_many_exposed_resources_have_one_shape_and_no_loss(tables):
    day = dt.date(1996, 1, 1)
    t = tables(
        exposed_domains=[dict(domain=f"1:d{i}", region="IAD") for i in range(1500)],
        account_history=[record(1, "Active", day, None, "Y")],
        weekly_charges=[charge(1, "1.00")],
    )
    names = {r.arn for r in status.exposed_by_account(t, [WEEK], day).collect()}
    assert len(names) == 1500 and "arn:aws:es:IAD:000000000001:domain/d7" in names
    joined = status.exposed_joined(t, [WEEK], day).collect()
    assert len(joined) == 16 and sorted(n for r in joined for n in r.arns.split("|")) == sorted(names)
    # values within the bound, whatever the number of names
    small = status.exposed_joined(t, [WEEK], day, most=500).collect()
    assert len(small) > 64 and sorted(n for r in small for n in r.arns.split("|")) == sorted(names)
    longest = max(map(len, names))
    assert all(len(r.arns) <= 500 + longest for r in small) and len({(r.part, r.piece) for r in small}) == len(small)
    few = t.replace(exposed_domains=t.exposed_domains.limit(2))
    assert sum(len(r.arns.split("|")) for r in status.exposed_joined(few, [WEEK], day).collect()) == 2


def test_free_hours_are_capped(tables):
    small = dict(usage_type="ESInstance:t2.small", price_per_unit=D("0.5"))
    t = tables(
        weekly_charges=[charge(1, "1.00", usage_value=100.0, **small), charge(1, "1.00", usage_value=100.0, **small), charge(2, "1.00", usage_value=9.0, **small)],
        free_tier=[dict(year=1996, week=6, account_id=acct(1), is_internal_flag="N")],
    )
    (r,) = freetier.t2small_free_cost(t, [WEEK]).collect()
    assert (r.cost, r.freetier_count, r.t2small_user_count) == (84.0, 1, 1)


def test_missing_price_is_counted_not_hidden(spark, tables):
    use = dict(year=1996, week=6, client_product_code="AmazonEC2", account_id=acct(1), usage_value=2.0, billed_amount=D("1.00"))
    t = tables(product_weekly_charges=[use | dict(usage_type="USW2-BoxUsage:m3.large"), use | dict(usage_type="BoxUsage:unknown"), use | dict(usage_type="EBS:VolumeUsage.gp2")])
    prices = [("x", "AmazonEC2", "m3.large", D("1.0"), D("3.0")), ("x", "AmazonEC2", "VolumeUsage.gp2", D("0.5"), None)]
    t = t.replace(price_wide=spark.createDataFrame(prices, "product string, client_product_code string, usage_type string, IAD decimal(12,4), PDX decimal(12,4)"))
    (r,) = cost.product_cost(t, [WEEK], SERVICE_A).collect()
    assert (r.ec2_cost, r.ebs_cost, r.unpriced_rows) == (6.0, 1.0, 1)
    assert r.ebs_volume == pytest.approx(2 * 4.345238, abs=1e-4)
    (m,) = cost.cost_margin(t, [WEEK], SERVICE_A).collect()
    assert m.overall_margin is None  # no revenue to compare with


def test_no_credits_in_an_empty_week(tables):
    (r,) = credits.credits_kpi(tables(), [WEEK], "AmazonRDS").collect()
    assert (r.credits_amount, r.credits_accounts) == (0.0, 0)


def test_day_against_the_day_before(tables):
    d = dt.date(1996, 1, 1)
    row = dict(account_id=acct(1), is_internal_flag="N", usage_type="u")
    t = tables(daily_charges=[row | dict(computation_date=d, billed_amount=D("2.00")), row | dict(computation_date=d - dt.timedelta(days=1), billed_amount=D("5.00"))])
    got = {r.computation_date: (r.charge_yesterday, r.charge_today, r["diff"]) for r in daily.daily_gainers(t, [d, d + dt.timedelta(days=1)]).collect()}
    assert got == {d: (5.0, 2.0, -3.0), d + dt.timedelta(days=1): (2.0, 0.0, -2.0)}


def test_contracts_are_shown_for_external_accounts_only(tables):
    t = tables(
        accounts=[account(1), account(2)],
        weekly_charges=[charge(1, "5.00"), charge(2, "7.00", is_internal_flag="Y")],
        weekly_metering=[metered(1, "a"), metered(2, "b", is_internal_flag="Y")],
        support_contracts=[dict(account_id=acct(n), product_name=p) for n in (1, 2) for p in ("Business", "Enterprise", "NULL")],
    )
    rows = sorted((r.account_id, r.usage_resource, r.service_contract or "") for r in revenue.top_by_region(t, [WEEK], SERVICE_A).collect())
    assert rows == [(acct(1), "a", "Business"), (acct(1), "a", "Enterprise"), (acct(2), "b", "")]


def daily_row(n, resource, usage, day=dt.date(1996, 1, 1), kind="ESInstance:m3.large"):
    return dict(request_day=day, account_id=acct(n), usage_type=kind, usage_value=usage, usage_resource=resource)


def test_usage_without_a_resource_configures_nothing(tables):
    day = dt.date(1996, 1, 1)
    t = tables(
        daily_metering=[daily_row(1, None, 24.0), daily_row(2, None, 48.0), daily_row(1, "r", 24.5), daily_row(1, "r", 23.5, kind="ESInstance:r3.large")],
        daily_charges=[dict(computation_date=day, account_id=acct(n), is_internal_flag="N") for n in (1, 2)],
        price_plan=[dict(plan_id=2, usage_type=u, price_unit=D("0.5")) for u in ("ESInstance:m3.large", "ESInstance:r3.large")],
    )
    (r,) = daily.domain_config(t, [day], SERVICE_A).collect()
    # of equally dear types the last by name; built-in storage of two nodes
    assert (r.usage_resource, r.instance_type, r.instance_hour, r.node_count, r.storage_type, r.storage_size) == ("r", "r3.large", 48.0, 2.0, "ephemeral", 64.0)


def test_usage_without_a_resource_is_not_compared(tables):
    day = dt.date(1996, 1, 2)
    t = tables(
        accounts=[account(1, payer=2), account(2)],
        weekly_metering=[metered(1)],
        daily_metering=[daily_row(1, None, 5.0, day), daily_row(1, "r", 0.1, day), daily_row(1, "r", 0.2, day), daily_row(1, "r", 1.0, day - dt.timedelta(days=1))],
    )
    (r,) = daily.daily_usage_diff(t, [day]).collect()
    assert (r.usage_resource, r.usage_yesterday, r.usage_today, r.price) == ("r", 1.0, 0.3, None)


def test_rows_without_a_resource_are_new_only_once(tables):
    t = tables(weekly_metering=[metered(1, None, week=5), metered(1, None), metered(1, "old", week=5), metered(1, "old"), metered(1, "new")])
    assert [r.usage_resource for r in domains.new_domains(t, [WEEK], SERVICE_A).collect()] == ["new"]
    t = tables(weekly_metering=[metered(1, None), metered(1, "old", week=5)])
    assert [r.usage_resource for r in domains.new_domains(t, [WEEK], SERVICE_A).collect()] == [None]


def test_rows_without_a_resource_count_as_one_resource_of_nobody(tables):
    t = tables(
        accounts=[account(1), account(2)],
        weekly_metering=[metered(1, None), metered(2, None), metered(2, "b")],
        weekly_charges=[charge(1, "1.00"), charge(2, "1.00")],
    )
    (r,) = domains.domain_counts(t, [WEEK], SERVICE_A).collect()
    assert (r.external_domain_count, r.one_domain_customer_count, r.multi_domain_customer_count) == (2, 1, 0)


def test_a_late_refund_adds_no_second_row_to_a_week(spark, tables):
    have = credits.credits_kpi(tables(), [(1996, 5)], "AmazonRDS").withColumn("credits_amount", F.lit(-7.0))
    got = credits.credits_history(tables(), (1996, 7), "AmazonRDS", 2, have).collect()
    assert sorted((r.year, r.week, r.credits_amount) for r in got) == [(1996, 5, -7.0), (1996, 6, 0.0)]


def test_patterns_must_be_given(tables):
    from tollhouse import SERVICE_A as bare

    with pytest.raises(ValueError, match="lab_pattern"):
        directory.lab_accounts(tables(), bare)


def test_ranks_of_fractional_usage(tables):
    lives = [dict(account_id=acct(n), company="c", is_internal_flag="N", min_request_year=1996, min_request_week=6) for n in (1, 2, 3)]
    use = [metered(1, "a", usage_value=0.1), metered(1, "b", usage_value=0.2), metered(2, "c", usage_value=0.3), metered(3, "d", usage_value=9.0)]
    got = {r.account_id: (r.sum_usage_value, r.rank) for r in revenue.new_customers(tables(active_date=lives, weekly_metering=use), [WEEK], SERVICE_A).collect()}
    assert got == {acct(1): (0.3, 2.5), acct(2): (0.3, 2.5), acct(3): (9.0, 1.0)}
