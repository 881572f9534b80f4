"""Some registered queries against their SQL (``check.py`` compares all), and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
import check
from tests.conftest import SF_DIR
from tollhouse.plans import credits, customers, daily, directory, domains, freetier, revenue, status
from tollhouse.sources.fixtures import AS_OF, DAYS, SERVICE_A, WEEKS
from tollhouse.sources.tables import parquet_tables

SAMPLE = ["size_bands", "top_customers", "customer_counts_trial", "credits_legacy", "domain_config", "exposed_by_account", "price_matrix_new"]


REPORTS = [*entry.SERVICE_A_QUERIES, *entry.SERVICE_B_QUERIES]


def test_every_report_has_sql():
    assert set(REPORTS) <= entry.oracle_sql().keys() <= entry.queries().keys()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_building_a_report_starts_no_job_and_gathers_nothing_in_one_task(spark):
    spark.sparkContext.setJobGroup("building", "reports")
    for name in REPORTS:
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
        # a one-row total at the end is the only thing that comes together
        alone = [line for line in plan.split("\n") if "SinglePartition" in line]
        totals = name in ("exposed_stats", "report_run", "report_run_b")
        assert totals or not alone, (name, alone)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("", "")


@pytest.fixture(scope="module")
def partitioned(spark, star, tmp_path_factory):
    """The fixture's facts as partitioned Parquet."""
    root = str(tmp_path_factory.mktemp("facts"))
    for name in ("weekly_charges", "weekly_metering"):
        star[name].write.partitionBy("year", "week").parquet(f"{root}/{name}")
    for name, day in (("revenue_fact", "computation_date"), ("daily_charges", "computation_date"), ("compute_fact", "week_begin_date")):
        star[name].write.partitionBy(day).parquet(f"{root}/{name}")
    for name in ("accounts", "test_accounts", "dim_products", "dim_accounts", "dim_activity", "dim_compute_accounts", "goals",
                 "account_history", "subscriptions", "price_wide", "exposed_domains", "support_contracts", "impacted_accounts"):
        star[name].write.parquet(f"{root}/{name}")
    return parquet_tables(spark, root)


def partition_filters(df):
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(df))


@pytest.mark.parametrize(
    "report, column",
    [
        (lambda t: credits.credit_totals(t, [(1996, 6)], "AmazonES"), "computation_date"),
        (lambda t: credits.credits_kpi(t, [(1996, 6)], "AmazonES"), "computation_date"),
        (lambda t: customers.compute_adoption(t, [(1996, 6)]), "week_begin_date"),
        (lambda t: freetier.freetier_month_rows(t, [(1996, 1)]), "computation_date"),
        (lambda t: freetier.monthly_revenue(t, [(1996, 1)]), "computation_date"),
    ],
)
def test_facts_are_pruned_by_date(partitioned, report, column):
    facts = [f for f in partition_filters(report(partitioned)) if column in f]
    assert facts and all(">=" in f and "<=" in f for f in facts), facts


def test_a_week_reads_one_week_of_metering(spark, partitioned, tmp_path):
    path = str(tmp_path / "metered")
    full = directory.payer_map(partitioned)
    t = partitioned
    for week in WEEKS:
        t = directory.store_metered_accounts(partitioned, [week], path)
    assert t.metered_accounts.count() == partitioned.weekly_metering.select("year", "week", "account_id").distinct().count()
    assert sorted(map(str, directory.payer_map(t).collect())) == sorted(map(str, full.collect()))
    plan = plan_of(domains.domain_counts(t, [(1996, 6)], SERVICE_A))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "usage_resource" in line]
    assert scans and all("1996" in s and "PartitionFilters" in s for s in scans)
    assert "weekly_metering" in plan and plan.count("weekly_metering") == len(scans)


def test_no_sorted_aggregates_over_the_history(partitioned):
    t, weeks = partitioned, [(1996, 6)]
    reports = [
        status.account_status(t, AS_OF),
        status.suspended_domains(t, weeks, SERVICE_A, AS_OF),
        status.exposed_by_account(t, weeks, AS_OF),
        domains.domain_counts(t, weeks, SERVICE_A),
    ]
    for report in reports:
        assert "SortAggregate" not in plan_of(report)


def test_only_clients_of_resellers_are_sorted(partitioned):
    plan = plan_of(revenue.reseller_label(partitioned, SERVICE_A))
    lines = plan.split("\n")
    sorted_by = [i for i, line in enumerate(lines) if "SortAggregate" in line]
    join = next(i for i, line in enumerate(lines) if "Join [" in line)
    assert sorted_by and max(sorted_by) < join  # the join with the resellers comes first


def test_no_sorted_aggregates_over_the_usage(star):
    plan = plan_of(daily.domain_config(star, DAYS, SERVICE_A))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("report, charges", [(revenue.four_week_revenue, 1), (revenue.top_customers, 3), (revenue.gainers_losers, 3)])
def test_lists_are_planned_few_times(partitioned, report, charges):
    """The list, its cuts, and the count of all payers between them."""
    plan = plan_of(report(partitioned, [(1996, 6)], SERVICE_A))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "billed_amount" in line]
    assert len(scans) == charges


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, name):
    result = check.compare(spark, check.oracle(SF_DIR), name, SF_DIR)
    assert result.startswith("ok"), result


def test_same_with_one_shuffle_partition(spark):
    query = entry.queries()["gainers_losers"]
    wide = sorted(map(tuple, query(spark, SF_DIR).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert sorted(map(tuple, query(spark, SF_DIR).collect())) == wide
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", ["customer_counts", "top_customers", "suspended_domains", "daily_usage_diff", "new_customers"])
def test_no_cross_joins(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_is_used(spark):
    plan = entry.queries()["region_revenue"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_shipdate" in plan
