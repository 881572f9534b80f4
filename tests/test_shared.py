"""Rows that a report reads several times are computed once."""

from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tollhouse.plans import credits, grains, revenue, status
from tollhouse.sources.fixtures import AS_OF, SERVICE_A, SERVICE_B, WEEKS, StarSchema
from tollhouse.sources.tables import Tables


def leaves(df):
    """(name, columns) of what the plan reads, kept rows taken as they are."""
    found = df._jdf.queryExecution().withCachedData().collectLeaves()
    return [(found.apply(i).nodeName(), found.apply(i).output().mkString(",")) for i in range(found.size())]


@pytest.mark.parametrize("name", ["weekly_metrics", "weekly_metrics_b", "weekly_metrics_history", "report_run", "report_run_b"])
def test_line_items_are_joined_once(spark, name):
    read = leaves(entry.queries()[name](spark, SF_DIR))
    assert sum(n == "InMemoryRelation" for n, _ in read) > 10
    again = [columns for n, columns in read if n != "InMemoryRelation" and "l_orderkey" in columns]
    assert not again, again


@pytest.mark.parametrize(
    "report",
    [
        lambda t: revenue.new_customers(t, WEEKS, SERVICE_A),
        lambda t: revenue.dropped_customers(t, WEEKS),
        lambda t: revenue.top_customers(t, WEEKS, SERVICE_A),
        lambda t: credits.credits_refunds(t, WEEKS, SERVICE_A.product_code),
        lambda t: status.suspended_domains(t, WEEKS, SERVICE_A, AS_OF),
    ],
)
def test_shared_rows_give_the_same(spark, star, report):
    shared = report(star.sharing())
    # the directory of those who pay is not among the shared rows
    before, now = (sum("l_orderkey" in columns for _, columns in leaves(df)) for df in (report(star), shared))
    assert now < before / 2, (before, now)
    assert sorted(map(str, shared.collect())) == sorted(map(str, report(star).collect()))


def test_a_report_built_again_reads_the_files_again(spark, tmp_path):
    def written(amount):
        pq.write_table(pa.table({"account_id": ["a"], "amount": [Decimal(amount)]}), tmp_path / "x.parquet")
        t = Tables(spark, lambda name: spark.read.parquet(str(tmp_path / "x.parquet"))).sharing()
        return [r.amount for r in t.shared(t.charges).collect()]

    assert written("1") == [1] and written("2") == [2]


@pytest.mark.parametrize("profile", [SERVICE_A, SERVICE_B], ids=["A", "B"])
def test_grains_one_by_one_are_those_of_tagged_rows(spark, profile):
    t = Tables(spark, StarSchema(spark, SF_DIR, profile).table)
    sums = grains.grain_sums(t.sharing(), WEEKS[-2:], profile)
    # no row is repeated for each grain, and the facts are read once
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and not [c for n, c in leaves(sums) if n != "InMemoryRelation"]
    tagged = grains.grain_sums(t, WEEKS[-2:], profile)
    assert sums.dtypes == tagged.dtypes
    assert sorted(map(str, sums.collect())) == sorted(map(str, tagged.collect()))


def test_grains_one_by_one_of_rows_without_values(tables):
    charge = {"year": 1996, "week": 6, "account_id": "a", "is_internal_flag": "N", "usage_type": "x", "region": "IAD"}
    use = {**charge, "usage_type": "ESInstance:m3", "usage_resource": None, "usage_value": 1.5}
    t = tables(
        weekly_charges=[{**charge, "billed_amount": None}, {**charge, "account_id": None, "region": None, "billed_amount": Decimal(2)}],
        weekly_metering=[use, use, {**use, "usage_type": None}, {**use, "usage_value": None, "usage_resource": "r"}],
    )
    got, want = (sorted(map(str, grains.grain_sums(x, [(1996, 6)], SERVICE_A).collect())) for x in (t.sharing(), t))
    assert got == want and len(got) == 10
    assert grains.grain_sums(tables().sharing(), [(1996, 6)], SERVICE_A).collect() == []
