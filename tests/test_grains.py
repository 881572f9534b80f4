"""Sums at all grains: the reports give the same from them, and facts are read once."""

from decimal import Decimal

import pytest

from tests.conftest import SF_DIR
from tollhouse.plans import grains, report
from tollhouse.plans.directory import payer_map
from tollhouse.sources.fixtures import SERVICE_A, SERVICE_B, StarSchema
from tollhouse.sources.tables import Tables

WEEK = [(1996, 6)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", params=[SERVICE_A, SERVICE_B], ids=["A", "B"])
def service(request, spark, tmp_path_factory):
    """A service's tables with the facts as partitioned Parquet and the payer map stored, as a run has them."""
    t = Tables(spark, StarSchema(spark, SF_DIR, request.param).table)
    root, stored = str(tmp_path_factory.mktemp("facts")), {}
    for name, frame in (("weekly_charges", t.weekly_charges), ("weekly_metering", t.weekly_metering), ("payer_map", payer_map(t))):
        writer = frame.write if name == "payer_map" else frame.write.partitionBy("year", "week")
        writer.parquet(f"{root}/{name}")
        stored[name] = spark.read.schema(frame.schema).parquet(f"{root}/{name}")
    return request.param, t.replace(**stored)


def test_metrics_from_sums_read_the_facts_once(spark, service, tmp_path):
    profile, t = service
    plan = plan_of(grains.grain_sums(t, WEEK, profile))
    for table in ("weekly_charges", "weekly_metering"):
        scans = [line for line in plan.split("\n") if "FileScan" in line and table in line]
        assert len(scans) == 1 and "1996" in scans[0], (table, scans)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    sums = grains.store_grains(t, WEEK, profile, str(tmp_path / "grains"))
    metrics = report.weekly_metrics(t, WEEK, profile, sums)
    plan = plan_of(metrics)
    assert "weekly_charges" not in plan and "weekly_metering" not in plan
    assert all("grain" in line for line in plan.split("\n") if "FileScan" in line and "/grains" in line)
    want = sorted(map(str, report.weekly_metrics(t, WEEK, profile).collect()))
    assert sorted(map(str, metrics.collect())) == want and len(want) > 40


def test_nulls_and_empty_tables(tables, spark, tmp_path):
    charge = {"year": 1996, "week": 6, "account_id": "a", "is_internal_flag": "N", "usage_type": "x", "region": "IAD"}
    use = {**charge, "usage_type": "ESInstance:m3", "usage_resource": None, "usage_value": 1.5}
    t = tables(
        weekly_charges=[{**charge, "billed_amount": None}, {**charge, "region": None, "billed_amount": None}, {**charge, "account_id": None, "billed_amount": Decimal(2)}],
        weekly_metering=[use, use, {**use, "usage_type": None}, {**use, "usage_value": None, "usage_resource": "r"}],
    )
    got = {(r["grain"], r["account_id"], r["region"], r["usage_resource"]): (r["billed_amount"], r["usage_value"]) for r in grains.grain_sums(t, WEEK, SERVICE_A).collect()}
    assert got[("charge_account", "a", None, None)] == (None, None) and got[("charge_account", None, None, None)][0] == 2
    assert {k[2] for k in got if k[:2] == ("charge_region", "a")} == {"IAD", None}
    assert got[("usage_resource", "a", None, None)] == (None, 3.0) and got[("usage_resource", "a", None, "r")] == (None, None)
    assert got[("usage_region", "a", "IAD", None)] == (None, 3.0)
    empty = tables()
    assert grains.grain_sums(empty, WEEK, SERVICE_A).collect() == []
    assert grains.store_grains(empty, WEEK, SERVICE_A, str(tmp_path / "g")).collect() == []
