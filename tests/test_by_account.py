"""Rows kept by account: sums and joins per account exchange nothing, and the rows are those of tables that are not kept."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tollhouse.operators.accounts import by_account, only_in_weeks
from tollhouse.plans import customers, domains, extracts, report, revenue
from tollhouse.sources.fixtures import SERVICE_A, SERVICE_B, WEEKS, StarSchema
from tollhouse.sources.tables import ADAPTIVE, Tables, keep


def exchanges(df):
    """The exchanges of a plan, not those by which kept rows are computed."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append(node.outputPartitioning().toString())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def kept(spark, profile=SERVICE_A):
    return report.kept_inputs(Tables(spark, StarSchema(spark, SF_DIR, profile, keep_usage=True).table), WEEKS)


@pytest.mark.parametrize(
    "sums",
    [
        lambda t: extracts.account_charges(t, WEEKS, "region", "is_internal_flag"),
        lambda t: extracts.charged_accounts(t, WEEKS),
        lambda t: domains._charged_metering(t, WEEKS, SERVICE_A, "usage_resource"),
        lambda t: domains.metering_sums(t, WEEKS, SERVICE_A),
        lambda t: customers._revenue_marks(t, WEEKS, SERVICE_A),
        lambda t: t.payer_map,
    ],
)
def test_sums_per_account_exchange_nothing(spark, sums):
    assert exchanges(sums(kept(spark))) == []


@pytest.mark.parametrize("profile", [SERVICE_A, SERVICE_B], ids=["A", "B"])
def test_rows_are_exchanged_for_orders_and_for_accounts_only(spark, profile):
    """Of line items and events, only sums are exchanged by a report: never by all that tells rows apart."""
    t = kept(spark, profile)
    metrics = exchanges(report.weekly_metrics(t, WEEKS, profile))
    by_rows = [e for e in metrics if "usage_type" in e and "account_id" in e or "operation" in e]
    assert not by_rows and not [e for e in exchanges(revenue.top_customers(t, WEEKS, profile)) if "usage" in e], by_rows


@pytest.mark.parametrize("profile", [SERVICE_A, SERVICE_B], ids=["A", "B"])
def test_lists_of_accounts_exchange_nothing(spark, profile):
    """Of a run's lists: charges per account meet companies and payers where they lie."""
    t = kept(spark, profile)
    assert exchanges(revenue.customer_list(t, WEEKS)) == []
    charged = extracts.account_charges(t, WEEKS)
    assert exchanges(charged.join(t.payer_map.select("account_id", "payer_account_id"), "account_id", "left")) == []


def test_history_exchanges_no_resources_by_account(spark):
    history = report.weekly_metrics_history(kept(spark), WEEKS[-1], SERVICE_A, 2)
    found = exchanges(history)
    assert found and not [e for e in found if "account_id" in e and "usage_resource" in e]


def test_small_sums_are_computed_once(spark):
    t = kept(spark)
    assert exchanges(domains.instance_revenue(t, WEEKS, SERVICE_A))[0].startswith("hashpartitioning(year")
    once = [domains.revenue_sums(t, WEEKS), revenue._payer_revenue(t, WEEKS)]
    assert all(df._jdf.queryExecution().withCachedData().nodeName() == "InMemoryRelation" for df in once)


def test_placed_rows_leave_the_session_as_it_was(spark):
    before = spark.conf.get(ADAPTIVE)
    rows = keep(by_account(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "account_id string, n int")), placed=True)
    assert spark.conf.get(ADAPTIVE) == before
    assert exchanges(rows.groupBy("account_id", "n").count()) == [] and rows.count() == 3


def test_only_in_weeks(spark):
    df = spark.createDataFrame([(1996, 1, "a", 1), (1996, 1, "a", 2), (1996, 2, "a", 3), (1995, 1, "a", 4), (1996, 1, None, 5), (None, 1, "a", 6), (1996, 1, "b", 7)], "year int, week int, account_id string, n int")
    seen = spark.createDataFrame([(1996, 1, "a"), (1996, 1, "a"), (1996, 3, "a"), (1995, 2, "a"), (1996, 2, "b"), (1996, 1, None), (None, 1, "a")], "year int, week int, account_id string")
    got = only_in_weeks(df, seen)
    assert got.columns == df.columns and sorted(r.n for r in got.collect()) == [1, 2]
    assert only_in_weeks(df, seen.limit(0)).collect() == []


DAY = dt.datetime(1996, 1, 1)
LINE = dict(l_orderkey=1, l_partkey=24, l_suppkey=5, l_linenumber=3, l_quantity=2.0, l_extendedprice=100.0, l_discount=0.1, l_tax=0.0,
            l_returnflag="N", l_linestatus="O", l_shipdate=DAY)
ODD = [
    {}, dict(l_returnflag="R", l_linenumber=1), dict(l_returnflag="A", l_linenumber=2), dict(l_returnflag=None), dict(l_returnflag="R", l_linenumber=None),
    dict(l_partkey=None), dict(l_partkey=23 * 8050), dict(l_partkey=-8051), dict(l_suppkey=None), dict(l_suppkey=-91), dict(l_discount=None), dict(l_discount=0.0),
    dict(l_discount=0.001), dict(l_tax=None), dict(l_tax=0.08), dict(l_linestatus="F"), dict(l_linestatus=None), dict(l_quantity=None), dict(l_extendedprice=None),
    dict(l_shipdate=None), dict(l_orderkey=2, l_returnflag="R", l_linenumber=1), dict(l_orderkey=2), dict(l_orderkey=None), dict(l_orderkey=99),
]


@pytest.fixture
def odd_star(tmp_path):
    """A star schema of rows that the given ones lack: nulls, negative keys, keys beyond twelve digits, orders without a priority."""
    return write_odd(tmp_path)


def write_odd(tmp_path):
    def put(name, columns, rows):
        pq.write_table(pa.Table.from_pylist([{c: r.get(c) for c in columns} for r in rows], pa.schema(list(columns.items()))), tmp_path / f"{name}.parquet")

    i, b, s, d, t = pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.timestamp("us")
    put("nation", {"n_nationkey": i, "n_name": s, "n_regionkey": i}, [dict(n_nationkey=k, n_regionkey=r) for k, r in ((0, 1), (1, None))])
    keys = [7, 10, 3 * 10**12 + 1]
    put("customer", {"c_custkey": b, "c_name": s, "c_nationkey": i, "c_acctbal": d, "c_mktsegment": s},
        [dict(c_custkey=k, c_nationkey=n % 2, c_mktsegment=[None, "MACHINERY", "X"][n]) for n, k in enumerate(keys)])
    orders = [dict(o_orderkey=1, o_custkey=7, o_orderpriority="1-URGENT"), dict(o_orderkey=2, o_custkey=10), dict(o_orderkey=3, o_custkey=keys[2], o_orderpriority="5-LOW")]
    put("orders", {"o_orderkey": b, "o_custkey": b, "o_orderstatus": s, "o_totalprice": d, "o_orderdate": t, "o_orderpriority": s}, orders)
    lines = [LINE | odd for odd in ODD] + [LINE | dict(l_orderkey=3)]
    kinds = {"l_linenumber": i, "l_quantity": d, "l_extendedprice": d, "l_discount": d, "l_tax": d, "l_returnflag": s, "l_linestatus": s, "l_shipdate": t}
    put("lineitem", {"l_orderkey": b, "l_partkey": b, "l_suppkey": b} | kinds, lines)
    events = [dict(event_id=n, user_id=u, ts=when, value=1.5) for n, (u, when) in enumerate([(7, DAY), (11, DAY), (None, DAY), (7, None), (-3, DAY)])]
    put("events", {"event_id": b, "ts": t, "user_id": b, "event_type": s, "value": d, "props": s}, events)
    return str(tmp_path)


NAMES = ["weekly_charges", "weekly_metering", "daily_charges", "daily_metering", "product_weekly_charges", "revenue_fact", "new_active_customers", "new_inactive_customers", "free_trial", "free_to_pay", "active_date", "exposed_domains"]


@pytest.mark.parametrize("name", NAMES)
def test_kept_tables_have_the_same_rows(spark, odd_star, name):
    plain, held = (StarSchema(spark, odd_star, SERVICE_A, keep_usage=k).table(name) for k in (False, True))
    assert plain.dtypes == held.dtypes
    rows = sorted(map(str, plain.collect()))
    assert rows == sorted(map(str, held.collect()))
    assert rows or name in ("free_trial", "free_to_pay", "exposed_domains")


def test_rows_of_odd_line_items(spark, odd_star):
    star = StarSchema(spark, odd_star, SERVICE_A, keep_usage=True)
    assert star.table("weekly_charges").count() == len(ODD) - 2 + 1  # those of an order
    facts = star.table("revenue_fact")
    refunded = facts.where("refund_amount <> 0").collect()
    assert len(refunded) == 1 and refunded[0].refund_amount == -refunded[0].billed_amount / 10
    assert {r.account_seq_id: r.payer_account_seq_id for r in facts.collect()} == {7: 5, 10: 10, 3 * 10**12 + 1: 3 * 10**12}
    credits = star.table("weekly_charges").where("credit_id IS NOT NULL")
    assert sorted((r.account_id, r.credit_id, r.billed_amount < 0) for r in credits.collect()) == [("000000000007", "CR1", False), ("000000000010", "CR2", True)]
    charges = star.table("daily_charges")
    assert {r.price_per_unit == 0 for r in charges.where("billed_amount IS NULL").collect()} == {False}
    assert charges.where("computation_date IS NULL").count() == 1 and charges.where(F.col("usage_type").isNull()).count() >= 2


def test_joined_and_left_are_those_of_the_metered_weeks(spark):
    for star in (StarSchema(spark, SF_DIR, SERVICE_A, keep_usage=k) for k in (False, True)):
        weeks = star._presence(star._metered_weeks())
        new, gone = weeks.where("now = 1 AND before = 0"), weeks.where("now = 0 AND before = 1 AND NOT (year = 1996 AND week > 8)")
        for name, want in (("new_active_customers", new), ("new_inactive_customers", gone)):
            rows = star.table(name)
            assert sorted(map(str, rows.collect())) == sorted(map(str, want.select(rows.columns).collect())) != []
