"""Runs that come in force as a whole, and charges clustered by account."""

import pytest

from tollhouse.plans import customers, report
from tollhouse.plans.directory import payer_map, store_metered_accounts
from tollhouse.plans.extracts import account_charges, charged_accounts
from tollhouse.operators.accounts import to_payer
from tollhouse.sources import clustered, runs, sinks
from tollhouse.sources.fixtures import SERVICE_A

W5, W6, W7 = (1996, 5), (1996, 6), (1996, 7)


def rows(df):
    return sorted(map(str, df.collect()))


def of(spark, *data):
    return spark.createDataFrame(list(data), "year int, week int, x string")


def test_a_run_is_seen_once_it_is_published(spark, tmp_path):
    path = str(tmp_path)
    assert runs.published(spark, path, "a") is None and runs.missing(spark, path, ["a"], [W6]) == [W6]
    first = runs.Run(spark, path, [W6, W7])
    first.stage("a", of(spark, (*W6, "1")), "parquet", sinks.write_weeks)
    first.stage("b", of(spark, (*W6, "1"), (*W7, "2")), "csv", sinks.write_week_lists)
    assert runs.published(spark, path, "a") is None
    first.publish()
    assert rows(runs.published(spark, path, "a")) == rows(of(spark, (*W6, "1")))
    assert rows(runs.published(spark, path, "b", [W7])) == rows(of(spark, (*W7, "2")))
    assert runs.published(spark, path, "a", [W7]).collect() == [] and runs.missing(spark, path, ["a", "b"], [W5, W6, W7]) == [W5]
    # a run that dies between two outputs changes nothing
    dead = runs.Run(spark, path, [W6])
    dead.stage("a", of(spark, (*W6, "dead")), "parquet", sinks.write_weeks)
    assert rows(runs.published(spark, path, "a")) == rows(of(spark, (*W6, "1")))
    # a later run replaces its weeks only, also by nothing
    second = runs.Run(spark, path, [W6])
    second.stage("b", of(spark).limit(0), "csv", sinks.write_week_lists)
    second.publish()
    assert rows(runs.published(spark, path, "b")) == rows(of(spark, (*W7, "2")))
    assert runs.superseded(spark, path) == []
    third = runs.Run(spark, path, [W6, W7])
    third.stage("a", of(spark, (*W7, "3")), "parquet", sinks.write_weeks)
    third.stage("b", of(spark, (*W7, "3")), "csv", sinks.write_week_lists)
    third.publish()
    assert runs.superseded(spark, path) == sorted([first.run_id, second.run_id])
    assert rows(runs.published(spark, path, "a")) == rows(of(spark, (*W7, "3")))


def test_a_run_holds_its_weeks_only(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path), [W6])
    with pytest.raises(ValueError):
        run.stage("a", of(spark, (*W7, "1")), "parquet", sinks.write_weeks)
    with pytest.raises(ValueError):
        run.stage("a", of(spark, (*W6, "1")).withColumnRenamed("x", "run_id"), "parquet", sinks.write_weeks)


def test_an_empty_week_is_computed_once(spark, tmp_path):
    asked = []

    def compute(weeks):
        asked.append(weeks)
        return of(spark, *[(*w, "x") for w in weeks if w != W6])

    for _ in range(2):
        assert runs.read_through(spark, str(tmp_path), "a", [W6], compute).collect() == []
        assert rows(runs.read_through(spark, str(tmp_path), "a", [W5, W6, W5], compute)) == rows(of(spark, (*W5, "x")))
    assert asked == [[W6], [W5]]


def test_metered_accounts_of_weeks_without_metering(tables, tmp_path):
    use = {"year": 1996, "week": 6, "account_id": "a"}
    t = store_metered_accounts(tables(weekly_metering=[use, use]), [W5], str(tmp_path))
    assert t.metered_accounts.collect() == []
    t = store_metered_accounts(tables(weekly_metering=[use, use]), [W5, W6], str(tmp_path))
    assert [tuple(r) for r in t.metered_accounts.select("account_id", "year", "week").collect()] == [("a", *W6)]


def test_a_killed_report_run_leaves_the_old_one(spark, star, tmp_path, monkeypatch):
    path, none = str(tmp_path), (2019, 1)
    assert report.committed_run(star, [W6, none], SERVICE_A, path) == [W6, none]
    before = {name: rows(runs.published(spark, path, name)) for name in report.OUTPUTS}
    assert before["top_customers"] and before["weekly_metrics"] and before["top_by_region"]
    plain = report.revenue.top_customers(star, [W6], SERVICE_A)
    assert runs.published(spark, path, "top_customers", [W6]).count() == plain.count()
    # lists ranked by ranges are those that ranks without a write give
    for name, df in (("new_customers", report.revenue.new_customers(star, [W6], SERVICE_A)), ("dropped_customers", report.revenue.dropped_customers(star, [W6]))):
        listed = ["account_id", "rank"]
        assert rows(runs.published(spark, path, name, [W6]).select(listed)) == rows(df.select(listed))
    # the week without any data has been done as well
    assert report.committed_run(star, [W6, none], SERVICE_A, path) == []
    assert runs.published(spark, path, "top_customers", [none]).collect() == []

    def killed(df, place):
        raise RuntimeError("killed")

    monkeypatch.setattr(sinks, "write_by_region", killed)
    fewer = star.replace(weekly_charges=star.weekly_charges.where("account_id < '000000000500'"))
    with pytest.raises(RuntimeError):
        report.committed_run(fewer, [W6], SERVICE_A, path, again=True)
    assert list((tmp_path / "top_customers").glob("run_id=*"))[1:]  # lists had been staged
    for name in ("top_customers", "customer_list", "weekly_metrics"):
        assert rows(runs.published(spark, path, name)) == before[name]


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def over_charges(df):
    """Names of the operators between the scan of the charges and the top of the plan, the scan's side first."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: next((i for i, c in enumerate(line) if c.isalpha() or c == "*"), 0)
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "billed_amount" in line or "FileScan" in line and "charges_of" in line)
    above, limit = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < limit:
            above.append(line.strip())
            limit = depth(line)
    return above


def test_clustered_charges(spark, star, tmp_path, shuffled_joins):
    path, weeks = str(tmp_path / "charges"), [W5, W6]
    clustered.store_charges(star, [W5], "charges_of_w5", path, buckets=4)
    frame = clustered.store_charges(star, [W6], "charges_of", path, buckets=99)  # the first number stays
    t = star.replace(weekly_charges=frame, payer_map=payer_map(star))
    assert len(list((tmp_path / "charges").glob("year=1996/week=6/*.parquet"))) <= 4
    for report_of in (lambda x: account_charges(x, weeks, "is_internal_flag"), lambda x: charged_accounts(x, weeks), lambda x: customers.customer_counts(x, [W6], SERVICE_A)):
        assert rows(report_of(t)) == rows(report_of(star))
    # sums, exclusions and payers: no exchange of the charges
    paid = account_charges(t, weeks).join(payer_map(t).select("account_id", "payer_account_id"), "account_id", "left")
    assert not [line for line in over_charges(paid) if "Exchange" in line]
    assert [line for line in over_charges(to_payer(account_charges(t, weeks), payer_map(t)).groupBy("account_id").count()) if "Exchange" in line]
    counts = over_charges(customers.customer_counts(t, [W6], SERVICE_A))
    first = next(i for i, line in enumerate(counts) if "Exchange" in line)
    assert sum("HashAggregate" in line for line in counts[:first]) >= 2  # the account sums are done by then
    # replaced, not added
    again = clustered.store_charges(star, [W6], "charges_of", path)
    assert rows(again) == rows(clustered.attach(spark, "charges_again", path))
    assert again.where("week = 6").count() == frame.where("week = 6").count() > 0
