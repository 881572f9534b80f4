import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tollhouse.functions import calendar
from tollhouse.operators import bitmaps
from tollhouse.plans import presence
from tollhouse.sources.fixtures import SERVICE_A, SERVICE_B, WEEKS
from tollhouse.sources.tables import parquet_tables

ALL = calendar.span((1999, 20), 200)


@pytest.fixture(scope="module")
def history(spark):
    """Keys over four years, with gaps, runs over words' ends, repeats and a null key."""
    rng = random.Random(4)
    held = {"always": set(ALL), None: set(ALL[60:70]), "once": {ALL[63]}}
    held |= {f"k{i}": {w for w in ALL if rng.random() < rng.choice((0.1, 0.9))} for i in range(12)}
    rows = [(k, *w) for k, ws in held.items() for w in ws] * 2
    return held, bitmaps.presence(spark.createDataFrame(rows, "k string, year int, week int").repartition(3), ["k"])


def test_week_numbers():
    numbers = [bitmaps.week_number(w) for w in ALL]
    assert numbers == list(range(numbers[0], numbers[0] + 200)) and [bitmaps.week_of(n) for n in numbers] == ALL


def got(frame):
    return {(r["k"], r["year"], r["week"]) for r in frame.collect()}


def test_new_gone_and_present(history):
    held, found = history
    before = dict(zip(ALL[1:], ALL))
    for name, bits, want in (
        ("here", F.col("bits"), lambda ws, w: w in ws),
        ("new", bitmaps.new_bits(F.col("bits")), lambda ws, w: w in ws and before[w] not in ws),
        ("gone", bitmaps.gone_bits(F.col("bits")), lambda ws, w: w not in ws and before[w] in ws),
        ("before", bitmaps.before_bits(F.col("bits")), lambda ws, w: before[w] in ws),
    ):
        rows = bitmaps.in_report_weeks(found, bits, ALL[1:]).collect()
        assert len(rows) == len({(r["k"], r["year"], r["week"]) for r in rows}), name
        assert got(bitmaps.in_report_weeks(found, bits, ALL[1:])) == {(k, *w) for k, ws in held.items() for w in ALL[1:] if want(ws, w)}, name
    assert got(bitmaps.in_report_weeks(found, F.col("bits"), [ALL[63], ALL[64]])) == {(k, *w) for k, ws in held.items() for w in (ALL[63], ALL[64]) if w in ws}


def test_first_and_last(history):
    held, found = history
    ends = {r["k"]: (r["first"], r["last"]) for r in bitmaps.first_and_last(found, ["k"]).collect()}
    assert ends == {k: tuple(bitmaps.week_number(f(ws)) for f in (min, max)) for k, ws in held.items()}


def test_joining_weeks_one_by_one_gives_the_same(spark, history):
    held, found = history
    part = None
    for half in (ALL[:77], ALL[77:]):
        rows = [(k, *w) for k, ws in held.items() for w in ws & set(half)]
        more = bitmaps.presence(spark.createDataFrame(rows, "k string, year int, week int"), ["k"])
        part = more if part is None else bitmaps.united(part.unionByName(more), ["k"])
    assert sorted(map(str, part.collect())) == sorted(map(str, found.collect()))


def test_weeks_of_another_name_have_no_bit(spark):
    rows = spark.createDataFrame([("a", 1996, 0), ("b", 1995, 52), ("c", 1996, 1)], "k string, year int, week int")
    assert {r["k"] for r in bitmaps.presence(rows, ["k"]).collect()} == {"b", "c"}
    assert bitmaps.presence(rows.where("false"), ["k"]).collect() == []


@pytest.fixture(scope="module")
def facts(spark, star, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("facts"))
    star["weekly_metering"].write.partitionBy("year", "week").parquet(f"{root}/weekly_metering")
    for name in ("accounts", "test_accounts"):
        star[name].write.parquet(f"{root}/{name}")
    return parquet_tables(spark, root)


REPORTS = [presence.joined_accounts, presence.left_accounts, presence.new_domains, presence.domain_diff, presence.customer_diff]


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_stored_bitmaps_give_the_same_and_a_week_reads_one_week(spark, facts, tmp_path):
    path = str(tmp_path / "bits")
    t = facts
    for some in (WEEKS[:4], WEEKS[3:7], *([w] for w in WEEKS[7:])):
        t = presence.store_presence(facts, some, SERVICE_A, path)
    for report in REPORTS:
        assert rows(report(t, WEEKS[1:], SERVICE_A)) == rows(report(facts, WEEKS[1:], SERVICE_A)), report
    year, week = WEEKS[-1]
    for report in REPORTS:
        plan = report(t, [WEEKS[-1]], SERVICE_A)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan" in line and "weekly_metering" in line and "usage_resource" in line]
        if report is presence.new_domains:
            assert len(scans) == 1 and f"(year#" in scans[0] and f"= {year}" in scans[0] and f"= {week}" in scans[0]
        else:
            assert not scans  # only the account ids that the payers' list is of
    assert rows(presence.account_lifetimes(t, SERVICE_A)) == rows(presence.account_lifetimes(facts, SERVICE_A))


def test_only_missing_weeks_are_read(spark, facts, tmp_path):
    path, read = str(tmp_path / "bits"), []


    presence.store_presence(facts, WEEKS[:3], SERVICE_B, path)
    original = presence.in_weeks
    try:
        presence.in_weeks = lambda df, weeks: read.append(list(weeks)) or original(df, weeks)
        presence.store_presence(facts, WEEKS[:4], SERVICE_B, path)
        assert read == [[WEEKS[3]]] * len(presence.KINDS)
        read.clear()
        presence.store_presence(facts, WEEKS[:4], SERVICE_B, path)
        assert read == []
        # a week without metering is known afterwards
        empty = calendar.shift(WEEKS[-1], 30)
        presence.store_presence(facts, [empty], SERVICE_B, path)
        read.clear()
        presence.store_presence(facts, [empty], SERVICE_B, path)
        assert read == []
    finally:
        presence.in_weeks = original


def test_a_run_that_ends_early_leaves_the_old_bitmaps(spark, facts, tmp_path, monkeypatch):
    path = str(tmp_path / "bits")
    before = rows(presence.store_presence(facts, WEEKS[:3], SERVICE_A, path)["presence_accounts"])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(presence, "_commit", lost)
        with pytest.raises(RuntimeError):
            presence.store_presence(facts, WEEKS[:5], SERVICE_A, path)
    assert rows(presence.store_presence(facts, WEEKS[:3], SERVICE_A, path)["presence_accounts"]) == before
    after = presence.store_presence(facts, WEEKS[:5], SERVICE_A, path)["presence_accounts"]
    direct = presence.presence(facts.weekly_metering.join(spark.createDataFrame(WEEKS[:5], "year int, week int"), ["year", "week"]), presence.ACCOUNT)
    assert rows(after) == rows(direct)


@pytest.mark.parametrize("name", ["presence_converted", "presence_domain_diff"])
def test_same_as_sql(spark, name):
    import check

    assert check.compare(spark, check.oracle(SF_DIR), name, SF_DIR).startswith("ok")
