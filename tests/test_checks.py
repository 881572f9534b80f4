"""Daily checks and exposed resources as runs."""

import datetime as dt

import pytest

from tollhouse.plans import checks, daily, status
from tollhouse.sources.fixtures import AS_OF, DAYS, LAST_WEEK


def rows(df):
    return sorted(map(str, df.collect()))


def test_daily_run(spark, star, tmp_path):
    path, days = str(tmp_path), DAYS[:2]
    written = checks.daily_run(star, days, path, as_of=days[0])
    assert [w.rsplit("/", 1)[1] for w in written] == list(checks.CHECKS)
    plain = daily.daily_gainers(star, days)
    read = lambda: spark.read.schema(plain.schema).csv(f"{path}/daily_gainers", header=True)
    assert rows(read().select(plain.columns)) == rows(plain) != []
    # read file by file, a day's rows fall
    for day in days:
        files = sorted((tmp_path / f"daily_gainers/computation_date={day}").glob("part-*.csv"))
        diffs = [r["diff"] for f in files for r in spark.read.csv(str(f), header=True, inferSchema=True).select("diff").collect()]
        assert diffs == sorted(diffs, reverse=True)
    # a day written again replaces itself only
    before = rows(read())
    checks.daily_run(star, days[1:], path)
    assert rows(read()) == before
    usage = spark.read.csv(f"{path}/daily_usage_diff", header=True)
    assert usage.count() == daily.daily_usage_diff(star, days).count()


def test_days_far_away_are_refused(tables, tmp_path):
    with pytest.raises(ValueError):
        checks.daily_run(tables(), [dt.date(1996, 1, 1)], str(tmp_path / "x"), as_of=dt.date(1996, 4, 11))
    assert not (tmp_path / "x").exists()
    checks.daily_run(tables(), [dt.date(1996, 1, 1)], str(tmp_path / "x"), as_of=dt.date(1996, 4, 10))


def test_exposure_run(spark, star, tmp_path):
    weeks = [LAST_WEEK]
    full, unsupported, joined = checks.exposure_run(star, weeks, AS_OF, str(tmp_path))
    want = status.exposed_domains(star, weeks, AS_OF)
    assert rows(spark.read.schema(want.schema).csv(full, header=True)) == rows(want) != []
    few = status.exposed_unsupported(star, weeks, AS_OF)
    assert rows(spark.read.schema(few.schema).csv(unsupported, header=True)) == rows(few)
    # no quotes, and every name of every account is there once
    text = "".join(p.read_text() for p in (tmp_path / "exposed_joined").glob("*.csv"))
    names = status.exposed_by_account(star, weeks, AS_OF)
    assert '"' not in text and sum(line.count("arn:") for line in text.split("\n")) == names.count()


def test_exposed_resources_are_looked_up_once(spark, star, tmp_path):
    found = star.replace(exposed_found=checks._kept(status.exposed_domains(star, [LAST_WEEK], AS_OF), str(tmp_path / "found")))
    plan = status.exposed_joined(found, [LAST_WEEK], AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "exposed_found" not in plan and str(tmp_path / "found") in plan and "l_shipdate" not in plan
