from tollhouse.functions import calendar
from tollhouse.plans import sketches
from tollhouse.sources import sinks
from tollhouse.sources.tables import Tables

SPAN = calendar.span((1996, 10), 6)


def metering(spark):
    """A third of the accounts of a week stay away the next; 30,000 in all, one without an id."""
    rows = spark.range(60_000).selectExpr("id % 6 AS i", "lpad(cast((id * 7919) % 30000 AS string), 12, '0') AS account_id")
    weeks = spark.createDataFrame([(i, *w) for i, w in enumerate(SPAN)], "i int, year int, week int")
    out = rows.join(weeks, "i").selectExpr("year", "week", "account_id", "if(account_id < '000000010000', 'N', 'Y') AS is_internal_flag")
    return out.union(spark.createDataFrame([(*SPAN[0], None, "N")], "year int, week int, account_id string, is_internal_flag string"))


def test_estimates_of_merged_and_stored_sketches(spark, tmp_path):
    t = Tables(spark, lambda name: {"weekly_metering": metering(spark)}[name])
    exact = sketches.account_estimates(t, SPAN[3:]).collect()
    assert len(exact) == 6 and all(r["within"] for r in exact) and max(r["exact"] for r in exact) > 5000
    sinks.write_weeks(sketches.account_sketches(t, SPAN), str(tmp_path / "sketches"))
    stored = Tables(spark, lambda name: None, {"account_sketches": spark.read.parquet(str(tmp_path / "sketches"))})
    key = lambda r: (r["year"], r["week"], r["is_internal_flag"])
    want = {key(r): r["accounts"] for r in sketches.approximate_accounts(t, SPAN[3:]).collect()}
    assert {key(r): r["accounts"] for r in sketches.approximate_accounts(stored, SPAN[3:]).collect()} == want
    one = {key(r): r["accounts"] for r in sketches.approximate_accounts(stored, SPAN, n=1).collect()}
    assert len(one) == 12 and all(v > 0 for v in one.values())
