import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollhouse.operators import ranking


def ranks_by_hand(rows):
    out = {}
    for week, _, value in rows:
        same_week = [v for w, _, v in rows if w == week]
        above = sum(1 for v in same_week if v is not None and (value is None or v > value))
        ties = sum(1 for v in same_week if v == value)
        out[week, value] = above + 1 + (ties - 1) / 2
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "week int, account string, value decimal(20,2)")


def random_rows(n, hot=None):
    rng = random.Random(3)
    picks = [Decimal(rng.randint(-10**k, 10**k)) / 100 for k in (2, 4, 7, 9, 13) for _ in range(n // 10)]
    rows = [(rng.randint(1, 3), f"a{i}", hot if hot is not None and rng.random() < 0.4 else rng.choice(picks)) for i in range(n)]
    return rows + [(1, "none", None)]


def test_ties_share_the_mean_rank_and_null_is_last(spark):
    rows = [(1, "a", Decimal(10)), (1, "b", Decimal(10)), (1, "c", Decimal(5)), (1, "d", None)]
    got = {r.account: r.rank for r in ranking.with_rank(frame(spark, rows), "value", ["week"], "rank").collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0, "d": 4.0}


def test_ranks_against_brute_force(spark):
    # values over many orders of magnitude, and one that two fifths of the rows share
    rows = random_rows(400, hot=Decimal("0.00"))
    want = ranks_by_hand(rows)
    got = ranking.with_rank(frame(spark, rows), "value", ["week"], "rank").collect()
    assert len(got) == len(rows)
    assert all(r.rank == want[r.week, r.value] for r in got)


def test_rank_of_a_short_list(spark):
    rows = random_rows(200)
    df, want = frame(spark, rows), ranks_by_hand(rows)
    top = ranking.top_k(df, 5, ["week"], [F.desc("value"), F.col("account")])
    got = ranking.rank_of(top, ranking.rank_table(df, "value", ["week"]), "value", ["week"], "rank").collect()
    assert len(got) == 15
    assert all(r.rank == want[r.week, r.value] for r in got)


def test_top_and_rest_add_up(spark):
    rows = [(w, f"a{i}", Decimal(-i)) for w in (1, 2) for i in range(1, 8)]
    rest = {"account": F.lit("other")}
    got = ranking.top_k_and_rest(frame(spark, rows), 3, ["week"], [F.asc("value"), F.col("account")], "value", rest).collect()
    assert sorted((r.week, r.position, r.account, int(r.value)) for r in got)[:4] == [
        (1, 1, "a7", -7), (1, 2, "a6", -6), (1, 3, "a5", -5), (1, 4, "other", -10),
    ]


def test_top_k_cuts_before_the_shuffle(spark):
    plan = ranking.top_k(frame(spark, random_rows(50)), 5, ["week"], [F.desc("value")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ranks_among_all_rows_in_one_pass(spark):
    rows = [(w, a, v, v if v is None else -v) for w, a, v in random_rows(400, hot=Decimal("0.00"))] + [(w, f"n{i}", None, None) for w in (1, 2) for i in range(3)]
    df = spark.createDataFrame(rows, "week int, account string, value decimal(20,2), other decimal(20,2)").repartition(4)
    few = df.where("abs(hash(account)) % 5 = 0 OR value IS NULL").limit(150)
    got = ranking.ranks_among(few, df, {"value": "r", "other": "s"}, ["week"]).collect()
    up, down = ranks_by_hand([(w, a, v) for w, a, v, _ in rows]), ranks_by_hand([(w, a, o) for w, a, _, o in rows])
    nulls = {w: [v for x, _, v, _ in rows if x == w and v is None] for w in (1, 2, 3)}
    size = {w: sum(x == w for x, *_ in rows) for w in (1, 2, 3)}
    assert len(got) == 150 or len(got) == few.count()
    for g in got:
        last = size[g.week] - (len(nulls[g.week]) - 1) / 2
        assert (g.r, g.s) == ((last, last) if g.value is None else (up[g.week, g.value], down[g.week, g.other]))


@pytest.fixture
def many_ranges(spark):
    """Small ranges stay ranges of their own."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def ranges_of(spark, path, week, value):
    """Ranges in which rows of a value were written."""
    rows = spark.read.parquet(path).where((F.col("week") == week) & F.col("value").eqNullSafe(F.lit(value)))
    return {r._at >> 33 for r in rows.collect()}


def test_ranks_by_ranges_against_brute_force(spark, tmp_path, many_ranges):
    hot = Decimal("0.00")
    rows = random_rows(2000, hot=hot)
    path, want = str(tmp_path / "ranges"), ranks_by_hand(rows)
    got = ranking.with_rank_by_ranges(frame(spark, rows).repartition(3), "value", ["week"], "rank", path).collect()
    assert sorted((r.week, r.account) for r in got) == sorted((w, a) for w, a, _ in rows)
    assert all(r.rank == want[r.week, r.value] for r in got)
    # one value is shared by rows on both sides of a border, in at least one week
    assert max(len(ranges_of(spark, path, w, hot)) for w in (1, 2, 3)) > 1


def test_ranks_by_ranges_of_any_number(spark, tmp_path, many_ranges):
    # decimals beyond two places, differences below those of doubles, and repeated rows
    rng = random.Random(5)
    close = [Decimal(10) ** 15 + Decimal(i) / 10**12 for i in range(40)]
    rows = [(rng.randint(1, 2), f"a{i % 90}", rng.choice([*close, None])) for i in range(300)]
    df, want = spark.createDataFrame(rows, "week int, account string, value decimal(38,12)"), ranks_by_hand(rows)
    got = ranking.with_rank_by_ranges(df, "value", ["week"], "rank", str(tmp_path / "d")).collect()
    nulls = {w: sum(x == w and v is None for x, _, v in rows) for w in (1, 2)}
    size = {w: sum(x == w for x, *_ in rows) for w in (1, 2)}
    assert len(got) == len(rows)
    assert all(r.rank == (size[r.week] - (nulls[r.week] - 1) / 2 if r.value is None else want[r.week, r.value]) for r in got)
    doubles = [(1, "a", 1e-9), (1, "b", 2e-9), (1, "c", float("-inf")), (1, "d", 1e300), (1, "e", 2e-9), (None, "f", 1.0), (None, "g", 2.0)]
    df = spark.createDataFrame(doubles, "week int, account string, value double")
    got = ranking.with_rank_by_ranges(df, "value", ["week"], "rank", str(tmp_path / "f")).collect()
    assert {r.account: r.rank for r in got} == {"a": 4.0, "b": 2.5, "c": 5.0, "d": 1.0, "e": 2.5, "f": 2.0, "g": 1.0}


def test_ranks_by_ranges_of_no_rows(spark, tmp_path):
    assert ranking.with_rank_by_ranges(frame(spark, []), "value", ["week"], "rank", str(tmp_path / "r")).collect() == []


def test_ranks_by_ranges_plan_the_input_once(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "ranges")
    frame(spark, random_rows(50)).write.parquet(source)
    ranked = ranking.with_rank_by_ranges(spark.read.parquet(source), "value", ["week"], "rank", path)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert source not in plan and path in plan
    # each window sees the ranges of one group, not its rows
    assert plan.count("Window [") == 1 and "SinglePartition" not in plan
