import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollhouse.functions import calendar


def test_columns_agree_with_strftime(spark):
    days = calendar.day_range(dt.date(1994, 1, 1), dt.date(2026, 12, 31))
    df = spark.createDataFrame([(d, int(d.strftime("%W")), int(d.strftime("%U"))) for d in days], "d date, w int, u int")
    wrong = df.where((calendar.monday_week(F.col("d")) != F.col("w")) | (calendar.sunday_week(F.col("d")) != F.col("u")))
    assert wrong.count() == 0


def test_column_shift_agrees_with_python(spark):
    weeks = [(y, w) for y in range(1994, 2026) for w in range(0, 53)]
    rows = [(*w, *calendar.shift(w, 1), *calendar.shift(w, -3), calendar.sunday_week_days(w)[0]) for w in weeks]
    df = spark.createDataFrame(rows, "y int, w int, ny int, nw int, py int, pw int, sunday date")
    y, w = F.col("y"), F.col("w")
    after, before = calendar.shifted_week(y, w, 1), calendar.shifted_week(y, w, -3)
    same = (after[0] == F.col("ny")) & (after[1] == F.col("nw")) & (before[0] == F.col("py")) & (before[1] == F.col("pw"))
    assert df.where(~(same & (calendar.sunday_week_start(y, w) == F.col("sunday")))).count() == 0


def test_year_boundary():
    # 1 January 1996 is a Monday; 1 January 1995 a Sunday, before the first Monday
    assert calendar.week_key(dt.date(1996, 1, 1)) == (1996, 1)
    assert calendar.week_key(dt.date(1995, 1, 1)) == (1995, 0)
    assert calendar.shift((1996, 1), -1) == (1995, 52)
    assert calendar.shift((1995, 52), 1) == (1996, 1)
    assert calendar.span((1996, 2), 4) == [(1995, 51), (1995, 52), (1996, 1), (1996, 2)]


def test_sunday_week_is_not_the_monday_week():
    days = calendar.sunday_week_days((1996, 6))
    assert (days[0], days[-1]) == (dt.date(1996, 2, 11), dt.date(1996, 2, 17))
    assert {calendar.week_key(d) for d in days} == {(1996, 6), (1996, 7)}


def test_defaults_and_guard():
    as_of = dt.date(1996, 2, 14)
    assert calendar.last_week(as_of) == (1996, 6)
    assert calendar.last_days(as_of, 2) == [dt.date(1996, 2, 13), dt.date(1996, 2, 12)]
    calendar.check_near([dt.date(1996, 1, 1)], as_of, 100)
    with pytest.raises(ValueError):
        calendar.check_near([dt.date(1995, 1, 1)], as_of, 100)
