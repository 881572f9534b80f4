from pyspark.sql import functions as F

from tollhouse.functions.text import account_id, head, matches, region, rest


def column(spark, values, make):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_ids_are_padded_but_never_cut(spark):
    assert column(spark, ["7", "123456789012", "1234567890123", None], account_id) == [
        "000000000007", "123456789012", "1234567890123", None,
    ]


def test_split_in_two(spark):
    values = ["a:b:c", "a", "a:", ":b", "", None]
    assert column(spark, values, lambda c: head(c, ":")) == ["a", "a", "a", "", "", None]
    assert column(spark, values, lambda c: rest(c, ":")) == ["b:c", "", "", "b", "", None]
    assert column(spark, ["3x m3.large", "x"], lambda c: rest(c, "x ")) == ["m3.large", ""]


def test_region_goes_both_ways(spark):
    assert column(spark, ["", "USW2", "EU", "PDX", "IAD", "nowhere", None], region) == [
        "IAD", "PDX", "DUB", "USW2", "", "IAD", "IAD",
    ]


def test_matches(spark):
    assert column(spark, ["t2.micro", "t2xmicro", "other", None], lambda c: matches(c, "t2.micro")) == [True, True, False, False]
    assert column(spark, ["An MSP here"], lambda c: matches(c, "msp", ignore_case=True)) == [True]
