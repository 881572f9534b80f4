"""Joins on accounts: exclusion lists, payers and companies.

None of these hints a broadcast, because every list here grows with the customer base; Spark picks
by size. Sum per account before calling them, so that a busy account is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, accounts: DataFrame) -> DataFrame:
    return df.join(accounts, "account_id", "left_anti")


def only(df: DataFrame, accounts: DataFrame, keys=("account_id",)) -> DataFrame:
    return df.join(accounts.select(*keys), list(keys), "left_semi")


def only_in_weeks(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose account is in ``seen`` (year, week, account_id) in their week.

    The account alone is the key, and the weeks are compared beside it, so that what lies by account stays where it is.
    """
    d, s = df.alias("d"), seen.select("year", "week", "account_id").alias("s")
    same_week = (F.col("d.year") - F.col("s.year") == 0) & (F.col("d.week") - F.col("s.week") == 0)
    return d.join(s, (F.col("d.account_id") == F.col("s.account_id")) & same_week, "left_semi")


def marked(df: DataFrame, accounts: DataFrame, name: str) -> DataFrame:
    """Add a boolean column: is the account on the list?"""
    flags = accounts.select("account_id").distinct().withColumn(name, F.lit(True))
    return df.join(flags, "account_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))


def to_payer(df: DataFrame, payers: DataFrame) -> DataFrame:
    """Replace each account by the account that pays for it."""
    mapped = df.join(payers.select("account_id", F.col("payer_account_id").alias("_payer")), "account_id", "left")
    return mapped.withColumn("account_id", F.coalesce("_payer", "account_id")).drop("_payer")


def with_company(df: DataFrame, payers: DataFrame) -> DataFrame:
    return df.join(payers.select("account_id", "company"), "account_id", "left")


def by_account(df: DataFrame, account: Column | str = "account_id") -> DataFrame:
    """The rows of an account in one partition: sums with the account among their keys, unions of such rows and joins on the
    account alone exchange nothing.

    The number of partitions is given, as partitions that Spark joins for their size are not those of other tables.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(account) if isinstance(account, str) else account)
