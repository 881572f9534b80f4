"""Charges clustered by account within the week.

A clustered table is a bucketed table of the session's catalog over files at a path: all rows of an account lie in one bucket,
sorted. Sums per account, exclusions and joins with payers over it need no exchange of the charges. How a path is clustered
lies beside it, so any session can attach it.

A bucket is read by one task. Charges are therefore summed before they are stored: what an account has in a week is bounded by
the usage types, regions and operations there are, however many lines it was billed. The metering, with any number of
resources for an account, has no such bound and is not clustered.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollhouse.operators.periods import in_weeks
from tollhouse.sources import sinks
from tollhouse.sources.tables import Tables, padded

KEYS = ("year", "week", "account_id", "is_internal_flag", "usage_type", "region", "operation")
LAYOUT = "buckets int, fields string"


def _summed(t: Tables, weeks) -> DataFrame:
    rows = padded(in_weeks(t.weekly_charges, weeks))
    sums = rows.groupBy(*KEYS, F.col("credit_id").isNotNull().alias("is_credit")).agg(F.sum("billed_amount").alias("billed_amount"))
    return sums.select(*KEYS[2:], F.when(F.col("is_credit"), "credit").alias("credit_id"), "billed_amount", *KEYS[:2])


def store_charges(t: Tables, weeks, table: str, path: str, buckets: int = 200) -> DataFrame:
    """Stores the charges of the weeks, summed, at ``path`` and attaches them as ``table``; weeks that are there are replaced.

    ``buckets`` counts for a path's first weeks and then stays: a bucket of a week is one file, and the sums per account of
    any number of weeks run in as many tasks.
    """
    spark, sums = t.spark, _summed(t, weeks)
    if sinks.exists(spark, f"{path}.layout"):
        attach(spark, table, path)
        buckets = _layout(spark, path)[0]
    else:
        _create(spark, table, path, sums.schema, buckets)
        spark.createDataFrame([(buckets, sums.schema.json())], LAYOUT).coalesce(1).write.parquet(f"{path}.layout")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        # rows are dealt as they are bucketed, so each task writes one file a week
        sums.repartition(buckets, "account_id").write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    return spark.table(table)


def attach(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The clustered table at ``path``, under a name of this session's catalog."""
    buckets, fields = _layout(spark, path)
    _create(spark, table, path, fields, buckets)
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


def _layout(spark: SparkSession, path: str) -> tuple[int, T.StructType]:
    row = spark.read.schema(LAYOUT).parquet(f"{path}.layout").first()
    return row["buckets"], T.StructType.fromJson(json.loads(row["fields"]))


def _create(spark: SparkSession, table: str, path: str, fields: T.StructType, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (year, week) "
        f"CLUSTERED BY (account_id) SORTED BY (account_id) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
