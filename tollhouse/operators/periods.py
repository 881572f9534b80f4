"""Reports over a list of weeks or days, in one job.

A report compares a period with earlier ones. Instead of one pass per period, every row is handed
to each report period it takes part in, together with how many periods back it lies; one aggregate
with conditional sums then gives all periods of all reports.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week


def literal_rows(spark: SparkSession, columns: dict[str, pa.DataType], rows: Iterable[Sequence]) -> DataFrame:
    """A short list as a local relation."""
    fields = list(zip(*rows)) or [() for _ in columns]
    arrays = [pa.array(list(values), type=t) for values, t in zip(fields, columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


def in_weeks(df: DataFrame, weeks: Iterable[Week]) -> DataFrame:
    """Rows of the given weeks; the predicate reaches the scan and prunes (year, week) partitions."""
    by_year: dict[int, list[int]] = {}
    for year, week in weeks:
        by_year.setdefault(year, []).append(week)
    conds = [(F.col("year") == y) & F.col("week").isin(sorted(set(w))) for y, w in sorted(by_year.items())]
    return df.where(reduce(lambda a, b: a | b, conds, F.lit(False)))


def in_days(df: DataFrame, day: str, days: Iterable[dt.date]) -> DataFrame:
    """Rows of the given days; consecutive days become a range, which scans prune best."""
    days = sorted(set(days))
    if not days:
        return df.where(F.lit(False))
    if (days[-1] - days[0]).days + 1 == len(days):
        return df.where(F.col(day).between(F.lit(days[0]), F.lit(days[-1])))
    return df.where(F.col(day).isin(days))


def spread_weeks(df: DataFrame, weeks: Sequence[Week], offsets: Iterable[int]) -> DataFrame:
    """Hand each (year, week) row to the report weeks it belongs to.

    (year, week) become the report week; ``back`` tells how many weeks before it the row lies. The
    map has one row per report week and offset, so it is always small enough to broadcast. Aggregate
    to (account, week) or similar first: each row is repeated once per offset.
    """
    rows = [(*calendar.shift(w, -back), *w, back) for w in weeks for back in offsets]
    types = {"year": pa.int32(), "week": pa.int32(), "_year": pa.int32(), "_week": pa.int32(), "back": pa.int32()}
    to_report = literal_rows(df.sparkSession, types, rows)
    spread = df.join(F.broadcast(to_report), ["year", "week"])
    kept = [c for c in df.columns if c not in ("year", "week")]
    return spread.select(F.col("_year").alias("year"), F.col("_week").alias("week"), "back", *kept)


def spread_days(df: DataFrame, day: str, days: Sequence[dt.date], offsets: Iterable[int]) -> DataFrame:
    """The same for a date column."""
    rows = [(d - dt.timedelta(days=back), d, back) for d in days for back in offsets]
    to_report = literal_rows(df.sparkSession, {day: pa.date32(), "_day": pa.date32(), "back": pa.int32()}, rows)
    spread = df.join(F.broadcast(to_report), day)
    return spread.select(F.col("_day").alias(day), "back", *[c for c in df.columns if c != day])


def earlier_weeks(weeks: Iterable[Week], offsets: Iterable[int]) -> list[Week]:
    """All weeks a report over ``weeks`` reads."""
    offsets = list(offsets)
    return sorted({calendar.shift(w, -back) for w in weeks for back in offsets})


def earlier_days(days: Iterable[dt.date], offsets: Iterable[int]) -> list[dt.date]:
    offsets = list(offsets)
    return sorted({d - dt.timedelta(days=back) for d in days for back in offsets})


def sunday_weeks(spark: SparkSession, weeks: Iterable[Week], day: str, back: int = 0) -> DataFrame:
    """(day, year, week) for the Sunday weeks ``back`` weeks before the report weeks; seven rows per week."""
    rows = [(d, *w) for w in weeks for d in calendar.sunday_week_days(calendar.shift(w, -back))]
    return literal_rows(spark, {day: pa.date32(), "year": pa.int32(), "week": pa.int32()}, rows)


def week_frame(spark: SparkSession, weeks: Iterable[Week]) -> DataFrame:
    return literal_rows(spark, {"year": pa.int32(), "week": pa.int32()}, list(weeks))


def one_row_per_week(df: DataFrame, weeks: Iterable[Week]) -> DataFrame:
    """A per-week result with a row for every report week; measures of weeks without data are 0."""
    measures = [c for c in df.columns if c not in ("year", "week")]
    return week_frame(df.sparkSession, weeks).join(df, ["year", "week"], "left").fillna(0, measures)
