"""Writers. Spark writes directories of part files; none of these passes data through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.operators.periods import in_weeks

#: Files that the rows of one week, or one region of a week, are written to at most.
FILES_PER_KEY = 8


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_pipe(df: DataFrame, path: str) -> None:
    """``|`` between fields and no quoting."""
    df.write.mode("overwrite").option("sep", "|").option("quote", "").csv(path, header=True)


def write_by_region(df: DataFrame, path: str) -> None:
    """One directory per week, region and internal flag; those present in ``df`` replace the stored ones."""
    _replacing(_spread(df, "year", "week", "region")).partitionBy("year", "week", "region", "is_internal_flag").csv(path, header=True)


def write_week_lists(df: DataFrame, path: str) -> None:
    """Lists with a header line, a directory per week; weeks present in ``df`` replace the stored ones."""
    _replacing(_spread(df, "year", "week")).partitionBy("year", "week").csv(path, header=True)


def write_ordered_lists(df: DataFrame, path: str, order: Sequence[Column | str], by: Sequence[str] = ("year", "week")) -> None:
    """Lists with a header line, a directory per week (or other ``by``), in order: read by their names, a week's files give its
    rows in the order asked for. Rows are dealt by ranges of (year, week, order), so a week of any size lies in several files
    and nothing is sorted in one place; weeks present in ``df`` replace the stored ones."""
    keys = [*map(F.col, by), *order]
    _replacing(df.repartitionByRange(*keys).sortWithinPartitions(*keys)).partitionBy(*by).csv(path, header=True)


def write_weeks(df: DataFrame, path: str) -> None:
    """Store weekly rows by (year, week); weeks present in ``df`` replace the stored ones."""
    _replacing(_spread(df, "year", "week")).partitionBy("year", "week").parquet(path)


def _spread(df: DataFrame, *keys: str, files: int = FILES_PER_KEY) -> DataFrame:
    """Rows of a key in at most ``files`` tasks, and so in as many files."""
    others = [F.col(f"`{c}`").cast("string") for c in df.columns if c not in keys]
    return df.repartition(*keys, F.pmod(F.xxhash64(F.lit(0), *others), F.lit(files)))


def _replacing(df: DataFrame):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path of any store that Spark reads."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def missing_weeks(df: DataFrame, stored: DataFrame | None, keys: Sequence[str] = ("year", "week")) -> DataFrame:
    """Rows of weeks the store does not hold yet."""
    if stored is None:
        return df
    return df.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def append_history(df: DataFrame, path: str) -> DataFrame:
    """Add the weeks the history lacks and return the whole of it."""
    spark = df.sparkSession
    new = missing_weeks(df, read_or_none(spark, path))
    new.write.mode("append").partitionBy("year", "week").parquet(path)
    return spark.read.parquet(path)


def read_through(spark: SparkSession, path: str, weeks: Sequence[tuple[int, int]], compute) -> DataFrame:
    """Stored rows of the weeks asked for; ``compute(weeks)`` supplies and stores those not there yet."""
    stored = read_or_none(spark, path)
    # one row per stored week
    have = set() if stored is None else {(r.year, r.week) for r in stored.select("year", "week").distinct().collect()}
    todo = [w for w in weeks if w not in have]
    if todo:
        write_weeks(compute(todo), path)
    return in_weeks(spark.read.parquet(path), weeks)
