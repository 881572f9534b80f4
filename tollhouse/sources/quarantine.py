"""Reading text files whose rows may be broken: good rows, and the others with their file.

A row with too few or too many fields, or with a value that is not of its column's type, neither stops the job nor turns into
a NULL that nobody sees: it goes, as it stands, to the second result, which is written aside and counted by file. Records are
lines: a quoted field does not go over several.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BAD = "_corrupt"


@dataclass(frozen=True)
class Checked:
    """``rows`` of the schema, and ``bad``: (file, record)."""

    rows: DataFrame
    bad: DataFrame


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    return lines.where(F.trim("record") != "")


def _split(lines: DataFrame, parsed: Column, required: Column | None, file_col: str | None = None) -> Checked:
    both = lines.withColumn("_row", parsed)
    wrong = F.col(f"_row.{_BAD}").isNotNull()
    if required is not None:
        wrong = wrong | ~F.coalesce(required, F.lit(False))
    more = [] if file_col is None else [F.col("file").alias(file_col)]
    good = both.where(~wrong).select("_row.*", *more).drop(_BAD)
    return Checked(good, both.where(wrong).select("file", "record"))


def _there(names: Sequence[str]) -> Column:
    """All of these fields are there and not empty."""
    filled = [F.coalesce(F.trim(F.col(f"_row.`{n}`").cast("string")) != "", F.lit(False)) for n in names]
    return reduce(Column.__and__, filled, F.lit(True))


def checked_csv(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True, required: Sequence[str] = (), file_col: str | None = None
) -> Checked:
    """Delimited lines; with ``header``, lines that are the columns' names are left out (each file may begin with one). A row
    without one of the ``required`` fields is bad too; ``file_col`` adds each good row's file."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    lines = _lines(spark, path)
    if header:
        lines = lines.where(F.regexp_replace("record", '["\\r]', "") != sep.join(names))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    # the parser takes a row with too many fields as it is: it is known by its separators outside quotes
    fields = F.size(F.split(F.regexp_replace("record", '"([^"]|"")*"', ""), f"\\Q{sep}\\E", -1))
    return _split(lines, F.from_csv("record", f"{schema}, {_BAD} string", options), (fields == len(names)) & _there(required), file_col)


def checked_json(spark: SparkSession, path: str, schema: str, required: Sequence[str] = ()) -> Checked:
    """A JSON object on each line; a row without one of the ``required`` fields is bad too."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return _split(_lines(spark, path), F.from_json("record", f"{schema}, {_BAD} string", options), _there(required))


def set_aside(bad: DataFrame, path: str) -> DataFrame:
    """Writes bad records as a table under ``path``, added to those there, and returns how many each file has there."""
    bad.write.mode("append").parquet(path)
    return bad.sparkSession.read.parquet(path).groupBy("file").agg(F.count(F.lit(1)).alias("records"))
