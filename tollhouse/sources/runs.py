"""Runs that come in force as a whole.

Each output of a run is staged in a folder of its own. Once all are there, one file of the manifest puts them in force; it has
a row for every output and week of the run, with the number of rows, so that a week without rows is known to be done. Readers
go by the manifest: a run that died is never seen, and what was in force before it stays readable.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollhouse.functions.calendar import Week
from tollhouse.sources import sinks

MANIFEST = "sequence long, run_id string, output string, form string, fields string, year int, week int, row_count long"


class Run:
    """One run over ``weeks``: ``stage`` its outputs, then ``publish`` them."""

    def __init__(self, spark: SparkSession, path: str, weeks: Iterable[Week]):
        self.spark, self.path, self.weeks = spark, path, sorted(set(weeks))
        self.run_id = uuid.uuid4().hex
        self.staged: list[tuple] = []

    def folder(self, output: str) -> str:
        return f"{self.path}/{output}/run_id={self.run_id}"

    def stage(self, output: str, df: DataFrame, form: str, write: Callable[[DataFrame, str], None]) -> None:
        """Writes an output by ``write(df, folder)``, which makes a folder per (year, week), in a form that Spark reads."""
        if "run_id" in df.columns:
            raise ValueError(f"{output} has a column run_id, which names the run")
        folder = self.folder(output)
        write(df, folder)
        # a row per week; what was written is counted, not what was to be written
        back = self.spark.read.schema(df.schema).option("header", True).format(form).load(folder)
        counts = {(r["year"], r["week"]): r["n"] for r in back.groupBy("year", "week").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts.keys() <= set(self.weeks):
            raise ValueError(f"{output} has rows of weeks that are not of this run: {sorted(counts.keys() - set(self.weeks))}")
        self.staged += [(output, form, df.schema.json(), *w, counts.get(w, 0)) for w in self.weeks]

    def publish(self) -> None:
        """Puts all staged outputs in force. Of two runs that publish at once, readers agree on one for all their outputs."""
        known = _manifest(self.spark, self.path)
        last = None if known is None else known.agg(F.max("sequence")).first()[0]
        rows = [((last or 0) + 1, self.run_id, *row) for row in self.staged]
        # one file: it is there as a whole or not at all
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    if not sinks.exists(spark, f"{path}/manifest"):
        return None
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def in_force(spark: SparkSession, path: str, outputs: Sequence[str] | None = None) -> list[Row]:
    """The manifest's rows that hold: the latest run of each output and week. Their number is that of outputs times weeks."""
    rows = _manifest(spark, path)
    if rows is None:
        return []
    if outputs is not None:
        rows = rows.where(F.col("output").isin(*outputs))
    latest = F.max_by(F.struct(*rows.columns), F.struct("sequence", "run_id")).alias("row")
    return rows.groupBy("output", "year", "week").agg(latest).select("row.*").orderBy("output", "year", "week").collect()


def missing(spark: SparkSession, path: str, outputs: Sequence[str], weeks: Iterable[Week]) -> list[Week]:
    """Weeks that some of the outputs have not been published for."""
    have = {(r["output"], r["year"], r["week"]) for r in in_force(spark, path, outputs)}
    return [w for w in sorted(set(weeks)) if not all((o, *w) in have for o in outputs)]


def published(spark: SparkSession, path: str, output: str, weeks: Iterable[Week] | None = None) -> DataFrame | None:
    """The rows in force of an output, of all its weeks or of those asked for; None if no run has published it.

    Only folders of these runs and weeks are opened. The columns are those of the latest run.
    """
    rows = in_force(spark, path, [output])
    if not rows:
        return None
    latest = max(rows, key=lambda r: (r["sequence"], r["run_id"]))
    fields = T.StructType.fromJson(json.loads(latest["fields"]))
    wanted = None if weeks is None else set(weeks)
    folders = [
        f"{path}/{output}/run_id={r['run_id']}/year={r['year']}/week={r['week']}"
        for r in rows
        if r["row_count"] and (wanted is None or (r["year"], r["week"]) in wanted)
    ]
    if not folders:
        return spark.createDataFrame([], fields)
    reader = spark.read.schema(fields).option("header", True).option("basePath", f"{path}/{output}")
    return reader.format(latest["form"]).load(folders).select(*[f"`{n}`" for n in fields.names])


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Published runs of which nothing is in force any longer: their folders may go."""
    rows = _manifest(spark, path)
    if rows is None:
        return []
    alive = {r["run_id"] for r in in_force(spark, path)}
    return sorted(r["run_id"] for r in rows.select("run_id").distinct().collect() if r["run_id"] not in alive)


def read_through(
    spark: SparkSession, path: str, output: str, weeks: Iterable[Week], compute: Callable[[list[Week]], DataFrame]
) -> DataFrame:
    """Published rows of the weeks; ``compute(weeks)`` supplies those that are missing, which are published as a run.
    A week without rows is computed once as well."""
    weeks = sorted(set(weeks))
    todo = missing(spark, path, [output], weeks)
    if todo:
        run = Run(spark, path, todo)
        run.stage(output, compute(todo), "parquet", sinks.write_weeks)
        run.publish()
    return published(spark, path, output, weeks)
