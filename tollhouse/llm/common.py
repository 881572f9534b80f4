"""What several operators of this package need: null-safe text, stored steps, ranks without one task."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Everything that separates words: space and the controls tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one is made only for a local session without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this package has written, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def handing_back(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives what it has freed back to the system when its task ends: workers live on
    from task to task, and what one keeps is lacking elsewhere on its machine."""

    def go(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return go


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared folder, with the lineage cut there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, kind: str = "zstd") -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder, read back: shorter than ``stored`` and read by columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", kind).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[str], within: list[str] = (), rank: str = "rank_no") -> DataFrame:
    """``df`` with the 0-based place of each row in the order of ``within`` and ``order``, counted anew in each group
    of ``within``. Rows are dealt by range, so a large group lies in many tasks.

    ``order`` must be total, or ties get places in any order. What is held in one place is one count for each range
    and group that meets it: at most the number of ranges, plus the number of groups.
    """
    keys = [*within, *order]
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    rows = stored(dealt.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    before = before.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_g_{c}") for c in within), "_first", "_before")
    on = [F.col("_part") == F.col("_p"), *(F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in within)]
    return (
        rows.join(F.broadcast(before), on, "left")
        .withColumn(rank, (F.col("_at") - F.col("_first") + F.col("_before")).cast("long"))
        .drop("_at", "_part", "_p", "_first", "_before", *(f"_g_{c}" for c in within))
    )
