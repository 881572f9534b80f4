"""Ranks and top-k lists that do not gather a whole week in one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A value is ranked inside a bucket, the bucket inside a block, the block inside the week. With two
# decimals a bucket has at most a million distinct values and a block a hundred thousand buckets.
BUCKET_WIDTH = 10_000
BUCKETS_PER_BLOCK = 100_000

#: Adds ranks to all rows: of (rows, value, by, name of the rank), as ``with_rank`` does.
Ranked = Callable[[DataFrame, str, Sequence[str], str], DataFrame]


def _above(by: Sequence[str], order: str) -> Column:
    """Rows ranked above, given one row per ``order`` with its row count ``_n``."""
    window = Window.partitionBy(*by).orderBy(F.desc_nulls_last(order))
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def rank_table(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """One row per distinct (by, value) with its descending rank; ties share the mean rank, NULL is last.

    Rows are first counted per distinct value, so no value is too frequent. Ranks are running counts
    over blocks, then over the buckets of a block, then over the values of a bucket: each window
    sees a bounded group, whatever the number of rows. Values must have two decimals at most; others are ranked by
    ``with_rank_by_ranges``.
    """
    by = list(by)
    bucket = F.floor(F.col(value).cast("double") / BUCKET_WIDTH)
    values = (
        df.groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", bucket)
        .withColumn("_block", F.floor(F.col("_bucket") / BUCKETS_PER_BLOCK))
    )
    buckets = values.groupBy(*by, "_block", "_bucket").agg(F.sum("_n").alias("_n"))
    blocks = buckets.groupBy(*by, "_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select(*by, "_block", _above(by, "_block").alias("_a2"))
    buckets = buckets.withColumn("_a1", _above([*by, "_block"], "_bucket")).drop("_n")
    values = values.withColumn("_a0", _above([*by, "_block", "_bucket"], value))

    v, b, k = values.alias("v"), buckets.alias("b"), blocks.alias("k")
    placed = (
        v.join(b, _same("v", "b", [*by, "_block", "_bucket"]))
        .join(k, _same("v", "k", [*by, "_block"]))
        .select(*[F.col(f"v.{c}") for c in [*by, value, "_n"]], "_a0", "_a1", "_a2")
    )
    rank = F.col("_a2") + F.col("_a1") + F.col("_a0") + 1 + (F.col("_n") - 1) / 2
    return placed.select(*by, value, "_n", rank.cast("double").alias("_rank"))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    cond = None
    for c in names:
        same = F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        cond = same if cond is None else cond & same
    return cond


def with_rank(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Add the mean rank of every row, joined on the value; a value that many rows share is an inner join's
    skewed key, which Spark splits."""
    by = list(by)
    joined = df.alias("d").join(rank_table(df, value, by).alias("r"), _same("d", "r", [*by, value]))
    return joined.select(*[F.col(f"d.{c}") for c in df.columns], F.col("_rank").alias(name))


def with_rank_by_ranges(df: DataFrame, value: str, by: Sequence[str], name: str, path: str) -> DataFrame:
    """Add the mean rank of every row, from one write of the rows in ranges of (group, value) to ``path``, which replaces what
    is there; ``df`` is computed once and not part of the result's plan.

    A row's place is its place in its range plus the rows of its group in the ranges before; ties share the mean of their
    first and last place, also where they fill several ranges, as rows of a frequent value are dealt by their other columns.
    NULL is last. Values may be of any type that can be sorted. Only the first rows and counts of each range and group
    are gathered: as many as there are ranges, plus groups.
    """
    by, spark = list(by), df.sparkSession
    order = [*map(F.col, by), F.desc_nulls_last(value)]
    dealt = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    placed = dealt.withColumn("_at", F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_range", F.shiftright("_at", 33))
    runs = rows.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # what to add to the number of a row in a range to have its place in its group
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    runs = runs.select(*by, "_range", shift.alias("_shift")).alias("s")
    ends = rows.groupBy(*by, "_range", value).agg(F.min("_at").alias("_from"), F.max("_at").alias("_to")).alias("e")
    ends = ends.join(F.broadcast(runs), _same("e", "s", [*by, "_range"])).select("e.*", "_shift")
    first, last = F.min(F.col("_from") + F.col("_shift")), F.max(F.col("_to") + F.col("_shift"))
    ranks = ends.groupBy(*by, value).agg(((first + last) / 2 + 1).cast("double").alias("_rank"))
    joined = rows.alias("d").join(ranks.alias("r"), _same("d", "r", [*by, value]))
    return joined.select(*[F.col(f"d.{c}") for c in df.columns], F.col("_rank").alias(name))


def rank_of(few: DataFrame, ranks: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Look up ranks for a bounded number of rows, such as a top-k list."""
    by = list(by)
    joined = ranks.alias("r").join(F.broadcast(few.alias("f")), _same("r", "f", [*by, value]))
    return joined.select(*[F.col(f"f.{c}") for c in few.columns], F.col("_rank").alias(name))


def ranks_among(few: DataFrame, df: DataFrame, values: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Adds to a bounded number of rows, such as a top-k list, their mean ranks among all rows of ``df``.

    ``values`` maps columns, of one type, to the names of their ranks. The rows' own values cut each group into a bounded
    number of intervals; the rows of ``df`` are counted per interval and value, all columns in one pass. Ties share the mean
    rank, NULL is last; values may have any number of decimals.
    """
    by, names = list(by), list(values)
    cuts = few.groupBy(*by).agg(*(F.sort_array(F.collect_set(v), asc=False).alias(f"_cuts_{v}") for v in names))
    placed = df.select(*by, *names).join(F.broadcast(cuts), by)

    def place(v: str) -> Column:
        x, edges = F.col(v), F.col(f"_cuts_{v}")
        above = F.when(x.isNull(), F.size(edges) + 1).otherwise(F.size(F.filter(edges, lambda e: e > x)))
        equal = x.isNull() | F.coalesce(F.array_contains(edges, x), F.lit(False))
        return F.struct(F.lit(v).alias("_of"), above.alias("_above"), equal.alias("_equal"), x.alias("_value"))

    at = placed.select(*by, F.inline(F.array(*map(place, names)))).groupBy(*by, "_of", "_above", "_equal")
    counts = at.agg(F.count(F.lit(1)).alias("_n"), F.max("_value").alias("_value"))  # at most two for each row of few
    # the rows between two cuts are above those at the lower one
    order = Window.partitionBy(*by, "_of").orderBy("_above", "_equal").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("_n").over(order), F.lit(0)) + (F.col("_n") + 1) / 2
    ranks = counts.withColumn("_rank", rank.cast("double")).where("_equal").select(*by, "_of", "_value", "_rank")
    asked = F.inline(F.array(*(F.struct(F.lit(v).alias("_of"), F.col(v).alias("_value")) for v in names)))
    a, r = few.select("*", asked).alias("a"), ranks.alias("r")
    found = a.join(F.broadcast(r), _same("a", "r", [*by, "_of", "_value"])).select("a.*", "_rank")
    mine = [F.max(F.when(F.col("_of") == v, F.col("_rank"))).alias(n) for v, n in values.items()]
    return found.groupBy(*few.columns).agg(*mine)


def top_k(df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column], position: str = "position") -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts every partition to ``k`` rows before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)


def top_k_and_rest(
    df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column], amount: str, rest: dict[str, Column]
) -> DataFrame:
    """The first ``k`` rows of each group and one row with the remainder of ``amount``."""
    by = list(by)
    top = top_k(df, k, by, order)
    totals = df.groupBy(*by).agg(F.sum(amount).alias("_total"))
    shown = top.groupBy(*by).agg(F.sum(amount).alias("_shown"))
    other = totals.join(shown, by).select(
        *by,
        *[c.alias(n) for n, c in rest.items()],
        (F.col("_total") - F.col("_shown")).alias(amount),
        F.lit(k + 1).alias("position"),
    )
    return top.unionByName(other)
