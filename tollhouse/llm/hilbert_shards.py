"""Sharding along a Hilbert curve: several metadata dimensions are quantised, rows sorted by their place on the curve
through the grid, and the sorted run cut into shards, so that a shard spans a small box in every dimension."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import ranked, stored, text_or_empty

#: Grid cells in each dimension: 2 ** GRID_BITS.
GRID_BITS = 6
#: Distinct values of a dimension up to which their cells are broadcast; beyond, they are joined by shuffling.
BROADCAST_VALUES = 100_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n rows, d dimensions of ``bits`` bits; d * bits < 64).

    Gray-code form: undo the rotations from the highest bit down, Gray-encode, then interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << 1 | (x[i] >> level & 1)
    return out


def with_places(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the string column ``name`` replaced by its place among all distinct values in bytewise order, null first."""
    values = stored(rows.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).select(name))
    places = ranked(values, [name], rank="_place").select(F.col(name).alias("_value"), "_place")
    places = F.broadcast(places) if values.count() <= BROADCAST_VALUES else places
    return rows.join(places, F.col(name).eqNullSafe(F.col("_value"))).drop("_value", name).withColumnRenamed("_place", name)


def curve_place(codes: DataFrame, dims: list[str], bits: int = GRID_BITS) -> DataFrame:
    """``codes`` with ``curve`` long: each dimension is cut at its quantiles over all rows into at most 2 ** bits
    cells. Only the cut points, at most 2 ** bits for each dimension, pass the driver."""
    if len(dims) * bits > 62:
        raise ValueError("dimensions times bits must stay below 63")
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = codes.agg(*(F.percentile_approx(c, steps, 10_000).alias(c) for c in dims)).first()
    edges = [np.unique(np.array(cuts[c] or [], np.int64)) for c in dims]

    @F.pandas_udf("long")
    def place(*columns: pd.Series) -> pd.Series:
        cells = np.stack([np.searchsorted(e, c.to_numpy(), side="left") for e, c in zip(edges, columns)], axis=1)
        return pd.Series(hilbert_index(cells, bits))

    return codes.withColumn("curve", place(*dims))


def shards(docs: DataFrame, n: int = 8, dims: tuple[str, ...] = ("lang", "source"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, size long (UTF-8 bytes of the text plus 1), text_crc32 long, curve long,
    shard int, slot long (gapless from 0 in each shard). Shards' row counts are at most one apart.

    Dimensions are the given string columns and the size. Equal texts of one cell lie side by side. Null text counts as
    empty, a null in a dimension comes before all values, a null id before all ids. Rows that agree in everything get
    neighbouring places. An empty table gives an empty one.
    """
    text = text_or_empty(text_col)
    names = [f"_d{i}" for i in range(len(dims))]
    codes = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        *(F.col(c).cast("string").alias(x) for c, x in zip(dims, names)),
    )
    for x in names:
        codes = with_places(codes, x)
    placed = curve_place(codes, [*names, "size"]).drop(*names)
    rows = ranked(placed, ["curve", "text_crc32", id_col], rank="_rank")
    small, more = divmod(rows.count(), n)  # the first `more` shards hold one row more
    edge = more * (small + 1)
    shard = F.expr(f"if(_rank < {edge}, _rank div {small + 1}, {more} + (_rank - {edge}) div {max(small, 1)})")
    rows = rows.withColumn("shard", shard.cast("int"))
    first = F.col("shard") * small + F.least(F.col("shard"), F.lit(more))
    return rows.withColumn("slot", (F.col("_rank") - first).cast("long")).select(id_col, "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, n: int = 8, dims: tuple[str, ...] = ("lang", "source"), id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes all columns of ``docs`` as Parquet, a folder for each shard, rows in the order of the curve, so that
    the files' column statistics prune in every dimension. Ids must be unique and not null. The folders are called ``shard``,
    or ``shard_`` (with as many marks as it takes) where ``docs`` has a column of that name."""
    plan = shards(docs, n, dims, id_col, text_col).select(F.col(id_col).alias("id"), "shard", "slot")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.join(plan, F.col("row").getField(id_col).cast("long") == F.col("id"))
    folder, taken = "shard", {c.lower() for c in docs.columns}
    while folder in taken:
        folder += "_"
    rows = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
