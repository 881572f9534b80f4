"""In which weeks a key occurs, as bits of longs.

Weeks are numbered from 1970 on. A word holds 64 of them and the next word begins with the last one's last week, so of any
week and the week before it there is a word that holds both: what is new, gone or converted follows from shifts and masks
within one row, without a join of two weeks and without a window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.operators.periods import literal_rows

#: Weeks by which a word is further than the one before it: one less than it holds.
STEP = 63
_FIRST = dt.date(1970, 1, 6)


def week_number(week: Week) -> int:
    return (calendar.tuesday(week) - _FIRST).days // 7


def week_of(number: int) -> Week:
    return calendar.week_key(_FIRST + dt.timedelta(days=7 * number))


def _number(year: Column, week: Column) -> Column:
    return F.floor(F.datediff(calendar.week_tuesday(year, week), F.lit(_FIRST)) / 7).cast("long")


def presence(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, word, bits): the weeks (columns year and week) in which each key has a row; a null is a key's value like others.

    Weeks that the calendar gives another name, as week 0 where it is the year before's last one, have no bit.
    """
    day = calendar.week_tuesday(F.col("year"), F.col("week"))
    named = rows.where((F.year(day) == F.col("year")) & (calendar.monday_week(day) == F.col("week")))
    at = named.select(*keys, _number(F.col("year"), F.col("week")).alias("_n"))
    word, bit = F.floor(F.col("_n") / STEP).cast("long"), F.pmod(F.col("_n"), F.lit(STEP)).cast("int")
    place = F.struct(word.alias("word"), bit.alias("bit"))
    edge = F.struct((word - 1).alias("word"), F.lit(STEP).alias("bit"))
    places = at.select(*keys, F.inline(F.when(bit == 0, F.array(place, edge)).otherwise(F.array(place))))
    return united(places.select(*keys, "word", F.expr("shiftleft(1L, bit)").alias("bits")), keys)


def united(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and word."""
    return bitmaps.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def new_bits(bits: Column) -> Column:
    """Weeks with a bit whose week before has none. The first bit of a word says nothing: the word before has it too."""
    return bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1))).bitwiseAND(F.lit(-2).cast("long"))


def gone_bits(bits: Column) -> Column:
    """Weeks without a bit whose week before has one."""
    return F.bitwise_not(bits).bitwiseAND(F.shiftleft(bits, 1)).bitwiseAND(F.lit(-2).cast("long"))


def before_bits(bits: Column) -> Column:
    """Weeks whose week before has a bit."""
    return F.shiftleft(bits, 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def in_report_weeks(bitmaps: DataFrame, bits: Column, weeks: Iterable[Week]) -> DataFrame:
    """(year, week, other columns): a row for each bit of ``bits`` that is one of the report weeks.

    Each week is read from the word that holds the week before as well. The map has one row per report week; words
    without a wanted bit go before it is joined.
    """
    spark, kept = bitmaps.sparkSession, [c for c in bitmaps.columns if c not in ("word", "bits")]
    places = [(*divmod(week_number(w) - 1, STEP), *w) for w in sorted(set(weeks))]
    masks: dict[int, int] = {}
    for word, bit, *_ in places:
        masks[word] = masks.get(word, 0) | 1 << bit + 1
    types = {"word": pa.int64(), "_bit": pa.int32(), "year": pa.int32(), "week": pa.int32()}
    wanted = F.broadcast(literal_rows(spark, types, [(word, bit + 1, y, w) for word, bit, y, w in places]))
    mask = F.broadcast(literal_rows(spark, {"word": pa.int64(), "_mask": pa.int64()}, [(k, _signed(m)) for k, m in masks.items()]))
    hit = bitmaps.withColumn("_bits", bits).join(mask, "word").where("(_bits & _mask) <> 0")
    rows = hit.join(wanted, "word").where("(shiftrightunsigned(_bits, _bit) & 1) = 1")
    return rows.select("year", "week", *kept)


def first_and_last(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, first, last): numbers of the first and the last week of each key."""
    lowest = F.expr("bit_count((bits & -bits) - 1)")
    spread = "bits"
    for by in (1, 2, 4, 8, 16, 32):
        spread = f"({spread} | shiftrightunsigned({spread}, {by}))" if by == 1 else f"transform(array({spread}), x -> x | shiftrightunsigned(x, {by}))[0]"
    highest = F.expr(f"bit_count({spread}) - 1")
    at = F.col("word") * STEP
    return bitmaps.groupBy(*keys).agg(F.min(at + lowest).alias("first"), F.max(at + highest).alias("last"))


def week_columns(number: str, year: str, week: str) -> tuple[Column, Column]:
    """Year and week of a week's number."""
    day = F.date_add(F.lit(_FIRST), (F.col(number) * 7).cast("int"))
    return F.year(day).alias(year), calendar.monday_week(day).alias(week)
