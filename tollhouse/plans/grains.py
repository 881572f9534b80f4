"""The sums that a weekly report reads, at every grain it asks for, from one pass over the charges and one over the metering.

Each row is tagged with all the grains it feeds, and one hash aggregate sums them. Stored by grain and week, the sums take
the place of the charges and of the metering: each figure is computed from the coarsest grain that it can be computed from,
by the same report, and reads that grain's files of its weeks only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import usage_total
from tollhouse.operators.periods import earlier_weeks, in_weeks
from tollhouse.plans.directory import payer_map
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables

CHARGES, METERING = "weekly_charges", "weekly_metering"
KEYS = ("year", "week", "account_id", "is_internal_flag")
#: What rows can be told apart by beside their keys.
DIMENSIONS = {"usage_type": "string", "region": "string", "operation": "string", "is_credit": "boolean", "usage_resource": "string"}
#: Each grain's table, and the dimensions it keeps. Grains of the metering hold rows of instances only.
GRAINS: dict[str, tuple[str, tuple[str, ...]]] = {
    "charge_account": (CHARGES, ("operation", "is_credit")),
    "charge_type": (CHARGES, ("usage_type", "operation", "is_credit")),
    "charge_region": (CHARGES, ("region",)),
    "usage_resource": (METERING, ("usage_resource",)),
    "usage_type": (METERING, ("usage_type",)),
    "usage_region": (METERING, ("region",)),
}


def _tagged(rows: DataFrame, table: str) -> DataFrame:
    """A row for each grain that a row of the table feeds; dimensions that a grain does not keep are NULL."""
    tags = []
    for grain, (of, kept) in GRAINS.items():
        if of == table:
            values = [(F.col(d) if d in kept else F.lit(None).cast(kind)).alias(d) for d, kind in DIMENSIONS.items()]
            tags.append(F.struct(F.lit(grain).alias("grain"), *values))
    return rows.select(*KEYS, "billed_amount", "usage_value", F.inline(F.array(*tags)))


def _grain(rows: DataFrame, grain: str) -> DataFrame:
    """The sums at one grain: as those of tagged rows, but no row is repeated, and keys hold only what the grain keeps."""
    of, kept = GRAINS[grain]
    grouped = rows.groupBy(*KEYS, *kept)
    if of == CHARGES:
        sums = grouped.agg(F.sum("billed_amount").alias("billed_amount")).withColumn("usage_value", F.lit(None).cast("double"))
    else:
        amount = F.lit(None).cast(rows.schema["billed_amount"].dataType)
        sums = grouped.agg(usage_total().alias("usage_value")).withColumn("billed_amount", amount)
    dimensions = [(F.col(d) if d in kept else F.lit(None).cast(kind)).alias(d) for d, kind in DIMENSIONS.items()]
    return sums.select(F.lit(grain).alias("grain"), *KEYS, *dimensions, "billed_amount", "usage_value")


def grain_sums(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Billed amounts and usage of the weeks, and of those before them, at all grains.

    Sums of which all parts are NULL are NULL; a key whose rows have no amount at all still has its row. Rows without an
    account, flag or dimension are summed under NULL, as the tables hold them. ``sharing`` tables are read once and summed
    grain by grain: where most rows have keys of their own, an aggregate of all grains at once outgrows a task's memory.
    """
    wanted = earlier_weeks(weeks, (0, 1))
    amount = t.weekly_charges.schema["billed_amount"].dataType
    charges = in_weeks(t.weekly_charges, wanted).select(
        *KEYS, "usage_type", "region", "operation", F.col("credit_id").isNotNull().alias("is_credit"),
        "billed_amount", F.lit(None).cast("double").alias("usage_value"),
    )
    metering = in_weeks(t.weekly_metering, wanted).where(F.col("usage_type").contains(profile.instance_token))
    metering = metering.withColumn("billed_amount", F.lit(None).cast(amount))
    if t.keeps:
        rows = {CHARGES: t.shared(charges), METERING: t.shared(metering)}
        return reduce(DataFrame.unionByName, [_grain(rows[of], grain) for grain, (of, _) in GRAINS.items()])
    rows = _tagged(charges, CHARGES).unionByName(_tagged(metering, METERING))
    return rows.groupBy("grain", *KEYS, *DIMENSIONS).agg(F.sum("billed_amount").alias("billed_amount"), usage_total().alias("usage_value"))


def store_grains(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, path: str) -> DataFrame:
    """``grain_sums`` written under ``path`` by grain and week, and read back. What was there before is replaced."""
    sums = grain_sums(t, weeks, profile)
    sums.write.mode("overwrite").partitionBy("grain", "year", "week").parquet(path)
    return t.spark.read.schema(sums.schema).parquet(path)


def at_grain(t: Tables, sums: DataFrame, profile: ServiceProfile, charges: str, usage: str | None = None) -> Tables:
    """The tables with charges, and metering where a grain of it is named, at these grains.

    Without ``usage`` there is no metering: a report that needs it finds no rows.
    """
    paid = sums.where(F.col("grain") == charges).withColumn("credit_id", F.when(F.col("is_credit"), "credit"))
    used = sums.where(F.col("grain") == usage)
    if usage is not None and "usage_type" not in GRAINS[usage][1]:
        used = used.withColumn("usage_type", F.lit(profile.instance_token))  # these are instances, of whichever type
    # the directory is one of all metered accounts, not of those of a grain
    return t.replace(weekly_charges=paid, weekly_metering=used, payer_map=payer_map(t))
