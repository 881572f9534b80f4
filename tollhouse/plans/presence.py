"""Who and what was there in which weeks: joined, left and converted accounts, new resources, lifetimes.

Each table of bitmaps comes from the metering or, if the tables hold a stored copy (``store_presence``), from that, so that
a week's run reads that week of the metering only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import external
from tollhouse.operators.accounts import with_company, without
from tollhouse.operators.bitmaps import before_bits, first_and_last, gone_bits, in_report_weeks, new_bits, presence, united, week_columns
from tollhouse.operators.periods import earlier_weeks, in_weeks
from tollhouse.plans.directory import payer_map
from tollhouse.plans.extracts import weekly_metering
from tollhouse.profiles import ServiceProfile
from tollhouse.sources import sinks
from tollhouse.sources.tables import Tables

ACCOUNT = ("account_id", "is_internal_flag")
OWNED = ("account_id", "region", "usage_resource")
RESOURCE = ("usage_resource",)


def _metered_resources(t: Tables, rows: DataFrame, profile: ServiceProfile) -> DataFrame:
    """The rows that ``weekly_metering`` keeps."""
    if profile.metering_instances_only:
        rows = rows.where(F.col("usage_type").contains(profile.instance_token))
    return without(rows, t.test_accounts)


#: Tables of bitmaps: their keys, and the rows of the metering they are of.
KINDS: dict[str, tuple[tuple[str, ...], Callable[[Tables, DataFrame, ServiceProfile], DataFrame]]] = {
    "presence_accounts": (ACCOUNT, lambda t, rows, p: rows),
    "presence_owned": (OWNED, lambda t, rows, p: rows.where(external())),
    "presence_resources": (RESOURCE, _metered_resources),
}


def _bitmaps(t: Tables, kind: str, profile: ServiceProfile, weeks: Sequence[Week] | None) -> DataFrame:
    """The stored bitmaps, else those of these weeks (all, if none are given)."""
    if kind in t:
        return t[kind]
    keys, rows = KINDS[kind]
    metering = t.weekly_metering if weeks is None else in_weeks(t.weekly_metering, weeks)
    return presence(rows(t, metering, profile), keys)


def _commit(t: Tables, place: str, version: int, weeks: Sequence[Week]) -> None:
    """One file with the weeks that a version holds puts it in force."""
    listed = t.spark.createDataFrame([(version, *w) for w in weeks], "version long, year int, week int")
    listed.coalesce(1).write.mode("append").parquet(f"{place}/weeks")


def store_presence(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, path: str) -> Tables:
    """Adds the weeks that the bitmaps under ``path`` lack, reading the metering of these only, and returns the tables with
    the bitmaps.

    The bitmaps are written anew beside the old ones; then one row set, in one commit, says which weeks they hold. A run
    that ends before that leaves the old bitmaps in force, and is simply started again. Weeks without any metering are
    known too, and not computed twice.
    """
    spark, stored = t.spark, {}
    for kind, (keys, rows) in KINDS.items():
        place = f"{path}/{kind}"
        known = sinks.read_or_none(spark, f"{place}/weeks")
        held = [] if known is None else known.collect()  # a row for each week and version
        version = max((r["version"] for r in held), default=0)
        have = {(r["year"], r["week"]) for r in held if r["version"] == version}
        todo = [w for w in sorted(set(weeks)) if w not in have]
        if todo:
            more = presence(rows(t, in_weeks(t.weekly_metering, todo), profile), keys)
            if version:
                more = united(spark.read.parquet(f"{place}/version={version}").unionByName(more), keys)
            more.write.mode("overwrite").parquet(f"{place}/version={version + 1}")
            version += 1
            _commit(t, place, version, sorted(have | set(todo)))
        stored[kind] = spark.read.parquet(f"{place}/version={version}")
    return t.replace(**stored)


def joined_accounts(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Accounts, with their flag, that are metered in the week and were not the week before."""
    bitmaps = _bitmaps(t, "presence_accounts", profile, earlier_weeks(weeks, (0, 1)))
    return in_report_weeks(bitmaps, new_bits(F.col("bits")), weeks)


def left_accounts(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Accounts that were metered the week before and are not in the week."""
    bitmaps = _bitmaps(t, "presence_accounts", profile, earlier_weeks(weeks, (0, 1)))
    return in_report_weeks(bitmaps, gone_bits(F.col("bits")), weeks)


def converted_accounts(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Accounts on the free list the week before that are still metered, and no longer on it."""
    wanted = earlier_weeks(weeks, (0, 1))
    metered = _bitmaps(t, "presence_accounts", profile, wanted)
    free = presence(in_weeks(t.free_tier, wanted), ACCOUNT).withColumnRenamed("bits", "free")
    both = metered.join(free, [*ACCOUNT, "word"])
    return in_report_weeks(both, F.col("bits").bitwiseAND(gone_bits(F.col("free"))), weeks).drop("free")


def account_lifetimes(t: Tables, profile: ServiceProfile) -> DataFrame:
    """First and last week of each account, and in how many weeks it was metered."""
    bitmaps = _bitmaps(t, "presence_accounts", profile, None)
    ends = first_and_last(bitmaps, ACCOUNT)
    # a word's first bit is the last one of the word before
    n = bitmaps.groupBy(*ACCOUNT).agg(F.sum(F.bit_count(F.shiftrightunsigned("bits", 1))).alias("weeks"))
    lives = ends.join(n, list(ACCOUNT))
    return lives.select(*ACCOUNT, *week_columns("first", "first_year", "first_week"), *week_columns("last", "last_year", "last_week"), F.col("weeks").cast("long").alias("weeks"))


def new_domains(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Metering rows of resources that were not metered the week before; with stored bitmaps, only the metering of ``weeks``
    is read. Rows without a resource are new if there were no such rows before."""
    bitmaps = _bitmaps(t, "presence_resources", profile, earlier_weeks(weeks, (0, 1)))
    new = in_report_weeks(bitmaps, new_bits(F.col("bits")), weeks).alias("b")
    now = weekly_metering(t, weeks, profile).alias("n")
    same = (F.col("n.year") == F.col("b.year")) & (F.col("n.week") == F.col("b.week")) & F.col("n.usage_resource").eqNullSafe(F.col("b.usage_resource"))
    return now.join(new, same, "left_semi")


def domain_diff(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """External resources per company and region, this week against last."""
    bitmaps = _bitmaps(t, "presence_owned", profile, earlier_weeks(weeks, (0, 1)))
    sides = []
    for name, bits in (("d1", before_bits(F.col("bits"))), ("d2", F.col("bits"))):
        side = in_report_weeks(bitmaps, bits, weeks).groupBy("year", "week", "account_id", "region")
        sides.append(side.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(name)))
    both = sides[0].unionByName(sides[1]).groupBy("year", "week", "account_id", "region")
    sums = both.agg(*(F.coalesce(F.sum(F.when(F.col("side") == d, F.col("n"))), F.lit(0)).alias(d) for d in ("d1", "d2")))
    named = with_company(sums, payer_map(t)).where(F.col("company").isNotNull() & F.col("region").isNotNull())
    return named.groupBy("year", "week", "company", "region").agg(F.sum(F.col("d2") - F.col("d1")).alias("diff"), F.sum("d1").alias("d1"), F.sum("d2").alias("d2"))


def customer_diff(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """New less lost external accounts per payer company."""
    new = joined_accounts(t, weeks, profile).where(external()).select("year", "week", "account_id", F.lit(1).alias("n"))
    lost = left_accounts(t, weeks, profile).where(external()).select("year", "week", "account_id", F.lit(-1).alias("n"))
    payers = payer_map(t)
    own = payers.select("account_id", F.coalesce("payer_account_id", "account_id").alias("payer"))
    changes = new.union(lost).join(own, "account_id").groupBy("year", "week", F.col("payer").alias("account_id"))
    named = with_company(changes.agg(F.sum("n").alias("diff")), payers).where(F.col("company").isNotNull())
    return named.groupBy("year", "week", "company").agg(F.sum("diff").alias("diff"))
