"""The weekly report: all metrics of a week, their history, and every list, in one run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import usage_total
from tollhouse.plans import cost, credits, customers, directory, domains, grains, revenue
from tollhouse.profiles import ServiceProfile
from tollhouse.operators.accounts import by_account
from tollhouse.operators.periods import earlier_weeks, in_weeks
from tollhouse.operators.ranking import Ranked, with_rank, with_rank_by_ranges
from tollhouse.sources import runs, sinks
from tollhouse.sources.tables import Tables

KEYS = ["year", "week", "metric"]
#: The tables that are compacted.
INPUTS = ("weekly_charges", "weekly_metering", "payer_map")


def compacted(t: Tables, weeks: Sequence[Week]) -> Tables:
    """The tables a report over ``weeks`` reads again and again, summed as far as the report allows.

    One pass over the charges and one over the metering. Amounts and usage per account, resource, usage type and region are all the weekly reports need.
    """
    wanted = earlier_weeks(weeks, range(4))
    charges = in_weeks(t.weekly_charges, wanted).groupBy(
        "year", "week", "account_id", "is_internal_flag", "usage_type", "region", "operation", F.col("credit_id").isNotNull().alias("is_credit")
    )
    # the reports only ask whether there is a credit; max() of a text would turn this into a sort
    credit = F.when(F.col("is_credit"), "credit").alias("credit_id")
    amounts = charges.agg(F.sum("billed_amount").alias("billed_amount")).select("*", credit).drop("is_credit")
    metering = in_weeks(t.weekly_metering, wanted).groupBy(
        "year", "week", "account_id", "is_internal_flag", "usage_resource", "usage_type", "region", "operation"
    )
    usage = metering.agg(usage_total().alias("usage_value"))
    return t.replace(weekly_charges=amounts, weekly_metering=usage, payer_map=directory.payer_map(t))


def kept_inputs(t: Tables, weeks: Sequence[Week]) -> Tables:
    """The tables for a report that only plans (see ``Tables.shared``): charges, metering and payers lie together by account.

    Sums per account and joins on it then exchange nothing; nor do tables that come by account already. The rows are not
    summed as in ``compacted``: where most have a key of their own that is a second copy of them, and each part sums what it asks for.
    """
    t = t.sharing()
    wanted = earlier_weeks(weeks, range(4))
    facts = {name: by_account(in_weeks(t[name], wanted)) for name in ("weekly_charges", "weekly_metering")}
    payers = t.shared(by_account(directory.payer_map(t)), placed=True)
    return t.replace(**facts, payer_map=payers, active_date=t.shared(t.active_date))


def stored_inputs(t: Tables, weeks: Sequence[Week], path: str) -> Tables:
    """``compacted`` tables written under ``path`` and read back; a run started again replaces them."""
    compact = compacted(t, weeks)
    kept = {}
    for name in INPUTS:
        frame = compact[name]
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
        kept[name] = t.spark.read.schema(frame.schema).parquet(f"{path}/{name}")
    return t.replace(**kept)


def _tall(df: DataFrame) -> DataFrame:
    """One-row-per-week measures as rows."""
    names = [c for c in df.columns if c not in ("year", "week")]
    numbers = df.select("year", "week", *[F.col(n).cast("double").alias(n) for n in names])
    return numbers.unpivot(["year", "week"], names, "metric", "value").withColumn("text", F.lit(None).cast("string"))


def _named(df: DataFrame, name, value: str, text: str | None = None) -> DataFrame:
    """Rows whose metric name depends on the data."""
    label = F.col(text) if text else F.lit(None).cast("string")
    return df.select("year", "week", name.alias("metric"), F.col(value).cast("double").alias("value"), label.alias("text"))


def _suffixed(key: str, suffix: str):
    return F.concat(F.col(key), F.lit(suffix))


def _positions(df: DataFrame, prefix: str) -> DataFrame:
    name = F.concat(F.lit(f"{prefix}_"), F.col("position"))
    return _named(df, name, "billed_amount", "label")


def weekly_metrics(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, sums: DataFrame | None = None) -> DataFrame:
    """Every metric of every week as (year, week, metric, value, text).

    With ``sums`` (see ``grains``) neither charges nor metering are read, but the sums at the grain of each metric.
    """

    def at(charges: str, usage: str | None = None) -> Tables:
        return t if sums is None else grains.at_grain(t, sums, profile, charges, usage)

    accounts, types = at("charge_account"), at("charge_type", "usage_type")
    if profile.domains_per_account:
        counts = customers.customer_counts_trial(accounts, weeks, profile)
    else:
        counts = customers.customer_counts(accounts, weeks, profile)
    by_region = at("charge_account", "usage_region")
    parts = [
        _tall(domains.domain_counts(at("charge_account", "usage_resource"), weeks, profile)),
        _tall(counts),
        _tall(revenue.revenue_metrics(types, weeks, profile)),
        _tall(revenue.size_bands(accounts, weeks)),
        _positions(revenue.top_external(accounts, weeks), "top_external_customer"),
        _positions(revenue.top_internal(accounts, weeks), "top_internal_customer"),
        _named(domains.instance_hours(at("charge_account", "usage_type"), weeks, profile), _suffixed("instance_type", "_hours"), "hours"),
        _named(domains.instance_revenue(types, weeks, profile), _suffixed("instance_type", "_revenue"), "revenue"),
        _named(domains.region_customers(by_region, weeks, profile), _suffixed("region", "_customer_count"), "customer_count"),
        _named(domains.region_revenue(at("charge_region"), weeks), _suffixed("region", "_revenue"), "revenue"),
        _tall(customers.compute_adoption(accounts, weeks)),
        _tall(cost.cost_margin(accounts, weeks, profile)),
    ]
    return reduce(DataFrame.unionByName, parts)


def weekly_metrics_history(
    t: Tables, last: Week, profile: ServiceProfile, n: int, history: DataFrame | None = None
) -> DataFrame:
    """The metrics of the ``n`` weeks ending with ``last``; weeks the history holds are not computed again."""
    wanted = calendar.span(last, n)
    if history is None:
        return weekly_metrics(t, wanted, profile)
    have = {(r.year, r.week) for r in history.select("year", "week").distinct().collect()}
    todo = [w for w in wanted if w not in have]
    return history.unionByName(weekly_metrics(t, todo, profile)) if todo else history


def weeks_side_by_side(metrics: DataFrame, weeks: Sequence[Week]) -> DataFrame:
    """Metrics as rows, weeks as columns."""
    labels = [f"w{y}_{w:02d}" for y, w in weeks]
    labelled = metrics.withColumn("label", F.format_string("w%d_%02d", "year", "week"))
    return labelled.groupBy("metric").pivot("label", labels).agg(F.max("value"))


def lists(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, ranks_path: str | None = None) -> dict[str, DataFrame]:
    """The lists of a run, by name. With ``ranks_path`` rows to be ranked are written there, each list's once."""

    def ranked(name: str) -> Ranked:
        return with_rank if ranks_path is None else partial(with_rank_by_ranges, path=f"{ranks_path}/{name}")

    return {
        "gainer_loser": revenue.gainers_losers(t, weeks, profile),
        "top_customers": revenue.top_customers(t, weeks, profile),
        "credits": credits.credits_refunds(t, weeks, profile.product_code),
        "new_customers": revenue.new_customers(t, weeks, profile, ranked("new_customers")),
        "dropped_customers": revenue.dropped_customers(t, weeks, ranked("dropped_customers")),
        "customer_list": revenue.customer_list(t, weeks),
    }


#: The order of the rows in a list's files; falling where there is a minus.
ORDER = {
    "gainer_loser": ("section", "position"),
    "top_customers": ("position",),
    "credits": ("kind", "position", "account_id"),
    "new_customers": ("rank", "account_id"),
    "dropped_customers": ("rank", "account_id"),
    "customer_list": ("-billed_amount", "account_id", "is_internal_flag"),
}


def report_manifest(t: Tables, weeks: Sequence[Week], profile: ServiceProfile) -> DataFrame:
    """Rows each output of a run has."""
    outputs = lists(t, weeks, profile) | {
        "top_by_region": revenue.top_by_region(t, weeks, profile),
        "weekly_metrics": weekly_metrics(t, weeks, profile),
        "compute_adoption": customers.compute_adoption(t, weeks),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("output"), "row_count") for name, df in outputs.items()]
    return reduce(DataFrame.union, counts)


def _write_outputs(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, inputs_path: str, write) -> None:
    """Computes the outputs of a run one after another and hands each to ``write`` as (name, rows, kind)."""
    inputs = stored_inputs(t, weeks, inputs_path)
    sums = grains.store_grains(inputs, weeks, profile, f"{inputs_path}/grains")
    for name, df in lists(inputs, weeks, profile, f"{inputs_path}/ranks").items():
        write(name, df, "list")
    write("top_by_region", revenue.top_by_region(inputs, weeks, profile), "by_region")
    write("weekly_metrics", weekly_metrics(inputs, weeks, profile, sums), "history")
    accounts = grains.at_grain(inputs, sums, profile, "charge_account")
    write("compute_adoption", customers.compute_adoption(accounts, weeks), "history")


def _order(name: str) -> list:
    return [F.desc_nulls_last(c[1:]) if c[0] == "-" else F.col(c) for c in ORDER[name]]


#: Outputs of a run.
OUTPUTS = [*ORDER, "top_by_region", "weekly_metrics", "compute_adoption"]


def report_run(t: Tables, weeks: Sequence[Week], profile: ServiceProfile, path: str, as_of: dt.date | None = None) -> list[str]:
    """Write every output of the weeks under ``path``: lists as CSV by week, accounts by region and flag, and the metrics
    and the adoption counts added to their histories.

    Running a week again replaces its lists and leaves its history as it is, so a run that was interrupted is simply
    started again. With ``as_of`` given, weeks more than 500 days away from it are refused. ``committed_run`` puts all
    outputs in force together.
    """
    if as_of is not None:
        calendar.check_near([calendar.tuesday(w) for w in weeks], as_of, 500)

    def write(name: str, df: DataFrame, kind: str) -> None:
        if kind == "list":
            sinks.write_ordered_lists(df, f"{path}/{name}", _order(name))
        elif kind == "by_region":
            sinks.write_by_region(df, f"{path}/{name}")
        else:
            sinks.append_history(df, f"{path}/{name}")

    _write_outputs(t, weeks, profile, f"{path}/inputs", write)
    return [f"{path}/{name}" for name in OUTPUTS]


def committed_run(
    t: Tables, weeks: Sequence[Week], profile: ServiceProfile, path: str, as_of: dt.date | None = None, again: bool = False
) -> list[Week]:
    """The outputs of ``report_run``, put in force together; gives the weeks that were computed.

    Weeks that have all their outputs, be it without rows, are not computed twice, unless ``again`` asks for it. A run that
    dies leaves what was in force before; ``runs.published(spark, path, name, weeks)`` reads an output.
    """
    if as_of is not None:
        calendar.check_near([calendar.tuesday(w) for w in weeks], as_of, 500)
    todo = sorted(set(weeks)) if again else runs.missing(t.spark, path, OUTPUTS, weeks)
    if not todo:
        return []
    run = runs.Run(t.spark, path, todo)

    def write(name: str, df: DataFrame, kind: str) -> None:
        if kind == "list":
            run.stage(name, df, "csv", lambda rows, place: sinks.write_ordered_lists(rows, place, _order(name)))
        elif kind == "by_region":
            run.stage(name, df, "csv", sinks.write_by_region)
        else:
            run.stage(name, df, "parquet", sinks.write_weeks)

    _write_outputs(t, todo, profile, run.folder("inputs"), write)
    run.publish()
    return todo
