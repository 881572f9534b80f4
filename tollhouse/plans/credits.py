"""Credits and refunds.

These cover Sunday to Saturday of the Sunday week that has the report week's number, while charges
are keyed by Monday weeks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.calendar import Week
from tollhouse.functions.measures import as_double, count_if, doubles, total
from tollhouse.functions.text import matches
from tollhouse.operators.accounts import to_payer, with_company
from tollhouse.operators.periods import in_days, one_row_per_week, sunday_weeks
from tollhouse.operators.ranking import top_k_and_rest
from tollhouse.plans.directory import payer_map
from tollhouse.plans.extracts import account_charges
from tollhouse.sources.tables import Tables

WEEK = ("year", "week")


def _largest_and_rest(df: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The ``k`` most negative amounts per group and a row for the rest."""
    order = [F.asc("billed_amount"), F.col("account_id"), F.col("company"), F.col("description")]
    rest = {"account_id": F.lit(""), "company": F.lit("other"), "description": F.lit("")}
    return top_k_and_rest(df, k, by, order, "billed_amount", rest)


def _amortised(t: Tables, weeks: Sequence[Week], product: str) -> DataFrame:
    """Fact rows of the product in the weeks' days, with amortised amounts."""
    days = F.broadcast(sunday_weeks(t.spark, weeks, "computation_date"))
    products = t.dim_products.where(F.col("product_code") == product)
    wanted = [d for w in weeks for d in calendar.sunday_week_days(w)]
    return (
        in_days(t.revenue_fact, "computation_date", wanted)
        .join(days, "computation_date")
        .join(products, "product_seq_id")
        .withColumn("credit", F.col("billed_amount") * F.col("amortization_factor"))
        .withColumn("refund", F.col("refund_amount") * F.col("amortization_factor"))
        .withColumnRenamed("charge_item_desc", "description")
    )


def _lines(t: Tables, weeks: Sequence[Week], product: str) -> DataFrame:
    """Amortised sums per day, description, account, period, credit and currency where one is negative."""
    keys = [
        "year", "week", "computation_date", "description", "account_seq_id", "charge_period_start_date",
        "charge_period_end_date", "product_code", "credit_id", "base_currency_code",
    ]
    sums = _amortised(t, weeks, product).groupBy(*keys).agg(F.sum("credit").alias("credits"), F.sum("refund").alias("refunds"))
    negative = sums.where((F.col("credits") < 0) | (F.col("refunds") < 0))
    return negative.join(t.dim_accounts.select("account_seq_id", "account_id"), "account_seq_id")


def credits_refunds(t: Tables, weeks: Sequence[Week], product: str, k: int = 20) -> DataFrame:
    """The largest credits and refunds per payer, company and description, and the rest of each.

    The company is the account's own, shown under its payer's id.
    """
    payers = payer_map(t)
    named = to_payer(with_company(_lines(t, weeks, product), payers), payers)
    named = named.where(F.col("company").isNotNull() & F.col("description").isNotNull())
    kinds = F.array(
        F.struct(F.lit("credit").alias("kind"), F.col("credits").alias("amount")),
        F.struct(F.lit("refund").alias("kind"), F.col("refunds").alias("amount")),
    )
    keys = ["year", "week", "kind", "account_id", "company", "description"]
    kept = named.select("*", F.inline(kinds)).where(F.col("amount") < 0)
    sums = kept.groupBy(*keys).agg(F.sum("amount").alias("billed_amount"))
    shown = _largest_and_rest(t.shared(sums), k, ["year", "week", "kind"])
    return doubles(shown, "billed_amount", scale=4)


def credits_legacy(t: Tables, weeks: Sequence[Week], k: int = 15) -> DataFrame:
    """Charge lines with a credit id per payer and description: the largest and the rest."""
    has_credit = F.col("credit_id").isNotNull() & F.col("charge_item_desc").isNotNull()
    payers = payer_map(t)
    paid = to_payer(account_charges(t, weeks, "charge_item_desc", where=has_credit), payers)
    sums = paid.groupBy("year", "week", "account_id", F.col("charge_item_desc").alias("description"))
    named = with_company(sums.agg(F.sum("billed_amount").alias("billed_amount")), payers)
    return doubles(_largest_and_rest(named, k, WEEK), "billed_amount")


def credit_totals(t: Tables, weeks: Sequence[Week], product: str) -> DataFrame:
    """Credits and refunds over the descriptions whose sum is negative."""
    by_text = _amortised(t, weeks, product).groupBy("year", "week", "description")
    sums = by_text.agg(F.sum("credit").alias("credits"), F.sum("refund").alias("refunds"))
    negative = sums.where((F.col("credits") < 0) | (F.col("refunds") < 0)).groupBy(*WEEK)
    return negative.agg(
        as_double(F.sum("credits"), 4).alias("credit_amount"), as_double(F.sum("refunds"), 4).alias("refund_amount")
    )


def credits_kpi(t: Tables, weeks: Sequence[Week], product: str) -> DataFrame:
    """Amounts and distinct payers of credits, refunds and enterprise discounts."""
    # How an enterprise discount describes itself.
    discount = matches(F.col("description"), "enterprise|Enterprise") & matches(F.col("description"), "discount|Discount")
    credit, refund = F.col("credits") < 0, F.col("refunds") < 0
    lines = to_payer(_lines(t, weeks, product), payer_map(t))
    payers = lines.groupBy("year", "week", "account_id").agg(
        total("credits", credit).alias("c"),
        total("refunds", refund).alias("r"),
        total("refunds", refund & discount).alias("d"),
    )
    sums = payers.groupBy(*WEEK).agg(
        as_double(F.sum("c"), 4).alias("credits_amount"),
        count_if(F.col("c") < 0).alias("credits_accounts"),
        as_double(F.sum("r"), 4).alias("refunds_amount"),
        count_if(F.col("r") < 0).alias("refunds_accounts"),
        as_double(F.sum("d"), 4).alias("edp_amount"),
        count_if(F.col("d") < 0).alias("edp_accounts"),
    )
    return one_row_per_week(sums, weeks)


def credits_history(t: Tables, last: Week, product: str, n: int = 10, history: DataFrame | None = None) -> DataFrame:
    """The same for the ``n`` weeks before ``last``, added to the history; a week that it holds stays as it is."""
    new = credits_kpi(t, calendar.span(calendar.shift(last, -1), n), product)
    if history is None:
        return new
    return history.unionByName(new.join(history.select(*WEEK).distinct(), list(WEEK), "left_anti"))
