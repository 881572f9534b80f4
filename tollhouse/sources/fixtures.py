"""The logical tables, derived from the TPC-H-like star schema and the event table.

Every line item becomes a metered and billed usage record and every event a metered one that is not
billed; dates are folded into ten weeks across a year boundary. Remainders of keys below assign attributes
(who pays, which usage type, which list an account or a resource is on). Lists, such as that of the
exposed resources, hold a part of the accounts or resources; charges and metering hold every row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.functions import calendar
from tollhouse.functions.text import account_id
from tollhouse.operators.periods import literal_rows
from tollhouse import profiles
from tollhouse.profiles import ServiceProfile
from tollhouse.operators.accounts import by_account
from tollhouse.sources.tables import Tables, keep

# Given, so that opening a table starts no job to infer them.
SOURCE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# the labs and resellers among the customers below
SERVICE_A = replace(profiles.SERVICE_A, lab_pattern="TrainLab", reseller_pattern="MSP")
SERVICE_B = replace(profiles.SERVICE_B, lab_pattern="TrainLab", reseller_pattern="MSP")

FIRST_DAY = dt.date(1995, 12, 18)
LAST_DAY = dt.date(1996, 2, 25)
DAYS = calendar.day_range(FIRST_DAY, LAST_DAY)
LAST_WEEK = (1996, 8)
WEEKS = calendar.span(LAST_WEEK, 10)
MONTHS = [(1995, 12), (1996, 1), (1996, 2)]
AS_OF = dt.date(2001, 8, 15)

REGION_PREFIXES = ["", "USW2-", "EU-", "APN1-", "SAE1-"]
REGION_CODES = ["IAD", "PDX", "DUB", "NRT", "GRU"]
USAGE_TYPES = {
    "A": [
        "ESInstance:m3.medium",
        "ESInstance:m3.large",
        "ESInstance:r3.large",
        "ES:GP2-Storage",
        "DataTransfer-Out-Bytes",
        "ESInstance:t2.micro",
        "ESInstance:t2.small",
    ],
    "B": [
        "SearchInstance:m3.medium",
        "SearchInstance:m3.large",
        "SearchInstance:r3.large",
        "DocumentBatchUpload",
        "DataTransfer-Out-Bytes",
        "IndexDocuments",
        "SearchInstance",
    ],
}
UNIT_PRICES = ["0.0940", "0.1880", "0.2240", "0.1350", "0.0900", "0.0180", "0.0360"]
OFFERINGS = ["607996", "607997", "615324", "615325", "729920"]
PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
INTERNAL = "c_mktsegment = 'MACHINERY'"
FLAG = "CASE WHEN is_internal THEN 'Y' ELSE 'N' END"
ACCOUNT = "lpad(CAST(o_custkey AS STRING), 12, '0')"
# multiples of all the numbers that part and supplier keys are divided by below
PART_CLASSES = 2 * 7 * 23 * 25
SUPPLIER_CLASSES = 9 * 10
# what a line item is or is not
MARKS = {
    "is_free": "l_discount = 0",
    "is_discounted": "l_tax = 0.08D",
    "is_first_generation": "l_linestatus = 'F'",
    "is_credit": "l_returnflag = 'R' AND l_linenumber = 1",
    "is_refund": "l_returnflag = 'A' AND l_linenumber = 2",
}
# hundredths of cents per cent times the account's scale
DIVISORS = ["10000000L", "1000000L", "100000L", "10000L", "1000L", "100L"]
SCALES = ["0.00001", "0.0001", "0.001", "0.01", "0.1", "1"]
PRODUCT_USAGE = [
    ("AmazonEC2", "BoxUsage:m3.large"),
    ("AmazonEC2", "EBS:VolumeUsage.gp2"),
    ("AmazonEC2", "LoadBalancerUsage"),
    ("AmazonS3", "TimedStorage-ByteHrs"),
    ("AmazonDynamoDB", "TimedStorage-ByteHrs"),
    ("AmazonCloudWatch", "CW:MonitorUsage"),
    ("AmazonSWF", "Requests"),
    ("AmazonRoute53", "DNS-Queries"),
    ("AmazonCloudFront", "DataTransfer-Out-Bytes"),
    ("AmazonEC2", "BoxUsage"),
]
# product, client_product_code, usage_type of the price list
PRICED = [
    ("Compute", "AmazonEC2", "m3.medium"),
    ("Compute", "AmazonEC2", "m3.large"),
    ("Compute", "AmazonEC2", "r3.large"),
    ("Compute", "AmazonEC2", "t2.micro"),
    ("Compute", "AmazonEC2", "t2.small"),
    ("Compute", "AmazonEC2", "m1.small"),
    ("Block storage", "AmazonEC2", "VolumeUsage.gp2"),
    ("Load balancer", "AmazonEC2", "LoadBalancerUsage"),
    ("Load balancer", "AmazonEC2", "DataProcessing-Bytes"),
    ("Object store", "AmazonS3", "TimedStorage-ByteHrs"),
    ("Table store", "AmazonDynamoDB", "TimedStorage-ByteHrs"),
    ("Monitoring", "AmazonCloudWatch", "MonitorUsage"),
    ("Monitoring", "AmazonCloudWatch", "CW:MonitorUsage"),
]
PLAN_FACTORS = {1: "0.0", 2: "1.0", 3: "1.1", 4: "0.0", 5: "0.8"}
ACTIVITIES = [
    (1, "EC2", "EC2 Instance Usage"),
    (2, "EC2", "EC2 RI Leases"),
    (3, "EC2", "EC2 EBS"),
    (4, "S3", "S3 Storage"),
    (5, "EC2", "EC2 Instance Usage"),
]
PRODUCTS = [(0, "AmazonES"), (1, "AmazonRDS"), (2, "AmazonCloudSearch")]
CATALOG_USAGE = [
    "BoxUsage:m3.large",
    "BoxUsage:r3.xlarge",
    "EBS:VolumeUsage.gp2",
    "EBS:VolumeUsage.piops",
    "EBS:VolumeUsage",
    "EBS:VolumeP-IOPS.piops",
    "EBS:VolumeUsage.sc1",
    "EBS:VolumeUsage.st1",
    "DataTransfer-Out-Bytes",
]
CATALOG_TEXT = ["Linux/UNIX on demand", "Windows on demand", "Linux/UNIX Dedicated"]
MATRIX_TYPES = ["m3.medium", "m4.large", "m4.xlarge", "r3.large", "r4.large", "c4.large", "i3.large", "t2.small"]
NODE_TYPES = ["m3.medium", "m3.large", "r3.large", "t2.micro", "c4.large"]


def _pick(values: list[str], index: Column, kind: str = "string") -> Column:
    items = [F.lit(Decimal(v)).cast(kind) if kind.startswith("decimal") else F.lit(v) for v in values]
    return F.get(F.array(*items), index.cast("int"))


def _choose(values: list[str], index: str, kind: str = "", quote: str = "'") -> str:
    """SQL text: the value at a position of a list."""
    text = ", ".join(f"{quote}{v}{quote}" for v in values)
    items = f"CAST(array({text}) AS ARRAY<{kind}>)" if kind else f"array({text})"
    return f"get({items}, CAST({index} AS INT))"


def _folded_days(ts: str) -> str:
    """SQL text: the same as ``_folded``."""
    return f"date_add(DATE '{FIRST_DAY}', pmod(datediff(CAST({ts} AS DATE), DATE '1995-01-01'), 70))"


def _folded(ts: Column) -> Column:
    """A date of the source tables folded into the ten weeks."""
    days = F.datediff(ts.cast("date"), F.lit(dt.date(1995, 1, 1)))
    return F.date_add(F.lit(FIRST_DAY), F.pmod(days, F.lit(70)))


def _account(key: str) -> Column:
    return account_id(F.col(key))


def _payer_key(key: str) -> Column:
    return F.col(key) - F.col(key) % 5


def _dated(rows: DataFrame) -> DataFrame:
    """Rows with years and weeks as tables have them; kept ones hold short numbers.

    A union knows where its rows lie if they are projected, not if they come straight from kept ones.
    """
    return rows.withColumns({name: F.col(name).cast("int") for name in ("year", "week")})


class StarSchema:
    """Builds each logical table of one service from ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, profile: ServiceProfile = SERVICE_A, keep_usage: bool = False):
        """With ``keep_usage`` line items and events are joined once for all tables derived from them, and kept by account (see ``Tables.shared``)."""
        self.spark, self.sf_dir, self.profile, self.keep_usage = spark, sf_dir, profile, keep_usage
        self._base = self._events = self._seen = None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    # -- usage ---------------------------------------------------------------------------------

    def _lines(self) -> DataFrame:
        """Line items with what their orders and customers add, no wider than what is derived from them.

        Line items are the most rows there are, so of keys that only assign attributes the remainders are shuffled, and
        all that is either so or not goes as bits of one number (NULL is not so).
        """
        # nation has 25 rows at every scale
        nation = F.broadcast(self.read("nation"))
        customer = self.read("customer").join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey", f"{INTERNAL} AS is_internal", "n_regionkey"
        )
        by_order = self.read("orders").selectExpr("o_orderkey", "o_custkey", f"{PRIORITY} AS priority")
        # orders meet customers first, so line items are shuffled once to meet orders
        by_order = by_order.join(customer, F.expr("o_custkey = c_custkey")).drop("c_custkey")
        lines = self.read("lineitem").selectExpr(
            "l_orderkey",
            f"CAST(l_partkey % {PART_CLASSES} AS INT) AS part",
            f"CAST(l_suppkey % {SUPPLIER_CLASSES} AS INT) AS supplier",
            "l_linenumber",
            f"{_folded_days('l_shipdate')} AS usage_date",
            "l_quantity",
            # amounts in whole cents and hundredths
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
            "CAST(round(l_discount * 100) AS BIGINT) AS off",
            " | ".join(f"CASE WHEN {so} THEN {1 << i} ELSE 0 END" for i, so in enumerate(MARKS.values())) + " AS marks",
        )
        lines = lines.join(by_order, F.expr("l_orderkey = o_orderkey")).selectExpr(
            "*", *(f"marks & {1 << i} <> 0 AS {name}" for i, name in enumerate(MARKS)), f"{_choose(DIVISORS, 'CAST(o_custkey div 5 % 6 AS INT)', quote='')} AS divisor"
        )
        return lines.selectExpr(
            "o_custkey",
            "is_internal",
            "n_regionkey",
            "priority",
            "part",
            "supplier",
            "usage_date",
            "l_quantity * 8 + CAST(l_linenumber AS DOUBLE) / 10 AS usage_value",
            "CASE WHEN is_credit THEN CAST(l_orderkey % 7 AS INT) END AS credit",
            # divided by a power of ten at the end; half a cent is rounded away from zero
            """CAST(CAST(CASE WHEN is_credit THEN -((cents * off + divisor div 2) div divisor)
                              WHEN off = 0 THEN 0
                              ELSE (cents * (100 - off) + divisor div 2) div divisor END AS DECIMAL(16,0)) * 0.01BD AS DECIMAL(18,2)) AS billed_amount""",
            "marks",
        )

    def _usage_base(self) -> DataFrame:
        """One row per line item. Kept ones lie in order by account, so that they take little space and are summed from few rows to the next."""
        if self._base is None:
            lines = self._lines()
            if self.keep_usage:
                lines = by_account(lines, F.expr(ACCOUNT)).sortWithinPartitions("o_custkey")
            lines = lines.selectExpr(
                "*",
                f"{ACCOUNT} AS account_id",
                "CAST(year(usage_date) AS SMALLINT) AS year",
                "CAST(floor((dayofyear(usage_date) + 6 - weekday(usage_date)) / 7) AS SMALLINT) AS week",
            )
            self._base = self._derived(_dated(keep(lines, placed=True) if self.keep_usage else lines))
        return self._base

    def _derived(self, lines: DataFrame) -> DataFrame:
        usage_type = f"concat({_choose(REGION_PREFIXES, 'n_regionkey')}, {_choose(USAGE_TYPES[self.profile.name], 'part % 7')})"
        marks = [f"marks & {1 << i} <> 0 AS {name}" for i, name in enumerate(MARKS)]
        return lines.selectExpr("*", f"{usage_type} AS usage_type", *marks).selectExpr(
            "o_custkey",
            "supplier",
            "part",
            "is_refund",
            "usage_date",
            "year",
            "week",
            "account_id",
            f"{FLAG} AS is_internal_flag",
            f"{_choose(REGION_PREFIXES, 'n_regionkey')} AS region_prefix",
            f"{_choose(REGION_CODES, 'n_regionkey')} AS region",
            "usage_type",
            # some records name no resource
            "CASE WHEN part % 23 <> 0 THEN concat('dom-', o_custkey, '-', supplier % 3) END AS usage_resource",
            "usage_value",
            "concat('CR', credit) AS credit_id",
            "billed_amount",
            f"CASE WHEN is_free THEN CAST(0 AS DECIMAL(8,4)) ELSE {_choose(UNIT_PRICES, 'part % 7', 'DECIMAL(8,4)')} END AS price_per_unit",
            "CASE WHEN is_first_generation THEN 'CSDomain:001' ELSE 'CSDomain:002' END AS operation",
            f"{_choose(OFFERINGS, 'priority - 1')} AS offering_id",
            """CASE WHEN is_credit THEN concat('credit ', supplier % 9) WHEN is_discounted THEN 'Enterprise Discount'
                    ELSE usage_type END AS charge_item_desc""",
        )

    def _event_usage(self) -> DataFrame:
        """One row per event; its user is a customer, or else an external account at home."""
        if self._events is not None:
            return self._events
        home = {"region_prefix": "''", "region": "'IAD'", "is_internal_flag": "'N'"}
        nation = F.broadcast(self.read("nation"))
        users = self.read("customer").join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey",
            f"CASE WHEN {INTERNAL} THEN 'Y' ELSE 'N' END AS is_internal_flag",
            f"{_choose(REGION_PREFIXES, 'n_regionkey')} AS region_prefix",
            f"{_choose(REGION_CODES, 'n_regionkey')} AS region",
        )
        events = self.read("events").selectExpr(
            "user_id", f"{_folded_days('ts')} AS usage_date", "value", "CAST(event_id % 7 AS INT) AS kind"
        )
        events = events.join(users, F.expr("user_id = c_custkey"), "left")
        events = events.withColumns({name: F.expr(f"coalesce({name}, {value})") for name, value in home.items()}).selectExpr(
            "usage_date",
            "lpad(CAST(user_id AS STRING), 12, '0') AS account_id",
            "is_internal_flag",
            "region",
            f"concat(region_prefix, {_choose(USAGE_TYPES[self.profile.name], 'kind')}) AS usage_type",
            "concat('dom-', user_id, '-e') AS usage_resource",
            "value AS usage_value",
            "'CSDomain:002' AS operation",
        ).withColumns({"year": F.year("usage_date").cast("smallint"), "week": calendar.monday_week(F.col("usage_date")).cast("smallint")})
        self._events = _dated(keep(by_account(events), placed=True) if self.keep_usage else events)
        return self._events

    def _metering(self) -> DataFrame:
        """Line items and events."""
        events = self._event_usage()
        return self._usage_base().select(events.columns).unionByName(events)

    def _weekly_charges(self) -> DataFrame:
        return self._usage_base().select(
            "year", "week", "account_id", "is_internal_flag", "billed_amount", "usage_type", "region", "operation",
            "credit_id", "charge_item_desc", "offering_id", "usage_value", "price_per_unit",
        )

    def _weekly_metering(self) -> DataFrame:
        return self._metering().select(
            "year", "week", "account_id", "usage_value", "is_internal_flag", "usage_resource", "usage_type", "region", "operation"
        )

    def _daily_charges(self) -> DataFrame:
        payer = F.when(F.col("o_custkey") % 5 != 0, account_id(_payer_key("o_custkey")))
        return self._usage_base().select(
            F.col("usage_date").alias("computation_date"), "charge_item_desc", "account_id", payer.alias("payer_account_id"),
            "usage_type", "usage_value", "offering_id", "billed_amount", "price_per_unit", "region", "is_internal_flag", "credit_id",
        )

    def _daily_metering(self) -> DataFrame:
        return self._metering().select(
            F.col("usage_date").alias("request_day"), "account_id", "usage_type", "usage_value", "usage_resource", "operation"
        )

    def _product_weekly_charges(self) -> DataFrame:
        kind = F.col("supplier") % len(PRODUCT_USAGE)
        return self._usage_base().select(
            "year",
            "week",
            _pick([p for p, _ in PRODUCT_USAGE], kind).alias("client_product_code"),
            "account_id",
            F.concat("region_prefix", _pick([u for _, u in PRODUCT_USAGE], kind)).alias("usage_type"),
            "usage_value",
            "billed_amount",
        )

    # -- accounts ------------------------------------------------------------------------------

    def _accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        company = (
            F.when(key % 50 == 0, F.concat(F.lit("MSP "), "c_name"))
            .when(key % 37 == 0, F.concat(F.lit("TrainLab "), "c_name"))
            .when(key % 211 == 0, F.lit(None))
            .otherwise(F.col("c_name"))
        )
        return self.read("customer").select(
            _account("c_custkey").alias("account_id"),
            F.when(key % 5 != 0, account_id(_payer_key("c_custkey"))).alias("payer_account_id"),
            company.alias("company"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "internal").otherwise("external").alias("internal"),
            F.concat(F.lower("c_mktsegment"), F.lit(".example")).alias("email_domain"),
        )

    def _test_accounts(self) -> DataFrame:
        return self.read("customer").where(F.col("c_custkey") % 97 == 0).select(_account("c_custkey").alias("account_id"))

    def _impacted_accounts(self) -> DataFrame:
        return self.read("customer").where(F.col("c_custkey") % 7 == 0).select(_account("c_custkey").alias("account_id"))

    def _account_history(self) -> DataFrame:
        """One record per order; the latest is current and open, the others last 45 days."""
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("start"))
        latest = orders.groupBy("o_custkey").agg(F.max(F.struct("start", "o_orderkey")).alias("latest"))
        latest = latest.select(F.col("latest.o_orderkey").alias("o_orderkey"), F.lit(True).alias("is_latest"))
        return orders.join(latest, "o_orderkey", "left").select(
            _account("o_custkey").alias("account_id"),
            F.when(F.col("o_orderstatus") == "P", "Suspended").otherwise("Active").alias("account_status_code"),
            F.col("start").alias("start_effective_date"),
            F.when(F.col("is_latest").isNull(), F.date_add("start", 45)).alias("end_effective_date"),
            F.when(F.col("is_latest"), "Y").otherwise("N").alias("current_record_flag"),
        )

    def _subscriptions(self) -> DataFrame:
        return self.read("orders").select(
            _account("o_custkey").alias("account_id"),
            F.expr(_choose(OFFERINGS, f"{PRIORITY} - 1")).alias("offering_id"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(F.to_date("o_orderdate"), 30)).alias("end_date"),
        )

    def _support_contracts(self) -> DataFrame:
        """One contract for accounts with a balance, and a second one for some of them."""
        first = F.when(F.col("c_custkey") % 19 == 0, "NULL").otherwise("Business")
        products = F.when(F.col("c_custkey") % 4 == 0, F.array(first, F.lit("Enterprise"))).otherwise(F.array(first))
        return self.read("customer").where(F.col("c_acctbal") > 5000).select("c_custkey", F.explode(products).alias("product_name")).select(
            _account("c_custkey").alias("account_id"),
            "product_name",
            F.lit("plan").alias("pricing_plan_name"),
            F.lit(dt.date(1995, 1, 1)).alias("begin_date"),
        )

    # -- lists prepared upstream ---------------------------------------------------------------

    def _presence(self, seen: DataFrame) -> DataFrame:
        """Per account and week: present in the week, present in the week before."""
        year, week = calendar.shifted_week(F.col("year"), F.col("week"), 1)
        here = F.struct(F.col("year"), F.col("week"), F.lit(1).alias("now"), F.lit(0).alias("before"))
        next_ = F.struct(year.alias("year"), week.alias("week"), F.lit(0).alias("now"), F.lit(1).alias("before"))
        both = seen.select("account_id", "is_internal_flag", F.inline(F.array(here, next_)))
        grouped = both.groupBy("year", "week", "account_id", "is_internal_flag")
        return grouped.agg(F.max("now").alias("now"), F.max("before").alias("before"))

    def _metered_weeks(self) -> DataFrame:
        return self._metering().select("year", "week", "account_id", "is_internal_flag").distinct()

    def _metered_presence(self) -> DataFrame:
        """What ``_presence`` gives of the metered weeks, for the ten weeks: an account's weeks are bits of a number, so accounts are grouped, not their weeks."""
        if self._seen is None:
            # the first day is a Monday, and the days are folded into whole weeks from there on
            at = F.floor(F.datediff("usage_date", F.lit(FIRST_DAY)) / 7).cast("int")
            bits = self._metering().groupBy("account_id", "is_internal_flag").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), at)).alias("bits"))
            weeks = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(w).alias("week"), F.lit(i).alias("at")) for i, (y, w) in enumerate(WEEKS)])
            bit = lambda shift: (F.call_function("shiftright", F.shiftleft("bits", 1), F.col("at") + shift)).bitwiseAND(1)
            rows = bits.select("account_id", "is_internal_flag", "bits", F.inline(weeks)).select(
                "year", "week", "account_id", "is_internal_flag", bit(1).alias("now"), bit(0).alias("before")
            )
            rows = rows.where("now = 1 OR before = 1")
            self._seen = keep(rows, placed=True) if self.keep_usage else rows
        return self._seen

    def _new_active_customers(self) -> DataFrame:
        return self._metered_presence().where("now = 1 and before = 0").drop("now", "before")

    def _new_inactive_customers(self) -> DataFrame:
        return self._metered_presence().where("now = 0 and before = 1").drop("now", "before")

    def _free_weeks(self) -> DataFrame:
        free = self._usage_base().where(F.col("price_per_unit") == 0)
        return free.select("year", "week", "account_id", "is_internal_flag").distinct()

    def _free_tier(self) -> DataFrame:
        return self._free_weeks()

    def _free_trial(self) -> DataFrame:
        return self._free_weeks().where(F.col("account_id").cast("bigint") % 4 == 0)

    def _free_to_pay(self) -> DataFrame:
        stopped = self._presence(self._free_weeks()).where("now = 0 and before = 1").drop("now", "before")
        return stopped.join(self._metered_weeks(), ["year", "week", "account_id", "is_internal_flag"], "left_semi")

    def _active_date(self) -> DataFrame:
        life = self._usage_base().groupBy("account_id", "is_internal_flag").agg(
            F.sum("billed_amount").alias("billed_amount"),
            F.min("usage_date").alias("min_request_day"),
            F.max("usage_date").alias("max_request_day"),
        )
        return life.join(self._accounts().select("account_id", "company"), "account_id", "left").select(
            "*",
            F.year("min_request_day").alias("min_request_year"),
            calendar.monday_week(F.col("min_request_day")).alias("min_request_week"),
            F.year("max_request_day").alias("max_request_year"),
            calendar.monday_week(F.col("max_request_day")).alias("max_request_week"),
        )

    def _goals(self) -> DataFrame:
        """Targets of every week but the last."""
        rows = [(y, w, 1000 + 10 * i, 1200 + 10 * i, 1_000_000.0 + 50_000 * i) for i, (y, w) in enumerate(WEEKS[:-1])]
        types = {"year": pa.int32(), "week": pa.int32(), "paying_customer_goal": pa.int32(), "active_customer_goal": pa.int32(), "revenue_goal": pa.float64()}
        return literal_rows(self.spark, types, rows)

    # -- star schema of the revenue reports ----------------------------------------------------

    def _revenue_fact(self) -> DataFrame:
        return self._usage_base().select(
            F.col("usage_date").alias("computation_date"),
            "charge_item_desc",
            F.col("o_custkey").alias("account_seq_id"),
            _payer_key("o_custkey").alias("payer_account_seq_id"),
            (F.col("supplier") % 3).cast("int").alias("product_seq_id"),
            "usage_type",
            "credit_id",
            F.trunc("usage_date", "month").alias("charge_period_start_date"),
            F.col("usage_date").alias("charge_period_end_date"),
            F.lit("USD").alias("base_currency_code"),
            "billed_amount",
            F.when(F.col("is_refund"), F.col("billed_amount") * F.lit(Decimal("-0.1")))
            .otherwise(F.lit(Decimal("0.000")))
            .cast("decimal(18,3)")
            .alias("refund_amount"),
            F.when(F.col("part") % 2 == 0, F.lit(Decimal("1.0"))).otherwise(F.lit(Decimal("0.5"))).cast("decimal(2,1)").alias("amortization_factor"),
        )

    def _dim_accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.read("customer").select(
            key.alias("account_seq_id"),
            _account("c_custkey").alias("account_id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Y").otherwise("N").alias("is_internal_flag"),
            F.when(key % 19 == 0, "Reinstated").when(key % 23 == 0, "Suspended").when(key % 3 == 0, "OK").alias("fraud_enforcement_status"),
        )

    def _dim_products(self) -> DataFrame:
        return literal_rows(self.spark, {"product_seq_id": pa.int32(), "product_code": pa.string()}, PRODUCTS)

    def _compute_fact(self) -> DataFrame:
        day = _folded(F.col("o_orderdate"))
        return self.read("orders").select(
            F.date_sub(day, F.dayofweek(day) - 1).alias("week_begin_date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("activity_type_id"),
            F.col("o_custkey").alias("account_seq_id"),
            F.when(F.col("o_orderkey") % 13 == 0, "Y").otherwise("N").alias("is_compromised_flag"),
        )

    def _dim_activity(self) -> DataFrame:
        types = {"activity_type_id": pa.int32(), "biz_product_group": pa.string(), "biz_product_name": pa.string()}
        return literal_rows(self.spark, types, ACTIVITIES)

    def _dim_compute_accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.read("customer").select(
            key.alias("account_seq_id"),
            _account("c_custkey").alias("account_id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Y").otherwise("N").alias("is_internal_flag"),
            F.when(key % 17 == 0, "Y").otherwise("N").alias("is_fraud_flag"),
            F.when(key % 11 == 0, "Suspended").otherwise("Active").alias("account_status_code"),
        )

    def _region_mapping(self) -> DataFrame:
        rows = [(p + u, c) for p, c in zip(REGION_PREFIXES, REGION_CODES) for u in USAGE_TYPES[self.profile.name]]
        return literal_rows(self.spark, {"usage_type": pa.string(), "region": pa.string()}, rows)

    def _dim_usage_types(self) -> DataFrame:
        """Includes usage types nobody uses."""
        never = literal_rows(self.spark, {"usage_type": pa.string(), "region": pa.string()}, [("USE2-" + u, "CMH") for u in USAGE_TYPES[self.profile.name]])
        return self._region_mapping().union(never)

    # -- prices --------------------------------------------------------------------------------

    def _cheapest_part(self, classes: int) -> DataFrame:
        """(class, least retail price) over the parts, which stand in for a price catalogue."""
        price = F.min(F.col("p_retailprice").cast("decimal(12,2)"))
        return self.read("part").groupBy((F.col("p_partkey") % classes).cast("int").alias("class")).agg(price.alias("least"))

    def _price_wide(self) -> DataFrame:
        types = {"class": pa.int32(), "product": pa.string(), "client_product_code": pa.string(), "usage_type": pa.string()}
        names = F.broadcast(literal_rows(self.spark, types, [(i, *r) for i, r in enumerate(PRICED)]))
        base = F.col("least") * (F.col("class") + 1) * F.lit(Decimal("0.0001"))
        factors = {"IAD": "1.0", "PDX": "1.1", "DUB": "1.2", "NRT": "1.3"}
        return self._cheapest_part(len(PRICED)).join(names, "class").select(
            "product",
            "client_product_code",
            "usage_type",
            *[F.round(base * F.lit(Decimal(f)), 4).cast("decimal(12,4)").alias(r) for r, f in factors.items()],
        )

    def _price_plan(self) -> DataFrame:
        """Five plans over all usage types but the last."""
        usage = [p + u for p in REGION_PREFIXES for u in USAGE_TYPES[self.profile.name]]
        types = {"class": pa.int32(), "usage_type": pa.string(), "plan_id": pa.int32(), "factor": pa.string()}
        rows = [(i, u, plan, f) for i, u in enumerate(usage[:-1]) for plan, f in PLAN_FACTORS.items()]
        names = F.broadcast(literal_rows(self.spark, types, rows))
        unit = F.col("least") * (F.col("class") + 1) * F.lit(Decimal("0.0001")) * F.col("factor").cast("decimal(2,1)")
        return self._cheapest_part(len(usage)).join(names, "class").select(
            "plan_id", "usage_type", F.round(unit, 4).cast("decimal(12,4)").alias("price_unit")
        )

    def _price_catalog_raw(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.read("part").select(
            _pick(CATALOG_TEXT, key % 3).alias("description"),
            F.concat(_pick(REGION_PREFIXES, F.floor(key / 9) % 5), _pick(CATALOG_USAGE, key % 9)).alias("usage_type"),
            (F.col("p_retailprice").cast("decimal(12,2)") * F.lit(Decimal("0.0001"))).cast("decimal(12,4)").alias("price_unit"),
            F.when(key % 9 < 2, "Hrs").otherwise("GB-Mo").alias("usage_unit"),
        )

    def _price_matrix(self) -> DataFrame:
        """Columns ``NA.`` (home) and one per region prefix; some types are not offered everywhere."""
        types = {"class": pa.int32(), "Price.prefix": pa.string()}
        rows = [(i, f"ESInstance:{t}") for i, t in enumerate(MATRIX_TYPES)] + [(len(MATRIX_TYPES), "ES:GP2-Storage")]
        names = F.broadcast(literal_rows(self.spark, types, rows))
        base = F.col("least") * (F.col("class") + 1) * F.lit(Decimal("0.0001"))
        columns = []
        for i, prefix in enumerate(REGION_PREFIXES):
            price = F.when((F.col("class") + i) % 4 == 0, F.lit(Decimal("0.0000"))).otherwise(base)
            columns.append(F.round(price, 4).cast("decimal(12,4)").alias(prefix.rstrip("-") or "NA."))
        return self._cheapest_part(len(rows)).join(names, "class").select("`Price.prefix`", *columns)

    def _regions(self) -> DataFrame:
        rows = [(p.rstrip("-"), c) for p, c in zip(REGION_PREFIXES, REGION_CODES)]
        return literal_rows(self.spark, {"prefix": pa.string(), "region": pa.string()}, rows)

    def _current_products(self) -> DataFrame:
        return self._usage_base().select("usage_type").distinct()

    # -- resources -----------------------------------------------------------------------------

    def _exposed_domains(self) -> DataFrame:
        found = self._usage_base().where((F.col("part") % 50 == 0) & F.col("usage_resource").isNotNull())
        return found.select(F.concat_ws(":", F.col("o_custkey").cast("string"), "usage_resource").alias("domain"), "region").distinct()

    def _domain_configs(self) -> DataFrame:
        """One JSON line per event."""
        nodes = F.get_json_object("props", "$.k")
        kind = _pick(NODE_TYPES, F.col("event_id") % len(NODE_TYPES))
        quoted = F.lit('"')
        fields = {
            "client_id": F.col("user_id").cast("string"),
            "domain": F.concat(F.lit("conf-"), F.col("event_id")),
            "data_node_type": kind,
            "data_node_count": F.concat(nodes, F.lit("x "), kind),
        }
        pairs = [F.concat(quoted, F.lit(n), F.lit('": "'), c, quoted) for n, c in fields.items()]
        return self.read("events").select(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("line"))


def star_tables(spark: SparkSession, sf_dir: str, profile: ServiceProfile = SERVICE_A) -> Tables:
    return Tables(spark, StarSchema(spark, sf_dir, profile).table)
