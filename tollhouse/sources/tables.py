"""The logical tables the reports read.

A report never opens a file itself: it takes a ``Tables`` and asks for ``tables.weekly_charges``.
Where the data lies (parquet, CSV, a database through Spark's JDBC source) is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollhouse.functions.text import account_id
from tollhouse.sources import sinks
from tollhouse.sources.files import read_price_csv

MONEY = "decimal(18,2)"

SCHEMAS: dict[str, str] = {
    "weekly_charges": f"year int, week int, account_id string, is_internal_flag string, billed_amount {MONEY}, "
    "usage_type string, region string, operation string, credit_id string, charge_item_desc string, "
    "offering_id string, usage_value double, price_per_unit decimal(8,4)",
    "weekly_metering": "year int, week int, account_id string, usage_value double, is_internal_flag string, "
    "usage_resource string, usage_type string, region string, operation string",
    "daily_charges": "computation_date date, charge_item_desc string, account_id string, payer_account_id string, "
    f"usage_type string, usage_value double, offering_id string, billed_amount {MONEY}, "
    "price_per_unit decimal(8,4), region string, is_internal_flag string, credit_id string",
    "daily_metering": "request_day date, account_id string, usage_type string, usage_value double, "
    "usage_resource string, operation string",
    "product_weekly_charges": "year int, week int, client_product_code string, account_id string, "
    f"usage_type string, usage_value double, billed_amount {MONEY}",
    "revenue_fact": "computation_date date, charge_item_desc string, account_seq_id bigint, "
    "payer_account_seq_id bigint, product_seq_id int, usage_type string, credit_id string, "
    "charge_period_start_date date, charge_period_end_date date, base_currency_code string, "
    f"billed_amount {MONEY}, refund_amount decimal(18,3), amortization_factor decimal(2,1)",
    "dim_accounts": "account_seq_id bigint, account_id string, is_internal_flag string, "
    "fraud_enforcement_status string",
    "dim_products": "product_seq_id int, product_code string",
    "compute_fact": "week_begin_date date, activity_type_id int, account_seq_id bigint, is_compromised_flag string",
    "dim_activity": "activity_type_id int, biz_product_group string, biz_product_name string",
    "dim_compute_accounts": "account_seq_id bigint, account_id string, is_internal_flag string, "
    "is_fraud_flag string, account_status_code string",
    "accounts": "account_id string, payer_account_id string, company string, internal string, email_domain string",
    "test_accounts": "account_id string",
    "metered_accounts": "year int, week int, account_id string",
    "customer_directory": "account_id string, payer_account_id string, company string, is_internal_flag string",
    "payer_map": "account_id string, payer_account_id string, company string, is_internal_flag string",
    "account_history": "account_id string, account_status_code string, start_effective_date date, "
    "end_effective_date date, current_record_flag string",
    "subscriptions": "account_id string, offering_id string, end_date date",
    "new_active_customers": "year int, week int, account_id string, is_internal_flag string",
    "new_inactive_customers": "year int, week int, account_id string, is_internal_flag string",
    "free_tier": "year int, week int, account_id string, is_internal_flag string",
    "free_to_pay": "year int, week int, account_id string, is_internal_flag string",
    "free_trial": "year int, week int, account_id string, is_internal_flag string",
    "active_date": f"account_id string, company string, billed_amount decimal(28,2), min_request_day date, "
    "max_request_day date, min_request_year int, min_request_week int, max_request_year int, "
    "max_request_week int, is_internal_flag string",
    "goals": "year int, week int, paying_customer_goal int, active_customer_goal int, revenue_goal double",
    "price_plan": "plan_id int, usage_type string, price_unit decimal(12,4)",
    "support_contracts": "account_id string, product_name string, pricing_plan_name string, begin_date date",
    "exposed_domains": "domain string, region string",
    "impacted_accounts": "account_id string",
    "domain_configs": "line string",
    "region_mapping": "usage_type string, region string",
    "dim_usage_types": "usage_type string, region string",
    "regions": "prefix string, region string",
    "current_products": "usage_type string",
    "price_catalog_raw": "description string, usage_type string, price_unit decimal(12,4), usage_unit string",
}
# Tables whose region columns depend on the data, with the number of columns before these: read with the columns they come with.
WIDE_TABLES = {"price_wide": 3, "price_matrix": 1}


#: Whether rows are planned anew, and so dealt anew, as they are computed.
ADAPTIVE = "spark.sql.adaptive.enabled"


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def keep(df: DataFrame, placed: bool = False) -> DataFrame:
    """Rows that are computed once, when first read, and not those of an earlier plan that was alike.

    Spark gives kept rows to every plan that holds the same one; the filter is there so that only those who keep rows get them.
    ``placed`` rows stay in the partitions that they are dealt to, which plans know before the rows are there: what relies on
    their place then exchanges nothing. Others are planned anew as they are computed, and no plan can count on their place.
    """
    rows, conf = df.where(F.lit(True)).unpersist(), df.sparkSession.conf
    if not placed:
        return rows.persist(StorageLevel.DISK_ONLY)
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, "false")
    try:
        return rows.persist(StorageLevel.DISK_ONLY)
    finally:
        conf.set(ADAPTIVE, before)


class Tables:
    """Named DataFrames, built when first asked for.

    ``source`` gives the DataFrame of a logical table, ``has`` tells whether there is one (needed for
    the tables that may be stored or not). Use ``replace`` to swap single tables, for example for
    stored copies of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[str], DataFrame],
        given: Mapping[str, DataFrame] | None = None,
        has: Callable[[str], bool] = lambda name: False,
        keep: bool = False,
    ):
        self.spark = spark
        self._source = source
        self._has = has
        self._keep = keep
        self._frames: dict[str, DataFrame] = dict(given or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._source(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __contains__(self, name: str) -> bool:
        return name in self._frames or self._has(name)

    def replace(self, **frames: DataFrame) -> Tables:
        return Tables(self.spark, self._source, {**self._frames, **frames}, self._has, self._keep)

    def sharing(self) -> Tables:
        """The same tables for a report that only plans and reads some rows several times: ``shared`` keeps them."""
        return Tables(self.spark, self._source, self._frames, self._has, True)

    def shared(self, df: DataFrame, placed: bool = False) -> DataFrame:
        """Rows that a report reads several times. Of ``sharing`` tables they are computed once, when they are first read.

        Nothing runs here. The rows stay on the executors' disks until the session ends or ``spark.catalog.clearCache()``;
        a report that is built again computes them anew, so that it never shows older files. For ``placed`` see ``keep``.
        """
        return keep(df, placed) if self._keep else df

    @property
    def keeps(self) -> bool:
        return self._keep


def padded(df: DataFrame, columns: Iterable[str] = ("account_id", "payer_account_id")) -> DataFrame:
    """Repair ids that lost their leading zeros in a text file."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: account_id(df[c]) for c in present})


def parquet_tables(spark: SparkSession, root: str) -> Tables:
    """Tables stored as ``root/<name>``; weekly ones are best partitioned by (year, week)."""

    def read(name: str) -> DataFrame:
        reader = spark.read if name in WIDE_TABLES else spark.read.schema(SCHEMAS[name])
        return padded(reader.parquet(f"{root}/{name}"))

    return Tables(spark, read, has=lambda name: sinks.exists(spark, f"{root}/{name}"))


def csv_tables(spark: SparkSession, root: str, sep: str = ",") -> Tables:
    """Tables stored as delimited text with a header line."""

    def read(name: str) -> DataFrame:
        reader = spark.read.option("header", True).option("sep", sep)
        if name in WIDE_TABLES:
            return read_price_csv(spark, f"{root}/{name}", WIDE_TABLES[name], sep)
        return padded(reader.schema(SCHEMAS[name]).csv(f"{root}/{name}"))

    return Tables(spark, read, has=lambda name: sinks.exists(spark, f"{root}/{name}"))


def jdbc_tables(spark: SparkSession, url: str, partitions: Mapping[str, Mapping[str, str]] | None = None, **options: str) -> Tables:
    """Tables in a database. ``partitions`` holds, per table, the ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` that let Spark read it in parallel."""

    def read(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
        return padded(reader.options(**(partitions or {}).get(name, {})).load())

    return Tables(spark, read)
