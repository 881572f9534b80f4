"""Readers for the loose files that come with the tables.

Each ``read_…`` has a ``checked_…`` beside it, which gives the good rows and, with their file, the records that do not parse;
``quarantine.set_aside`` writes and counts the latter. A price that is not there is NULL in both; one that is no number goes aside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.functions.text import account_id
from tollhouse.sources.quarantine import Checked, checked_csv, checked_json

PRICE = "decimal(12,4)"
DOMAIN_CONFIG = "client_id string, domain string, data_node_type string, data_node_count string"


def read_price_csv(spark: SparkSession, path: str, keys: int = 3, sep: str = ",") -> DataFrame:
    """Wide price list: key columns, then one price column per region."""
    df = spark.read.csv(path, header=True, sep=sep)
    return df.withColumns({c: df[f"`{c}`"].cast(PRICE) for c in df.columns[keys:]})


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    return spark.read.csv(path, header=True, sep=sep).columns


def _fields(names: list[str], kinds: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in zip(names, kinds))


def checked_price_csv(spark: SparkSession, path: str, keys: int = 3, sep: str = ",") -> Checked:
    names = _header(spark, path, sep)
    kinds = ["string"] * keys + [PRICE] * (len(names) - keys)
    return checked_csv(spark, path, _fields(names, kinds), sep, required=names[:keys])


def read_account_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A list of accounts with a header line."""
    df = spark.read.csv(path, header=True, sep=sep)
    return df.withColumn("account_id", account_id(F.col("account_id")))


def checked_account_list(spark: SparkSession, path: str, sep: str = ",") -> Checked:
    """A row without an account id is no row."""
    names = _header(spark, path, sep)
    found = checked_csv(spark, path, _fields(names, ["string"] * len(names)), sep, required=["account_id"])
    return Checked(found.rows.withColumn("account_id", account_id(F.col("account_id"))), found.bad)


def read_by_region(spark: SparkSession, directory: str) -> DataFrame:
    """All ``<region>.csv`` files of a directory as (domain, region), in one read."""
    df = spark.read.schema("domain string").csv(f"{directory}/*csv", header=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    return df.select("domain", name.alias("region"))


def checked_by_region(spark: SparkSession, directory: str) -> Checked:
    found = checked_csv(spark, f"{directory}/*csv", "domain string", required=["domain"], file_col="file")
    name = F.regexp_extract("file", r"([^/]+)\.csv$", 1)
    return Checked(found.rows.select("domain", name.alias("region")), found.bad)


def read_domain_configs(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one resource configuration each."""
    return spark.read.schema(DOMAIN_CONFIG).json(path)


def checked_domain_configs(spark: SparkSession, path: str) -> Checked:
    """A configuration names its owner and its resource."""
    return checked_json(spark, path, DOMAIN_CONFIG, required=["client_id", "domain"])


def parse_domain_configs(lines: DataFrame) -> DataFrame:
    """The same from a text column named ``line``."""
    parsed = F.from_json("line", DOMAIN_CONFIG)
    return lines.select(parsed.alias("c")).select("c.*")


def read_price_plan(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Plan files (usage type, unit price) as one table keyed by plan id."""
    plans = [
        spark.read.csv(path, header=True).select(
            F.lit(plan).alias("plan_id"),
            F.col("`Usage.Type`").alias("usage_type"),
            F.col("`Price.Unit`").cast(PRICE).alias("price_unit"),
        )
        for plan, path in sorted(paths.items())
    ]
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    return out


def checked_price_plan(spark: SparkSession, paths: dict[int, str]) -> Checked:
    plans = []
    for plan, path in sorted(paths.items()):
        names = _header(spark, path, ",")
        found = checked_csv(spark, path, _fields(names, [PRICE if n == "Price.Unit" else "string" for n in names]), required=["Usage.Type"])
        rows = found.rows.select(F.lit(plan).alias("plan_id"), F.col("`Usage.Type`").alias("usage_type"), F.col("`Price.Unit`").alias("price_unit"))
        plans.append(Checked(rows, found.bad))
    return Checked(reduce(DataFrame.unionByName, (p.rows for p in plans)), reduce(DataFrame.union, (p.bad for p in plans)))
