"""Price catalogues brought into the form of the price list."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.measures import as_double
from tollhouse.functions.text import head, matches, rest
from tollhouse.profiles import ServiceProfile
from tollhouse.sources.tables import Tables


def price_catalog(t: Tables) -> DataFrame:
    """Shared Linux compute and block storage lines as (region alias, type)."""
    usage, text = F.col("usage_type"), F.col("description")
    place, kind = head(usage, ":"), rest(usage, ":")
    # How the catalogue names what it sells, and what the price list calls it.
    box = matches(text, "Linux") & matches(usage, "BoxUsage") & ~matches(text, "Dedicated")
    disk = matches(usage, "VolumeUsage|VolumeP-IOPS") & ~matches(usage, "sc1|st1")
    names = {
        "VolumeUsage.gp2": "GP2-Storage",
        "VolumeUsage.piops": "PIOPS-Storage",
        "VolumeUsage": "Magnetic-Storage",
        "VolumeP-IOPS.piops": "PIOPS",
    }
    renamed = kind
    for old, new in names.items():
        renamed = F.regexp_replace(renamed, old, new)
    compute = t.price_catalog_raw.where(box).select("*", F.regexp_replace(place, "BoxUsage|-", "").alias("region"), kind.alias("instance_type"))
    storage = t.price_catalog_raw.where(disk).select("*", F.regexp_replace(place, "EBS|-", "").alias("region"), renamed.alias("instance_type"))
    return compute.union(storage).withColumn("price_unit", as_double("price_unit", 4))


def price_matrix_new(t: Tables, profile: ServiceProfile) -> DataFrame:
    """Instance prices of a matrix (one column per region prefix) that are not on sale yet."""
    matrix = t.price_matrix.withColumnRenamed("Price.prefix", "type")
    prices = []
    for column in matrix.columns[1:]:
        prefix = re.sub("NA.", "", column)
        usage_type = F.concat(F.lit(f"{prefix}-" if prefix else ""), "type")
        prices.append(F.struct(F.lit(prefix).alias("prefix"), usage_type.alias("usage_type"), F.col(f"`{column}`").alias("price")))
    long = matrix.select(F.inline(F.array(*prices))).where(F.col("price") > 0)
    named = long.withColumn("price", as_double("price", 4))
    instances = named.where(matches(F.col("usage_type"), profile.instance_token))
    return instances.join(t.regions, "prefix", "left").join(t.current_products, "usage_type", "left_anti")
