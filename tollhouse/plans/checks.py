"""The daily checks and the list of exposed resources as runs that write their outputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.functions.calendar import Week, check_near
from tollhouse.plans import daily, directory, status
from tollhouse.sources import sinks
from tollhouse.sources.tables import Tables

#: Days that a daily check may be away from today.
NEAR = 100

#: Outputs of the daily checks: their day, and what orders rows of equal differences.
CHECKS = {
    "daily_gainers": ("computation_date", "account_id"),
    "daily_charge_type_diff": ("computation_date", "usage_type"),
    "daily_usage_diff": ("request_day", "account_id", "usage_resource", "usage_type"),
}


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Written and read back; a run started again replaces it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def daily_run(t: Tables, days: Sequence[dt.date], path: str, as_of: dt.date | None = None, near: int = NEAR) -> list[str]:
    """Write what changed on each of the days against the day before under ``path``: charges by account and by usage type, and
    usage by resource, a folder per day, the greatest rise first and the greatest fall last.

    Days written again replace themselves only. With ``as_of`` given, days more than ``near`` days away from it are refused.
    Payers are looked up once for all outputs.
    """
    if as_of is not None:
        check_near(days, as_of, near)
    inputs = t.replace(payer_map=_kept(directory.payer_map(t), f"{path}/inputs/payer_map"))
    for name, (day, *ties) in CHECKS.items():
        change = "charge_diff" if name == "daily_usage_diff" else "diff"
        order = [F.desc_nulls_last(change), *map(F.col, ties)]
        sinks.write_ordered_lists(getattr(daily, name)(inputs, days), f"{path}/{name}", order, by=[day])
    return [f"{path}/{name}" for name in CHECKS]


def exposure_run(t: Tables, weeks: Sequence[Week], as_of: dt.date, path: str) -> list[str]:
    """Write under ``path`` all exposed resources, those of customers without support, and of the latter the names that were not
    hit yet, joined by account, without quotes and with ``|`` between all fields and names.

    The resources are looked up once for all three; a run started again replaces what is there.
    """
    found = t.replace(exposed_found=_kept(status.exposed_domains(t, weeks, as_of), f"{path}/inputs/exposed_found"))
    sinks.write_csv(found["exposed_found"], f"{path}/exposed_domains")
    sinks.write_csv(status.exposed_unsupported(found, weeks, as_of), f"{path}/exposed_unsupported")
    sinks.write_pipe(status.exposed_joined(found, weeks, as_of), f"{path}/exposed_joined")
    return [f"{path}/{name}" for name in ("exposed_domains", "exposed_unsupported", "exposed_joined")]
