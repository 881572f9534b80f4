"""Identifiers, usage types and regions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region alias -> airport code. The empty alias is the home region.
REGION_AIRPORTS = {
    "": "IAD",
    "USW2": "PDX",
    "USW1": "SFO",
    "EU": "DUB",
    "APN1": "NRT",
    "APS1": "SIN",
    "APS2": "SYD",
    "APS3": "BOM",
    "SAE1": "GRU",
    "EUC1": "FRA",
    "APN2": "ICN",
    "USE2": "CMH",
}
HOME_REGION = "IAD"


def account_id(raw: Column) -> Column:
    """Zero-pad to twelve digits; longer ids stay whole."""
    text = raw.cast("string")
    return F.when(F.length(text) >= 12, text).otherwise(F.lpad(text, 12, "0"))


def head(value: Column, sep: str) -> Column:
    """Text before the first ``sep``; all of it if there is none."""
    return F.substring_index(value, sep, 1)


def rest(value: Column, sep: str) -> Column:
    """Text after the first ``sep``; empty if there is none."""
    at = F.instr(value, sep)
    return F.when(at > 0, F.substring(value, at + len(sep), F.length(value))).otherwise(
        F.when(value.isNotNull(), "")
    )


def region(alias: Column) -> Column:
    """Alias to airport code, else code to alias, else the home region."""
    pairs = {code: alias_ for alias_, code in REGION_AIRPORTS.items()} | REGION_AIRPORTS
    lookup = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, alias), F.lit(HOME_REGION))


def matches(value: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Regular-expression search; NULL does not match."""
    return F.coalesce(value.rlike(("(?i)" if ignore_case else "") + pattern), F.lit(False))
