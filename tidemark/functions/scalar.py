"""Scalar expressions: scores, scales, identifiers, text and JSON helpers."""

from __future__ import annotations

from uuid import UUID

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.operators.rolling import ratio

MIN_SCALE = 1e-4


def hit(prob_up: Column, y: Column) -> Column:
    """Whether the likelier side came; no move counts as down."""
    return ((prob_up > 0.5) == (y > 0)).cast("double")


def brier(prob_up: Column, y: Column) -> Column:
    return F.pow(prob_up - (y > 0).cast("double"), 2)


def covered(low: Column, high: Column, y: Column) -> Column:
    return ((low <= y) & (y <= high)).cast("double")


def to_digits(x: Column, digits: int) -> Column:
    """x >= 0 rounded as DuckDB does: the scaled double, half up. F.round goes by the decimal form, which may show a tie that the scaled double isn't."""
    return F.round(x * 10.0**digits) / 10.0**digits


def horizon_scale(vol_20: Column, horizon: Column) -> Column:
    """sqrt(h / 252) times the yearly volatility, at least 1e-4; missing or infinite counts as the least."""
    x = F.sqrt(horizon / F.lit(252.0)) * vol_20
    return F.when(x.isNull() | F.isnan(x) | (x == float("inf")) | (x < MIN_SCALE), MIN_SCALE).otherwise(x)


def sign_bin(x: Column) -> Column:
    """-1, 0 or 1; missing counts as 0."""
    return F.coalesce(F.signum(F.nanvl(x, F.lit(0.0))), F.lit(0.0)).cast("int")


def price_band(close: Column, band: Column) -> Column:
    return close * F.exp(band)


def uuid5(name: Column, namespace: UUID) -> Column:
    """The name-based UUID of version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(63)).bitwiseOR(F.lit(128))), 2, "0"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


#: Namespace of forecast ids: this library's own.
FORECASTS = UUID("6f0c7c2e-4f7a-5b1e-9a53-1d2f8f6f3a10")


def forecast_id(instrument: Column, session: Column, horizon: Column, version: Column) -> Column:
    """The same id for the same forecast, whenever it is made."""
    return uuid5(F.concat_ws("|", instrument, session.cast("string"), horizon.cast("string"), version), FORECASTS)


def display_ticker(symbol: Column) -> Column:
    """A provider's symbol without its numeric tag and quote currency."""
    return F.regexp_replace(F.regexp_replace(symbol, "-USD$", ""), r"(?<=[A-Za-z])\d+$", "")


def listed_symbols(text: Column, pattern: str = r"`([A-Z0-9]{2,12})`") -> Column:
    """All symbols that a document quotes."""
    return F.regexp_extract_all(text, F.lit(pattern), 1)


def exact_name(name: Column, offered: Column) -> Column:
    """How many of the offered names are the same but for case."""
    return F.size(F.filter(offered, lambda o: F.lower(o) == F.lower(name)))


def rule_name(rule: Column) -> Column:
    """A rule without its variant."""
    return F.substring_index(rule, "|", 1)


def rule_variant(rule: Column) -> Column:
    """What stands after the bar, or null."""
    return F.when(rule.contains("|"), F.substring_index(rule, "|", -1))


def combo_parts(combo: Column) -> tuple[Column, Column]:
    """Trigger and contexts of a combination's name."""
    parts = F.split(combo, r"\+")
    return parts[0], F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def number(x: Column, digits: int = 4) -> Column:
    """Rounded for a document; NaN and the infinities become null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(F.round(x, digits))


def masked(x: Column, withheld: Column) -> Column:
    """Null where the forecast is withheld."""
    return F.when(~F.coalesce(withheld, F.lit(False)), x)


def top_contributions(parts: Column, most: int = 6) -> Column:
    """Of an array of (feature, value) the largest by size, none of them 0."""
    some = F.filter(parts, lambda p: p["value"] != 0)
    by_size = F.array_sort(some, lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1).when(F.abs(a["value"]) < F.abs(b["value"]), 1).otherwise(F.when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0)))
    return F.slice(by_size, 1, most)


def implied_probability(k1: Column, c1: Column, k2: Column, c2: Column, rate: Column, years: Column) -> Column:
    """Risk-neutral chance of a rise from two neighbouring calls."""
    return -ratio(c2 - c1, k2 - k1) * F.exp(rate * years)
