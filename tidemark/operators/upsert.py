"""Merges of fresh rows into stored ones, and derived series across instruments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rolling import ratio

KEYS = ["instrument_id", "date"]


def upsert(existing: DataFrame, fresh: DataFrame, replaced: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Fresh rows replace stored ones of the same key; instruments in ``replaced`` lose all stored rows."""
    kept = existing if replaced is None else existing.join(replaced.select("instrument_id"), "instrument_id", "left_anti")
    return kept.join(fresh.select(*keys), [*keys], "left_anti").select(*existing.columns).unionByName(fresh.select(*existing.columns))


def keep_last(rows: DataFrame, arrival: Sequence[Column], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row a key: the last to arrive."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*arrival))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def by_priority(rows: DataFrame, key: str = "ticker", rank: str = "source_rank") -> DataFrame:
    """All rows of the first source that has any for the key: later sources only serve what earlier ones lack."""
    best = rows.groupBy(key).agg(F.min(rank).alias("__best"))
    return rows.join(best, key).where(F.col(rank) == F.col("__best")).drop("__best")


def served(wanted: DataFrame, rows: DataFrame, key: str = "ticker", rank: str = "source_rank") -> DataFrame:
    """key, source_rank that served it, null where none did."""
    return wanted.select(key).join(rows.groupBy(key).agg(F.min(rank).alias("served_by")), key, "left")


def cross_rates(rates: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per-unit rates (currency, date, rate) to pairs (instrument_id, base, quote, starts): quote over base on shared days."""
    base = rates.select("date", F.col("currency").alias("base"), F.col("rate").alias("base_rate"))
    quote = rates.select("date", F.col("currency").alias("quote"), F.col("rate").alias("quote_rate"))
    found = pairs.join(base, "base").join(quote, ["quote", "date"])
    return found.where("starts is null or date >= starts").select("instrument_id", "date", ratio(F.col("quote_rate"), F.col("base_rate")).alias("close"))


def spread_series(curve: DataFrame, specs: DataFrame) -> DataFrame:
    """A wide curve (date, tenors) to series named by ``spec``: a tenor, or two as A-B for A less B."""
    tenors = [c for c in curve.columns if c != "date"]
    long = curve.unpivot(["date"], tenors, "tenor", "value").where("value is not null")
    parts = F.split("spec", "-")
    named = specs.withColumns({"left": parts[0], "right": F.try_element_at(parts, F.lit(2))})
    one = long.select("date", F.col("tenor").alias("left"), F.col("value").alias("a"))
    two = long.select("date", F.col("tenor").alias("right"), F.col("value").alias("b"))
    found = named.join(one, "left").join(two, ["right", "date"], "left")
    return found.where("right is null or b is not null").select("instrument_id", "date", (F.col("a") - F.coalesce("b", F.lit(0.0))).alias("value"))


def as_price(yields: DataFrame, columns: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """Yields in per cent as a price-like level, so that log returns are yield changes."""
    return yields.withColumns({c: F.exp(F.col(c) / 100) for c in columns})


def as_yield(prices: DataFrame, columns: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    return prices.withColumns({c: 100 * F.ln(F.col(c)) for c in columns})


def split_factor(lots: DataFrame, actions: DataFrame) -> DataFrame:
    """Add factor: the product of an instrument's split ratios in (entered, until]."""
    splits = actions.where((F.col("split_ratio") > 0) & (F.col("split_ratio") != 1)).select("instrument_id", F.col("date").alias("__day"), "split_ratio")
    inside = (F.col("__day") > F.col("entered")) & (F.col("__day") <= F.col("until"))
    found = lots.select("instrument_id", "entered", "until").distinct().join(splits, "instrument_id").where(inside).groupBy("instrument_id", "entered", "until").agg(F.product("split_ratio").alias("factor"))
    return lots.join(found, ["instrument_id", "entered", "until"], "left").withColumn("factor", F.coalesce("factor", F.lit(1.0)))


def pairs_of(universe: DataFrame, home: str) -> DataFrame:
    """All pairs of currencies in code order, the home currency always the base: base, quote."""
    a, b = universe.select(F.col("currency").alias("base")), universe.select(F.col("currency").alias("quote"))
    return a.join(b, (F.col("base") == home) & (F.col("quote") != home) | (F.col("base") != home) & (F.col("quote") != home) & (F.col("base") < F.col("quote")))


def one_per_company(rows: DataFrame, rank: Column) -> DataFrame:
    """One share class a company: names that differ only in the class are one company."""
    key = F.regexp_replace(F.lower("name"), r"\b(class|series|cl)\s+[a-z]\b|[^a-z0-9]+", " ")
    order = Window.partitionBy("__company").orderBy(rank, "ticker")
    return rows.withColumn("__company", F.trim(F.regexp_replace(key, r"\s+", " "))).withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__company", "__rank")


def top_by_volume(volumes: DataFrame, most: int, forced: Sequence[str] = ()) -> DataFrame:
    """rank, symbol, dollars: forced members first, then the largest median traded value."""
    always = F.col("symbol").isin(list(forced))
    ranked = volumes.orderBy(always.desc(), F.col("dollars").desc(), "symbol").limit(most)
    return ranked.select(F.row_number().over(Window.orderBy(F.col("symbol").isin(list(forced)).desc(), F.col("dollars").desc(), "symbol")).alias("rank"), "symbol", "dollars")


def expansion(volumes: DataFrame, least: float = 1e6, most: int = 150) -> DataFrame:
    return top_by_volume(volumes.where(F.col("dollars") >= least), most)
