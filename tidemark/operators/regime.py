"""Market regime from a basket's returns: volatility, mutual correlation, stress, label."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.macro import by_day
from tidemark.operators.rolling import guarded
from tidemark.operators.ranks import with_expanding_ranks
from tidemark.operators.technical import YEAR

CALM_BELOW, STRESSED_FROM, MIN_HISTORY = 1 / 3, 0.80, 252


def wide_returns(returns: DataFrame, basket: Sequence[str], signs: dict[str, int] | None = None) -> DataFrame:
    """(instrument_id, date, ret) to one row a day with a column for each of the basket, each times its sign."""
    wide = returns.where(F.col("instrument_id").isin(list(basket))).groupBy("date").pivot("instrument_id", list(basket)).agg(F.first("ret"))
    return wide.withColumns({c: F.col(f"`{c}`") * (signs or {}).get(c, 1) for c in basket})


def synthetic_index(wide: DataFrame, basket: Sequence[str], name: str = "index") -> DataFrame:
    """Add the mean of the basket on days when all of it is present."""
    return wide.withColumn(name, sum(F.col(f"`{c}`") for c in basket) / len(basket))


def rolling_index(wide: DataFrame, name: str = "index", n: int = 20) -> DataFrame:
    """Add the sum of the index over n rows."""
    return wide.withColumn(f"{name}_ret_{n}", guarded(F.sum, F.col(name), n, over=by_day()))


def curve(wide_yields: DataFrame, short: str, long: str) -> DataFrame:
    """level, slope and its change over 20 rows of a yield curve."""
    slope = F.col(f"`{long}`") - F.col(f"`{short}`")
    return wide_yields.select("date", F.col(f"`{long}`").alias("curve_level"), slope.alias("curve_slope")).withColumn("curve_slope_chg_20", F.col("curve_slope") - F.lag("curve_slope", 20).over(by_day()))


def pair_correlation(wide: DataFrame, basket: Sequence[str], n: int = 60) -> DataFrame:
    """date, corr: mean absolute rolling correlation over all pairs, null while any pair lacks n joint rows."""
    pairs = list(combinations(basket, 2))
    each = F.explode(F.array(*[F.struct(F.lit(f"{a}-{b}").alias("pair"), F.col(f"`{a}`").alias("x"), F.col(f"`{b}`").alias("y")) for a, b in pairs]))
    long = wide.select("date", each.alias("p")).select("date", "p.*")
    over = Window.partitionBy("pair").orderBy("date").rowsBetween(1 - n, 0)
    both = F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)
    rolled = long.withColumn("c", F.when(F.count(both).over(over) == n, F.abs(F.corr("x", "y").over(over))))
    return rolled.groupBy("date").agg(F.when(F.count("c") == len(pairs), F.avg("c")).alias("corr"))


def label(stress: Column) -> Column:
    return F.when(stress < CALM_BELOW, "calm").when(stress < STRESSED_FROM, "normal").when(stress.isNotNull(), "stressed")


def regime(wide: DataFrame, market: str, basket: Sequence[str], least: int = MIN_HISTORY) -> DataFrame:
    """date, market_vol_20, cross_market_corr_60, vol_pct, corr_pct, stress, regime."""
    vol = guarded(F.stddev_samp, F.col(f"`{market}`"), 20, over=by_day()) * F.sqrt(F.lit(float(YEAR)))
    daily = wide.select("date", vol.alias("market_vol_20")).join(pair_correlation(wide, basket).withColumnRenamed("corr", "cross_market_corr_60"), "date", "left")
    ranked = with_expanding_ranks(daily, {"vol_pct": "market_vol_20", "corr_pct": "cross_market_corr_60"}, least)
    return ranked.withColumn("stress", (F.col("vol_pct") + F.col("corr_pct")) / 2).withColumn("regime", label(F.col("stress")))
