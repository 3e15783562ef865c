"""Statistics across instruments on one day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rolling import by_instrument, first_of_run, median
from tidemark.operators.technical import momentum


def with_sector_relative(features: DataFrame, universe: DataFrame, ret: str = "ret_20") -> DataFrame:
    """Add sector_ret_20, the median of the day's equities of a sector, and sector_rel_20, the distance from it."""
    named = features.join(universe.select("instrument_id", "asset_class", "sector"), "instrument_id", "left")
    equities = F.when(F.col("asset_class") == "equity", F.col(ret))
    middle = median(equities).over(Window.partitionBy("date", "sector"))
    return named.withColumn("sector_ret_20", F.when(F.col("asset_class") == "equity", middle)).withColumn("sector_rel_20", F.col(ret) - F.col("sector_ret_20"))


def breadth(features: DataFrame, distance: str = "ema_dist_50") -> DataFrame:
    """date, breadth_50: the share of instruments above their mean, of those that have one."""
    return features.groupBy("date").agg(F.avg(F.when(F.col(distance).isNotNull(), (F.col(distance) > 0).cast("double"))).alias("breadth_50"))


def relative_to(features: DataFrame, leader: str, ret: str = "ret_20") -> DataFrame:
    """Add the return over that of one instrument on the same day."""
    led = features.where(F.col("instrument_id") == leader).select("date", F.col(ret).alias("leader_ret"))
    return features.join(led, "date", "left").withColumn("leader_rel", F.col(ret) - F.col("leader_ret"))


def top_decile(prices: DataFrame, least: int = 252, share: float = 0.9) -> DataFrame:
    """First days on which an instrument's momentum stands in the day's top decile."""
    ready = prices.withColumns({"momentum": momentum(F.col("close")), "history": F.row_number().over(by_instrument())})
    cutoff: Column = F.percentile("momentum", F.lit(share)).over(Window.partitionBy("date"))
    flagged = ready.withColumn("in_top", F.coalesce(F.col("momentum") >= cutoff, F.lit(False)))
    return flagged.withColumn("fired", first_of_run(F.col("in_top"))).where((F.col("history") >= least) & F.col("fired")).select("instrument_id", "date", F.lit("momentum_top_decile").alias("rule"))


def by_date(rows: DataFrame, *daily: DataFrame) -> DataFrame:
    """``rows`` with tables of one row a day joined by date; a day that one lacks leaves its columns null."""
    for table in daily:
        rows = rows.join(table, "date", "left")
    return rows
