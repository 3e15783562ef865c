"""Strategy lab: a grid of universes, thresholds and costs over non-overlapping periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.calendars import every_nth_day

UNIVERSES = ("all", "main", "cross")
THRESHOLDS, COSTS = (0.50, 0.55, 0.60, 0.65), (0.0, 0.0005, 0.001)
YEAR = 252
CURVE_POINTS = 120


def grid(spark: SparkSession, universes: Sequence[str] = UNIVERSES, thresholds: Sequence[float] = THRESHOLDS, costs: Sequence[float] = COSTS) -> DataFrame:
    return spark.createDataFrame([(u, t, c) for u in universes for t in thresholds for c in costs], "universe string, threshold double, cost double")


def periods(scored: DataFrame, universe: DataFrame, horizon: int, points: DataFrame) -> DataFrame:
    """universe, threshold, cost, date, positions, strategy, hold: mean simple returns of each rebalancing day.

    The returns are averaged by day first, once for each universe and
    threshold; the small grid meets only those daily rows.
    """
    rows = every_nth_day(scored.where(F.col("horizon") == horizon), horizon).withColumn("ret", F.exp("y") - 1)
    named = rows.join(universe.select("instrument_id", "segment"), "instrument_id", "left").withColumn("universe", F.explode(F.array_compact(F.array(F.lit("all"), "segment"))))
    thresholds = [r["threshold"] for r in points.select("threshold").distinct().collect()]  # the grid's own few values
    picked = [F.struct(F.lit(t).alias("threshold"), F.avg(F.when(F.col("prob_up") >= t, F.col("ret"))).alias("gross"), F.count_if(F.col("prob_up") >= t).alias("positions")) for t in sorted(thresholds)]
    daily = named.groupBy("universe", "date").agg(F.avg("ret").alias("hold"), F.array(*picked).alias("p"))
    long = daily.select("universe", "date", "hold", F.explode("p").alias("p")).select("universe", "date", "hold", "p.*")
    joined = long.join(F.broadcast(points), ["universe", "threshold"])
    strategy = F.coalesce("gross", F.lit(0.0)) - F.col("cost") * (F.col("positions") > 0).cast("double")
    return joined.select("universe", "threshold", "cost", F.lit(horizon).alias("horizon"), "date", "positions", strategy.alias("strategy"), "hold")


def _keys() -> list[str]:
    return ["universe", "threshold", "cost", "horizon"]


def curves(table: DataFrame) -> DataFrame:
    """Add running growth of strategy and hold, and the drawdown of each from its peak so far."""
    so_far = Window.partitionBy(*_keys()).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    grown = table.withColumns({f"{c}_curve": F.product(1 + F.col(c)).over(so_far) for c in ("strategy", "hold")})
    return grown.withColumns({f"{c}_drawdown": F.col(f"{c}_curve") / F.max(f"{c}_curve").over(so_far) - 1 for c in ("strategy", "hold")})


def thinned(curve: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """At most ``points`` evenly spaced rows of each curve, with both ends."""
    over = Window.partitionBy(*_keys())
    placed = curve.withColumns({"i": F.row_number().over(over.orderBy("date")) - 1, "n": F.count(F.lit(1)).over(over)})
    step = (F.col("n") - 1) / F.lit(points - 1)
    near = F.floor(F.floor(F.ceil(F.col("i") / step)) * step)
    return placed.where((F.col("n") <= points) | (near == F.col("i")) | (F.col("i") == F.col("n") - 1)).drop("i", "n")


def summary(table: DataFrame) -> DataFrame:
    """One row a grid point: periods, annual return and volatility of strategy and hold, drawdowns, share of better periods, positions."""
    c = curves(table)
    years = F.count(F.lit(1)) * F.col("horizon") / F.lit(float(YEAR))
    annual = lambda x: F.when(F.max_by(f"{x}_curve", "date") > 0, F.pow(F.max_by(f"{x}_curve", "date"), 1 / years) - 1)
    spread = lambda x: F.stddev_samp(x) * F.sqrt(F.lit(float(YEAR)) / F.col("horizon"))
    return c.groupBy(*_keys()).agg(
        F.count(F.lit(1)).alias("periods"),
        annual("strategy").alias("ann_return"),
        spread("strategy").alias("ann_vol"),
        F.min("strategy_drawdown").alias("max_drawdown"),
        annual("hold").alias("bh_ann_return"),
        spread("hold").alias("bh_ann_vol"),
        F.min("hold_drawdown").alias("bh_max_drawdown"),
        F.avg((F.col("strategy") > F.col("hold")).cast("double")).alias("share_better"),
        F.coalesce(F.avg(F.when(F.col("positions") > 0, F.col("positions"))), F.lit(0.0)).alias("avg_positions"),
        F.count_if(F.col("positions") == 0).alias("cash_periods"),
        F.avg(F.col("strategy") - F.col("hold")).alias("excess_per_period"),
    )
