"""Pivots, market structure and bars of higher timeframes, as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rolling import by_instrument

HALF_WIDTH = 5


def _is_first_extreme(x: str, k: int, high: bool) -> Column:
    best, order = (F.max, lambda a, b: a < b) if high else (F.min, lambda a, b: a > b)
    around = by_instrument().rowsBetween(-k, k)
    before = best(x).over(by_instrument().rowsBetween(-k, -1))
    return (F.count(x).over(around) == 2 * k + 1) & (best(x).over(around) == F.col(x)) & order(before, F.col(x))


def pivots(prices: DataFrame, k: int = HALF_WIDTH) -> DataFrame:
    """instrument_id, date, row, kind, price, known_row: highs and lows of 2k+1 rows, known k rows later; of equal ones the first."""
    numbered = prices.withColumn("row", F.row_number().over(by_instrument()))
    flagged = numbered.withColumns({"is_high": _is_first_extreme("high", k, True), "is_low": _is_first_extreme("low", k, False)})
    one = lambda flag, kind: F.when(F.col(flag), F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("price")))
    both = F.explode(F.array_compact(F.array(one("is_high", "high"), one("is_low", "low"))))
    return flagged.select("instrument_id", "date", "row", both.alias("p")).select("instrument_id", "date", "row", "p.kind", "p.price", (F.col("row") + k).alias("known_row"))


def structure_states(prices: DataFrame, found: DataFrame) -> DataFrame:
    """instrument_id, date, state: up or down where the last two known highs and lows both rise or fall, else neutral."""
    steps = found.withColumn("before", F.lag("price").over(Window.partitionBy("instrument_id", "kind").orderBy("row")))
    moved = F.signum(F.col("price") - F.col("before")).cast("int")
    known = steps.groupBy("instrument_id", F.col("known_row").alias("row")).agg(*(F.max(F.when(F.col("kind") == k, F.coalesce(moved, F.lit(0)))).alias(f"{k}_step") for k in ("high", "low")))
    rows = prices.select("instrument_id", "date", F.row_number().over(by_instrument()).alias("row")).join(known, ["instrument_id", "row"], "left")
    last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(by_instrument().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    high, low = last("high_step"), last("low_step")
    state = F.when((high == 1) & (low == 1), "up").when((high == -1) & (low == -1), "down").otherwise("neutral")
    return rows.select("instrument_id", "date", state.alias("state"))


def structure_breaks(prices: DataFrame, found: DataFrame) -> DataFrame:
    """instrument_id, date, rule, variant, direction: the first close beyond the latest known high or low."""
    rows = prices.select("instrument_id", "date", "close", F.row_number().over(by_instrument()).alias("row")).join(structure_states(prices, found), ["instrument_id", "date"])
    parts = []
    for kind, rule, direction, with_it in (("high", "structure_break_up", "long", "up"), ("low", "structure_break_down", "short", "down")):
        level = found.where(F.col("kind") == kind).select("instrument_id", F.col("known_row").alias("row"), F.col("price").alias("level"), F.col("row").alias("pivot"))
        held = rows.join(level, ["instrument_id", "row"], "left")
        running = by_instrument().rowsBetween(Window.unboundedPreceding, 0)
        held = held.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in ("level", "pivot")})
        beyond = F.col("close") > F.col("level") if kind == "high" else F.col("close") < F.col("level")
        first = held.where(beyond).withColumn("nth", F.row_number().over(Window.partitionBy("instrument_id", "pivot").orderBy("row"))).where("nth = 1")
        against = "down" if with_it == "up" else "up"
        variant = F.when(F.col("state") == with_it, "bos").when(F.col("state") == against, "choch").otherwise("neutral")
        parts.append(first.select("instrument_id", "date", F.lit(rule).alias("rule"), variant.alias("variant"), F.lit(direction).alias("direction")))
    return parts[0].unionByName(parts[1])


def period_bars(prices: DataFrame, period: str) -> DataFrame:
    """Bars of weeks that end on Friday or of months: instrument_id, period, open, high, low, close, last_date."""
    key = F.date_trunc("week", F.date_add("date", 2)) if period == "week" else F.date_trunc("month", "date")
    return prices.groupBy("instrument_id", F.to_date(key).alias("period")).agg(
        F.min_by("open", "date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"),
        F.max("date").alias("last_date"),
    )
