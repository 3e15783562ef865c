"""Indicator rules: the first day of each run of days on which a condition holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cross_section import top_decile
from tidemark.operators.rolling import by_instrument, first_of_run, guarded, median
from tidemark.operators.technical import rsi, smoothed

LEAST_HISTORY, SPIKE = 252, 3.0
#: Rule names and the direction they stand for: fixed values.
DIRECTIONS = {
    "macd_cross_up": "long",
    "macd_cross_down": "short",
    "golden_cross": "long",
    "death_cross": "short",
    "close_above_ema200": "long",
    "close_below_ema200": "short",
    "rsi_oversold": "long",
    "rsi_overbought": "short",
    "bollinger_lower": "long",
    "bollinger_upper": "short",
    "volume_spike_up": "long",
    "momentum_top_decile": "long",
}


def _before(x: Column) -> Column:
    return F.lag(x).over(by_instrument())


def _turns(above: Column, known: Column) -> tuple[Column, Column]:
    """Days a state switches on, and off while ``known``."""
    was = F.coalesce(_before(above), F.lit(False))
    return above & ~was, ~above & was & known.isNotNull()


def conditions(prices: DataFrame) -> DataFrame:
    """instrument_id, date, history and one flag for each rule of a single instrument."""
    c, v = F.col("close"), F.col("volume")
    ready = smoothed(prices, ["instrument_id", "date", "close", "volume"])
    mean20, dev20 = guarded(F.avg, c, 20), guarded(F.stddev_samp, c, 20)
    ready = ready.withColumns(
        {
            "rsi": rsi(F.col("gain_14"), F.col("loss_14")),
            "sma_50": guarded(F.avg, c, 50),
            "sma_200": guarded(F.avg, c, 200),
            "low_band": mean20 - 2 * dev20,
            "high_band": mean20 + 2 * dev20,
            "usual_volume": guarded(median, v, 20),
            "history": F.row_number().over(by_instrument()),
        }
    )
    state = {"macd_above": F.col("macd") > F.col("macd_signal"), "sma_above": F.col("sma_50") > F.col("sma_200"), "ema_above": c > F.col("ema_200")}
    ready = ready.withColumns({k: F.coalesce(x, F.lit(False)) for k, x in state.items()})
    flags = dict(zip(("macd_cross_up", "macd_cross_down"), _turns(F.col("macd_above"), F.col("macd")), strict=True))
    flags |= dict(zip(("golden_cross", "death_cross"), _turns(F.col("sma_above"), F.col("sma_200")), strict=True))
    flags |= dict(zip(("close_above_ema200", "close_below_ema200"), _turns(F.col("ema_above"), F.col("ema_200")), strict=True))
    flags |= {
        "rsi_oversold": (F.col("rsi") < 30) & (_before(F.col("rsi")) >= 30),
        "rsi_overbought": (F.col("rsi") > 70) & (_before(F.col("rsi")) <= 70),
        "bollinger_lower": c < F.col("low_band"),
        "bollinger_upper": c > F.col("high_band"),
        "volume_spike_up": (v >= SPIKE * F.col("usual_volume")) & (c > _before(c)),
    }
    return ready.select("instrument_id", "date", "history", *(F.coalesce(x, F.lit(False)).alias(k) for k, x in flags.items()))


def indicator_signals(prices: DataFrame) -> DataFrame:
    """instrument_id, date, rule of the eleven rules that need one instrument alone."""
    found = conditions(prices)
    rules = [c for c in found.columns if c in DIRECTIONS]
    fired = found.select("instrument_id", "date", "history", *(first_of_run(F.col(r)).alias(r) for r in rules))
    long = fired.where(F.col("history") >= LEAST_HISTORY).unpivot(["instrument_id", "date"], rules, "rule", "on")
    return long.where("on").select("instrument_id", "date", "rule")


def all_signals(prices: DataFrame) -> DataFrame:
    """All twelve rules with their direction."""
    direction = F.create_map(*[F.lit(x) for pair in DIRECTIONS.items() for x in pair])
    return indicator_signals(prices).unionByName(top_decile(prices, LEAST_HISTORY)).withColumn("direction", direction[F.col("rule")])
