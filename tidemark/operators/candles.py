"""Candlestick patterns as boolean expressions over a row and the two before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import by_instrument
from tidemark.operators.technical import prior_trend

#: Pattern names with direction and number of candles: fixed values.
PATTERNS = {
    "hammer": ("long", 1),
    "hanging_man": ("short", 1),
    "inverted_hammer": ("long", 1),
    "shooting_star": ("short", 1),
    "bullish_engulfing": ("long", 2),
    "bearish_engulfing": ("short", 2),
    "morning_star": ("long", 3),
    "evening_star": ("short", 3),
    "morning_doji_star": ("long", 3),
    "evening_doji_star": ("short", 3),
    "piercing_line": ("long", 2),
    "dark_cloud_cover": ("short", 2),
    "bullish_harami": ("long", 2),
    "bearish_harami": ("short", 2),
    "three_white_soldiers": ("long", 3),
    "three_black_crows": ("short", 3),
}


class Candle:
    """The candle k rows back."""

    def __init__(self, k: int):
        self.o, self.h, self.l, self.c, self.trend = (F.col(n) if k == 0 else F.lag(n, k).over(by_instrument()) for n in ("open", "high", "low", "close", "trend"))
        self.top, self.bottom = F.greatest(self.o, self.c), F.least(self.o, self.c)
        self.body, self.range = F.abs(self.c - self.o), self.h - self.l
        self.upper, self.lower = self.h - self.top, self.bottom - self.l
        self.green, self.red = self.c > self.o, self.c < self.o
        self.long, self.doji = self.body >= 0.6 * self.range, self.body <= 0.1 * self.range
        self.middle = (self.o + self.c) / 2


def _between(x: Column, a: Column, b: Column) -> Column:
    return (x >= a) & (x <= b)


def patterns() -> dict[str, Column]:
    """Each pattern as a condition on its last day. Needs the column trend."""
    now, one, two = Candle(0), Candle(1), Candle(2)
    falling, rising = (lambda k: k.trend < 0), (lambda k: k.trend > 0)
    small = (now.range > 0) & (now.body <= 0.3 * now.range)
    hammer = small & (now.lower >= 2 * now.body) & (now.upper <= 0.1 * now.range)
    inverted = small & (now.upper >= 2 * now.body) & (now.lower <= 0.1 * now.range)
    pause = one.body <= 0.3 * two.body
    morning = two.red & two.long & pause & (one.top < two.c) & now.green & (now.c > two.middle) & falling(two)
    evening = two.green & two.long & pause & (one.bottom > two.c) & now.red & (now.c < two.middle) & rising(two)
    inside = (now.top <= one.top) & (now.bottom >= one.bottom)
    return {
        "hammer": hammer & falling(now),
        "hanging_man": hammer & rising(now),
        "inverted_hammer": inverted & falling(now),
        "shooting_star": inverted & rising(now),
        "bullish_engulfing": one.red & now.green & (now.o <= one.c) & (now.c >= one.o) & falling(one),
        "bearish_engulfing": one.green & now.red & (now.o >= one.c) & (now.c <= one.o) & rising(one),
        "morning_star": morning,
        "evening_star": evening,
        "morning_doji_star": morning & one.doji,
        "evening_doji_star": evening & one.doji,
        "piercing_line": one.red & one.long & now.green & (now.o < one.l) & (now.c > one.middle) & (now.c < one.o) & falling(one),
        "dark_cloud_cover": one.green & one.long & now.red & (now.o > one.h) & (now.c < one.middle) & (now.c > one.o) & rising(one),
        "bullish_harami": one.red & now.green & inside & falling(one),
        "bearish_harami": one.green & now.red & inside & rising(one),
        "three_white_soldiers": two.green & one.green & now.green & (one.c > two.c) & (now.c > one.c) & _between(one.o, two.o, two.c) & _between(now.o, one.o, one.c) & falling(two),
        "three_black_crows": two.red & one.red & now.red & (one.c < two.c) & (now.c < one.c) & _between(one.o, two.c, two.o) & _between(now.o, one.c, one.o) & rising(two),
    }


def candle_flags(prices: DataFrame) -> DataFrame:
    """The bars with one flag for each pattern that ends on the day."""
    ready = prices.withColumn("trend", prior_trend(F.col("close")))
    return ready.select(*prices.columns, *(F.coalesce(x, F.lit(False)).alias(k) for k, x in patterns().items()))


def candle_days(prices: DataFrame) -> DataFrame:
    """instrument_id, date, pattern, direction: one row for each pattern that ends on a day."""
    direction = F.create_map(*[F.lit(x) for k, (d, _) in PATTERNS.items() for x in (k, d)])
    long = candle_flags(prices).unpivot(["instrument_id", "date"], list(PATTERNS), "pattern", "on")
    return long.where("on").select("instrument_id", "date", "pattern", direction[F.col("pattern")].alias("direction"))
