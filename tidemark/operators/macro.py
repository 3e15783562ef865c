"""Macro series: derived changes, and alignment to trading sessions or to every day.

These tables hold one row a day; windows over all of it run in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.rolling import positive_ln, ratio


def by_day() -> WindowSpec:
    return Window.orderBy("date")


#: A value may stand in for at most this many missing rows after it.
FILL_LIMIT = 5


def filled(columns: Sequence[str]) -> dict:
    """Each column carried forward over at most FILL_LIMIT rows."""
    return {c: F.last(c, ignorenulls=True).over(by_day().rowsBetween(-FILL_LIMIT, 0)) for c in columns}


def with_changes(macro: DataFrame) -> DataFrame:
    """Add vix_chg_20 and dollar_ret_20: logs over the value 20 rows before."""
    change = lambda c: positive_ln(ratio(F.col(c), F.lag(c, 20).over(by_day())))
    return macro.withColumns({"vix_chg_20": change("vix"), "dollar_ret_20": change("dollar_index")})


def with_curve(macro: DataFrame) -> DataFrame:
    return macro.withColumn("yield_curve_10y2y", F.col("yield_10y") - F.col("yield_2y"))


def aligned_to_sessions(macro: DataFrame, sessions: DataFrame) -> DataFrame:
    """The series on each session, as known the session before: fill over the union of days, keep sessions, shift one."""
    names = [c for c in macro.columns if c != "date"]
    union = sessions.select("date", F.lit(True).alias("session")).join(macro, "date", "full")
    on_sessions = union.withColumns(filled(names)).where("session")
    return with_curve(on_sessions.select("date", *(F.lag(c).over(by_day()).alias(c) for c in names)))


def each_day(days: DataFrame) -> DataFrame:
    """All calendar days from the first to the last of ``days``."""
    ends = days.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    return ends.where("low is not null").select(F.explode(F.sequence("low", "high")).alias("date"))


def as_of_day(macro: DataFrame, days: DataFrame, shift: int = 0) -> DataFrame:
    """The series on each wanted day, filled over at most five calendar days, known ``shift`` days before."""
    names = [c for c in macro.columns if c != "date"]
    spine = each_day(days.select("date").unionByName(macro.select("date"))).join(macro, "date", "left").withColumns(filled(names))
    if shift:
        spine = spine.select("date", *(F.lag(c, shift).over(by_day()).alias(c) for c in names))
    return with_curve(spine).join(days.select("date").distinct(), "date", "left_semi")
