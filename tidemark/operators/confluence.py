"""Confluence: triggers, the contexts that held with them, and every small combination measured twice."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.quality import is_trigger
from tidemark.operators.candles import PATTERNS
from tidemark.operators.evaluate import LEAST, compared, corrected, daily_cells, verdict
from tidemark.operators.patterns import CONTEXTS, masks, pattern_events
from tidemark.operators.returns import forward_direction, usual_direction
from tidemark.session import stored

MOST_CONTEXTS = 3
BITS = {c: 1 << i for i, c in enumerate(CONTEXTS)}


def excluded_mask(trigger: Column) -> Column:
    """Contexts that a trigger would measure against itself."""
    level = trigger.startswith("sr_") | trigger.isin(list(PATTERNS))
    bit = lambda cond, name: F.when(cond, BITS[name]).otherwise(0)
    return (
        bit(level, "level")
        .bitwiseOR(bit(trigger.startswith("topdown_"), "htf"))
        .bitwiseOR(bit(trigger.isin("close_above_ema200", "close_below_ema200"), "trend"))
        .bitwiseOR(bit(trigger.startswith("structure_break_"), "structure"))
    )


def combos(spark: SparkSession) -> DataFrame:
    """combo_mask, contexts: the 41 sets of one to three of six contexts."""
    rows = [(sum(BITS[c] for c in s), "+".join(s)) for k in range(1, MOST_CONTEXTS + 1) for s in combinations(CONTEXTS, k)]
    return spark.createDataFrame(rows, "combo_mask int, contexts string")


def triggers(ready: DataFrame, indicator_signals: DataFrame) -> DataFrame:
    """instrument_id, date, trigger, direction, mask of pattern and indicator triggers."""
    found = pattern_events(ready).where(is_trigger(F.col("rule")))
    rows = found.select("instrument_id", "date", "rule", "direction").unionByName(indicator_signals.select("instrument_id", "date", "rule", "direction"))
    held = F.when(F.col("direction") == "long", F.col("long_mask")).otherwise(F.col("short_mask"))
    return rows.join(masks(ready), ["instrument_id", "date"]).select("instrument_id", "date", F.col("rule").alias("trigger"), "direction", held.alias("mask"))


def with_combos(events: DataFrame) -> DataFrame:
    """Each event once for each combination that held and that its trigger allows: trigger, combo, contexts. The 41-row table is fixed."""
    grid = F.broadcast(combos(events.sparkSession))
    allowed = F.col("combo_mask").bitwiseAND(excluded_mask(F.col("trigger"))) == 0
    matched = F.col("mask").bitwiseAND(F.col("combo_mask").cast("long")) == F.col("combo_mask")
    return events.join(grid, allowed & matched).withColumn("combo", F.concat_ws("+", "trigger", "contexts"))


def period_outcomes(events: DataFrame, prices: DataFrame, horizon: int, start=None, end=None) -> DataFrame:
    """Events whose horizon closed within the period, with the hit and the usual direction's hit, both of the period."""
    within = prices if end is None else prices.where(F.col("date") <= end)
    outcomes = forward_direction(within, horizon)
    if start is not None:
        outcomes = outcomes.where(F.col("date") >= start)
        events = events.where(F.col("date") >= start)
    if end is not None:
        events = events.where(F.col("date") <= end)
    usual = usual_direction(outcomes).select("instrument_id", "usual_up")
    joined = events.join(outcomes, ["instrument_id", "date"]).join(usual, "instrument_id")
    return joined.select("trigger", "direction", "mask", F.lit(horizon).alias("horizon"), F.col("date").alias("day"), (F.col("up") == (F.col("direction") == "long")).cast("double").alias("model"), (F.col("up") == F.col("usual_up")).cast("double").alias("base"))


def measured(outcomes: DataFrame) -> DataFrame:
    """combo, trigger, contexts, direction, horizon, n and, from 30 observations on, the corrected comparison."""
    keys = ["combo", "trigger", "contexts", "direction", "horizon"]
    cells = daily_cells(with_combos(outcomes), keys)
    counts = cells.groupBy(*keys).agg(F.sum("n").alias("seen"))
    enough = cells.join(counts.where(F.col("seen") >= LEAST), keys, "left_semi")
    found = corrected(compared(enough, keys), [])
    return counts.join(found, keys, "left").withColumn("verdict", F.when(F.col("n").isNotNull(), verdict(F.lit("direction_accuracy"))))


def measure(events: DataFrame, prices: DataFrame, horizons: Sequence[int], discovery_end, confirmation_start) -> DataFrame:
    """The whole protocol: discovery, correction, confirmation of what was found, correction, status.

    Discovery and the later outcomes are written once; several steps read each.
    """

    def period(start, end) -> DataFrame:
        parts = None
        for h in horizons:
            p = period_outcomes(events, prices, h, start, end)
            parts = p if parts is None else parts.unionByName(p)
        return parts

    keys = ["combo", "trigger", "contexts", "direction", "horizon"]
    discovery = stored(measured(period(None, discovery_end)), "discovery")
    found = discovery.where("verdict = 'better_significant'").select("trigger", "horizon", "contexts")
    later = stored(period(confirmation_start, None), "later")
    # Only combinations that were found are measured again, and corrected among themselves.
    again = with_combos(later).join(found, ["trigger", "horizon", "contexts"], "left_semi")
    cells = daily_cells(again, keys)
    counts = cells.groupBy(*keys).agg(F.sum("n").alias("conf_seen"))
    compared_again = corrected(compared(cells.join(counts.where(F.col("conf_seen") >= LEAST), keys, "left_semi"), keys), [])
    confirmed = counts.join(compared_again.withColumn("conf_verdict", verdict(F.lit("direction_accuracy"))).select(*keys, "conf_verdict", F.col("delta").alias("conf_delta"), F.col("p_value_fdr").alias("conf_p")), keys, "left")
    # A trigger that fired again leaves its combinations too early, not merely found.
    fired = later.select("trigger", "horizon").distinct().withColumn("fired", F.lit(0).cast("long"))
    joined = discovery.join(confirmed, keys, "left").join(fired, ["trigger", "horizon"], "left").withColumn("conf_seen", F.coalesce("conf_seen", "fired")).drop("fired")
    return joined.withColumn("status", status())


def status() -> Column:
    """too_early, not_found, found (nothing seen since), found_too_early, found_not_confirmed or confirmed."""
    found = F.col("verdict") == "better_significant"
    return (
        F.when(F.col("verdict").isNull(), "too_early")
        .when(~found, "not_found")
        .when(F.col("conf_seen").isNull(), "found")
        .when(F.col("conf_verdict").isNull(), "found_too_early")
        .when(F.col("conf_verdict") == "better_significant", "confirmed")
        .otherwise("found_not_confirmed")
    )


def summary(table: DataFrame, events: DataFrame) -> DataFrame:
    """One row of counters over the measured table and its events."""
    seen = events.agg(F.count(F.lit(1)).alias("events"), F.count_distinct("trigger").alias("triggers"), F.count_distinct("instrument_id").alias("instruments"))
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("too_early", "not_found", "found", "found_too_early", "found_not_confirmed", "confirmed")]
    return table.agg(F.count(F.lit(1)).alias("combinations"), *counts).crossJoin(seen)


def standing(events: DataFrame, table: DataFrame, session) -> DataFrame:
    """The day's events with every measured combination that stands on them."""
    today = with_combos(events.where(F.col("date") == session))
    return today.select("instrument_id", "date", "trigger", "direction", "combo").join(table.select("combo", "horizon", "status", "delta", "n"), "combo")
