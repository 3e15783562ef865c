"""Resolution of forecasts, theses and scenarios against what came, as of their target day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import brier, covered, hit
from tidemark.operators.rolling import log_of, ratio
from tidemark.operators.shocks import as_of

REGIMES = ("calm", "normal", "stressed")


def ends(rows: DataFrame, series: DataFrame, value: str = "tr_close") -> DataFrame:
    """Add start_value, end_value, end_date: the series on the session, and its last day up to the target, if that is after the session.

    The last day comes by one as-of pass over each instrument instead of a join of all days between.
    """
    start = series.select("instrument_id", F.col("date").alias("session"), F.col(value).alias("start_value"))
    marked = rows.join(start, ["instrument_id", "session"])
    points = marked.withColumn("date", F.col("target_session"))
    known = series.where(F.col(value).isNotNull()).select("instrument_id", "date", F.col("date").alias("end_date"), F.col(value).alias("end_value"))
    found = as_of(points, known, ["end_date", "end_value"], by=["instrument_id"]).drop("date")
    return found.where("end_date > session")


def resolve_due(forecasts: DataFrame, series: DataFrame, last_session) -> DataFrame:
    """Outcomes of forecasts that are due: actual log return, scores of model and baseline, and how the series ended.

    The return is ln(end / start) in doubles as they are: of a series that came back from beyond their range it is minus
    infinity, and it is no number, which counts as a rise, where both ends lie there.
    """
    due = forecasts.where(F.col("target_session").isNotNull() & (F.col("target_session") <= last_session))
    found = ends(due, series).withColumn("actual_return", log_of(ratio(F.col("end_value"), F.col("start_value"))))
    y, p, b = F.col("actual_return"), F.col("prob_up"), F.col("baseline_prob")
    kind = F.when(F.col("end_date") == F.col("target_session"), "normal").otherwise("delisted_or_halted")
    scores = {"hit": hit(p, y), "baseline_hit": hit(b, y), "brier": brier(p, y), "baseline_brier": brier(b, y), "covered": covered(F.col("band_low"), F.col("band_high"), y), "resolution_type": kind}
    return found.withColumns(scores).drop("start_value", "end_value", "end_date")


def still_open(forecasts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Forecasts without an outcome."""
    return forecasts.join(outcomes.select("forecast_id"), "forecast_id", "left_anti")


def next_resolutions(forecasts: DataFrame, outcomes: DataFrame) -> DataFrame:
    return still_open(forecasts, outcomes).where("target_session is not null").groupBy("horizon").agg(F.min("target_session").alias("next_target"), F.count(F.lit(1)).alias("open"))


def resolve_theses(theses: DataFrame, series: DataFrame, last_session, value: str = "close") -> DataFrame:
    """Users' theses (with session and target_session): simple return, hit and Brier of the stated probability, with the model's and baseline's beside it."""
    due = theses.where(F.col("target_session") <= last_session)
    found = ends(due, series, value).withColumn("outcome_return", ratio(F.col("end_value"), F.col("start_value")) - 1)
    up = F.col("outcome_return") > 0
    right = F.when(F.col("direction") == "long", up).otherwise(~up)
    of = lambda p: F.pow(p - up.cast("double"), 2)
    scores = {"hit": right, "brier": F.pow(F.col("probability") - right.cast("double"), 2), "model_brier": of(F.col("prob_up")), "baseline_brier": of(F.col("baseline_prob"))}
    return found.withColumns({k: x for k, x in scores.items() if k in ("hit", "brier") or {"prob_up", "baseline_prob"} <= set(theses.columns)}).drop("start_value", "end_value", "end_date")


def condition_held(entries: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Add condition_held: on every package session in (session, target_session] the instrument has an ok row without a signal."""
    days = forecasts.select(F.col("session").alias("day")).distinct()
    own = forecasts.select("instrument_id", F.col("session").alias("day"), ((F.col("shock_status") == "ok") & (F.col("shock_signals") == "") & (F.col("shock_market") == "")).alias("quiet"))
    own = own.groupBy("instrument_id", "day").agg(F.bool_and(F.coalesce("quiet", F.lit(False))).alias("quiet"))
    # Running counts of package days and of an instrument's quiet days: a window is calm if both grew alike.
    counted = days.withColumn("n", F.row_number().over(Window.orderBy("day")))
    quiet = own.where("quiet").withColumn("q", F.row_number().over(Window.partitionBy("instrument_id").orderBy("day")))
    out = entries
    for name, at in (("a", "session"), ("b", "target_session")):
        out = as_of(out.withColumn("date", F.col(at)), counted.select(F.col("day").alias("date"), F.col("n").alias(f"n_{name}")), [f"n_{name}"])
        out = as_of(out, quiet.select("instrument_id", F.col("day").alias("date"), F.col("q").alias(f"q_{name}")), [f"q_{name}"], by=["instrument_id"]).drop("date")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    length = zero("n_b") - zero("n_a")
    return out.withColumn("condition_held", (length > 0) & (zero("q_b") - zero("q_a") == length)).drop("n_a", "n_b", "q_a", "q_b")


def resolve_entries(entries: DataFrame, series: DataFrame, forecasts: DataFrame, last_session) -> DataFrame:
    """Pinned scenario entries that are due: condition_failed, or resolved with return and hits."""
    due = entries.where(F.col("prob_up").isNotNull() & (F.col("target_session") <= last_session))
    found = condition_held(ends(due, series, "close"), forecasts)
    change = ratio(F.col("end_value"), F.col("start_value")) - 1
    ok, up = F.col("condition_held"), change > 0
    side = lambda p: (p > 0.5) == up
    return found.withColumns({"status": F.when(ok, "resolved").otherwise("condition_failed"), "outcome_return": F.when(ok, F.round(change, 8)), "hit": F.when(ok, side(F.col("prob_up"))), "baseline_hit": F.when(ok, side(F.coalesce("baseline_prob", F.lit(0.5))))}).drop("start_value", "end_value", "end_date", "condition_held")


def pin_entries(entries: DataFrame, forecasts: DataFrame, grid: DataFrame) -> DataFrame:
    """Give each entry (id, instrument_id, horizon, assumed_regime, created_at) its probability from the last package made before it.

    ``grid`` holds the calm quantiles: horizon, regime, levels, quantiles, band_q.
    """
    packages = forecasts.groupBy("session").agg(F.max("made_at").alias("date"))
    named = as_of(entries.drop("session").withColumn("date", F.col("created_at")), packages.select("date", F.col("session").alias("forecast_session")), ["forecast_session"]).drop("date").where("forecast_session is not null")
    rows = forecasts.select(F.col("session").alias("forecast_session"), "instrument_id", "horizon", "expected_return", "scale", "baseline_prob", "target_session", "regime", "withheld")
    found = named.join(rows, ["forecast_session", "instrument_id", "horizon"], "left")
    wanted = F.when(F.col("assumed_regime") == "today", F.coalesce("regime", F.lit("all"))).otherwise(F.col("assumed_regime"))
    found = found.withColumn("regime_used", F.when(wanted.isin(*REGIMES), wanted).otherwise("all"))
    found = found.join(grid.select("horizon", F.col("regime").alias("regime_used"), "levels", "quantiles", "band_q"), ["horizon", "regime_used"], "left")
    ok = ~F.coalesce("withheld", F.lit(False)) & F.col("scale").isNotNull() & F.col("quantiles").isNotNull()
    prob = 1 - interpolate(-F.col("expected_return") / F.col("scale"), F.col("quantiles"), F.col("levels"))
    band = F.col("band_q") * F.col("scale")
    values = {"status": F.when(ok, "pinned").otherwise("no_estimate"), "prob_up": F.when(ok, F.round(prob, 6)), "band_low": F.when(ok, F.round(F.col("expected_return") - band, 6)), "band_high": F.when(ok, F.round(F.col("expected_return") + band, 6))}
    return found.withColumns(values).select("id", "instrument_id", "horizon", "status", "forecast_session", "regime_used", "prob_up", "band_low", "band_high", F.round("baseline_prob", 6).alias("baseline_prob"), "target_session")


def interpolate(x, xs, ys):
    """Piecewise linear between the points of two arrays; 0 left of the first and 1 right of the last."""
    below = F.size(F.filter(xs, lambda q: q <= x))
    last = F.size(xs)
    x0, x1 = F.try_element_at(xs, below), F.try_element_at(xs, below + 1)
    y0, y1 = F.try_element_at(ys, below), F.try_element_at(ys, below + 1)
    inside = y0 + F.coalesce(ratio(x - x0, x1 - x0), F.lit(0.0)) * (y1 - y0)
    return F.when(x.isNull(), None).when(below == 0, F.lit(0.0)).when((below == last) & (x > F.element_at(xs, -1)), F.lit(1.0)).when(below == last, F.element_at(ys, -1)).otherwise(inside)


def ticker_on(rows: DataFrame, history: DataFrame, universe: DataFrame) -> DataFrame:
    """Add ticker: the one valid on the row's day, else the current one."""
    spans = history.select("instrument_id", F.col("ticker").alias("__old"), "valid_from", "valid_to")
    now = universe.select("instrument_id", F.col("ticker").alias("__now"))
    keyed = rows.select("instrument_id", "date").distinct()
    valid = (F.col("valid_from") <= F.col("date")) & (F.col("valid_to").isNull() | (F.col("date") <= F.col("valid_to")))
    found = keyed.join(spans, "instrument_id").where(valid).groupBy("instrument_id", "date").agg(F.max_by("__old", "valid_from").alias("__old"))
    return rows.join(found, ["instrument_id", "date"], "left").join(now, "instrument_id", "left").withColumn("ticker", F.coalesce("__old", "__now")).drop("__old", "__now")
