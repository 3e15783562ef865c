"""Paired comparison of a model and its baseline: daily cells, bootstrap, correction, verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import brier, covered, hit
from tidemark.operators.bootstrap import resampled, uniform, z_of_p_sql

LEAST, SIGNIFICANT = 30, 0.05
MARGIN, COVERAGE_TOLERANCE, NOMINAL = 0.005, 0.02, 0.90
REPS, SEED = 2000, 7
CORE_HORIZONS = (5, 20, 60)
#: Metrics for which less is better.
LOSSES = ("brier", "rmse")


def family(horizon: Column) -> Column:
    """Horizons added later are corrected apart, so that they change no verdict already given."""
    return F.when(horizon.isin(*CORE_HORIZONS), "core").otherwise("extended")


def scored_long(outcomes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each outcome and metric: keys, day, metric, model, base."""
    y = F.col("actual_return")
    metric = lambda name, model, base: F.struct(F.lit(name).alias("metric"), model.cast("double").alias("model"), base.cast("double").alias("base"))
    metrics = F.array(
        metric("direction_accuracy", hit(F.col("prob_up"), y), hit(F.col("baseline_prob"), y)),
        metric("brier", brier(F.col("prob_up"), y), brier(F.col("baseline_prob"), y)),
        metric("coverage", covered(F.col("band_low"), F.col("band_high"), y), F.lit(NOMINAL)),
    )
    return outcomes.select(*keys, F.col("session").alias("day"), F.explode(metrics).alias("m")).select(*keys, "day", "m.*")


def daily_cells(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key and day: n, sums of the model, the baseline and their difference, and its squares. All a bootstrap needs."""
    d = F.col("model") - F.col("base")
    return long.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("n"), F.sum("model").alias("model"), F.sum("base").alias("base"), F.sum(d).alias("d"), F.sum(d * d).alias("dd"))


def with_all_regimes(rows: DataFrame, keys: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """Grouping sets (keys) and (keys, regime): the rows of all regimes together, named all, and of each. A null regime is in all only."""
    grouped = rows.groupingSets([[*map(F.col, keys)], [*map(F.col, keys), F.col("regime")]], *keys, "regime")
    found = grouped.agg(F.grouping("regime").alias("__all"), *values)
    named = found.withColumn("regime", F.when(F.col("__all") == 1, "all").otherwise(F.col("regime")))
    return named.where("regime is not null").drop("__all")


def each_regime(rows: DataFrame) -> DataFrame:
    """Every row as regime all, and once more under its own."""
    both = F.array_compact(F.array(F.lit("all"), F.col("regime")))
    return rows.withColumn("regime", F.explode(both))


def compared(cells: DataFrame, keys: Sequence[str], horizon: str | int = "horizon", reps: int = REPS, seed: int = SEED) -> DataFrame:
    """From daily cells to one comparison a key: value, baseline_value, delta, n, n_eff, p_value, by stationary block bootstrap."""
    return resampled(cells, keys, F.lit(horizon) if isinstance(horizon, int) else F.col(horizon), reps, seed)


def corrected(comparisons: DataFrame, partition: Sequence[str], horizon: str = "horizon") -> DataFrame:
    """Add p_value_fdr and n_tests: Benjamini-Hochberg in each family. A missing p counts as a test but isn't corrected."""
    keys = [*partition, "__family"]
    named = comparisons.withColumn("__family", family(F.col(horizon)))
    everyone = Window.partitionBy(*keys)
    ordered = Window.partitionBy(*keys, F.col("p_value").isNull()).orderBy("p_value")
    m = F.count("p_value").over(everyone)
    raw = named.withColumns({"n_tests": F.count(F.lit(1)).over(everyone), "__raw": F.col("p_value") * m / F.row_number().over(ordered)})
    # Equal p-values end up equal: the running minimum from the largest covers ties.
    rising = Window.partitionBy(*keys, F.col("p_value").isNull()).orderBy("p_value").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    return raw.withColumn("p_value_fdr", F.when(F.col("p_value").isNotNull(), F.least(F.lit(1.0), F.min("__raw").over(rising)))).drop("__raw", "__family")


def verdict(metric: Column, p: str = "p_value_fdr") -> Column:
    """too_early, better_significant, same, better_not_significant or worse."""
    better = F.when(metric.isin(*LOSSES), -F.col("delta")).otherwise(F.col("delta"))
    significant = F.coalesce((F.col(p) < SIGNIFICANT) & (F.col("n_eff") >= LEAST), F.lit(False))
    coverage = F.when(F.abs("delta") <= COVERAGE_TOLERANCE, "same").otherwise("worse")
    ladder = F.when((better > 0) & significant, "better_significant").when(F.abs(better) < MARGIN, "same").when(better >= MARGIN, "better_not_significant").otherwise("worse")
    return F.when(F.col("n") < LEAST, "too_early").when(metric == "coverage", coverage).otherwise(ladder)


def observations_needed(power_80: bool = True) -> Column:
    """How many observations would show the measured difference at the 5 % level."""
    z = 1.959963985 + (0.841621234 if power_80 else 1.281551566)
    deviation = F.abs("delta") / F.greatest(F.expr(z_of_p_sql("p_value")), F.lit(1e-6)) * F.sqrt("n_eff")
    none = (F.col("delta") == 0) | F.col("n_eff").isNull() | (F.col("n_eff") < 2)
    return F.when(none, F.lit(0)).otherwise(F.ceil(F.pow(z * deviation / F.abs("delta"), 2))).cast("long")


def records(long: DataFrame, keys: Sequence[str], partition: Sequence[str]) -> DataFrame:
    """Comparisons with correction, verdict and the observations needed. ``keys`` hold metric and horizon."""
    found = corrected(compared(daily_cells(long, keys), keys), partition)
    return found.withColumns({"verdict": verdict(F.col("metric")), "observations_needed": observations_needed()})


def arena_long(signals: DataFrame, prices: DataFrame, horizons: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """One row for each signal whose horizon has closed: keep, rule, direction, horizon, day, model (its hit), base (the usual direction's)."""
    from tidemark.operators.returns import forward_direction, usual_direction

    parts = None
    for h in horizons:
        outcomes = forward_direction(prices, h)
        usual = usual_direction(outcomes).select("instrument_id", "usual_up")
        joined = signals.join(outcomes, ["instrument_id", "date"]).join(usual, "instrument_id")
        rows = joined.select(*keep, "rule", "direction", F.lit(h).alias("horizon"), F.col("date").alias("day"), (F.col("up") == (F.col("direction") == "long")).cast("double").alias("model"), (F.col("up") == F.col("usual_up")).cast("double").alias("base"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def arena(signals: DataFrame, prices: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Every rule at every horizon against the instrument's usual direction, corrected over rules and horizons."""
    keys = ["rule", "direction", "horizon"]
    found = corrected(compared(daily_cells(arena_long(signals, prices, horizons), keys), keys), [])
    return found.withColumn("verdict", verdict(F.lit("direction_accuracy"))).orderBy("horizon", F.col("delta").desc(), "rule")


def hardest_baseline(records: DataFrame, metric: str = "direction_accuracy") -> DataFrame:
    """Of each horizon's records over all regimes the one whose baseline leaves the smallest difference."""
    rows = records.where((F.col("metric") == metric) & (F.col("regime") == "all"))
    others = [c for c in records.columns if c != "horizon"]
    return rows.groupBy("horizon").agg(F.min_by(F.struct(*others), F.struct("delta", "baseline")).alias("r")).select("horizon", "r.*")


def random_control(rows: DataFrame, id_col: str, low: float = 0.3, high: float = 0.7, seed: int = SEED) -> DataFrame:
    """Replace prob_up by a uniform number that depends on seed and id alone."""
    u = uniform(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col))))
    return rows.withColumn("prob_up", low + (high - low) * u)


def calibration_table(scored: DataFrame, width: float = 0.05) -> DataFrame:
    """horizon, bin, n, mean_prob, up_share by probability bins."""
    cell = F.round(F.floor(F.round(F.col("prob_up") / width, 9)) * width, 6)
    return scored.groupBy("horizon", cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("prob_up").alias("mean_prob"), F.avg((F.col("actual_return") > 0).cast("double")).alias("up_share"))


def daily_table(scored: DataFrame) -> DataFrame:
    """horizon, session, n and the day's mean scores."""
    y = F.col("actual_return")
    return scored.groupBy("horizon", "session").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(hit(F.col("prob_up"), y)).alias("hit"),
        F.avg(brier(F.col("prob_up"), y)).alias("brier"),
        F.avg(covered(F.col("band_low"), F.col("band_high"), y)).alias("covered"),
        F.avg(hit(F.col("baseline_prob"), y)).alias("baseline_hit"),
    )
