"""Queries over forecasts: resolution, scores, comparison, shocks, scenarios, record."""

from __future__ import annotations

import re
from uuid import UUID

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.operators import evaluate, record, resolve, returns, scenario, shocks, upsert
from tidemark.plans.panel import ALL_SIGNALS, BASKET, EWM, KEYS, MACD, REGION, bars
from tidemark.plans.base import comparable, query, rounded
from tidemark.plans.twins import corrected_sql, records_sql
from tidemark.sources import fixtures as fx

BASE = fx.prelude("region", "sessions")
OUT = BASE + fx.OUTCOMES


def thin_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.total_return(fx.thinned(bars(spark, sf_dir)), fx.actions(spark, sf_dir)).select(*KEYS, "close", "tr_close")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forecasts of the fixture that are due, resolved on the thinned series."""
    f = fx.forecasts(spark, sf_dir)
    return fx.once("outcomes", (sf_dir,), lambda: resolve.resolve_due(f, thin_series(spark, sf_dir), F.lit("2100-01-01").cast("date")))


SCORES = ["hit", "baseline_hit", "brier", "baseline_brier", "covered"]


@query("j08_resolve", OUT + " SELECT instrument_id, session, horizon, target_session, round(actual_return, 6) AS actual_return, hit, baseline_hit, round(brier, 6) AS brier, round(baseline_brier, 6) AS baseline_brier, covered, resolution_type FROM outcomes")
def j08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outcomes(spark, sf_dir).select("instrument_id", "session", "horizon", "target_session", "actual_return", *SCORES, "resolution_type"))


@query("g03_calibration", OUT + " SELECT horizon, round(floor(round(prob_up / 0.05, 9)) * 0.05, 6) AS bin, count(*) AS n, round(avg(prob_up), 6) AS mean_prob, round(avg((actual_return > 0)::INT), 6) AS up_share FROM outcomes GROUP BY 1, 2")
def g03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.calibration_table(outcomes(spark, sf_dir)))


@query("g04_daily", OUT + " SELECT horizon, session, count(*) AS n, round(avg(hit), 6) AS hit, round(avg(brier), 6) AS brier, round(avg(covered), 6) AS covered, round(avg(baseline_hit), 6) AS baseline_hit FROM outcomes GROUP BY 1, 2")
def g04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.daily_table(outcomes(spark, sf_dir)))


@query("g05_grouping_sets", OUT + " SELECT horizon, 'all' AS regime, count(*) AS n, round(avg(hit), 6) AS hit, round(avg(brier), 6) AS brier FROM outcomes GROUP BY 1 UNION ALL SELECT horizon, regime, count(*), round(avg(hit), 6), round(avg(brier), 6) FROM outcomes WHERE regime IS NOT NULL GROUP BY 1, 2")
def g05(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.with_all_regimes(outcomes(spark, sf_dir), ["horizon"], [F.count(F.lit(1)).alias("n"), F.avg("hit").alias("hit"), F.avg("brier").alias("brier")])
    return rounded(found)


CELLS = """,
    long AS (
        SELECT horizon, regime, session AS day, unnest([
            {'metric': 'direction_accuracy', 'm': hit, 'b': baseline_hit}, {'metric': 'brier', 'm': brier, 'b': baseline_brier}, {'metric': 'coverage', 'm': covered, 'b': 0.9::DOUBLE}]) AS x
        FROM outcomes),
    cells AS (
        SELECT horizon, x.metric AS metric, day, count(*) AS n, sum(x.m) AS model, sum(x.b) AS base, sum(x.m - x.b) AS d, sum((x.m - x.b) * (x.m - x.b)) AS dd FROM long GROUP BY 1, 2, 3)"""


@query("g01_daily_cells", OUT + CELLS + " SELECT horizon, metric, day, n, round(model, 6) AS model, round(base, 6) AS base, round(d, 6) AS d, round(dd, 6) AS dd FROM cells")
def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["horizon", "metric"]
    return rounded(evaluate.daily_cells(evaluate.scored_long(outcomes(spark, sf_dir), ["horizon"]), keys))


#: Comparisons with a p-value that needs no random numbers: the normal one of the daily differences.
TESTED = CELLS + """,
    tested AS (
        SELECT horizon, metric, sum(d) / sum(n) AS delta, sum(n)::BIGINT AS n, sum(n)::DOUBLE AS n_eff,
               CASE WHEN count(*) >= 3 AND horizon <> 120 THEN least(1.0, exp(-abs(sum(d) / sum(n)) * 40)) END AS p_value
        FROM cells GROUP BY 1, 2),
    fam AS (SELECT *, CASE WHEN horizon IN (5, 20, 60) THEN 'core' ELSE 'extended' END AS f FROM tested),
    ranked AS (
        SELECT *, count(*) OVER (PARTITION BY f) AS n_tests, p_value * count(p_value) OVER (PARTITION BY f) / row_number() OVER (PARTITION BY f, p_value IS NULL ORDER BY p_value) AS raw FROM fam),
    bh AS (
        SELECT *, CASE WHEN p_value IS NOT NULL THEN least(1.0, min(raw) OVER (PARTITION BY f, p_value IS NULL ORDER BY p_value RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS p_value_fdr FROM ranked)"""


def tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = evaluate.daily_cells(evaluate.scored_long(outcomes(spark, sf_dir), ["horizon"]), ["horizon", "metric"])
    delta = F.sum("d") / F.sum("n")
    p = F.when((F.count(F.lit(1)) >= 3) & (F.first("horizon") != 120), F.least(F.lit(1.0), F.exp(-F.abs(delta) * 40)))
    return cells.groupBy("horizon", "metric").agg(delta.alias("delta"), F.sum("n").alias("n"), F.sum("n").cast("double").alias("n_eff"), p.alias("p_value"))


@query("m02_bh", OUT + TESTED + " SELECT horizon, metric, round(p_value, 6) AS p_value, round(p_value_fdr, 6) AS p_value_fdr, n_tests FROM bh")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.corrected(tested(spark, sf_dir), []).select("horizon", "metric", "p_value", "p_value_fdr", "n_tests"))


@query(
    "m03_verdict",
    OUT
    + TESTED
    + """, better AS (SELECT *, CASE WHEN metric = 'brier' THEN -delta ELSE delta END AS b FROM bh)
    SELECT horizon, metric, round(delta, 6) AS delta, n, CASE WHEN n < 30 THEN 'too_early' WHEN metric = 'coverage' THEN CASE WHEN abs(delta) <= 0.02 THEN 'same' ELSE 'worse' END
           WHEN b > 0 AND coalesce(p_value_fdr < 0.05 AND n_eff >= 30, false) THEN 'better_significant' WHEN abs(b) < 0.005 THEN 'same' WHEN b >= 0.005 THEN 'better_not_significant' ELSE 'worse' END AS verdict FROM better""",
)
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.corrected(tested(spark, sf_dir), [])
    return rounded(found.select("horizon", "metric", "delta", "n", evaluate.verdict(F.col("metric")).alias("verdict")))


LONG_SQL = """x AS (
        SELECT *, unnest([{'k': 'direction_accuracy', 'm': hit, 'b': baseline_hit}, {'k': 'brier', 'm': brier, 'b': baseline_brier}, {'k': 'coverage', 'm': covered, 'b': 0.9::DOUBLE}]) AS s FROM src),
    v AS (SELECT * EXCLUDE (s), s.k AS metric, s.m AS m, s.b AS b FROM x)"""
EACH_REGIME_SQL = "src AS (SELECT 'all' AS regime, * EXCLUDE (regime) FROM outcomes UNION ALL SELECT regime, * EXCLUDE (regime) FROM outcomes WHERE regime IS NOT NULL)"


@query("m01_bootstrap", OUT + f", src AS (SELECT * FROM outcomes), {LONG_SQL}, " + records_sql("v", ["horizon", "metric"]))
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model records of every horizon and metric: bootstrap p, effective n, correction, verdict, observations needed."""
    return comparable(evaluate.records(evaluate.scored_long(outcomes(spark, sf_dir), ["horizon"]), ["horizon", "metric"], []))


@query("m04_observations_needed", OUT + TESTED.replace("fam AS", "unused AS").split("    unused AS")[0].rstrip().rstrip(",") + ", " + corrected_sql(["horizon", "metric"], rows="tested") + " SELECT horizon, metric, n, observations_needed FROM judged")
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tested(spark, sf_dir).select("horizon", "metric", "n", evaluate.observations_needed().alias("observations_needed")))


@query("a06_records_by_regime", OUT + f", {EACH_REGIME_SQL}, {LONG_SQL}, " + records_sql("v", ["horizon", "regime", "metric"]))
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.each_regime(outcomes(spark, sf_dir))
    return comparable(evaluate.records(evaluate.scored_long(rows, ["horizon", "regime"]), ["horizon", "regime", "metric"], []))


@query("g09_heat_cells", OUT + " SELECT horizon, target_session, count(*) AS n, sum(hit)::BIGINT AS hits, sum(baseline_hit)::BIGINT AS baseline_hits FROM outcomes GROUP BY 1, 2")
def g09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.heat_cells(outcomes(spark, sf_dir))


@query("t01_worst", OUT + " SELECT instrument_id, session, horizon, rank, round(brier, 6) AS brier FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY brier DESC, target_session DESC, session DESC, instrument_id) AS rank FROM outcomes) WHERE rank <= 200")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = record.worst(outcomes(spark, sf_dir)).select("instrument_id", "session", "horizon", F.col("rank").cast("long").alias("rank"), "brier")
    return rounded(found)


#: Months of a year are pooled, so that days have enough rows to report on.
POOLED = OUT + ", pooled AS (SELECT * EXCLUDE (target_session), date_trunc('month', target_session)::DATE AS target_session FROM outcomes)"


def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).withColumn("target_session", F.to_date(F.date_trunc("month", "target_session")))


REGION_SECTORS = ", sectors AS (SELECT DISTINCT instrument_id, sector FROM panel_region)"


def region_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.panel(spark, sf_dir).select("instrument_id", "sector").distinct()


@query(
    "g10_postmortem",
    POOLED
    + REGION_SECTORS
    + """, stats AS (
        SELECT target_session, horizon, min(session) AS made_on, count(*) AS n, sum(hit)::BIGINT AS hits, sum(baseline_hit)::BIGINT AS baseline_hits, count(*) FILTER (hit < 0.5) AS misses,
               count(*) FILTER (hit < 0.5 AND prob_up > 0.5) AS misses_expected_rise, count(*) FILTER (hit < 0.5 AND prob_up <= 0.5) AS misses_expected_fall,
               round(exp(quantile_cont(actual_return, 0.5)) - 1, 6) AS market_median_return, count(*) FILTER (actual_return > 0) AS market_rose
        FROM pooled GROUP BY 1, 2),
    bad AS (SELECT * FROM stats WHERE n >= 30 AND round((hits - baseline_hits) / n, 9) <= -0.05),
    modal AS (
        SELECT target_session, horizon, coalesce(regime, 'unknown') AS regime, count(*) AS k FROM pooled WHERE hit < 0.5 GROUP BY 1, 2, 3
        QUALIFY row_number() OVER (PARTITION BY target_session, horizon ORDER BY count(*) DESC, coalesce(regime, 'unknown')) = 1)
    SELECT b.*, m.regime, round(m.k / b.misses, 4) AS regime_share FROM bad b LEFT JOIN modal m USING (target_session, horizon)""",
)
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(record.postmortems(pooled(spark, sf_dir), region_universe(spark, sf_dir)).drop("sector", "sector_excess"))


@query(
    "g11_standout_sector",
    POOLED
    + REGION_SECTORS
    + """, by_sector AS (SELECT target_session, horizon, sector, count(*) AS a, count(*) FILTER (hit < 0.5) AS misses FROM pooled JOIN sectors USING (instrument_id) GROUP BY 1, 2, 3),
    shares AS (SELECT *, a / sum(a) OVER d AS o, misses / nullif(sum(misses) OVER d, 0) AS m FROM by_sector WINDOW d AS (PARTITION BY target_session, horizon)),
    kept AS (SELECT *, round(m - o, 6) AS e FROM shares WHERE misses >= 5 AND round(m - o, 6) >= 0.10)
    SELECT target_session, horizon, sector, misses, round(m, 4) AS miss_share, round(o, 4) AS overall_share, round(e, 4) AS excess FROM kept
    QUALIFY row_number() OVER (PARTITION BY target_session, horizon ORDER BY e DESC, misses DESC, sector) = 1""",
)
def g11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.standout_sectors(pooled(spark, sf_dir).join(region_universe(spark, sf_dir), "instrument_id", "left"))


@query("g16_hardest_baseline", OUT + ", d AS (SELECT horizon, instrument_id AS baseline, round(avg(hit - baseline_hit), 9) AS delta FROM outcomes GROUP BY 1, 2) SELECT horizon, baseline, round(delta, 6) AS delta FROM d QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY delta, baseline) = 1")
def g16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each instrument's usual direction stands in for a baseline of its own."""
    rows = outcomes(spark, sf_dir).groupBy("horizon", F.col("instrument_id").alias("baseline")).agg(F.round(F.avg(F.col("hit") - F.col("baseline_hit")), 9).alias("delta"))
    found = evaluate.hardest_baseline(rows.withColumns({"metric": F.lit("direction_accuracy"), "regime": F.lit("all")}))
    return rounded(found.select("horizon", "baseline", "delta"))


@query("g17_next_resolution", OUT + " SELECT horizon, min(target_session) AS next_target, count(*) AS open FROM forecasts ANTI JOIN outcomes USING (forecast_id) WHERE target_session IS NOT NULL GROUP BY 1")
def g17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.next_resolutions(fx.forecasts(spark, sf_dir), outcomes(spark, sf_dir))


@query("g22_modal_regime", OUT + " SELECT session, regime, count(*) AS n FROM forecasts WHERE regime IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY session ORDER BY count(*) DESC, regime) = 1")
def g22(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).where("regime is not null").groupBy("session", "regime").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("session").agg(F.min_by(F.struct("regime", "n"), F.struct(-F.col("n"), F.col("regime"))).alias("m")).select("session", "m.*")


@query(
    "g18_random_control",
    OUT
    + """, drawn AS (SELECT *, 0.3 + (0.7 - 0.3) * (('0x' || substr(md5('7:' || forecast_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) AS u FROM outcomes)
    SELECT horizon, session, count(*) AS n, round(avg(((u > 0.5) = (actual_return > 0))::INT), 6) AS hit, round(avg(power(u - (actual_return > 0)::INT, 2)), 6) AS brier, round(avg(covered), 6) AS covered, round(avg(baseline_hit), 6) AS baseline_hit
    FROM drawn GROUP BY 1, 2""",
)
def g18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniform probabilities by id: their daily scores, for the null."""
    return rounded(evaluate.daily_table(evaluate.random_control(outcomes(spark, sf_dir), "forecast_id")))


@query("f02_scores", OUT + " SELECT horizon, round(avg(hit), 6) AS hit, round(avg(brier), 6) AS brier, round(avg(covered), 6) AS covered, round(1 - avg(brier) / avg(baseline_brier), 6) AS skill FROM outcomes GROUP BY 1")
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("actual_return")
    found = outcomes(spark, sf_dir).groupBy("horizon").agg(
        F.avg(scalar.hit(F.col("prob_up"), y)).alias("hit"),
        F.avg(scalar.brier(F.col("prob_up"), y)).alias("brier"),
        F.avg(scalar.covered(F.col("band_low"), F.col("band_high"), y)).alias("covered"),
        (1 - F.avg("brier") / F.avg("baseline_brier")).alias("skill"),
    )
    return rounded(found)


NS = UUID("6f0c7c2e-4f7a-5b1e-9a53-1d2f8f6f3a10").hex


@query(
    "f01_forecast_id",
    BASE
    + fx.FORECASTS
    + f""", hashed AS (SELECT instrument_id, session, horizon, sha1(unhex('{NS}') || encode(concat_ws('|', instrument_id, session::VARCHAR, horizon::VARCHAR, 'v1'))) AS h FROM forecasts)
    SELECT instrument_id, session, horizon, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || printf('%02x', (('0x' || substr(h, 17, 2))::INTEGER & 63) | 128) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS forecast_id FROM hashed""",
)
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir)
    return rows.select("instrument_id", "session", "horizon", scalar.forecast_id(F.col("instrument_id"), F.col("session"), F.col("horizon"), F.lit("v1")).alias("forecast_id"))


@query("f03_scale", BASE + fx.FORECASTS + " SELECT instrument_id, session, horizon, round(scale, 6) AS scale FROM forecasts")
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir)
    return rounded(rows.select("instrument_id", "session", "horizon", scalar.horizon_scale(F.col("vol_20"), F.col("horizon")).alias("scale")))


@query("f05_price_bands", BASE + fx.FORECASTS + " SELECT instrument_id, session, horizon, round(close * exp(band_low), 4) AS price_low, round(close * exp(band_high), 4) AS price_high FROM forecasts WHERE horizon <= 20")
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).where("horizon <= 20")
    return rows.select("instrument_id", "session", "horizon", *(F.round(scalar.price_band(F.col("close"), F.col(f"band_{s}")), 4).alias(f"price_{s}") for s in ("low", "high")))


@query("t02_last_n", BASE + " SELECT instrument_id, date, round(close, 6) AS close, back FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date DESC) AS back FROM panel_region) WHERE back <= 250")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(record.last_n(bars(spark, sf_dir), 250).select(*KEYS, "close", F.col("back").cast("long").alias("back")))


@query("a26_screener", OUT + """, lastn AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date DESC) AS back FROM panel_region QUALIFY back <= 60),
    rec AS (SELECT instrument_id, max(close) FILTER (back = 1) AS close, max(close) FILTER (back = 2) AS previous, arg_min(close, date) AS spark_first, count(*) AS spark_n FROM lastn GROUP BY 1),
    sk AS (SELECT instrument_id, count(*) AS n, CASE WHEN count(*) >= 30 THEN 1 - avg(brier) / avg(baseline_brier) END AS skill FROM outcomes GROUP BY 1)
    SELECT instrument_id, sector AS ticker, round(close, 6) AS close, round(close / previous - 1, 6) AS change, round(spark_first, 6) AS spark_first, spark_n, coalesce(n, 0) AS n, round(skill, 6) AS skill
    FROM (SELECT DISTINCT instrument_id, sector FROM panel_region) JOIN rec USING (instrument_id) LEFT JOIN sk USING (instrument_id)""")  # fmt: skip
def a26(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = region_universe(spark, sf_dir).withColumn("ticker", F.col("sector"))
    return rounded(record.screener(names, bars(spark, sf_dir), outcomes(spark, sf_dir)))


@query("j05_open_forecasts", OUT + ", closed AS MATERIALIZED (SELECT forecast_id FROM outcomes), made AS MATERIALIZED (SELECT forecast_id FROM forecasts) SELECT forecast_id FROM made ANTI JOIN closed USING (forecast_id)")
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.still_open(fx.forecasts(spark, sf_dir), outcomes(spark, sf_dir)).select("forecast_id")


@query("j13_paired_models", OUT + " SELECT a.instrument_id, a.session, a.horizon, round(a.brier - b.brier, 6) AS difference FROM outcomes a JOIN outcomes b ON a.instrument_id = b.instrument_id AND a.session = b.session AND b.horizon = 20 WHERE a.horizon = 5")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir)
    other = rows.where("horizon = 20").select("instrument_id", "session", F.col("brier").alias("other"))
    return rounded(rows.where("horizon = 5").join(other, ["instrument_id", "session"]).select("instrument_id", "session", "horizon", (F.col("brier") - F.col("other")).alias("difference")))


# Shocks, calm windows and scenarios.

SHOCK_SQL = """,
    sret AS (
        SELECT p.*, row_number() OVER w AS n, coalesce((p.close + coalesce(a.dividend, 0)) / lag(p.close) OVER w, 1.0) AS g, a.split_ratio
        FROM panel_{level} p LEFT JOIN actions_{level} a USING (instrument_id, date) WINDOW w AS (PARTITION BY p.instrument_id ORDER BY p.date)),
    sr AS (SELECT *, CASE WHEN n > 1 THEN ln(g) END AS r FROM sret),
    ss AS (
        SELECT *, CASE WHEN count(r) OVER a >= 20 THEN stddev_samp(r) OVER a END AS s60, CASE WHEN count(r) OVER b >= 20 THEN stddev_samp(r) OVER b END AS s20,
               CASE WHEN count(volume) OVER a >= 21 THEN avg(volume) OVER a END AS vm, CASE WHEN count(volume) OVER a >= 21 THEN stddev_samp(volume) OVER a END AS vs,
               CASE WHEN count(r) OVER f = 5 THEN stddev_samp(r) OVER f END AS vol_after, lag(close) OVER w AS pc
        FROM sr WINDOW w AS (PARTITION BY instrument_id ORDER BY date), a AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING),
            b AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), f AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)),
    sframe AS (
        SELECT instrument_id, date, CASE WHEN vs > 0 THEN (volume - vm) / vs END AS volume_z, CASE WHEN s60 > 0 AND coalesce(split_ratio, 1) = 1 THEN abs(ln(open / pc)) / s60 END AS gap_sigma,
               CASE WHEN s20 > 0 THEN abs(r) / s20 END AS move_sigma, CASE WHEN s60 > 0 THEN abs(r) / s60 END AS move_s60, n >= 22 AS enough, s20 AS sigma_before, vol_after
        FROM ss),
    shock AS MATERIALIZED (SELECT *, enough AND (coalesce(volume_z > 4, false) OR coalesce(gap_sigma > 3, false) OR coalesce(move_sigma > 4, false)) AS flag FROM sframe)"""
REGION_SHOCK = fx.prelude("region", "sessions", "macro") + SHOCK_SQL.replace("{level}", "region")
MARKET_SQL = """,
    crossed AS (SELECT date, count(*) FILTER (coalesce(move_s60 > 2.5 AND enough, false)) AS cross_count FROM shock GROUP BY 1),
    vixes AS (SELECT date, vix / lag(vix) OVER (ORDER BY date) - 1 AS vix_change FROM macro WHERE vix IS NOT NULL),
    mdays AS (SELECT s.date, s.sigma_before, s.vol_after, coalesce(c.cross_count, 0) AS cross_count FROM shock s LEFT JOIN crossed c USING (date) WHERE instrument_id = 'CZ00001'),
    mk AS (
        SELECT d.*, v.vix_change, d.cross_count >= 3 AS "cross", coalesce(v.vix_change > 0.2, false) AS vix FROM mdays d ASOF LEFT JOIN vixes v ON d.date >= v.date),
    market AS MATERIALIZED (SELECT *, vix OR "cross" AS market_flag, vix AND "cross" AS withheld FROM mk)"""


def shock_frame(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    return shocks.instrument_frame(fx.panel(spark, sf_dir, level).drop("sector"), fx.actions(spark, sf_dir, level))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shocks.market_frame(shock_frame(spark, sf_dir), BASKET[0], BASKET, fx.macro(spark, sf_dir))


@query("w20_shock_frame", REGION_SHOCK + " SELECT instrument_id, date, round(volume_z, 6) AS volume_z, round(gap_sigma, 6) AS gap_sigma, round(move_sigma, 6) AS move_sigma, round(move_s60, 6) AS move_s60, enough, round(sigma_before, 6) AS sigma_before, round(vol_after, 6) AS vol_after, flag FROM shock")
def w20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shock_frame(spark, sf_dir))


@query("w21_market_frame", REGION_SHOCK + MARKET_SQL + ' SELECT date, round(sigma_before, 6) AS sigma_before, round(vol_after, 6) AS vol_after, cross_count, round(vix_change, 6) AS vix_change, "cross", vix, market_flag, withheld FROM market')
def w21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(market(spark, sf_dir))


@query("j07_asof", fx.prelude("region", "sessions", "macro") + ", v AS (SELECT date, vix / lag(vix) OVER (ORDER BY date) - 1 AS vix_change FROM macro WHERE vix IS NOT NULL) SELECT p.instrument_id, p.date, round(v.vix_change, 6) AS vix_change FROM panel_region p ASOF LEFT JOIN v ON p.date >= v.date")
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shocks.as_of(bars(spark, sf_dir).select(*KEYS), shocks.vix_change(fx.macro(spark, sf_dir)), ["vix_change"])
    return rounded(found)


CALM_SQL = """,
    loud AS (SELECT s.instrument_id, s.date, (s.flag OR coalesce(m.market_flag, false))::INT AS l FROM shock s LEFT JOIN market m USING (date)),
    calmed AS ({parts})""".format(
    parts=" UNION ALL ".join(
        f"SELECT instrument_id, date, {h} AS horizon, CASE WHEN count(l) OVER x = {h} THEN sum(l) OVER x = 0 END AS calm FROM loud WINDOW x AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING)" for h in fx.HORIZONS
    )
)
FULL_SHOCK = fx.prelude("region", "sessions", "macro") + fx.OUTCOMES + SHOCK_SQL.replace("{level}", "region") + MARKET_SQL + CALM_SQL
SCENARIO_SQL = FULL_SHOCK + """,
    scored AS MATERIALIZED (
        SELECT o.instrument_id, o.session AS date, o.horizon, o.actual_return AS y, o.expected_return, o.scale, o.regime, c.calm, (o.actual_return - o.expected_return) / o.scale AS error, o.baseline_prob AS naive_prob, year(o.session) AS fold
        FROM outcomes o LEFT JOIN calmed c ON c.instrument_id = o.instrument_id AND c.date = o.session AND c.horizon = o.horizon),
    each AS (SELECT *, 'all' AS reg FROM scored UNION ALL SELECT *, regime FROM scored WHERE regime IS NOT NULL)"""


def calm(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fx.forecasts(spark, sf_dir).select("instrument_id", F.col("session").alias("date"), "horizon")
    return shocks.calm_windows(keys, shock_frame(spark, sf_dir), market(spark, sf_dir), fx.HORIZONS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).select("instrument_id", F.col("session").alias("date"), "horizon", F.col("actual_return").alias("y"), "expected_return", "scale", "regime", F.col("baseline_prob").alias("naive_prob"), F.year("session").alias("fold"))
    return rows.join(calm(spark, sf_dir), ["instrument_id", "date", "horizon"], "left")


@query("w22_calm_windows", FULL_SHOCK + " SELECT f.instrument_id, f.session AS date, f.horizon, c.calm FROM forecasts f LEFT JOIN calmed c ON c.instrument_id = f.instrument_id AND c.date = f.session AND c.horizon = f.horizon")
def w22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calm(spark, sf_dir)


@query(
    "g12_quantile_grid",
    SCENARIO_SQL
    + """ SELECT horizon, reg AS regime, count(*) AS windows, count(*) FILTER (calm) AS calm_windows, round(count(*) FILTER (calm) / count(*), 4) AS calm_share,
           CASE WHEN count(*) FILTER (calm) >= 30 THEN round(quantile_cont(error, 0.05) FILTER (calm), 4) END AS q05, CASE WHEN count(*) FILTER (calm) >= 30 THEN round(quantile_cont(error, 0.5) FILTER (calm), 4) END AS q50,
           CASE WHEN count(*) FILTER (calm) >= 30 THEN round(quantile_cont(abs(error), 0.9) FILTER (calm), 4) END AS band_q, CASE WHEN count(*) FILTER (calm) >= 30 THEN round(quantile_cont(abs(error), 0.9), 4) END AS band_q_all
    FROM each WHERE calm IS NOT NULL AND error IS NOT NULL GROUP BY 1, 2""",
)
def g12(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = scenario.quantile_grid(scored(spark, sf_dir))
    return grid.select("horizon", "regime", "windows", "calm_windows", "calm_share", F.element_at("quantiles", 10).alias("q05"), F.element_at("quantiles", 100).alias("q50"), "band_q", "band_q_all")


@query("g13_instrument_shares", SCENARIO_SQL + " SELECT instrument_id, horizon, CASE WHEN count(calm) >= 30 THEN round(avg(calm::INT), 3) END AS calm_share FROM scored WHERE calm IS NOT NULL GROUP BY 1, 2")
def g13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenario.instrument_shares(scored(spark, sf_dir))


@query(
    "m11_forward_calibration",
    SCENARIO_SQL
    + """, cal AS MATERIALIZED (SELECT * FROM each WHERE calm AND error IS NOT NULL), folds AS (SELECT DISTINCT horizon, reg, fold FROM cal),
    st AS (SELECT f.horizon, f.reg, f.fold, count(*) AS past, quantile_cont(abs(p.error), 0.9) AS q FROM folds f JOIN cal p ON p.horizon = f.horizon AND p.reg = f.reg AND p.fold < f.fold GROUP BY 1, 2, 3 HAVING count(*) >= 300),
    h AS (SELECT t.horizon, t.reg AS regime, t.date, abs(t.error) <= s.q AS cov, (t.naive_prob > 0.5) = (t.y > 0) AS bh FROM cal t JOIN st s USING (horizon, reg, fold))
    SELECT horizon, regime, count(*) AS n, round(avg(cov::INT), 6) AS coverage, round(avg(bh::INT), 6) AS naive_hit FROM h GROUP BY 1, 2""",
)
def m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scenario.forward_scores(scored(spark, sf_dir))
    return rounded(found.groupBy("horizon", "regime").agg(F.count(F.lit(1)).alias("n"), F.avg("covered").alias("coverage"), F.avg("base_hit").alias("naive_hit")))


@query(
    "m06_empirical_cdf",
    SCENARIO_SQL
    + """, cal AS MATERIALIZED (SELECT * FROM scored WHERE calm AND error IS NOT NULL AND horizon = 5), n AS (SELECT fold, (SELECT count(*) FROM cal p WHERE p.fold < f.fold) AS past FROM (SELECT DISTINCT fold FROM cal) f),
    pr AS (SELECT t.fold, 1 - (SELECT count(*) FROM cal p WHERE p.fold < t.fold AND p.error <= -t.expected_return / t.scale) / n.past AS prob, t.y FROM cal t JOIN n USING (fold) WHERE n.past >= 300)
    SELECT fold, count(*) AS n, round(avg(((prob > 0.5) = (y > 0))::INT), 6) AS hit FROM pr GROUP BY 1""",
)
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).where("horizon = 5")
    found = scenario.forward_scores(rows.withColumn("regime", F.lit(None).cast("string")))
    return rounded(found.groupBy(F.year("day").cast("long").alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.avg("hit").alias("hit")))


@query("j17_paired_control", fx.prelude("nation") + SHOCK_SQL.replace("{level}", "nation") + ", u AS (SELECT *, (vol_after > sigma_before)::INT AS rose FROM shock WHERE vol_after IS NOT NULL AND sigma_before > 0), b AS (SELECT date, avg(rose) AS base FROM u WHERE NOT flag GROUP BY 1) SELECT instrument_id, u.date AS day, rose::DOUBLE AS model, round(base, 6) AS base FROM u JOIN b USING (date) WHERE flag")
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shocks.paired_control(shock_frame(spark, sf_dir, "nation")))


SCOPE_SQL = fx.prelude("nation", "universe", "macro") + SHOCK_SQL.replace("{level}", "nation") + """,
    crossed AS (SELECT date, count(*) FILTER (coalesce(move_s60 > 2.5 AND enough, false)) AS cross_count FROM shock WHERE instrument_id IN ('CZ00001', 'CZ00002', 'CZ00003', 'CZ00004', 'CZ00005') GROUP BY 1),
    vixes AS (SELECT date, vix / lag(vix) OVER (ORDER BY date) - 1 AS vix_change FROM macro WHERE vix IS NOT NULL),
    mdays AS (SELECT s.date, coalesce(c.cross_count, 0) AS cross_count FROM shock s LEFT JOIN crossed c USING (date) WHERE instrument_id = 'CZ00001'),
    mk AS (SELECT d.date, d.cross_count >= 3 AS c, coalesce(v.vix_change > 0.2, false) AS v FROM mdays d ASOF LEFT JOIN vixes v ON d.date >= v.date),
    listed AS (
        SELECT s.instrument_id, s.date, u.asset_class, u.sector, coalesce(mk.v, false) AS v, coalesce(mk.c, false) AS c,
               CASE WHEN enough THEN concat_ws(',', CASE WHEN volume_z > 4 THEN 'volume' END, CASE WHEN gap_sigma > 3 THEN 'gap' END, CASE WHEN move_sigma > 4 THEN 'move' END) ELSE '' END AS signals
        FROM shock s LEFT JOIN universe u USING (instrument_id) LEFT JOIN mk ON mk.date = s.date),
    counted AS (
        SELECT *, count(*) FILTER (signals <> '' AND asset_class = 'equity') OVER d AS le, count(*) FILTER (asset_class = 'equity') OVER d AS e,
               count(*) OVER g AS gn, avg((signals <> '')::INT) OVER g AS gs, CASE WHEN signals = '' THEN 0 ELSE len(string_split(signals, ',')) END AS k
        FROM listed WINDOW d AS (PARTITION BY date), g AS (PARTITION BY date, sector))
    SELECT instrument_id, date, signals,
           CASE WHEN v OR c THEN 'global_macro' WHEN e > 0 AND le >= 0.3 * e THEN 'country' WHEN signals <> '' AND gn >= 5 AND gs >= 0.3 THEN 'sector' WHEN signals <> '' THEN 'instrument' END AS shock_scope,
           CASE WHEN v OR c OR k >= 2 THEN 'days' WHEN k = 1 THEN 'intraday_noise' END AS shock_persistence,
           CASE WHEN v AND c THEN 'unknowable' ELSE 'priceable' END AS shock_tractability, v AND c AS withheld FROM counted"""


@query("f08_shock_scope", SCOPE_SQL)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = shock_frame(spark, sf_dir, "nation")
    days = shocks.market_frame(frame, BASKET[0], BASKET, fx.macro(spark, sf_dir))
    return shocks.classified(frame, days, fx.universe(spark, sf_dir))


@query("f09_broad_count", REGION_SHOCK + " SELECT date, count(*) FILTER (coalesce(move_sigma > 2.5 AND enough, false)) AS moved, count(*) FILTER (coalesce(move_sigma > 2.5 AND enough, false)) >= 2 AS broad FROM shock WHERE instrument_id IN ('CZ00001', 'CZ00002', 'CZ00003') GROUP BY 1")
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shocks.broad_count(shock_frame(spark, sf_dir), BASKET[:3], 2)


NEWS_SQL = (
    fx.prelude("region", "nation", "sessions", "macro") + SHOCK_SQL.replace("{level}", "nation") + """,
    u AS MATERIALIZED (SELECT *, (vol_after > sigma_before)::INT::DOUBLE AS rose FROM shock WHERE vol_after IS NOT NULL AND sigma_before > 0),
    calm_share AS (SELECT date, avg(rose) AS base FROM u WHERE NOT flag GROUP BY 1),
    own AS (SELECT 'instrument_shock' AS signal, u.date AS session, rose AS m, base AS b FROM u JOIN calm_share USING (date) WHERE flag)"""
    + re.sub(r"\b(sret|sr|ss|sframe|shock)\b", r"region_\1", SHOCK_SQL.replace("{level}", "region")) + MARKET_SQL.replace("FROM shock", "FROM region_shock").replace("JOIN shock", "JOIN region_shock") + """,
    md AS MATERIALIZED (SELECT *, (vol_after > sigma_before)::INT::DOUBLE AS r1, (vol_after >= 1.5 * sigma_before)::INT::DOUBLE AS r2 FROM market WHERE vol_after IS NOT NULL AND sigma_before > 0),
    v AS (
        SELECT *, 5 AS horizon, 'direction_accuracy' AS metric FROM (
            SELECT * FROM own
            UNION ALL SELECT 'market_shock', date, r1, (SELECT avg(r1) FROM md WHERE NOT coalesce(market_flag, false)) FROM md WHERE market_flag
            UNION ALL SELECT 'withheld', date, r2, (SELECT avg(r2) FROM md WHERE NOT coalesce(withheld, false)) FROM md WHERE withheld) WHERE b IS NOT NULL), """
    + records_sql("v", ["signal", "horizon", "metric"])
)


@query("a20_news_arena", NEWS_SQL)
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do volatilities rise after a signal: instruments against the day's others, market days against the rest."""
    days = market(spark, sf_dir)
    parts = [
        shocks.paired_control(shock_frame(spark, sf_dir, "nation")).select(F.lit("instrument_shock").alias("signal"), "day", "model", "base"),
        shocks.day_control(days, "market_flag").select(F.lit("market_shock").alias("signal"), "day", "model", "base"),
        shocks.day_control(days, "withheld", 1.5).select(F.lit("withheld").alias("signal"), "day", "model", "base"),
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumns({"horizon": F.lit(5), "metric": F.lit("direction_accuracy")})
    return comparable(evaluate.records(long, ["signal", "horizon", "metric"], []))


@query("a28_news_arena_documents", "SELECT horizon, signal, metric, n, n_tests, verdict FROM (" + NEWS_SQL + ")")
def a28_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The news arena's published document, parsed again: a row a signal."""
    published = record.verdict_documents(a20(spark, sf_dir), ["signal", "metric"])
    kind = "array<struct<signal:string,metric:string,n:bigint,n_tests:bigint,verdict:string>>"
    return published.select("horizon", F.explode(F.from_json("document", kind)).alias("r")).select("horizon", "r.*")


ENTRIES = ", entries AS (SELECT forecast_id AS id, instrument_id, session, target_session, horizon, prob_up, baseline_prob FROM forecasts WHERE horizon IN (5, 20) AND target_session IS NOT NULL AND right(instrument_id, 1) = '1')"


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' entries: the first region's forecasts at two horizons."""
    rows = fx.forecasts(spark, sf_dir).where("horizon in (5, 20) and target_session is not null and instrument_id like '%1'")
    return rows.select(F.col("forecast_id").alias("id"), "instrument_id", "session", "target_session", "horizon", "prob_up", "baseline_prob")


HELD = """, pk AS (SELECT DISTINCT session AS day FROM forecasts), own AS (SELECT instrument_id, session AS day, bool_and(shock_status = 'ok' AND shock_signals = '' AND shock_market = '') AS quiet FROM forecasts GROUP BY 1, 2),
    held AS (SELECT e.*, (SELECT count(*) > 0 AND count(*) = count(*) FILTER (o.quiet) FROM pk LEFT JOIN own o ON o.day = pk.day AND o.instrument_id = e.instrument_id WHERE pk.day > e.session AND pk.day <= e.target_session) AS condition_held FROM entries e)"""


@query("j10_condition_held", BASE + fx.FORECASTS + ENTRIES + HELD + " SELECT id, condition_held FROM held")
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.condition_held(entries(spark, sf_dir), fx.forecasts(spark, sf_dir)).select("id", "condition_held")


@query(
    "a22_resolve_scenarios",
    OUT
    + ENTRIES
    + HELD
    + """ SELECT id, CASE WHEN condition_held THEN 'resolved' ELSE 'condition_failed' END AS status, CASE WHEN condition_held THEN round(round(e.close / s.close - 1, 8), 6) END AS outcome_return,
           CASE WHEN condition_held THEN (prob_up > 0.5) = (e.close / s.close - 1 > 0) END AS hit, CASE WHEN condition_held THEN (baseline_prob > 0.5) = (e.close / s.close - 1 > 0) END AS baseline_hit
    FROM held h JOIN thin_tr s ON s.instrument_id = h.instrument_id AND s.date = h.session ASOF JOIN thin_tr e ON e.instrument_id = h.instrument_id AND h.target_session >= e.date WHERE e.date > h.session""",
)
def a22(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.resolve_entries(entries(spark, sf_dir), thin_series(spark, sf_dir), fx.forecasts(spark, sf_dir), F.lit("2100-01-01").cast("date"))
    return rounded(found.select("id", "status", "outcome_return", "hit", "baseline_hit"))


@query(
    "a23_resolve_theses",
    OUT
    + ", theses AS (SELECT forecast_id AS id, instrument_id, session, target_session, CASE WHEN horizon = 5 THEN 'long' ELSE 'short' END AS direction, 0.7::DOUBLE AS probability, prob_up, baseline_prob FROM forecasts WHERE horizon IN (5, 20) AND target_session IS NOT NULL) "
    + """, done AS (SELECT t.*, e.close / s.close - 1 AS r FROM theses t JOIN thin_tr s ON s.instrument_id = t.instrument_id AND s.date = t.session ASOF JOIN thin_tr e ON e.instrument_id = t.instrument_id AND t.target_session >= e.date WHERE e.date > t.session),
    sided AS (SELECT *, CASE WHEN direction = 'long' THEN r > 0 ELSE NOT r > 0 END AS hit FROM done)
    SELECT id, round(r, 6) AS outcome_return, hit, round(power(probability - hit::INT, 2), 6) AS brier, round(power(prob_up - (r > 0)::INT, 2), 6) AS model_brier, round(power(baseline_prob - (r > 0)::INT, 2), 6) AS baseline_brier FROM sided""",
)
def a23(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).where("horizon in (5, 20) and target_session is not null")
    theses = rows.select(F.col("forecast_id").alias("id"), "instrument_id", "session", "target_session", F.when(F.col("horizon") == 5, "long").otherwise("short").alias("direction"), F.lit(0.7).alias("probability"), "prob_up", "baseline_prob")
    found = resolve.resolve_theses(theses, thin_series(spark, sf_dir), F.lit("2100-01-01").cast("date"))
    return rounded(found.select("id", "outcome_return", "hit", "brier", "model_brier", "baseline_brier"))


@query(
    "j09_pin_entries",
    OUT
    + """, asks AS (SELECT instrument_id || ':' || date AS id, instrument_id, 5 AS horizon, date + INTERVAL 30 HOUR AS created_at FROM panel_region WHERE date > (SELECT min(session) FROM forecasts)),
    packs AS (SELECT session, max(made_at) AS made_at FROM forecasts GROUP BY 1),
    named AS (SELECT a.*, p.session AS forecast_session FROM asks a ASOF JOIN packs p ON a.created_at >= p.made_at)
    SELECT n.id, n.forecast_session, f.target_session, CASE WHEN f.withheld OR f.scale IS NULL THEN 'no_estimate' ELSE 'pinned' END AS status, CASE WHEN NOT (f.withheld OR f.scale IS NULL) THEN round(f.expected_return - 2 * f.scale, 6) END AS band_low
    FROM named n LEFT JOIN forecasts f ON f.session = n.forecast_session AND f.instrument_id = n.instrument_id AND f.horizon = n.horizon""",
)
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.forecasts(spark, sf_dir)
    first = f.agg(F.min("session").alias("first_session"))
    asks = bars(spark, sf_dir).crossJoin(F.broadcast(first)).where("date > first_session").select(F.concat_ws(":", "instrument_id", F.col("date").cast("string")).alias("id"), "instrument_id", F.lit(5).alias("horizon"), F.lit("all").alias("assumed_regime"), (F.col("date").cast("timestamp") + F.expr("INTERVAL 30 HOURS")).alias("created_at"), F.lit(None).cast("date").alias("session"))
    grid = spark.createDataFrame([(5, "all", [0.25, 0.75], [-1.0, 1.0], 2.0)], "horizon int, regime string, levels array<double>, quantiles array<double>, band_q double")
    found = resolve.pin_entries(asks, f, grid)
    return rounded(found.select("id", "forecast_session", "target_session", "status", "band_low"))


@query("m10_interp", BASE + fx.FORECASTS + ", x AS (SELECT forecast_id, -expected_return / scale AS x FROM forecasts WHERE horizon = 5) SELECT forecast_id, round(CASE WHEN x < -1 THEN 0.0 WHEN x < 0 THEN 0.1 + (x + 1) * 0.4 WHEN x < 1 THEN 0.5 + x * 0.4 WHEN x = 1 THEN 0.9 ELSE 1.0 END, 6) AS share FROM x")
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).where("horizon = 5")
    xs, ys = F.array(F.lit(-1.0), F.lit(0.0), F.lit(1.0)), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))
    return rounded(rows.select("forecast_id", resolve.interpolate(-F.col("expected_return") / F.col("scale"), xs, ys).alias("share")))


@query("g19_split_factor", BASE + ", lots AS (SELECT instrument_id, min(date) AS entered, max(date) AS until FROM panel_region GROUP BY 1, year(date)) SELECT instrument_id, entered, until, coalesce((SELECT product(split_ratio) FROM actions_region a WHERE a.instrument_id = lots.instrument_id AND a.date > entered AND a.date <= until AND split_ratio <> 1), 1.0) AS factor FROM lots")
def g19(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = bars(spark, sf_dir).groupBy("instrument_id", F.year("date").alias("y")).agg(F.min("date").alias("entered"), F.max("date").alias("until")).drop("y")
    return upsert.split_factor(lots, fx.actions(spark, sf_dir))


QUESTIONS_SQL = BASE + """, q AS (
        SELECT instrument_id, date, close, row_number() OVER w AS n, lead(close, 20) OVER w AS later, (close > lag(close, 20) OVER w)::INT AS rose, count(*) OVER x AS ahead FROM panel_region
        WINDOW w AS (PARTITION BY instrument_id ORDER BY date), x AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)),
    r AS (SELECT *, avg(rose) OVER (PARTITION BY instrument_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS rate FROM q),
    questions AS (SELECT instrument_id, date, round(least(greatest(rate, 0.01), 0.99), 4) AS baseline_prob, later > close AS up FROM r WHERE n > 120 AND ahead = 20)"""


@query("w30_questions", QUESTIONS_SQL + " SELECT * FROM questions")
def w30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.questions(bars(spark, sf_dir), 20).select(*KEYS, "baseline_prob", "up")


@query("t10_seeded_sample", QUESTIONS_SQL + " SELECT * FROM questions ORDER BY md5('7|' || instrument_id || '|' || date), instrument_id, date LIMIT 200")
def t10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.seeded_sample(record.questions(bars(spark, sf_dir), 20), 200, 7, "instrument_id", "date").select(*KEYS, "baseline_prob", "up")


def arena_sql(horizons: tuple[int, ...]) -> str:
    """``v``: each signal's hit and that of the instrument's usual direction, at every horizon that has closed."""
    ahead = " UNION ALL ".join(f"SELECT instrument_id, date, {h} AS horizon, lead(close, {h}) OVER (PARTITION BY instrument_id ORDER BY date) > close AS up FROM panel_region" for h in horizons)
    return f""", f AS MATERIALIZED ({ahead}),
    usual AS (SELECT instrument_id, horizon, avg(up::INT) >= 0.5 AS usual FROM f WHERE up IS NOT NULL GROUP BY 1, 2),
    v AS (
        SELECT s.rule, s.direction, f.horizon, s.date AS session, 'direction_accuracy' AS metric, (f.up = (s.direction = 'long'))::INT::DOUBLE AS m, (f.up = u.usual)::INT::DOUBLE AS b
        FROM signals s JOIN f USING (instrument_id, date) JOIN usual u ON u.instrument_id = s.instrument_id AND u.horizon = f.horizon WHERE f.up IS NOT NULL), """


@query("a16_indicator_arena", REGION + EWM + MACD + ALL_SIGNALS + arena_sql(fx.HORIZONS) + records_sql("v", ["rule", "direction", "horizon", "metric"], judged=False))
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.signals import all_signals

    prices = bars(spark, sf_dir)
    return comparable(evaluate.arena(all_signals(prices), prices, fx.HORIZONS))


PACKAGE_SQL = """, lines AS (
        SELECT session, sha256('forecast_id=' || forecast_id || '|horizon=' || horizon || '|prob_up=' || coalesce(prob_up::DECIMAL(38, 9)::VARCHAR, 'null') || '|session=' || session
                               || '|target_session=' || coalesce(target_session::VARCHAR, 'null')) AS line FROM forecasts),
    packed AS (
        SELECT session, count(*) AS rows, sum(('0x' || substr(line, 1, 12))::BIGINT) AS a, sum(('0x' || substr(line, 13, 12))::BIGINT) AS b, sum(('0x' || substr(line, 25, 12))::BIGINT) AS c,
               sum(('0x' || substr(line, 37, 12))::BIGINT) AS d, sum(('0x' || substr(line, 49, 12))::BIGINT) AS e FROM lines GROUP BY 1)"""


@query("k07_package_hash", BASE + fx.FORECASTS + PACKAGE_SQL + " SELECT session, rows, sha256(rows || '|' || a || '|' || b || '|' || c || '|' || d || '|' || e) AS sha256 FROM packed")
def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.content_hash(fx.forecasts(spark, sf_dir).select("forecast_id", "session", "horizon", "prob_up", "target_session"), ["forecast_id"])


@query("k13_archive", BASE + fx.FORECASTS + " SELECT session, count(*) AS rows, day(session) <> 1 AS verified FROM forecasts GROUP BY 1")
def k13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).select("forecast_id", "session", "horizon", "prob_up", "target_session")
    stated = record.content_hash(rows, ["forecast_id"]).withColumn("sha256", F.when(F.dayofmonth("session") == 1, "tampered").otherwise(F.col("sha256")))
    return record.archive(rows, stated)


@query(
    "a27_documents_read_back",
    OUT
    + REGION_SECTORS
    + """, newest AS (SELECT * FROM forecasts QUALIFY row_number() OVER (PARTITION BY instrument_id, horizon ORDER BY session DESC) = 1),
    own AS (SELECT instrument_id, horizon, count(*) AS n, round(avg(hit), 4) AS hit FROM outcomes GROUP BY 1, 2),
    closes AS (SELECT instrument_id, least(count(*), 250) AS closes, round(max_by(close, date), 4) AS last_close FROM panel_region GROUP BY 1)
    SELECT s.instrument_id, s.sector AS ticker, c.closes, c.last_close, f.horizon, f.session, f.target_session, round(f.prob_up, 4) AS prob_up, round(f.band_low, 6) AS band_low, o.n, o.hit
    FROM sectors s JOIN closes c USING (instrument_id) LEFT JOIN newest f USING (instrument_id) LEFT JOIN own o ON o.instrument_id = f.instrument_id AND o.horizon = f.horizon""",
)
def a27_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruments' documents parsed again: what a reader of them sees."""
    forecast = "struct<horizon:int,session:date,target_session:date,prob_up:double,band_low:double,band_high:double>"
    kind = f"ticker string, closes array<double>, forecasts array<{forecast}>, record array<struct<horizon:int,n:bigint,hit:double,baseline_hit:double>>"
    parsed = a27(spark, sf_dir).select("instrument_id", F.from_json("document", kind).alias("d")).select("instrument_id", "d.*").withColumn("f", F.explode("forecasts"))
    own = F.element_at(F.filter("record", lambda r: r["horizon"] == F.col("f.horizon")), 1)
    read = parsed.withColumn("own", F.when(F.exists("record", lambda r: r["horizon"] == F.col("f.horizon")), own))
    fields = [F.col(f"f.{c}") for c in ("horizon", "session", "target_session", "prob_up", "band_low")]
    return rounded(read.select("instrument_id", "ticker", F.size("closes").cast("long").alias("closes"), F.element_at("closes", -1).alias("last_close"), *fields, F.col("own.n").alias("n"), F.col("own.hit").alias("hit")))


@query("a27_documents")
def a27(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = region_universe(spark, sf_dir).withColumn("ticker", F.col("sector"))
    return record.instrument_documents(names, bars(spark, sf_dir), fx.forecasts(spark, sf_dir), outcomes(spark, sf_dir))


@query(
    "k08_history_read_back",
    fx.prelude("region") + " SELECT instrument_id, date, true AS as_stored FROM panel_region QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY date DESC) <= 1460",
)
def k08_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history documents parsed again, a row a day, and whether all its numbers are the bars' own to four digits."""
    names = ("open", "high", "low", "close", "volume")
    kind = "date array<date>, " + ", ".join(f"{c} array<double>" for c in names)
    parsed = k08(spark, sf_dir).select("instrument_id", F.from_json("document", kind).alias("d"))
    days = parsed.select("instrument_id", F.explode(F.arrays_zip(*(F.col(f"d.{c}").alias(c) for c in ("date", *names)))).alias("x")).select("instrument_id", F.col("x.date").alias("date"), "x")
    same = F.lit(True)
    for c in names:
        same &= F.abs(F.col(f"x.{c}") - F.col(c)) <= 0.00005 + 1e-9
    return days.join(bars(spark, sf_dir), KEYS, "left").select(*KEYS, F.coalesce(same, F.lit(False)).alias("as_stored"))


@query("k08_history_json")
def k08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.history_documents(bars(spark, sf_dir))
