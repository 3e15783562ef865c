"""Queries over the daily panel: returns, features, regime, macro, signals, candles, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import candles, cross_section, macro, pivots, ranks, regime, returns, signals, technical
from tidemark.operators.rolling import by_instrument, exponential_means, guarded, span
from tidemark.plans.base import query, rounded
from tidemark.sources import fixtures as fx

KEYS = ["instrument_id", "date"]
REGION = fx.prelude("region")
NATION = fx.prelude("nation")
#: The five regions stand in for a market and its basket.
BASKET = [f"CZ0000{i}" for i in range(1, 6)]
W = "WINDOW w AS (PARTITION BY instrument_id ORDER BY date)"

TR = """,
    grown AS (
        SELECT p.*, coalesce((p.close + coalesce(a.dividend, 0)) / lag(p.close) OVER (PARTITION BY p.instrument_id ORDER BY p.date), 1.0) AS growth
        FROM panel_region p LEFT JOIN actions_region a USING (instrument_id, date)),
    tr AS (
        SELECT *, exp(sum(ln(growth)) OVER (PARTITION BY instrument_id ORDER BY date ROWS UNBOUNDED PRECEDING)) AS tr_close FROM grown),
    rets AS (
        SELECT *, ln(tr_close) - lag(ln(tr_close)) OVER (PARTITION BY instrument_id ORDER BY date) AS ret FROM tr)"""

#: Exponential means of panel_region's close by recursion over row numbers: name, weight.
EWM = """,
    numbered AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date) AS n,
               close - lag(close) OVER (PARTITION BY instrument_id ORDER BY date) AS step,
               greatest(high - low, abs(high - lag(close) OVER (PARTITION BY instrument_id ORDER BY date)),
                        abs(low - lag(close) OVER (PARTITION BY instrument_id ORDER BY date))) AS true_range
        FROM panel_region),
    walk AS (
        SELECT instrument_id, n, close AS e12, close AS e26, close AS e200, NULL::DOUBLE AS gain, NULL::DOUBLE AS loss, true_range AS atr
        FROM numbered WHERE n = 1
        UNION ALL
        SELECT x.instrument_id, x.n, w.e12 + (x.close - w.e12) * 2 / 13, w.e26 + (x.close - w.e26) * 2 / 27, w.e200 + (x.close - w.e200) * 2 / 201,
               CASE WHEN w.gain IS NULL THEN greatest(x.step, 0) ELSE w.gain + (greatest(x.step, 0) - w.gain) / 14 END,
               CASE WHEN w.loss IS NULL THEN greatest(-x.step, 0) ELSE w.loss + (greatest(-x.step, 0) - w.loss) / 14 END,
               w.atr + (x.true_range - w.atr) / 14
        FROM walk w JOIN numbered x ON x.instrument_id = w.instrument_id AND x.n = w.n + 1),
    smooth AS MATERIALIZED (SELECT x.*, w.e12, w.e26, w.e200, w.gain, w.loss, w.atr AS atr_now FROM numbered x JOIN walk w USING (instrument_id, n))"""

MACD = """,
    macds AS MATERIALIZED (SELECT *, e12 - e26 AS macd FROM smooth),
    sig AS (
        SELECT instrument_id, n, macd AS s FROM macds WHERE n = 26
        UNION ALL
        SELECT x.instrument_id, x.n, w.s + (x.macd - w.s) * 2 / 10 FROM sig w JOIN macds x ON x.instrument_id = w.instrument_id AND x.n = w.n + 1)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.panel(spark, sf_dir).drop("sector")


def with_tr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.total_return(bars(spark, sf_dir), fx.actions(spark, sf_dir))


def log_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tr(spark, sf_dir).withColumn("ret", returns.log_return("tr_close"))


@query(
    "flagship_total_return_vol",
    REGION
    + TR
    + f""",
    vols AS (
        SELECT *, CASE WHEN count(ret) OVER r = 20 THEN stddev_samp(ret) OVER r * sqrt(252.0) END AS vol_20,
               lead(close, 5) OVER (PARTITION BY instrument_id ORDER BY date) > close AS up
        FROM rets WINDOW r AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING)),
    usual AS (SELECT instrument_id, avg(up::INT) >= 0.5 AS usual_up FROM vols WHERE up IS NOT NULL GROUP BY 1)
    SELECT instrument_id, count(*) AS days, round(avg(vol_20), 6) AS mean_vol_20, round(avg(up::INT), 6) AS up_rate,
           round(avg((up = usual_up)::INT), 6) AS baseline_hit_rate, round(sum(ret), 6) AS total_log_return
    FROM vols JOIN usual USING (instrument_id) GROUP BY 1""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_returns(spark, sf_dir).withColumns({"vol_20": technical.volatility(F.col("ret"), 20), "later": F.lead("close", 5).over(by_instrument())})
    rows = rows.withColumn("up", F.col("later") > F.col("close"))
    usual = returns.usual_direction(rows.where("up is not null").select(*KEYS, "up")).select("instrument_id", "usual_up")
    found = rows.join(usual, "instrument_id").groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("vol_20").alias("mean_vol_20"),
        F.avg(F.col("up").cast("int")).alias("up_rate"),
        F.avg((F.col("up") == F.col("usual_up")).cast("int")).alias("baseline_hit_rate"),
        F.sum("ret").alias("total_log_return"),
    )
    return rounded(found)


@query("w01_total_return", REGION + TR + " SELECT instrument_id, date, round(tr_close, 6) AS tr_close FROM tr")
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(with_tr(spark, sf_dir).select(*KEYS, "tr_close"))


@query("w02_log_return", REGION + TR + " SELECT instrument_id, date, round(ret, 6) AS ret FROM rets")
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(log_returns(spark, sf_dir).select(*KEYS, "ret"))


@query(
    "w03_rolling_vol",
    REGION
    + TR
    + """ SELECT instrument_id, date, round(CASE WHEN count(ret) OVER a = 20 THEN stddev_samp(ret) OVER a * sqrt(252.0) END, 6) AS vol_20,
           round(CASE WHEN count(ret) OVER b = 60 THEN stddev_samp(ret) OVER b * sqrt(252.0) END, 6) AS vol_60
    FROM rets WINDOW a AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING), b AS (PARTITION BY instrument_id ORDER BY date ROWS 59 PRECEDING)""",
)
def w03_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(log_returns(spark, sf_dir).select(*KEYS, *(technical.volatility(F.col("ret"), n).alias(f"vol_{n}") for n in (20, 60))))


@query("w03_momentum", REGION + f" SELECT instrument_id, date, round(ln(lag(close, 21) OVER w) - ln(lag(close, 252) OVER w), 6) AS mom_252_21 FROM panel_region {W}")
def w03_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars(spark, sf_dir).select(*KEYS, technical.momentum(F.col("close")).alias("mom_252_21")))


@query(
    "w03_volume_anomaly",
    REGION
    + """ SELECT instrument_id, date, round(CASE WHEN count(volume) OVER r = 20 AND volume > 0 THEN ln(volume / quantile_cont(volume, 0.5) OVER r) END, 6) AS volume_anomaly_20
    FROM panel_region WINDOW r AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING)""",
)
def w03_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars(spark, sf_dir).select(*KEYS, technical.volume_anomaly(F.col("volume")).alias("volume_anomaly_20")))


@query(
    "w03_bollinger_width",
    REGION
    + """ SELECT instrument_id, date, round(CASE WHEN count(close) OVER r = 20 THEN 4 * stddev_samp(close) OVER r / avg(close) OVER r END, 6) AS bb_width_20,
           round(ln(open / lag(close) OVER w), 6) AS gap_1
    FROM panel_region WINDOW r AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING), w AS (PARTITION BY instrument_id ORDER BY date)""",
)
def w03_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars(spark, sf_dir).select(*KEYS, technical.bollinger_width(F.col("close")).alias("bb_width_20"), technical.gap(F.col("open"), F.col("close")).alias("gap_1")))


def features_sql(source: str = "tr") -> str:
    """``features``: all sixteen of ``source`` (bars with tr_close), on the total-return scale; exponential means by recursion over rows."""
    spans = (12, 20, 26, 50, 200)
    first = ", ".join(f"c AS e{n}" for n in spans)
    step = ", ".join(f"w.e{n} + (x.c - w.e{n}) * 2 / {n + 1}" for n in spans)
    known = ", ".join(f"CASE WHEN f.n >= {n} THEN f.e{n} END AS m{n}" for n in spans)
    back = ", ".join(f"ln(c) - lag(ln(c), {k}) OVER w AS ret_{k}" for k in (1, 5, 20, 60))
    distance = ", ".join(f"ln(c / m{n}) AS ema_dist_{n}" for n in (20, 50, 200))
    return f""",
    fadj AS MATERIALIZED (
        SELECT instrument_id, date, open * tr_close / close AS o, tr_close AS c, volume, row_number() OVER w AS n, tr_close - lag(tr_close) OVER w AS step
        FROM {source} WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    fwalk AS (
        SELECT instrument_id, n, {first}, NULL::DOUBLE AS gain, NULL::DOUBLE AS loss FROM fadj WHERE n = 1
        UNION ALL
        SELECT x.instrument_id, x.n, {step},
               CASE WHEN w.gain IS NULL THEN greatest(x.step, 0) ELSE w.gain + (greatest(x.step, 0) - w.gain) / 14 END,
               CASE WHEN w.loss IS NULL THEN greatest(-x.step, 0) ELSE w.loss + (greatest(-x.step, 0) - w.loss) / 14 END
        FROM fwalk w JOIN fadj x ON x.instrument_id = w.instrument_id AND x.n = w.n + 1),
    fsmooth AS MATERIALIZED (SELECT a.*, {known}, f.gain, f.loss FROM fadj a JOIN fwalk f USING (instrument_id, n)),
    fsignal AS (
        SELECT instrument_id, n, m12 - m26 AS s FROM fsmooth WHERE n = 26
        UNION ALL
        SELECT x.instrument_id, x.n, w.s + (x.m12 - x.m26 - w.s) * 2 / 10 FROM fsignal w JOIN fsmooth x ON x.instrument_id = w.instrument_id AND x.n = w.n + 1),
    fback AS (
        SELECT a.*, g.s, {back}, lag(ln(c), 21) OVER w - lag(ln(c), 252) OVER w AS mom_252_21, ln(o / lag(c) OVER w) AS gap_1,
               CASE WHEN count(volume) OVER v = 20 THEN quantile_cont(volume, 0.5) OVER v END AS vm, CASE WHEN count(c) OVER v = 20 THEN 4 * stddev_samp(c) OVER v / avg(c) OVER v END AS bb_width_20
        FROM fsmooth a LEFT JOIN fsignal g USING (instrument_id, n)
        WINDOW w AS (PARTITION BY instrument_id ORDER BY date), v AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING)),
    features AS MATERIALIZED (
        SELECT instrument_id, date, n AS history_sessions, ret_1, ret_5, ret_20, ret_60, mom_252_21, gap_1, bb_width_20, {distance},
               CASE WHEN count(ret_1) OVER v = 20 THEN stddev_samp(ret_1) OVER v * sqrt(252.0) END AS vol_20, CASE WHEN count(ret_1) OVER z = 60 THEN stddev_samp(ret_1) OVER z * sqrt(252.0) END AS vol_60,
               CASE WHEN n >= 15 AND loss <> 0 THEN 100 - 100 / (1 + gain / loss) END AS rsi_14, CASE WHEN n >= 34 THEN (m12 - m26 - s) / c END AS macd_hist,
               CASE WHEN volume <> 0 AND vm <> 0 THEN ln(volume / vm) END AS volume_anomaly_20
        FROM fback WINDOW v AS (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING), z AS (PARTITION BY instrument_id ORDER BY date ROWS 59 PRECEDING))"""


FEATURE_NAMES = ["ret_1", "ret_5", "ret_20", "ret_60", "vol_20", "vol_60", "mom_252_21", "rsi_14", "macd_hist", "ema_dist_20", "ema_dist_50", "ema_dist_200", "volume_anomaly_20", "bb_width_20", "gap_1"]


@query("w03_all_features", REGION + TR + features_sql() + f" SELECT instrument_id, date, history_sessions, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURE_NAMES)} FROM features")
def w03_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(technical.features(with_tr(spark, sf_dir)).withColumn("history_sessions", F.col("history_sessions").cast("long")))


@query("w03_technical_features")
def w03_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen features, as 32-bit floats (their parts have twins above and below)."""
    return technical.as_floats(technical.features(with_tr(spark, sf_dir)))


@query("w04_adjusted_ohlc", REGION + TR + "".join(f"{',' if i else ' SELECT instrument_id, date,'} round({c} * tr_close / close, 6) AS {c}" for i, c in enumerate(("open", "high", "low", "close"))) + " FROM tr")
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(returns.adjusted_bars(with_tr(spark, sf_dir)).select(*KEYS, "open", "high", "low", "close"))


@query("w05_ema12", REGION + EWM + " SELECT instrument_id, date, round(CASE WHEN n >= 12 THEN e12 END, 6) AS ema_12 FROM smooth")
def w05_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(exponential_means(bars(spark, sf_dir), {"ema_12": ("close", span(12), 12)}, KEYS).select(*KEYS, "ema_12"))


@query("w05_rsi14", REGION + EWM + " SELECT instrument_id, date, round(CASE WHEN n >= 15 AND loss <> 0 THEN 100 - 100 / (1 + gain / loss) END, 6) AS rsi_14 FROM smooth")
def w05_rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    smooth = technical.smoothed(bars(spark, sf_dir), KEYS)
    return rounded(smooth.select(*KEYS, technical.rsi(F.col("gain_14"), F.col("loss_14")).alias("rsi_14")))


@query("w05_macd", REGION + EWM + MACD + " SELECT m.instrument_id, m.date, round(CASE WHEN n >= 26 THEN macd END, 6) AS macd, round(CASE WHEN n >= 34 THEN s END, 6) AS macd_signal FROM macds m LEFT JOIN sig USING (instrument_id, n)")
def w05_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(technical.smoothed(bars(spark, sf_dir), KEYS).select(*KEYS, "macd", "macd_signal"))


@query("w06_atr", REGION + EWM + " SELECT instrument_id, date, round(CASE WHEN n >= 15 THEN lag(atr_now) OVER (PARTITION BY instrument_id ORDER BY n) END, 6) AS atr FROM smooth")
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(technical.lagged_atr(technical.smoothed(bars(spark, sf_dir), KEYS)).select(*KEYS, "atr"))


@query("w07_prior_trend", REGION + f" SELECT instrument_id, date, round(lag(close, 1) OVER w / lag(close, 11) OVER w - 1, 6) AS trend FROM panel_region {W}")
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars(spark, sf_dir).select(*KEYS, technical.prior_trend(F.col("close")).alias("trend")))


EXPANDING = "(SELECT (count(*) FILTER (b.{x} < a.{x}) + (count(*) FILTER (b.{x} = a.{x}) + 1) / 2.0) / count(b.{x}) FROM {t} b WHERE b.date <= a.date AND b.{x} IS NOT NULL HAVING count(b.{x}) >= 252)"
MARKET = """,
    market AS MATERIALIZED (
        SELECT date, max(ret) FILTER (instrument_id = 'CZ00001') AS m FROM rets GROUP BY 1),
    vols AS MATERIALIZED (
        SELECT date, CASE WHEN count(m) OVER r = 20 THEN stddev_samp(m) OVER r * sqrt(252.0) END AS v
        FROM market WINDOW r AS (ORDER BY date ROWS 19 PRECEDING))"""


@query("w08_expanding_rank", REGION + TR + MARKET + f" SELECT date, round(v, 6) AS vol, round(CASE WHEN v IS NOT NULL THEN {EXPANDING.format(x='v', t='vols')} END, 6) AS vol_pct FROM vols a")
def w08(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = regime.wide_returns(log_returns(spark, sf_dir), BASKET)
    vol = guarded(F.stddev_samp, F.col(BASKET[0]), 20, over=macro.by_day()) * F.sqrt(F.lit(252.0))
    daily = wide.select("date", vol.alias("vol"))
    return rounded(ranks.with_expanding_ranks(daily, {"vol_pct": "vol"}, 252))


CORR = """,
    wide AS MATERIALIZED (
        SELECT date, {cols} FROM rets GROUP BY 1),
    pairs AS (
        SELECT date, unnest([{pairs}]) AS p FROM wide),
    rolled AS (
        SELECT date, CASE WHEN count(CASE WHEN p.x IS NOT NULL AND p.y IS NOT NULL THEN 1 END) OVER r = 60 THEN abs(corr(p.x, p.y) OVER r) END AS c
        FROM pairs WINDOW r AS (PARTITION BY p.k ORDER BY date ROWS 59 PRECEDING)),
    corrs AS MATERIALIZED (SELECT date, CASE WHEN count(c) = 10 THEN avg(c) END AS c FROM rolled GROUP BY 1)""".format(
    cols=", ".join(f"max(ret) FILTER (instrument_id = '{b}') AS r{i}" for i, b in enumerate(BASKET)),
    pairs=", ".join(f"{{'k': {10 * i + j}, 'x': r{i}, 'y': r{j}}}" for i in range(5) for j in range(i + 1, 5)),
)


@query(
    "w09_regime",
    REGION
    + TR
    + MARKET
    + CORR
    + f""",
    ranked AS (
        SELECT a.date, a.v, CASE WHEN a.v IS NOT NULL THEN {EXPANDING.format(x="v", t="vols")} END AS vp FROM vols a),
    ranked2 AS (SELECT a.date, a.c, CASE WHEN a.c IS NOT NULL THEN {EXPANDING.format(x="c", t="corrs")} END AS cp FROM corrs a),
    joined AS (SELECT date, v, c, vp, cp, (vp + cp) / 2 AS stress FROM ranked LEFT JOIN ranked2 USING (date))
    SELECT date, round(v, 6) AS market_vol_20, round(c, 6) AS cross_market_corr_60, round(vp, 6) AS vol_pct, round(cp, 6) AS corr_pct,
           round(stress, 6) AS stress, CASE WHEN stress < 1.0::DOUBLE / 3 THEN 'calm' WHEN stress < 0.8 THEN 'normal' WHEN stress IS NOT NULL THEN 'stressed' END AS regime
    FROM joined""",
)
def w09(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = regime.wide_returns(log_returns(spark, sf_dir), BASKET)
    return rounded(regime.regime(wide, BASKET[0], BASKET))


SIGNS = {BASKET[1]: -1, BASKET[3]: -1}


@query(
    "w10_index_returns",
    REGION
    + TR
    + CORR
    + ", idx AS (SELECT date, (r0 - r1 + r2 - r3 + r4) / 5 AS i FROM wide) SELECT date, round(i, 6) AS \"index\", round(CASE WHEN count(i) OVER r = 20 THEN sum(i) OVER r END, 6) AS index_ret_20 FROM idx WINDOW r AS (ORDER BY date ROWS 19 PRECEDING)",
)
def w10(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = regime.synthetic_index(regime.wide_returns(log_returns(spark, sf_dir), BASKET, SIGNS), BASKET)
    return rounded(regime.rolling_index(wide).select("date", "index", "index_ret_20"))


@query("w11_curve", fx.prelude("macro") + " SELECT date, round(yield_10y, 6) AS curve_level, round(yield_10y - yield_3m, 6) AS curve_slope, round((yield_10y - yield_3m) - lag(yield_10y - yield_3m, 20) OVER (ORDER BY date), 6) AS curve_slope_chg_20 FROM macro")
def w11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regime.curve(fx.macro(spark, sf_dir), "yield_3m", "yield_10y"))


@query("w12_macro_change", fx.prelude("macro") + " SELECT date, round(ln(vix / lag(vix, 20) OVER d), 6) AS vix_chg_20, round(ln(dollar_index / lag(dollar_index, 20) OVER d), 6) AS dollar_ret_20 FROM macro WINDOW d AS (ORDER BY date)")
def w12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(macro.with_changes(fx.macro(spark, sf_dir)).select("date", "vix_chg_20", "dollar_ret_20"))


MACRO_COLS = ("vix", "yield_10y", "yield_2y", "yield_3m", "dollar_index")


@query(
    "w13_macro_align",
    fx.prelude("region", "sessions", "macro")
    + ", filled AS (SELECT date, idx, "
    + ", ".join(f"last_value({c} IGNORE NULLS) OVER f AS {c}" for c in MACRO_COLS)
    + " FROM sessions FULL JOIN macro USING (date) WINDOW f AS (ORDER BY date ROWS 5 PRECEDING)), kept AS (SELECT date, "
    + ", ".join(f"lag({c}) OVER d AS {c}" for c in MACRO_COLS)
    + " FROM filled WHERE idx IS NOT NULL WINDOW d AS (ORDER BY date)) SELECT date, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in MACRO_COLS)
    + ", round(yield_10y - yield_2y, 6) AS yield_curve_10y2y FROM kept",
)
def w13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(macro.aligned_to_sessions(fx.macro(spark, sf_dir), fx.sessions(fx.panel(spark, sf_dir)).select("date")))


@query(
    "w14_macro_asof",
    fx.prelude("region", "sessions", "macro")
    + ", ends AS (SELECT min(date) AS lo, max(date) AS hi FROM (SELECT date FROM sessions UNION ALL SELECT date FROM macro)), spine AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date FROM ends), filled AS (SELECT date, "
    + ", ".join(f"last_value({c} IGNORE NULLS) OVER f AS {c}" for c in MACRO_COLS)
    + " FROM spine LEFT JOIN macro USING (date) WINDOW f AS (ORDER BY date ROWS 5 PRECEDING)), kept AS (SELECT date, "
    + ", ".join(f"lag({c}) OVER d AS {c}" for c in MACRO_COLS)
    + " FROM filled WINDOW d AS (ORDER BY date)) SELECT date, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in MACRO_COLS)
    + ", round(yield_10y - yield_2y, 6) AS yield_curve_10y2y FROM kept WHERE date IN (SELECT date FROM sessions)",
)
def w14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(macro.as_of_day(fx.macro(spark, sf_dir), fx.sessions(fx.panel(spark, sf_dir)), shift=1))


@query("w15_targets", REGION + TR + " SELECT instrument_id, date, " + ", ".join(f"round(lead(ln(tr_close), {h}) OVER w - ln(tr_close), 6) AS y_{h}" for h in fx.HORIZONS) + f" FROM tr {W}")
def w15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(returns.with_targets(with_tr(spark, sf_dir), fx.HORIZONS).select(*KEYS, *(f"y_{h}" for h in fx.HORIZONS)))


@query("w16_forward_up", REGION + f" SELECT instrument_id, date, later > close AS up FROM (SELECT *, lead(close, 5) OVER w AS later FROM panel_region {W}) WHERE later IS NOT NULL")
def w16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.forward_direction(bars(spark, sf_dir), 5)


SIGNALS = """,
    ready AS (
        SELECT m.instrument_id, m.date, m.n, m.close, m.volume, CASE WHEN m.n >= 26 THEN m.macd END AS macd, CASE WHEN m.n >= 34 THEN s END AS sig,
               CASE WHEN m.n >= 200 THEN m.e200 END AS ema200, CASE WHEN m.n >= 15 AND loss <> 0 THEN 100 - 100 / (1 + gain / loss) END AS rsi,
               CASE WHEN count(close) OVER a = 50 THEN avg(close) OVER a END AS sma50, CASE WHEN count(close) OVER b = 200 THEN avg(close) OVER b END AS sma200,
               CASE WHEN count(close) OVER c = 20 THEN avg(close) OVER c END AS mid, CASE WHEN count(close) OVER c = 20 THEN stddev_samp(close) OVER c END AS dev,
               CASE WHEN count(volume) OVER c = 20 THEN quantile_cont(volume, 0.5) OVER c END AS med
        FROM macds m LEFT JOIN sig USING (instrument_id, n)
        WINDOW a AS (PARTITION BY m.instrument_id ORDER BY m.n ROWS 49 PRECEDING), b AS (PARTITION BY m.instrument_id ORDER BY m.n ROWS 199 PRECEDING), c AS (PARTITION BY m.instrument_id ORDER BY m.n ROWS 19 PRECEDING)),
    states AS (
        SELECT *, coalesce(macd > sig, false) AS ma, coalesce(sma50 > sma200, false) AS sa, coalesce(close > ema200, false) AS ea FROM ready),
    conds AS (
        SELECT *, ma AND NOT coalesce(lag(ma) OVER w, false) AS macd_cross_up, NOT ma AND coalesce(lag(ma) OVER w, false) AND macd IS NOT NULL AS macd_cross_down,
               sa AND NOT coalesce(lag(sa) OVER w, false) AS golden_cross, NOT sa AND coalesce(lag(sa) OVER w, false) AND sma200 IS NOT NULL AS death_cross,
               ea AND NOT coalesce(lag(ea) OVER w, false) AS close_above_ema200, NOT ea AND coalesce(lag(ea) OVER w, false) AND ema200 IS NOT NULL AS close_below_ema200,
               rsi < 30 AND lag(rsi) OVER w >= 30 AS rsi_oversold, rsi > 70 AND lag(rsi) OVER w <= 70 AS rsi_overbought,
               close < mid - 2 * dev AS bollinger_lower, close > mid + 2 * dev AS bollinger_upper,
               volume >= 3 * med AND close > lag(close) OVER w AS volume_spike_up
        FROM states WINDOW w AS (PARTITION BY instrument_id ORDER BY n)),
    long AS (UNPIVOT (SELECT instrument_id, date, n, {cols} FROM conds) ON {names} INTO NAME rule VALUE flag),
    fired AS (SELECT *, flag AND NOT coalesce(lag(flag) OVER (PARTITION BY instrument_id, rule ORDER BY n), false) AS f FROM long)""".format(
    cols=", ".join(f"coalesce({r}, false) AS {r}" for r in signals.DIRECTIONS if r != "momentum_top_decile"),
    names=", ".join(r for r in signals.DIRECTIONS if r != "momentum_top_decile"),
)
TOP = """,
    moms AS (
        SELECT instrument_id, date, row_number() OVER w AS n, ln(lag(close, 21) OVER w) - ln(lag(close, 252) OVER w) AS mom FROM panel_region WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    tops AS (SELECT *, coalesce(mom >= quantile_cont(mom, 0.9) OVER (PARTITION BY date), false) AS t FROM moms),
    top AS (SELECT *, t AND NOT coalesce(lag(t) OVER (PARTITION BY instrument_id ORDER BY date), false) AS f FROM tops)"""
DIRECTION = "CASE WHEN rule IN (" + ", ".join(f"'{r}'" for r, d in signals.DIRECTIONS.items() if d == "long") + ") THEN 'long' ELSE 'short' END"
ALL_SIGNALS = SIGNALS + TOP + f""",
    signals AS (
        SELECT *, {DIRECTION} AS direction FROM (
            SELECT instrument_id, date, rule FROM fired WHERE f AND n >= 252
            UNION ALL SELECT instrument_id, date, 'momentum_top_decile' FROM top WHERE f AND n >= 252))"""


@query("w17_indicator_signals", REGION + EWM + MACD + SIGNALS + " SELECT instrument_id, date, rule FROM fired WHERE f AND n >= 252")
def w17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.indicator_signals(bars(spark, sf_dir))


@query("w18_top_decile", REGION + TOP + " SELECT instrument_id, date, 'momentum_top_decile' AS rule FROM top WHERE f AND n >= 252")
def w18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_section.top_decile(bars(spark, sf_dir))


@query("w19_all_signals", REGION + EWM + MACD + ALL_SIGNALS + " SELECT * FROM signals")
def w19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.all_signals(bars(spark, sf_dir))


PIVOTS = """,
    rows AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date) AS "row" FROM panel_region),
    piv AS (
        SELECT instrument_id, date, "row", 'high' AS kind, high AS price, "row" + 5 AS known_row FROM rows
        WINDOW x AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
        QUALIFY count(*) OVER x = 11 AND max(high) OVER x = high AND max(high) OVER (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) < high
        UNION ALL
        SELECT instrument_id, date, "row", 'low', low, "row" + 5 FROM rows
        WINDOW x AS (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
        QUALIFY count(*) OVER x = 11 AND min(low) OVER x = low AND min(low) OVER (PARTITION BY instrument_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) > low)"""
STATES = """,
    steps AS (SELECT *, sign(price - lag(price) OVER (PARTITION BY instrument_id, kind ORDER BY "row")) AS s FROM piv),
    latest AS (
        SELECT r.instrument_id, r.date, r.close, r."row",
               (SELECT arg_max(coalesce(s, 0), p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'high' AND p.known_row <= r."row") AS hs,
               (SELECT arg_max(coalesce(s, 0), p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'low' AND p.known_row <= r."row") AS ls,
               (SELECT arg_max(price, p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'high' AND p.known_row <= r."row") AS hp,
               (SELECT max(p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'high' AND p.known_row <= r."row") AS hr,
               (SELECT arg_max(price, p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'low' AND p.known_row <= r."row") AS lp,
               (SELECT max(p."row") FROM steps p WHERE p.instrument_id = r.instrument_id AND p.kind = 'low' AND p.known_row <= r."row") AS lr
        FROM rows r),
    stated AS (SELECT *, CASE WHEN hs = 1 AND ls = 1 THEN 'up' WHEN hs = -1 AND ls = -1 THEN 'down' ELSE 'neutral' END AS state FROM latest)"""


@query("w25_pivots", REGION + PIVOTS + ' SELECT instrument_id, date, "row", kind, round(price, 6) AS price, known_row FROM piv')
def w25(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rounded(pivots.pivots(bars(spark, sf_dir)))
    return found.withColumns({c: F.col(c).cast("long") for c in ("row", "known_row")})


@query("w26_structure_states", REGION + PIVOTS + STATES + " SELECT instrument_id, date, state FROM stated")
def w26_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    return pivots.structure_states(prices, pivots.pivots(prices))


@query(
    "w26_structure_breaks",
    REGION
    + PIVOTS
    + STATES
    + """ SELECT instrument_id, date, 'structure_break_up' AS rule, CASE state WHEN 'up' THEN 'bos' WHEN 'down' THEN 'choch' ELSE 'neutral' END AS variant, 'long' AS direction
    FROM stated WHERE close > hp QUALIFY row_number() OVER (PARTITION BY instrument_id, hr ORDER BY "row") = 1
    UNION ALL SELECT instrument_id, date, 'structure_break_down', CASE state WHEN 'down' THEN 'bos' WHEN 'up' THEN 'choch' ELSE 'neutral' END, 'short'
    FROM stated WHERE close < lp QUALIFY row_number() OVER (PARTITION BY instrument_id, lr ORDER BY "row") = 1""",
)
def w26_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    return pivots.structure_breaks(prices, pivots.pivots(prices))


BARS = "SELECT instrument_id, {key} AS period, round(first(open ORDER BY date), 6) AS open, round(max(high), 6) AS high, round(min(low), 6) AS low, round(last(close ORDER BY date), 6) AS close, max(date) AS last_date FROM panel_region GROUP BY 1, 2"


@query("w27_weekly_bars", REGION + " " + BARS.format(key="date_trunc('week', date + 2)::DATE"))
def w27_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pivots.period_bars(bars(spark, sf_dir), "week"))


@query("w27_monthly_bars", REGION + " " + BARS.format(key="date_trunc('month', date)::DATE"))
def w27_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pivots.period_bars(bars(spark, sf_dir), "month"))


CANDLES = """,
    c0 AS (
        SELECT *, lag(close, 1) OVER w / lag(close, 11) OVER w - 1 AS t, abs(close - open) AS b, high - low AS r, greatest(open, close) AS hi, least(open, close) AS lo
        FROM panel_region WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    c AS (
        SELECT *, lag(open) OVER w AS o1, lag(high) OVER w AS h1, lag(low) OVER w AS l1, lag(close) OVER w AS c1, lag(b) OVER w AS b1, lag(r) OVER w AS r1, lag(hi) OVER w AS hi1, lag(lo) OVER w AS lo1, lag(t) OVER w AS t1,
               lag(open, 2) OVER w AS o2, lag(close, 2) OVER w AS c2, lag(b, 2) OVER w AS b2, lag(r, 2) OVER w AS r2, lag(t, 2) OVER w AS t2
        FROM c0 WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    flags AS (
        SELECT instrument_id, date,
            r > 0 AND lo - low >= 2 * b AND high - hi <= 0.1 * r AND b <= 0.3 * r AND t < 0 AS hammer,
            r > 0 AND lo - low >= 2 * b AND high - hi <= 0.1 * r AND b <= 0.3 * r AND t > 0 AS hanging_man,
            r > 0 AND high - hi >= 2 * b AND lo - low <= 0.1 * r AND b <= 0.3 * r AND t < 0 AS inverted_hammer,
            r > 0 AND high - hi >= 2 * b AND lo - low <= 0.1 * r AND b <= 0.3 * r AND t > 0 AS shooting_star,
            c1 < o1 AND close > open AND open <= c1 AND close >= o1 AND t1 < 0 AS bullish_engulfing,
            c1 > o1 AND close < open AND open >= c1 AND close <= o1 AND t1 > 0 AS bearish_engulfing,
            c2 < o2 AND b2 >= 0.6 * r2 AND b1 <= 0.3 * b2 AND hi1 < c2 AND close > open AND close > (o2 + c2) / 2 AND t2 < 0 AS morning_star,
            c2 > o2 AND b2 >= 0.6 * r2 AND b1 <= 0.3 * b2 AND lo1 > c2 AND close < open AND close < (o2 + c2) / 2 AND t2 > 0 AS evening_star,
            c2 < o2 AND b2 >= 0.6 * r2 AND b1 <= 0.3 * b2 AND hi1 < c2 AND close > open AND close > (o2 + c2) / 2 AND t2 < 0 AND b1 <= 0.1 * r1 AS morning_doji_star,
            c2 > o2 AND b2 >= 0.6 * r2 AND b1 <= 0.3 * b2 AND lo1 > c2 AND close < open AND close < (o2 + c2) / 2 AND t2 > 0 AND b1 <= 0.1 * r1 AS evening_doji_star,
            c1 < o1 AND b1 >= 0.6 * r1 AND close > open AND open < l1 AND close > (o1 + c1) / 2 AND close < o1 AND t1 < 0 AS piercing_line,
            c1 > o1 AND b1 >= 0.6 * r1 AND close < open AND open > h1 AND close < (o1 + c1) / 2 AND close > o1 AND t1 > 0 AS dark_cloud_cover,
            c1 < o1 AND close > open AND hi <= hi1 AND lo >= lo1 AND t1 < 0 AS bullish_harami,
            c1 > o1 AND close < open AND hi <= hi1 AND lo >= lo1 AND t1 > 0 AS bearish_harami,
            c2 > o2 AND c1 > o1 AND close > open AND c1 > c2 AND close > c1 AND o1 BETWEEN o2 AND c2 AND open BETWEEN o1 AND c1 AND t2 < 0 AS three_white_soldiers,
            c2 < o2 AND c1 < o1 AND close < open AND c1 < c2 AND close < c1 AND o1 BETWEEN c2 AND o2 AND open BETWEEN c1 AND o1 AND t2 > 0 AS three_black_crows
        FROM c),
    days AS (UNPIVOT flags ON {names} INTO NAME pattern VALUE f)""".replace("{names}", ", ".join(candles.PATTERNS))


@query("w28_candles", REGION + CANDLES + " SELECT instrument_id, date, pattern, CASE WHEN pattern IN (" + ", ".join(f"'{k}'" for k, (d, _) in candles.PATTERNS.items() if d == "long") + ") THEN 'long' ELSE 'short' END AS direction FROM days WHERE f")
def w28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles.candle_days(bars(spark, sf_dir))


@query("g02_baseline", REGION + f" SELECT instrument_id, round(avg((later > close)::INT), 6) AS up_rate, count(*) AS n, avg((later > close)::INT) >= 0.5 AS usual_up FROM (SELECT *, lead(close, 20) OVER w AS later FROM panel_region {W}) WHERE later IS NOT NULL GROUP BY 1")
def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(returns.usual_direction(returns.forward_direction(bars(spark, sf_dir), 20)))


def nation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ret_20 and the distance from the 50-day mean, by nation."""
    rows = fx.panel(spark, sf_dir, "nation").drop("sector")
    mean = guarded(F.avg, F.col("close"), 50)
    return rows.select(*KEYS, returns.log_return("close", 20).alias("ret_20"), F.ln(F.col("close") / mean).alias("ema_dist_50"))


NATION_FEATURES = """,
    feats AS (
        SELECT instrument_id, date, ln(close) - lag(ln(close), 20) OVER w AS ret_20,
               CASE WHEN count(close) OVER r = 50 THEN ln(close / avg(close) OVER r) END AS dist
        FROM panel_nation WINDOW w AS (PARTITION BY instrument_id ORDER BY date), r AS (PARTITION BY instrument_id ORDER BY date ROWS 49 PRECEDING))"""


@query(
    "g06_sector_rel",
    fx.prelude("nation", "universe")
    + NATION_FEATURES
    + """, med AS (SELECT date, sector, quantile_cont(ret_20, 0.5) AS m FROM feats JOIN universe USING (instrument_id) WHERE asset_class = 'equity' GROUP BY 1, 2)
    SELECT instrument_id, f.date, round(ret_20, 6) AS ret_20, round(CASE WHEN asset_class = 'equity' THEN m END, 6) AS sector_ret_20,
           round(CASE WHEN asset_class = 'equity' THEN ret_20 - m END, 6) AS sector_rel_20
    FROM feats f JOIN universe u USING (instrument_id) LEFT JOIN med ON med.date = f.date AND med.sector = u.sector""",
)
def g06_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_section.with_sector_relative(nation_features(spark, sf_dir), fx.universe(spark, sf_dir))
    return rounded(found.select(*KEYS, "ret_20", "sector_ret_20", "sector_rel_20"))


@query("g06_breadth", NATION + NATION_FEATURES + " SELECT date, round(avg((dist > 0)::INT), 6) AS breadth_50 FROM feats GROUP BY 1")
def g06_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cross_section.breadth(nation_features(spark, sf_dir)))


@query("g07_leader_relative", NATION + NATION_FEATURES + " SELECT f.instrument_id, f.date, round(f.ret_20 - l.ret_20, 6) AS leader_rel FROM feats f LEFT JOIN feats l ON l.date = f.date AND l.instrument_id = 'CZ00001'")
def g07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cross_section.relative_to(nation_features(spark, sf_dir), "CZ00001").select(*KEYS, "leader_rel"))


@query("s_hourly_bars", "SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, round(first(value ORDER BY ts, event_id), 6) AS open, round(max(value), 6) AS high, round(min(value), 6) AS low, round(last(value ORDER BY ts, event_id), 6) AS close, count(*) AS volume FROM events GROUP BY 1, 2")
def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fx.hourly_bars(spark, sf_dir))


