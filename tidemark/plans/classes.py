"""Queries over the other asset classes, training tasks and published documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.functions.assets import ASSETS, HORIZONS
from tidemark.operators import evaluate, lab, macro, models, record, regime, returns, upsert, walkforward
from tidemark.operators.signals import all_signals
from tidemark.plans import composites as flows
from tidemark.plans.inputs import FEATURES, G08_SQL, LAB, fx_pairs, lab_rows
from tidemark.plans.measure import EACH_REGIME_SQL, LONG_SQL, OUT, outcomes, region_universe
from tidemark.plans.panel import BASKET, KEYS, REGION, bars, log_returns
from tidemark.plans.base import query, rounded
from tidemark.plans.stores import CLASS_SQL, class_of
from tidemark.session import scratch, stored
from tidemark.sources import fixtures as fx

# Inputs of the classes.


def class_prices(spark: SparkSession, sf_dir: str, asset: str) -> DataFrame:
    """instrument_id, date, close of a class: coins are nations' bars, currencies cross rates of regions, bonds yields and a spread as prices."""
    if asset == "crypto":
        return fx.panel(spark, sf_dir, "nation").where(class_of() == "crypto").select(*KEYS, "close")
    if asset == "fx":
        rates = bars(spark, sf_dir).select("date", F.substring("instrument_id", -1, 1).alias("currency"), F.col("close").alias("rate"))
        return upsert.cross_rates(rates, fx_pairs(spark).withColumn("starts", F.lit(None).cast("date"))).select(*KEYS, "close")
    specs = spark.createDataFrame([("SPREAD", "yield_10y-yield_2y"), ("TEN", "yield_10y")], "instrument_id string, spec string")
    series = upsert.spread_series(fx.macro(spark, sf_dir).select("date", "yield_10y", "yield_2y"), specs)
    return upsert.as_price(series.select(*KEYS, (F.col("value") / 1e7).alias("close")), ["close"])


def full_bars(closes: DataFrame) -> DataFrame:
    return closes.withColumns({c: F.col("close") for c in ("open", "high", "low")} | {"volume": F.lit(1.0)})


CLASSES_SQL = fx.prelude("region", "nation", "macro") + f""", rates AS (SELECT date, right(instrument_id, 1) AS currency, close AS rate FROM panel_region),
    pairs AS (SELECT a.c || b.c AS instrument_id, a.c AS base, b.c AS quote FROM (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) a(c) JOIN (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) b(c) ON a.c = '1' AND b.c <> '1' OR a.c <> '1' AND b.c <> '1' AND a.c < b.c),
    every AS (SELECT 'crypto' AS asset, instrument_id, date, close FROM panel_nation WHERE {CLASS_SQL} = 'crypto'
        UNION ALL SELECT 'fx', p.instrument_id, b.date, q.rate / b.rate FROM pairs p JOIN rates b ON b.currency = p.base JOIN rates q ON q.currency = p.quote AND q.date = b.date
        UNION ALL SELECT 'bonds', 'SPREAD', date, exp((yield_10y - yield_2y) / 1e7 / 100) FROM macro WHERE yield_10y IS NOT NULL AND yield_2y IS NOT NULL
        UNION ALL SELECT 'bonds', 'TEN', date, exp(yield_10y / 1e7 / 100) FROM macro WHERE yield_10y IS NOT NULL)"""


@query("a02_ingest_classes", CLASSES_SQL + " SELECT asset, instrument_id, date, round(CASE WHEN date >= DATE '2001-06-01' THEN close * 2 ELSE close END, 6) AS close FROM every WHERE date <= DATE '2001-06-20'")
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored prices of each class up to June, and a provider's from June on, that replace them and end with the last closed day."""
    out = None
    for asset in ("crypto", "fx", "bonds"):
        rows = class_prices(spark, sf_dir, asset)
        fresh = full_bars(rows.where("date >= '2001-06-01'").select(F.col("instrument_id").alias("ticker"), "date", (F.col("close") * 2).alias("close"))).withColumn("source_rank", F.lit(1))
        ids = rows.select("instrument_id").distinct().withColumn("ticker", F.col("instrument_id"))
        last, made = F.lit("2001-06-20").cast("date"), F.lit("2001-06-21").cast("timestamp")
        done = flows.ingest(rows.where("date < '2001-06-15'"), fresh, ids, rows.select("date").distinct(), last, made).select(F.lit(asset).alias("asset"), *KEYS, "close")
        out = done if out is None else out.unionByName(done)
    return rounded(out)


def class_panel(spark: SparkSession, sf_dir: str, asset: str) -> DataFrame:
    """A class's bars with their total return (no actions)."""
    nothing = spark.createDataFrame([], "instrument_id string, date date, dividend double")
    return returns.total_return(full_bars(class_prices(spark, sf_dir, asset)), nothing)


def class_features(spark: SparkSession, sf_dir: str, asset: str) -> DataFrame:
    wide = regime.wide_returns(log_returns(spark, sf_dir), BASKET)
    regimes = regime.regime(wide, BASKET[0], BASKET, ASSETS[asset].regime_history)
    aligned = macro.aligned_to_sessions(fx.macro(spark, sf_dir), fx.sessions(fx.panel(spark, sf_dir)))
    names = region_universe(spark, sf_dir).withColumn("asset_class", F.lit(asset))
    nothing = spark.createDataFrame([], "instrument_id string, date date, dividend double, split_ratio double")
    return flows.build_features(full_bars(class_prices(spark, sf_dir, asset)), nothing, names, regimes, aligned, ASSETS[asset])


@query("a04_features_crypto")
def a04_crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_features(spark, sf_dir, "crypto"))


@query("a04_features_bonds")
def a04_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_features(spark, sf_dir, "bonds"))


@query("a11_daily_forecasts")
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last package of each other class at all horizons, from models of its own."""
    flags = spark.createDataFrame([], "instrument_id string, session date, shock_signals string, shock_market string")
    out = None
    for asset in ("crypto", "fx", "bonds"):
        level = "nation" if asset == "crypto" else "region"
        done = flows.package(spark, class_panel(spark, sf_dir, asset), asset, flags, flows.official_days(spark, sf_dir), flows.implied_now(spark, sf_dir, level)).withColumn("asset", F.lit(asset))
        out = done if out is None else out.unionByName(done)
    return rounded(out)


@query("a33_class_backtests")
def a33(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fold of each class's own walk-forward: asset, horizon, fold, n, hit, brier, coverage and the baseline's."""
    out, y = None, F.col("actual_return")
    for asset in ("crypto", "fx", "bonds"):
        prices = class_panel(spark, sf_dir, asset)
        scored = walkforward.walk_forward_scores(flows.target_rows(prices, HORIZONS), fx.sessions(prices), FEATURES, HORIZONS, ASSETS[asset]).where("actual_return is not null")
        values = {"hit": scalar.hit(F.col("prob_up"), y), "brier": scalar.brier(F.col("prob_up"), y), "covered": scalar.covered(F.col("band_low"), F.col("band_high"), y), "baseline_brier": scalar.brier(F.col("baseline_prob"), y)}
        part = scored.groupBy("horizon", "fold").agg(F.count(F.lit(1)).alias("n"), *(F.avg(v).alias(k) for k, v in values.items())).withColumn("asset", F.lit(asset))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query("a15_scoped_arena", OUT + f", src AS (SELECT {CLASS_SQL} AS scope, * FROM outcomes), {LONG_SQL} SELECT scope, horizon, metric, {flows.SUMMED} FROM v GROUP BY 1, 2, 3")
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Due forecasts of each class resolved, and compared within the class."""
    rows = outcomes(spark, sf_dir).withColumn("scope", class_of())
    return rounded(flows.points(evaluate.scored_long(rows, ["scope", "horizon"]), ["scope", "horizon", "metric"]))


@query("a06_record_points", OUT + f", {EACH_REGIME_SQL}, {LONG_SQL} SELECT horizon, regime, metric, {flows.SUMMED} FROM v GROUP BY 1, 2, 3")
def a06_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.each_regime(outcomes(spark, sf_dir))
    return rounded(flows.points(evaluate.scored_long(rows, ["horizon", "regime"]), ["horizon", "regime", "metric"]))


ARENA_SQL = """, f AS (SELECT instrument_id, date, lead(close, 5) OVER (PARTITION BY instrument_id ORDER BY date) > close AS up FROM panel_region), u AS (SELECT instrument_id, avg(up::INT) >= 0.5 AS usual FROM f WHERE up IS NOT NULL GROUP BY 1),
    v AS (SELECT s.rule, s.direction, s.instrument_id, s.date AS session, (f.up = (s.direction = 'long'))::INT::DOUBLE AS m, (f.up = u.usual)::INT::DOUBLE AS b FROM signals s JOIN f USING (instrument_id, date) JOIN u USING (instrument_id) WHERE f.up IS NOT NULL)"""


@query("a16_indicator_points", REGION + "@SIGNALS" + ARENA_SQL + f" SELECT rule, direction, 5 AS horizon, {flows.SUMMED} FROM v GROUP BY 1, 2")
def a16_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    return rounded(flows.points(evaluate.arena_long(all_signals(prices), prices, (5,)), ["rule", "direction", "horizon"]))


@query("a21_class_arenas", REGION + "@SIGNALS" + ARENA_SQL + f" SELECT {CLASS_SQL} AS asset, rule, 5 AS horizon, {flows.SUMMED} FROM v GROUP BY 1, 2")
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator rules measured within each class."""
    prices = bars(spark, sf_dir)
    signals = all_signals(prices).withColumn("asset", class_of())
    return rounded(flows.points(evaluate.arena_long(signals, prices, (5,), ["asset"]), ["asset", "rule", "horizon"]))


@query("a09_lab_points", LAB + " SELECT universe, threshold, cost, 20 AS horizon, count(*) AS days, count(*) AS n, round(avg(strategy), 6) AS value, round(avg(hold), 6) AS baseline_value, round(avg(strategy - hold), 6) + 0.0 AS delta FROM per GROUP BY 1, 2, 3")
def a09_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lab.periods(lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), 20, lab.grid(spark))
    keys = ["universe", "threshold", "cost", "horizon"]
    return rounded(flows.points(table.select(*keys, F.col("date").alias("day"), F.col("strategy").alias("model"), F.col("hold").alias("base")), keys))


PREDICT_SQL = G08_SQL[: G08_SQL.index("SELECT 'momentum'")] + """SELECT forecast_id, round(coalesce(mm, bm), 6) AS expected_return, round(least(greatest(coalesce(r, br), 0.01), 0.99), 6) AS prob_up,
    round(coalesce(mm, bm) - q * greatest(sqrt(5 / 252.0) * vol_20, 1e-4), 6) AS band_low, round(coalesce(mm, bm) + q * greatest(sqrt(5 / 252.0) * vol_20, 1e-4), 6) AS band_high FROM tr5 f LEFT JOIN bins ON coalesce(sign(f.expected_return)::INTEGER, 0) = bin, base, band"""


@query("m09_momentum_predictions", PREDICT_SQL)
def m09_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).where("horizon = 5").withColumns({"y_5": F.col("actual_return"), "ret_20": F.col("expected_return")})
    plain = rows.drop("expected_return", "prob_up", "band_low", "band_high")
    found = models.predict_baseline(plain, models.fit_baselines(rows, "y_5", 5), "momentum", 5)
    return rounded(found.select("forecast_id", "expected_return", "prob_up", "band_low", "band_high"))


@query("e02_human_model_baseline", flows.THESES.replace("hit, baseline_brier,", "hit, brier, baseline_brier,") + """, d AS (SELECT person, count(*) AS n, avg(b - brier) AS against_model, avg(b - baseline_brier) AS against_baseline FROM th GROUP BY 1)
    SELECT person, n, round(against_model, 6) + 0.0 AS against_model, round(against_baseline, 6) + 0.0 AS against_baseline, CASE WHEN abs(against_model) < 0.005 THEN 'same' WHEN against_model < 0 THEN 'better' ELSE 'worse' END AS model_verdict, CASE WHEN abs(against_baseline) < 0.005 THEN 'same' WHEN against_baseline < 0 THEN 'better' ELSE 'worse' END AS baseline_verdict FROM d""")  # fmt: skip
def e02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A person's loss against the model's and the baseline's on the same theses; within half a per cent is the same."""
    p = F.greatest("prob_up", 1 - F.col("prob_up"))
    rows = outcomes(spark, sf_dir).select(F.col("instrument_id").alias("person"), F.pow(p - F.col("hit"), 2).alias("b"), "brier", "baseline_brier")
    found = rows.groupBy("person").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("b") - F.col("brier")).alias("against_model"), F.avg(F.col("b") - F.col("baseline_brier")).alias("against_baseline"))
    verdict = lambda c: F.when(F.abs(c) < 0.005, "same").when(F.col(c) < 0, "better").otherwise("worse")
    return rounded(found.withColumns({"model_verdict": verdict("against_model"), "baseline_verdict": verdict("against_baseline")}))


# Training and reports.


def train_task(rows: DataFrame, calendar: DataFrame, horizons: tuple[int, ...], path: str, kind: str = "linear", calibration_sessions: int = 252) -> None:
    """Models of all horizons, fitted on everything but the last sessions' calibration window, saved under ``path``."""
    end = calendar.agg(F.max("idx")).first()[0]
    placed = rows.join(calendar, "date")
    fitted = {}
    for h in horizons:
        known, edge = placed.where(F.col("idx") + h <= end), end - h - calibration_sessions
        fitted[h] = models.fit_horizon(known.where(F.col("idx") <= edge), known.where(F.col("idx") > edge), FEATURES, h, kind)
    models.save_models(fitted, FEATURES, path)


def report_task(scored: DataFrame) -> DataFrame:
    """horizon, n, hit, brier, baseline_brier, covered, skill of scored rows."""
    y = F.col("actual_return")
    values = {"hit": scalar.hit(F.col("prob_up"), y), "brier": scalar.brier(F.col("prob_up"), y), "baseline_brier": scalar.brier(F.col("baseline_prob"), y), "covered": scalar.covered(F.col("band_low"), F.col("band_high"), y)}
    found = scored.groupBy("horizon").agg(F.count(F.lit(1)).alias("n"), *(F.avg(v).alias(k) for k, v in values.items()))
    return found.withColumn("skill", 1 - F.try_divide("brier", "baseline_brier"))


def held_out(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows with targets of all horizons and a calendar, and where the last fifth of the sessions begins: what comes after it is reported on."""
    from tidemark.plans.panel import with_tr

    prices = with_tr(spark, sf_dir)
    return stored(flows.target_rows(prices, HORIZONS), "training"), stored(fx.sessions(prices), "calendar")


@query("a07_train_and_report")
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of all horizons trained on the first four fifths of the sessions, saved, loaded again and reported on the last fifth, which they never saw."""
    rows, calendar = held_out(spark, sf_dir)
    path, cut = scratch(spark, "models"), calendar.agg(F.floor(F.max("idx") * 0.8)).first()[0]
    train_task(rows, calendar.where(F.col("idx") <= cut), HORIZONS, path)
    placed, parts = rows.join(calendar, "date"), None
    for h, model in models.load_models(spark, path, HORIZONS).items():
        known = placed.where(F.col(f"y_{h}").isNotNull())
        base = known.where(F.col("idx") + h <= cut).agg(F.avg((F.col(f"y_{h}") > 0).cast("double")).alias("baseline_prob"))
        later = model.predict(known.where(F.col("idx") > cut)).crossJoin(F.broadcast(base))  # one row
        part = later.select(F.lit(h).alias("horizon"), F.col(f"y_{h}").alias("actual_return"), "prob_up", "band_low", "band_high", "baseline_prob")
        parts = part if parts is None else parts.unionByName(part)
    return rounded(report_task(parts))


@query(
    "a07_report_points",
    flows.WALK_TR
    + flows.LATEST_WALK
    + """, cut AS (SELECT floor(max(idx) * 0.8) AS last_seen FROM sessions),
    base AS (SELECT horizon, avg((y > 0)::INT) AS p FROM ahead, cut WHERE y IS NOT NULL AND idx + horizon <= last_seen GROUP BY 1)
    SELECT horizon, count(*) AS n, round(avg(power(p - (y > 0)::INT, 2)), 6) AS baseline_brier FROM ahead JOIN base USING (horizon), cut WHERE y IS NOT NULL AND idx > last_seen GROUP BY 1""",
)
def a07_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the report rests on: held-out rows of each horizon and the loss of the share that rose before."""
    rows, calendar = held_out(spark, sf_dir)
    cut = calendar.agg(F.floor(F.max("idx") * 0.8)).first()[0]
    each = F.explode(F.array(*(F.struct(F.lit(h).alias("horizon"), F.col(f"y_{h}").alias("y")) for h in HORIZONS)))
    long = rows.join(calendar, "date").select("idx", each.alias("x")).select("idx", "x.*").where("y is not null")
    up = (F.col("y") > 0).cast("double")
    # The mean of (p - up)^2 over rows of which a share s rose is p^2 - 2 p s + s.
    found = long.groupBy("horizon").agg(F.avg(F.when(F.col("idx") + F.col("horizon") <= cut, up)).alias("p"), F.count_if(F.col("idx") > cut).alias("n"), F.avg(F.when(F.col("idx") > cut, up)).alias("s"))
    return rounded(found.where("n > 0").select("horizon", "n", (F.col("p") * F.col("p") - 2 * F.col("p") * F.col("s") + F.col("s")).alias("baseline_brier")))


# Documents.


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind, key, document of everything that is published."""
    names = region_universe(spark, sf_dir).withColumn("ticker", F.col("sector"))
    prices, due, rows = bars(spark, sf_dir), outcomes(spark, sf_dir), fx.forecasts(spark, sf_dir)
    named = lambda t, kind, key: t.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "document")
    table = lab.summary(lab.periods(lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), 20, lab.grid(spark)))
    packed = lambda t, key, *fields: t.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*(scalar.number(F.col(c), 6).alias(c) if d == "double" else F.col(c) for c, d in t.dtypes if c in fields))))).alias("document"))
    live = flows.points(flows.models_live(flows.families(spark, sf_dir), "main", 3), ["horizon", "family", "metric"])
    parts = [
        named(record.instrument_documents(names, prices, rows, due), "instrument", "instrument_id"),
        named(record.history_documents(prices), "history", "instrument_id"),
        named(packed(record.screener(names, prices, due).withColumn("all", F.lit("index")), "all", "instrument_id", "ticker", "close", "change", "n", "skill"), "index", "all"),
        named(packed(flows.points(evaluate.scored_long(due, ["horizon"]), ["horizon", "metric"]), "horizon", "metric", "n", "value", "baseline_value", "delta"), "arena", "horizon"),
        named(packed(live, "horizon", "family", "metric", "n", "value", "delta"), "model_arena", "horizon"),
        named(packed(table, "universe", "threshold", "cost", "ann_return", "bh_ann_return", "max_drawdown"), "lab", "universe"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a34_documents")
def a34(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir)


@query("a34_document_keys", OUT + " SELECT 'instrument' AS kind, instrument_id AS key FROM (SELECT DISTINCT instrument_id FROM panel_region) UNION ALL SELECT 'history', instrument_id FROM (SELECT DISTINCT instrument_id FROM panel_region) UNION ALL SELECT 'index', 'index' UNION ALL SELECT k, h::VARCHAR FROM (SELECT DISTINCT horizon AS h FROM outcomes), (VALUES ('arena'), ('model_arena')) t(k) UNION ALL SELECT 'lab', u FROM (VALUES ('all'), ('main'), ('cross')) t(u)")
def a34_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("kind", "key")


def _fill_in() -> None:
    from tidemark.plans.panel import ALL_SIGNALS, EWM, MACD
    from tidemark.plans.base import ORACLES

    for name in ("a16_indicator_points", "a21_class_arenas"):
        ORACLES[name] = ORACLES[name].replace("@SIGNALS", EWM + MACD + ALL_SIGNALS)


_fill_in()
