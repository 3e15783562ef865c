"""End-to-end flows: ingest, feature build, walk-forward backtest, daily forecast, live comparison, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import calendars, quality, scalar
from tidemark.functions.assets import ASSETS, HORIZONS, Asset
from tidemark.operators import confluence, cross_section, evaluate, macro, models, record, regime, resolve, returns, technical, upsert, walkforward
from tidemark.operators.signals import all_signals
from tidemark.plans.inputs import FEATURES, offered, ready
from tidemark.plans.measure import EACH_REGIME_SQL, LONG_SQL, OUT, market, outcomes, region_universe, shock_frame, thin_series
from tidemark.plans.panel import BASKET, KEYS, REGION, TR, bars, log_returns, with_tr
from tidemark.plans.base import comparable, query, rounded
from tidemark.plans.twins import records_sql
from tidemark.session import stored
from tidemark.sources import feeds
from tidemark.sources import fixtures as fx


def ingest(kept: DataFrame, offered: DataFrame, ids: DataFrame, sessions: DataFrame, last: Column, fetched_at: Column, replaced: DataFrame | None = None) -> DataFrame:
    """Provider rows of ranked sources into the stored prices: first source with any row, canonical rows, upsert."""
    best = upsert.by_priority(offered)
    fresh = quality.canonical(best, ids, sessions, last, fetched_at, [F.col("source_rank")])
    return upsert.upsert(kept, fresh, replaced)


def build_features(prices: DataFrame, actions: DataFrame, universe: DataFrame, regimes: DataFrame, macro_on_sessions: DataFrame, asset: Asset) -> DataFrame:
    """All features of an asset class, one lazy plan from prices on: technical, cross-sectional, macro, regime."""
    own = technical.features(returns.total_return(prices, actions))
    if asset.name == "equity":
        own = cross_section.with_sector_relative(own, universe).drop("asset_class", "sector")
    elif asset.name == "crypto":
        own = cross_section.relative_to(own, BASKET[0])
    else:
        own = own.drop("volume_anomaly_20", "gap_1")
    return own.join(cross_section.breadth(own), "date", "left").join(macro.with_changes(macro_on_sessions), "date", "left").join(regimes.select("date", "stress", "regime"), "date", "left")


def fittable(train: DataFrame, calibration: DataFrame, target: str) -> bool:
    """Whether both have a row with a label."""
    return not any(rows.where(F.col(target).isNotNull()).isEmpty() for rows in (train, calibration))


def points(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a comparison rests on, before any resampling: keys, days, n, value, baseline_value, delta."""
    total = F.sum("n")
    return evaluate.daily_cells(long, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("days"), total.alias("n"), (F.sum("model") / total).alias("value"), (F.sum("base") / total).alias("baseline_value"), (F.sum("d") / total).alias("delta"))


def with_scores(rows: DataFrame) -> DataFrame:
    y = F.col("actual_return")
    return rows.withColumns({"hit": scalar.hit(F.col("prob_up"), y), "brier": scalar.brier(F.col("prob_up"), y)})


def shared_sample(rows: DataFrame, families: int, keys: Sequence[str] = ("instrument_id", "session", "horizon")) -> DataFrame:
    """Rows of the keys that all families forecast."""
    full = rows.groupBy(*keys).agg(F.count_distinct("family").alias("__f")).where(F.col("__f") == families).select(*keys)
    return rows.join(full, [*keys], "left_semi")


def models_live(rows: DataFrame, main: str, families: int) -> DataFrame:
    """horizon, family, metric, day, model, base: every other family against the main one, on what all of them forecast."""
    shared = shared_sample(rows, families)
    others = shared.where(F.col("family") != main)
    base = shared.where(F.col("family") == main).select("instrument_id", "session", "horizon", F.col("hit").alias("base_hit"), F.col("brier").alias("base_brier"))
    pair = lambda m, a, b: F.struct(F.lit(m).alias("metric"), F.col(a).alias("model"), F.col(b).alias("base"))
    both = others.join(base, ["instrument_id", "session", "horizon"])
    return both.select("horizon", "family", F.col("session").alias("day"), F.explode(F.array(pair("direction_accuracy", "hit", "base_hit"), pair("brier", "brier", "base_brier"))).alias("m")).select("horizon", "family", "day", "m.*")


def implied_comparisons(rows: DataFrame) -> DataFrame:
    """horizon, metric, day, model, base: the model against the market's implied probability, where it has one."""
    y, known = F.col("actual_return"), rows.where((F.col("implied_status") == "ok") & F.col("implied_prob_up").isNotNull())
    pair = lambda m, f: F.struct(F.lit(m).alias("metric"), f(F.col("prob_up"), y).alias("model"), f(F.col("implied_prob_up"), y).alias("base"))
    return known.select("horizon", F.col("session").alias("day"), F.explode(F.array(pair("direction_accuracy", scalar.hit), pair("brier", scalar.brier))).alias("m")).select("horizon", "day", "m.*")


def daily_package(parts: DataFrame, calendar: DataFrame, version: str, made_at: Column, flags: DataFrame, events: DataFrame, implied: DataFrame) -> DataFrame:
    """One session's forecasts in returns and prices, with target, events, shock flags and the implied columns.

    ``parts`` has instrument_id, session, horizon, close, expected_return, scale, prob_up, band_low and band_high, a row a
    horizon; ``flags`` has instrument_id, session, shock_signals and shock_market; a session
    on which the market itself is in shock has its probabilities withheld.
    """
    placed = calendars.events_in_window(calendars.with_target(parts, calendar), events, calendar)
    flagged = placed.join(flags, ["instrument_id", "session"], "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("shock_signals", "shock_market")})
    named = feeds.attach_implied(flagged, implied).withColumns(
        {
            "forecast_id": scalar.forecast_id(F.col("instrument_id"), F.col("session"), F.col("horizon"), F.lit(version)),
            "price_low": scalar.price_band(F.col("close"), F.col("band_low")),
            "price_high": scalar.price_band(F.col("close"), F.col("band_high")),
            "withheld": F.col("shock_market") != "",
            "made_at": made_at,
        }
    )
    return named.withColumn("prob_up", scalar.masked(F.col("prob_up"), F.col("withheld")))


def paired_long(challenger: DataFrame, main: DataFrame, keys: Sequence[str] = ("instrument_id", "session", "horizon")) -> DataFrame:
    """Challenger against main on the forecasts that both made: horizon, metric, day, model, base."""
    other = main.select(*keys, F.col("hit").alias("base_hit"), F.col("brier").alias("base_brier"))
    both = challenger.join(other, [*keys])
    pair = lambda m, a, b: F.struct(F.lit(m).alias("metric"), F.col(a).alias("model"), F.col(b).alias("base"))
    return both.select("horizon", F.col("session").alias("day"), F.explode(F.array(pair("direction_accuracy", "hit", "base_hit"), pair("brier", "brier", "base_brier"))).alias("m")).select("horizon", "day", "m.*")


def label_share(regimes: DataFrame, windows: DataFrame) -> DataFrame:
    """name, label, share: of the days in each named interval the share that carries a label."""
    inside = windows.join(regimes, F.col("date").between(F.col("first"), F.col("last")))
    return inside.groupBy("name", "label").agg(F.avg((F.coalesce(F.col("regime"), F.lit("")) == F.col("label")).cast("double")).alias("share"))


# Queries.


@query("a01_ingest", fx.prelude("nation", "universe") + """, offered AS (SELECT ticker, date, 1 AS source_rank, close FROM panel_nation JOIN universe USING (instrument_id) WHERE segment = 'main' AND asset_class = 'equity' UNION ALL SELECT ticker, date, 2, close * 2 FROM panel_nation JOIN universe USING (instrument_id) WHERE segment = 'main' UNION ALL SELECT ticker, date, 3, close * 4 FROM panel_nation JOIN universe USING (instrument_id)),
    best AS (SELECT ticker, min(source_rank) AS source_rank FROM offered GROUP BY 1),
    fresh AS (SELECT u.instrument_id, o.date, o.close FROM offered o JOIN best USING (ticker, source_rank) JOIN universe u USING (ticker) WHERE date >= DATE '2001-06-01' AND date <= DATE '2001-09-30'),
    old AS (SELECT instrument_id, date, close FROM panel_nation WHERE date < DATE '2001-07-01')
    SELECT instrument_id, date, round(close, 6) AS close FROM fresh UNION ALL SELECT instrument_id, date, round(close, 6) FROM old ANTI JOIN fresh USING (instrument_id, date)""")  # fmt: skip
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, rows = fx.universe(spark, sf_dir), fx.panel(spark, sf_dir, "nation")
    provider = offered(spark, sf_dir).where("date >= '2001-06-01'").withColumns({c: F.col("close") for c in ("open", "high", "low")} | {"volume": F.lit(1.0)})
    before = rows.where("date < '2001-07-01'").select(*KEYS, "close")
    merged = ingest(before, provider, names, rows.select("date").distinct(), F.lit("2001-09-30").cast("date"), F.lit("2001-10-01").cast("timestamp"))
    return rounded(merged.select(*KEYS, "close"))


def _features(spark: SparkSession, sf_dir: str, asset: str) -> DataFrame:
    wide = regime.wide_returns(log_returns(spark, sf_dir), BASKET)
    regimes = regime.regime(wide, BASKET[0], BASKET, ASSETS[asset].regime_history)
    aligned = macro.aligned_to_sessions(fx.macro(spark, sf_dir), fx.sessions(fx.panel(spark, sf_dir)))
    names = region_universe(spark, sf_dir).withColumn("asset_class", F.lit("equity"))
    return build_features(bars(spark, sf_dir), fx.actions(spark, sf_dir), names, regimes, aligned, ASSETS[asset])


@query("a03_features_equity")
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return technical.as_floats(_features(spark, sf_dir, "equity"))


@query("a04_features_fx")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return technical.as_floats(_features(spark, sf_dir, "fx"))


@query("g15_label_share", REGION + TR + ", v AS (SELECT date, CASE WHEN max(ret) FILTER (instrument_id = 'CZ00001') > 0 THEN 'calm' ELSE 'stressed' END AS regime FROM rets GROUP BY 1) SELECT w.name, w.label, round(avg((v.regime = w.label)::INT), 6) AS share FROM (VALUES ('early', DATE '1996-01-01', DATE '1996-12-31', 'calm'), ('late', DATE '2000-01-01', DATE '2000-06-30', 'stressed')) w(name, first, last, label) JOIN v ON v.date BETWEEN w.first AND w.last GROUP BY 1, 2")
def g15(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = F.max(F.when(F.col("instrument_id") == "CZ00001", F.col("ret"))) > 0
    days = log_returns(spark, sf_dir).groupBy("date").agg(F.when(up, "calm").otherwise("stressed").alias("regime"))
    windows = spark.sql("SELECT * FROM VALUES ('early', DATE '1996-01-01', DATE '1996-12-31', 'calm'), ('late', DATE '2000-01-01', DATE '2000-06-30', 'stressed') AS w(name, first, last, label)")
    return rounded(label_share(days, windows))


def target_rows(prices: DataFrame, horizons: Sequence[int], least: int = 252) -> DataFrame:
    """Features and targets of priced rows with enough history."""
    targets = returns.with_targets(prices, list(horizons), "tr_log").select(*KEYS, *(f"y_{h}" for h in horizons))
    return technical.features(prices, "tr_log").join(targets, KEYS).where(F.col("history_sessions") >= least)


#: Families of the walk-forward: all features, and the control on an instrument's own returns.
FAMILIES = {"linear": FEATURES, "ar": walkforward.AR_INPUTS}
WALKED = list(dict.fromkeys([*FEATURES, *walkforward.AR_INPUTS]))


def walked(spark: SparkSession, sf_dir: str, families: dict[str, Sequence[str]]) -> DataFrame:
    """Every fold of every horizon, for each family."""
    prices = with_tr(spark, sf_dir)
    used = [c for c in WALKED if any(c in columns for columns in families.values())]
    return walkforward.walk_forward_scores(target_rows(prices, HORIZONS), fx.sessions(prices), used, HORIZONS, ASSETS["equity"], families)


@query("a05_backtest")
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fold of the linear model at all horizons."""
    return rounded(walked(spark, sf_dir, {"linear": FEATURES}))


#: The horizons; folds of all of them, or the last session's; the labelled rows, and what each day is to each fold.
HORIZON_LIST = f""", hz AS (SELECT unnest({list(HORIZONS)})::INTEGER AS horizon),"""
FOLDS_PLAN = """
    starts AS (SELECT k AS fold, 756 + k * 504 AS start FROM (SELECT unnest(range(100))::INTEGER AS k) WHERE 756 + k * 504 + 504 <= (SELECT max(idx) FROM sessions)),
    plan AS (
        SELECT horizon, fold, greatest(0, start - horizon - 1) + 1 - horizon AS last_label, greatest(0, start - horizon - 1) + 1 - horizon - 252 AS edge, start + 1 AS first_test, start + 504 AS last_test
        FROM starts, hz),"""
LATEST_PLAN = """
    plan AS (SELECT horizon, 0 AS fold, m - horizon AS last_label, m - horizon - 252 AS edge, m AS first_test, m AS last_test FROM hz, (SELECT max(idx) AS m FROM sessions)),"""
DAY_ROLES = """
    priced AS (SELECT instrument_id, date, idx, close, ltr, row_number() OVER w AS n, lag(ltr, 20) OVER w AS before FROM walk_tr JOIN sessions USING (date) WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    ahead AS (SELECT p.*, horizon, a.ltr - p.ltr AS y FROM priced p CROSS JOIN hz LEFT JOIN (SELECT instrument_id, n AS later, ltr FROM priced) a ON a.instrument_id = p.instrument_id AND a.later = p.n + horizon WHERE p.n >= 252),
    days AS (SELECT horizon, date, idx, row_number() OVER (PARTITION BY horizon ORDER BY date) - 1 AS k FROM (SELECT DISTINCT horizon, date, idx FROM ahead WHERE y IS NOT NULL)),
    days_of AS (
        SELECT d.horizon, fold, date, 'train' AS role FROM days d JOIN plan p ON p.horizon = d.horizon AND idx <= edge WHERE k % greatest(1, d.horizon // 5) = 0
        UNION ALL SELECT horizon, fold, date, CASE WHEN half = 1 THEN 'band' ELSE 'prob' END FROM (
            SELECT d.horizon, fold, date, ntile(2) OVER (PARTITION BY d.horizon, fold ORDER BY date) AS half FROM days d JOIN plan p ON p.horizon = d.horizon AND idx > edge AND idx <= last_label)
        UNION ALL SELECT horizon, fold, date, 'test' FROM plan JOIN sessions ON idx BETWEEN first_test AND last_test),
    placed AS MATERIALIZED (SELECT a.*, fold, role FROM ahead a JOIN days_of d ON d.date = a.date AND d.horizon = a.horizon WHERE role = 'test' OR y IS NOT NULL)"""
WALK, LATEST_WALK = (HORIZON_LIST + plan + DAY_ROLES for plan in (FOLDS_PLAN, LATEST_PLAN))
#: Total return by instrument and day, as the logarithm.
WALK_TR = fx.prelude("region", "sessions") + """, walk_g AS (
        SELECT p.instrument_id, p.date, p.close, coalesce((p.close + coalesce(a.dividend, 0)) / lag(p.close) OVER (PARTITION BY p.instrument_id ORDER BY p.date), 1.0) AS g
        FROM panel_region p LEFT JOIN actions_region a USING (instrument_id, date)),
    walk_tr AS MATERIALIZED (SELECT instrument_id, date, close, sum(ln(g)) OVER (PARTITION BY instrument_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS ltr FROM walk_g)"""


@query("a05_fold_parts", WALK_TR + WALK + " SELECT horizon, fold, count(*) FILTER (role = 'train') AS train, count(*) FILTER (role IN ('band', 'prob')) AS calibration, count(*) FILTER (role = 'test') AS test FROM placed GROUP BY 1, 2")
def a05_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows every fold of every horizon trains, calibrates and tests on."""
    prices = with_tr(spark, sf_dir)
    rows = stored(target_rows(prices, HORIZONS), "history")
    days = walkforward.roles(rows, fx.sessions(prices), HORIZONS, ASSETS["equity"])
    placed = walkforward.placed_rows(rows, days, ["ret_5"], HORIZONS, KEYS)
    own = placed.groupBy("horizon", "fold").agg(*(F.count_if(F.col("role").isin(*of)).alias(name) for name, of in (("train", ["train"]), ("calibration", ["band", "prob"]), ("test", ["test"]))))
    # A training day stands under its first fold and trains all later ones.
    so_far = Window.partitionBy("horizon").orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumn("train", F.sum("train").over(so_far))


#: A ridge on one feature, its bands and the naive baseline, over ``placed``.
ONE_FEATURE = """, rows AS (SELECT *, ltr - before AS x FROM placed),
    vol AS (SELECT instrument_id, date, stddev_samp(r) OVER (PARTITION BY instrument_id ORDER BY date ROWS 19 PRECEDING) * sqrt(252.0) AS vol_20
            FROM (SELECT instrument_id, date, ltr - lag(ltr) OVER (PARTITION BY instrument_id ORDER BY date) AS r FROM walk_tr)),
    moments AS (SELECT horizon, fold, count(*) AS m, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS cxy, avg((y > 0)::INT) AS rate FROM rows WHERE role = 'train' GROUP BY 1, 2),
    fits AS (SELECT *, CASE WHEN vx > 1e-24 THEN m * cxy / (m * vx + vx) ELSE 0 END AS w FROM moments),
    points AS (
        SELECT r.*, rate, my + w * (x - mx) AS point, greatest(sqrt(horizon / 252.0) * vol_20, 1e-4) AS scale FROM rows r JOIN fits USING (horizon, fold) JOIN vol USING (instrument_id, date) WHERE role <> 'train'),
    bands AS (SELECT horizon, fold, quantile_cont(abs((y - point) / scale), 0.9) AS q FROM points WHERE role = 'band' GROUP BY 1, 2)
    SELECT @COLUMNS
    FROM points JOIN bands USING (horizon, fold) WHERE role = 'test' AND (horizon, fold) IN (SELECT (horizon, fold) FROM points WHERE role = 'prob')"""


@query(
    "a05_one_feature",
    WALK_TR
    + WALK
    + ONE_FEATURE.replace("@COLUMNS", """instrument_id, date, horizon, fold, round(y, 6) AS actual_return, round(point, 6) AS expected_return, round(least(greatest(rate, 0.01), 0.99), 6) AS baseline_prob,
           round(point - q * scale, 6) AS band_low, round(point + q * scale, 6) AS band_high"""),
)
def a05_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fold of every horizon of a ridge on one feature, whose closed form SQL can say: points, bands, the naive baseline."""
    found = walked(spark, sf_dir, {"momentum": ["ret_20"]})
    return rounded(found.select(*KEYS, "horizon", "fold", "actual_return", "expected_return", "baseline_prob", "band_low", "band_high"))


@query("a08_challenger_records")
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control and the ensemble against the linear model, on every fold of all horizons."""
    rows = with_scores(walked(spark, sf_dir, FAMILIES).where("actual_return is not null").withColumnRenamed("date", "session"))
    return comparable(evaluate.records(models_live(rows, "linear", 3), ["family", "horizon", "metric"], []))


@query(
    "a08_baseline_points",
    WALK_TR
    + WALK
    + """, rate AS (SELECT horizon, fold, least(greatest(avg((y > 0)::INT), 0.01), 0.99) AS p FROM placed WHERE role = 'train' GROUP BY 1, 2),
    tested AS (SELECT * FROM placed JOIN rate USING (horizon, fold) WHERE role = 'test' AND y IS NOT NULL AND (horizon, fold) IN (SELECT (horizon, fold) FROM placed WHERE role = 'prob'))
    SELECT horizon, fold, count(DISTINCT date) AS days, count(*) AS n, round(avg(((p > 0.5) = (y > 0))::INT), 6) AS baseline_hit, round(avg(power(p - (y > 0)::INT, 2)), 6) AS baseline_brier FROM tested GROUP BY 1, 2""",
)
def a08_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the challengers' records rest on: days, rows and the naive baseline of every fold of all horizons."""
    y, p = F.col("actual_return"), F.col("baseline_prob")
    rows = walked(spark, sf_dir, {"ar": walkforward.AR_INPUTS}).where("actual_return is not null")
    return rounded(rows.groupBy("horizon", "fold").agg(F.count_distinct("date").alias("days"), F.count(F.lit(1)).alias("n"), F.avg(scalar.hit(p, y)).alias("baseline_hit"), F.avg(scalar.brier(p, y)).alias("baseline_brier")))


def official_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, day: of each priority of orders the first order of every month, as a schedule of official days."""

    def make() -> DataFrame:
        rows = fx.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("kind"), F.to_date("o_orderdate").alias("day"))
        return rows.groupBy("kind", F.trunc("day", "month").alias("month")).agg(F.min("day").alias("day")).select(F.concat_ws("-", "kind", F.date_format("month", "yyyyMM")).alias("event_id"), "day")

    return fx.once("official_days", (sf_dir,), make)


def implied_now(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """The market-implied columns of every instrument of a panel at its last close, from a chain of calls on it."""
    return feeds.implied_table(call_chains(fx.panel(spark, sf_dir, level)))


def package(spark: SparkSession, prices: DataFrame, asset: str, flags: DataFrame, events: DataFrame, implied: DataFrame, horizons: Sequence[int] = HORIZONS, features: Sequence[str] = FEATURES) -> DataFrame:
    """The last session's package of one asset class, from models of all horizons fitted in one scan on what was known a horizon before it."""
    calendar, own = fx.sessions(prices), ASSETS[asset]
    rows = target_rows(prices, horizons, own.regime_history)
    scores = walkforward.walk_forward_scores(rows, calendar, features, horizons, own, {"linear": features}, plan=walkforward.latest_plan(calendar, horizons, own))
    named = scores.join(prices.select(*KEYS, "close"), KEYS).withColumnRenamed("date", "session")
    parts = named.select("instrument_id", "session", "horizon", "close", "expected_return", "scale", "prob_up", "band_low", "band_high")
    return daily_package(parts, calendar, f"{asset}-v1", F.lit("2002-01-01 22:00:00").cast("timestamp"), flags, events, implied)


def shock_flags(frame: DataFrame, days: DataFrame) -> DataFrame:
    """instrument_id, session, shock_signals, shock_market of the days with any."""
    names = (("volume_z", 4.0, "volume"), ("gap_sigma", 3.0, "gap"), ("move_sigma", 4.0, "move"))
    own = F.concat_ws(",", *(F.when(F.col(c) > least, name) for c, least, name in names))
    rows = frame.where("enough").select("instrument_id", F.col("date").alias("session"), own.alias("shock_signals"))
    on_market = days.where("market_flag").select(F.col("date").alias("session"), F.concat_ws(",", F.when(F.col("vix"), "vix"), F.when(F.col("cross"), "cross")).alias("shock_market"))
    return rows.join(on_market, "session", "left").where("shock_signals <> '' or shock_market is not null")


@query("a10_daily_forecast")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last session's package of all horizons: features, fitted models, targets, events, shocks and implied columns."""
    flags = shock_flags(shock_frame(spark, sf_dir), market(spark, sf_dir))
    return rounded(package(spark, with_tr(spark, sf_dir), "equity", flags, official_days(spark, sf_dir), implied_now(spark, sf_dir)))


@query(
    "a10_one_feature",
    WALK_TR
    + LATEST_WALK
    + ONE_FEATURE.replace("@COLUMNS", """instrument_id, date AS session, horizon, round(close, 6) AS close, round(point, 6) AS expected_return, round(exp(ln(close) + point - q * scale), 6) AS price_low,
           round(exp(ln(close) + point + q * scale), 6) AS price_high"""),
)
def a10_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The package of a model whose closed form SQL can say: closes, points and price bands of all horizons."""
    none = spark.createDataFrame([], "instrument_id string, session date, shock_signals string, shock_market string")
    found = package(spark, with_tr(spark, sf_dir), "equity", none, official_days(spark, sf_dir), implied_now(spark, sf_dir), features=["ret_20"])
    return rounded(found.select("instrument_id", "session", "horizon", "close", "expected_return", "price_low", "price_high"))


@query("a12_resolve_due", OUT + " SELECT resolution_type, horizon, count(*) AS n FROM outcomes WHERE target_session <= DATE '2000-12-31' GROUP BY 1, 2")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.resolve_due(fx.forecasts(spark, sf_dir), thin_series(spark, sf_dir), F.lit("2000-12-31").cast("date"))
    return found.groupBy("resolution_type", "horizon").agg(F.count(F.lit(1)).alias("n"))


IMPLIED = """implied AS (SELECT *, 0.5 + 0.4 * (baseline_prob - 0.5) AS p FROM outcomes WHERE horizon = 20 AND day(session) % 5 <> 0),
    ix AS (
        SELECT horizon, session, unnest([
            {'k': 'direction_accuracy', 'm': hit, 'b': ((p > 0.5) = (actual_return > 0))::INT::DOUBLE}, {'k': 'brier', 'm': brier, 'b': power(p - (actual_return > 0)::INT, 2)}]) AS s FROM implied),
    live AS (
        SELECT horizon, regime, session, metric, m, b FROM v
        UNION ALL SELECT horizon, 'implied', session, s.k, s.m, s.b FROM ix)"""


@query("a13_live_arena", OUT + f", {EACH_REGIME_SQL}, {LONG_SQL}, {IMPLIED}, " + records_sql("live", ["horizon", "regime", "metric"], ["regime"]))
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records over all and by regime, and the model against the market's implied probability."""
    rows = stored(with_implied(outcomes(spark, sf_dir)), "live")
    each = evaluate.each_regime(rows)
    own = evaluate.records(evaluate.scored_long(each, ["horizon", "regime"]), ["horizon", "regime", "metric"], ["regime"])
    implied = evaluate.records(implied_comparisons(rows), ["horizon", "metric"], []).withColumn("regime", F.lit("implied"))
    return comparable(own.unionByName(implied))


def with_implied(rows: DataFrame) -> DataFrame:
    """A made-up implied probability of the twenty-day forecasts."""
    has = (F.col("horizon") == 20) & (F.dayofmonth("session") % 5 != 0)
    return rows.withColumns({"implied_status": F.when(has, "ok").otherwise("fetch_failed"), "implied_prob_up": F.when(has, 0.5 + 0.4 * (F.col("baseline_prob") - 0.5))})


SUMMED = "count(DISTINCT session) AS days, count(*) AS n, round(avg(m), 6) AS value, round(avg(b), 6) AS baseline_value, round(avg(m - b), 6) + 0.0 AS delta"
IMPLIED_SQL = OUT + ", i AS (SELECT *, 0.5 + 0.4 * (baseline_prob - 0.5) AS p FROM outcomes WHERE horizon = 20 AND day(session) % 5 <> 0), x AS (SELECT horizon, session, unnest([{'k': 'direction_accuracy', 'm': hit, 'b': ((p > 0.5) = (actual_return > 0))::INT::DOUBLE}, {'k': 'brier', 'm': brier, 'b': power(p - (actual_return > 0)::INT, 2)}]) AS s FROM i), v AS (SELECT horizon, session, s.k AS metric, s.m AS m, s.b AS b FROM x)"


@query("a13_implied_points", IMPLIED_SQL + f" SELECT horizon, metric, {SUMMED} FROM v GROUP BY 1, 2")
def a13_implied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(points(implied_comparisons(with_implied(outcomes(spark, sf_dir))), ["horizon", "metric"]))


FAMILIES_SQL = OUT + """, fam AS (
        SELECT 'main' AS family, * FROM outcomes UNION ALL SELECT 'calm', * REPLACE (power((prob_up + baseline_prob) / 2 - (actual_return > 0)::INT, 2) AS brier, (((prob_up + baseline_prob) / 2 > 0.5) = (actual_return > 0))::INT::DOUBLE AS hit) FROM outcomes WHERE day(session) % 3 <> 0
        UNION ALL SELECT 'base', * REPLACE (baseline_brier AS brier, baseline_hit AS hit) FROM outcomes WHERE day(session) % 4 <> 0),
    shared AS (SELECT * FROM fam SEMI JOIN (SELECT instrument_id, session, horizon FROM fam GROUP BY ALL HAVING count(DISTINCT family) = 3) USING (instrument_id, session, horizon)),
    x AS (SELECT a.horizon, a.family, a.session, unnest([{'k': 'direction_accuracy', 'm': a.hit, 'b': b.hit}, {'k': 'brier', 'm': a.brier, 'b': b.brier}]) AS s FROM shared a JOIN shared b ON a.family <> 'main' AND b.family = 'main' AND a.instrument_id = b.instrument_id AND a.session = b.session AND a.horizon = b.horizon),
    v AS (SELECT horizon, family, session, s.k AS metric, s.m AS m, s.b AS b FROM x)"""


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three families of outcomes: the package's, its mean with the baseline on two days of three, and the baseline on three of four."""
    rows, y = outcomes(spark, sf_dir), F.col("actual_return")
    mean, day = (F.col("prob_up") + F.col("baseline_prob")) / 2, F.dayofmonth("session")
    calm = rows.where(day % 3 != 0).withColumns({"family": F.lit("calm"), "hit": scalar.hit(mean, y), "brier": scalar.brier(mean, y)})
    base = rows.where(day % 4 != 0).withColumns({"family": F.lit("base"), "hit": F.col("baseline_hit"), "brier": F.col("baseline_brier")})
    return rows.withColumn("family", F.lit("main")).unionByName(calm).unionByName(base)


@query("a14_model_arena", FAMILIES_SQL + f" SELECT horizon, family, metric, {SUMMED} FROM v GROUP BY 1, 2, 3")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table of model families on the sample that all of them share."""
    return rounded(points(models_live(families(spark, sf_dir), "main", 3), ["horizon", "family", "metric"]))


@query("a14_model_arena_verdicts", FAMILIES_SQL + ", " + records_sql("v", ["family", "horizon", "metric"]))
def a14_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(evaluate.records(models_live(families(spark, sf_dir), "main", 3), ["family", "horizon", "metric"], []))


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and indicator triggers with the contexts that held, written once."""
    return stored(confluence.triggers(ready(spark, sf_dir), all_signals(bars(spark, sf_dir))), "triggers")


@query("a18_confluence")
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of a trigger and the contexts that stood with it: discovery, correction, confirmation."""
    split = F.lit("1999-12-31").cast("date")
    return rounded(confluence.measure(live_events(spark, sf_dir), bars(spark, sf_dir), (5, 20), split, F.date_add(split, 1)))


@query("a19_live_panel")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last session's triggers with every measured combination that stands on them."""
    events = live_events(spark, sf_dir)
    split = F.lit("1999-12-31").cast("date")
    table = confluence.measure(events, bars(spark, sf_dir), (5,), split, F.date_add(split, 1))
    last = events.agg(F.max("date")).first()[0]
    return rounded(confluence.standing(events, table, F.lit(last)))


@query("g14_confluence_summary", REGION + "@SIGNALS, h AS (SELECT instrument_id, date, rule AS trigger FROM signals) SELECT count(*) AS events, count(DISTINCT trigger) AS triggers, count(DISTINCT instrument_id) AS instruments, 3::BIGINT AS combinations, 1::BIGINT AS too_early, 0::BIGINT AS not_found, 0::BIGINT AS found, 0::BIGINT AS found_too_early, 1::BIGINT AS found_not_confirmed, 1::BIGINT AS confirmed FROM h")
def g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.createDataFrame([("a", "too_early"), ("b", "confirmed"), ("c", "found_not_confirmed")], "combo string, status string")
    events = all_signals(bars(spark, sf_dir)).withColumnRenamed("rule", "trigger")
    return confluence.summary(table, events)


@query("a28_arena_documents")
def a28(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.records(evaluate.scored_long(outcomes(spark, sf_dir), ["horizon"]), ["horizon", "metric"], [])
    return record.verdict_documents(found, ["metric"])


@query("a30_market_section", OUT + " SELECT session, count(*) FILTER (shock_signals <> '') AS flagged, bool_or(shock_market <> '') AS on_market, bool_or(withheld) AS withheld FROM forecasts GROUP BY 1")
def a30(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir)
    return rows.groupBy("session").agg(F.count_if(F.col("shock_signals") != "").alias("flagged"), F.bool_or(F.col("shock_market") != "").alias("on_market"), F.bool_or("withheld").alias("withheld"))


@query("a31_status", OUT + ", sf AS (SELECT session, count(DISTINCT instrument_id) AS instruments, max(made_at) AS made_at FROM forecasts GROUP BY 1) SELECT session, instruments, instruments < 0.8 * 5 AS partial, made_at > session + INTERVAL 20 HOUR AS late FROM sf")
def a31(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).groupBy("session").agg(F.count_distinct("instrument_id").alias("instruments"), F.max("made_at").alias("made_at"))
    deadline = F.col("session").cast("timestamp") + F.expr("INTERVAL 20 HOURS")
    return rows.select("session", "instruments", quality.partial(F.col("instruments"), F.lit(5)).alias("partial"), (F.col("made_at") > deadline).alias("late"))


CHAIN = """, chain AS (SELECT instrument_id, 20 AS horizon, max_by(close, date) AS spot FROM panel_nation GROUP BY 1),
    strikes AS (SELECT c.*, k, spot * (0.85 + 0.05 * k) AS strike, greatest(spot * (0.20 - 0.04 * k), spot * 0.002) AS price, CASE WHEN substr(instrument_id, 7) = '0' THEN 10 ELSE 500 END AS oi FROM chain c, (SELECT unnest(range(6)) AS k)),
    pairs AS (SELECT *, lead(strike) OVER w AS s2, lead(price) OVER w AS p2 FROM strikes WINDOW w AS (PARTITION BY instrument_id ORDER BY strike)),
    near AS (SELECT * FROM pairs WHERE s2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY round(abs((strike + s2) / 2 - spot) / spot, 6), strike) = 1),
    probs AS (SELECT *, -(p2 - price) / (s2 - strike) * exp(0.02 * 0.25) AS p FROM near)
    SELECT instrument_id, CASE WHEN oi < 100 THEN 'illiquid' WHEN p < 0.01 OR p > 0.99 THEN 'bad_price' ELSE 'ok' END AS status, CASE WHEN oi >= 100 AND p BETWEEN 0.01 AND 0.99 THEN round(p, 6) END AS prob_up FROM probs"""


def call_chains(prices: DataFrame) -> DataFrame:
    """Calls on every instrument's last close at six strikes; those of ids with a 0 in the last place but one are hardly traded."""
    spots = prices.groupBy("instrument_id").agg(F.max_by("close", "date").alias("spot"))
    rows = spots.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    price = F.greatest(F.col("spot") * (0.20 - 0.04 * F.col("k")), F.col("spot") * 0.002)
    terms = (F.lit(20).alias("horizon"), "spot", F.lit(0.02).alias("rate"), F.lit(0.25).alias("years"))
    traded = F.when(F.substring("instrument_id", 7, 1) == "0", 10).otherwise(500).cast("long")
    return rows.select("instrument_id", *terms, (F.col("spot") * (0.85 + 0.05 * F.col("k"))).alias("strike"), price.alias("bid"), price.alias("ask"), F.lit(0.3).alias("iv"), traded.alias("open_interest"))


@query("f06_implied_prob", fx.prelude("nation") + CHAIN)
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of calls on every nation's last close."""
    return rounded(feeds.implied_table(call_chains(fx.panel(spark, sf_dir, "nation"))).select("instrument_id", "status", "prob_up"))


A35_SQL = fx.prelude("region", "sessions") + fx.FORECASTS + CHAIN.replace("panel_nation GROUP BY", "panel_region WHERE instrument_id <> 'CZ00005' GROUP BY").replace(
    "    SELECT instrument_id, CASE WHEN oi", "    , implied AS (SELECT instrument_id, CASE WHEN oi"
)


@query("a35_implied_flow", A35_SQL + ") SELECT forecast_id, coalesce(i.status, 'fetch_failed') AS implied_status, i.prob_up AS implied_prob_up FROM forecasts f LEFT JOIN implied i ON i.instrument_id = f.instrument_id AND f.horizon = 20")
def a35(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market-implied columns of every forecast, from chains of all instruments but one, whose fetch failed: its columns are empty and say so."""
    chains = call_chains(fx.panel(spark, sf_dir).where("instrument_id <> 'CZ00005'"))
    return rounded(feeds.attach_implied(fx.forecasts(spark, sf_dir), feeds.implied_table(chains)).select("forecast_id", "implied_status", "implied_prob_up"))


@query("j19_attach_implied", fx.prelude("region", "sessions") + fx.FORECASTS + " SELECT forecast_id, CASE WHEN horizon = 20 AND instrument_id <> 'CZ00005' THEN 'ok' ELSE 'fetch_failed' END AS implied_status FROM forecasts")
def j19(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([(b, 20, "ok", 0.5, 0.3, -0.1, 0.1) for b in BASKET[:4]], "instrument_id string, horizon int, status string, prob_up double, iv double, band_low double, band_high double")
    return feeds.attach_implied(fx.forecasts(spark, sf_dir), known).select("forecast_id", "implied_status")


@query("f07_risk_free", fx.prelude("macro") + " SELECT round(arg_max(yield_3m, date) / 100, 6) AS rate FROM macro WHERE date <= DATE '1999-05-05' AND yield_3m IS NOT NULL")
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feeds.rate_on(fx.macro(spark, sf_dir), F.lit("1999-05-05").cast("date")))


@query("w23_tail_signals", fx.prelude("region", "sessions", "macro") + "@SHOCK SELECT instrument_id, round(volume_z, 6) AS volume_z, round(gap_sigma, 6) AS gap_sigma, round(move_sigma, 6) AS move_sigma FROM shock WHERE date = (SELECT max(date) FROM panel_region) AND enough")
def w23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector on one session: the frame of all days, cut to that day."""
    frame = shock_frame(spark, sf_dir)
    last = fx.panel(spark, sf_dir).agg(F.max("date").alias("date"))
    return rounded(frame.join(F.broadcast(last), "date", "left_semi").where("enough").select("instrument_id", "volume_z", "gap_sigma", "move_sigma"))


@query("w24_market_shock", fx.prelude("region", "sessions", "macro") + "@SHOCK@MARKET SELECT date, vix, \"cross\", cross_count FROM market WHERE vix OR \"cross\"")
def w24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market(spark, sf_dir).where("vix or cross").select("date", "vix", "cross", "cross_count")


@query("j18_first_flags", fx.prelude("region", "sessions") + fx.FORECASTS + " SELECT instrument_id, session, arg_min(shock_signals, horizon) AS shock_signals FROM forecasts GROUP BY 1, 2")
def j18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags from packages: the first row of each key."""
    rows = quality.keep_first(fx.forecasts(spark, sf_dir), [F.col("horizon")], ["instrument_id", "session"])
    return rows.select("instrument_id", "session", "shock_signals")


@query("j01_signal_outcomes", REGION + "@SIGNALS, f AS (SELECT instrument_id, date, lead(close, 5) OVER (PARTITION BY instrument_id ORDER BY date) AS later, close FROM panel_region) SELECT rule, count(*) AS n, round(avg(((later > close) = (direction = 'long'))::INT), 6) AS hit FROM signals JOIN f USING (instrument_id, date) WHERE later IS NOT NULL GROUP BY 1")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    joined = all_signals(prices).join(returns.forward_direction(prices, 5), KEYS)
    return rounded(joined.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("up") == (F.col("direction") == "long")).cast("int")).alias("hit")))


@query("c08_upcoming", "SELECT 'e' || i AS event_id, (DATE '2024-01-01' + (i * 20)::INTEGER)::DATE AS day FROM (SELECT unnest(range(12)) AS i) WHERE (DATE '2024-01-01' + (i * 20)::INTEGER) > DATE '2024-03-01' AND (DATE '2024-01-01' + (i * 20)::INTEGER) <= DATE '2024-03-01' + 45")
def c08(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.range(12).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 20).cast("int")).alias("day"))
    return calendars.upcoming(events, F.lit("2024-03-01").cast("date"))


# Documented extensions over users' theses.

THESES = OUT + ", th AS (SELECT horizon AS trigger_kind, instrument_id AS person, greatest(prob_up, 1 - prob_up) AS p, hit, baseline_brier, power(greatest(prob_up, 1 - prob_up) - hit, 2) AS b FROM outcomes)"


def theses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.greatest("prob_up", 1 - F.col("prob_up"))
    return outcomes(spark, sf_dir).select(F.col("horizon").alias("trigger_kind"), F.col("instrument_id").alias("person"), p.alias("p"), "hit", "baseline_brier", F.pow(p - F.col("hit"), 2).alias("b"))


@query("e01_user_bands", THESES + " SELECT CASE WHEN p < 0.645 THEN '.55-.64' WHEN p < 0.745 THEN '.65-.74' WHEN p < 0.845 THEN '.75-.84' ELSE '.85-.95' END AS band, count(*) AS n, sum(hit)::BIGINT AS hits, round(avg(b), 6) AS brier, CASE WHEN count(*) >= 30 THEN round(avg(hit), 6) END AS rate FROM th WHERE p >= 0.545 AND p < 0.955 GROUP BY 1")
def e01(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    band = F.when(p < 0.645, ".55-.64").when(p < 0.745, ".65-.74").when(p < 0.845, ".75-.84").otherwise(".85-.95")
    rows = theses(spark, sf_dir).where("p >= 0.545 and p < 0.955")
    return rounded(rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.sum("hit").cast("long").alias("hits"), F.avg("b").alias("brier"), F.when(F.count(F.lit(1)) >= 30, F.avg("hit")).alias("rate")))


@query("e03_leaderboard", THESES + ", s AS (SELECT person, count(*) AS n, round(1 - avg(b) / avg(baseline_brier), 6) AS skill FROM th GROUP BY 1 HAVING count(*) >= 30) SELECT row_number() OVER (ORDER BY skill DESC, person) AS rank, person, n, skill FROM s")
def e03(spark: SparkSession, sf_dir: str) -> DataFrame:
    skill = F.round(1 - F.avg("b") / F.avg("baseline_brier"), 6)
    rows = theses(spark, sf_dir).groupBy("person").agg(F.count(F.lit(1)).alias("n"), skill.alias("skill")).where("n >= 30")
    return rows.select(F.row_number().over(Window.orderBy(F.col("skill").desc(), "person")).cast("long").alias("rank"), "person", "n", "skill")


@query("e04_by_trigger", THESES + " SELECT trigger_kind, count(*) AS n, round(avg(hit), 6) AS hit FROM th GROUP BY 1")
def e04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(theses(spark, sf_dir).groupBy("trigger_kind").agg(F.count(F.lit(1)).alias("n"), F.avg("hit").alias("hit")))


@query("e05_r_multiples", OUT + ", r AS (SELECT actual_return / scale AS r FROM outcomes) SELECT CASE WHEN r <= -3 THEN -3 WHEN r >= 3 THEN 3 WHEN r < 0 THEN floor(r)::INTEGER ELSE ceil(r)::INTEGER END AS bin, count(*) AS n FROM r GROUP BY 1")
def e05(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("actual_return") / F.col("scale")
    edge = F.when(r <= -3, -3).when(r >= 3, 3).when(r < 0, F.floor(r)).otherwise(F.ceil(r)).cast("int")
    return outcomes(spark, sf_dir).groupBy(edge.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _fill_in() -> None:
    from tidemark.plans.measure import MARKET_SQL, SHOCK_SQL
    from tidemark.plans.panel import ALL_SIGNALS, EWM, MACD
    from tidemark.plans.base import ORACLES

    parts = {"@SHOCK": SHOCK_SQL.replace("{level}", "region"), "@MARKET": MARKET_SQL, "@SIGNALS": EWM + MACD + ALL_SIGNALS}
    for name in ("w23_tail_signals", "w24_market_shock", "j01_signal_outcomes", "g14_confluence_summary"):
        for mark, text in parts.items():
            ORACLES[name] = ORACLES[name].replace(mark, text)


_fill_in()

