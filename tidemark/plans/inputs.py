"""Queries over inputs and calendars: quality, coverage, merges, sessions, folds; patterns, confluence, lab, models."""

from __future__ import annotations

import re
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import calendars, quality, scalar
from tidemark.operators import boosting, confluence, cross_section, evaluate, lab, models, patterns, record, regime, returns, technical, upsert
from tidemark.operators.signals import all_signals
from tidemark.operators.shocks import as_of
from tidemark.plans.measure import FULL_SHOCK, OUT, SCENARIO_SQL, outcomes
from tidemark.plans.panel import ALL_SIGNALS, BASKET, EWM, KEYS, MACD, REGION, TR, bars, features_sql, log_returns, with_tr
from tidemark.plans.base import comparable, query, rounded
from tidemark.sources import feeds
from tidemark.plans.twins import records_sql
from tidemark.sources import fixtures as fx
from tidemark.session import stored

SESSIONS = fx.prelude("region", "sessions")
RAW_SQL = """,
    raw AS (
        SELECT instrument_id, date, CASE WHEN n % 101 = 0 THEN -close ELSE close END AS close, open, CASE WHEN n % 37 = 0 THEN low * 0.99 ELSE high END AS high,
               CASE WHEN n % 41 = 0 THEN NULL ELSE low END AS low, CASE WHEN n % 53 = 0 THEN -volume ELSE volume END AS volume, n
        FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date) AS n FROM panel_region))"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).withColumn("n", F.row_number().over(Window.partitionBy("instrument_id").orderBy("date")))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with planted faults."""
    n = F.col("n")
    return numbered(spark, sf_dir).withColumns(
        {
            "close": F.when(n % 101 == 0, -F.col("close")).otherwise(F.col("close")),
            "high": F.when(n % 37 == 0, F.col("low") * 0.99).otherwise(F.col("high")),
            "low": F.when(n % 41 != 0, F.col("low")),
            "volume": F.when(n % 53 == 0, -F.col("volume")).otherwise(F.col("volume")),
        }
    )


QUALITY_SQL = "CASE WHEN coalesce(close <= 0, false) OR coalesce(low > CASE WHEN open IS NOT NULL AND close IS NOT NULL THEN least(open, close) END + 1e-9, false) OR coalesce(high < CASE WHEN open IS NOT NULL AND close IS NOT NULL THEN greatest(open, close) END - 1e-9, false) OR coalesce(low > high, false) OR coalesce(volume < 0, false) THEN 'suspect' ELSE 'ok' END"


@query("p01_quality", REGION + RAW_SQL + f" SELECT instrument_id, date, {QUALITY_SQL} AS quality FROM raw")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select(*KEYS, quality.quality().alias("quality"))


@query("p02_hard_rules", REGION + ", doubled AS (SELECT instrument_id, date FROM panel_region UNION ALL SELECT instrument_id, date FROM panel_region WHERE day(date) = 13) SELECT 'duplicate' AS fault, instrument_id, date, count(*) AS rows FROM doubled GROUP BY 2, 3 HAVING count(*) > 1 UNION ALL SELECT 'future', instrument_id, date, count(*) FROM doubled WHERE date > DATE '2001-06-30' GROUP BY 2, 3")
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir).select(*KEYS)
    return quality.hard_faults(rows.unionByName(rows.where(F.dayofmonth("date") == 13)), F.lit("2001-06-30").cast("date"))


@query("p03_off_session", SESSIONS + " SELECT instrument_id, date FROM panel_region WHERE date NOT IN (SELECT date FROM sessions WHERE idx % 10 <> 0)")
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_days = fx.sessions(fx.panel(spark, sf_dir)).where("idx % 10 <> 0")
    return quality.off_sessions(bars(spark, sf_dir), open_days).select(*KEYS)


@query(
    "p05_canonical",
    fx.prelude("nation", "universe")
    + f""", ses AS (SELECT DISTINCT date FROM panel_nation WHERE dayofweek(date) NOT IN (0)), rawn AS (
        SELECT u.ticker, t.date, t.price AS close, t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.l_quantity, t.l_extendedprice FROM trades_nation t JOIN universe u USING (instrument_id) WHERE u.segment = 'main'),
    k AS (SELECT r.*, u.instrument_id FROM rawn r JOIN universe u USING (ticker) WHERE r.date IN (SELECT date FROM ses) AND r.date <= DATE '2001-06-30'
        QUALIFY row_number() OVER (PARTITION BY u.instrument_id, r.date ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)
    SELECT instrument_id, date, round(close, 6) AS close, {QUALITY_SQL} AS quality FROM (SELECT *, close AS open, close AS high, close AS low, l_quantity AS volume FROM k)""",
)
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single trades stand in for provider rows; the first of a day is kept."""
    names = fx.universe(spark, sf_dir)
    trades = fx.trades(spark, sf_dir, "nation").join(names.where("segment = 'main'").select("instrument_id", "ticker"), "instrument_id").drop("instrument_id")
    provider = trades.select("ticker", "date", *(F.col("price").alias(c) for c in ("open", "high", "low", "close")), F.col("l_quantity").alias("volume"), *fx.TRADE_ORDER)
    days = fx.panel(spark, sf_dir, "nation").select("date").distinct().where(F.dayofweek("date") != 1)
    found = quality.canonical(provider, names, days, F.lit("2001-06-30").cast("date"), F.lit("2001-07-01").cast("timestamp"), [F.col(c) for c in fx.TRADE_ORDER])
    return rounded(found.select(*KEYS, "close", "quality"))


@query("p08_active_on", fx.prelude("universe") + " SELECT instrument_id, ticker FROM universe WHERE valid_from <= DATE '2001-03-01' AND (valid_to IS NULL OR valid_to >= DATE '2001-03-01')")
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.active_on(fx.universe(spark, sf_dir), F.lit("2001-03-01").cast("date")).select("instrument_id", "ticker")


@query("p09_universe_faults", fx.prelude("universe") + " SELECT 'class' AS fault, asset_class AS what FROM universe WHERE asset_class NOT IN ('equity') UNION ALL SELECT 'segment', segment FROM universe WHERE segment NOT IN ('main')")
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.universe_faults(fx.universe(spark, sf_dir), ["equity"], ["main"])


@query("p11_trainable", OUT + " SELECT instrument_id, session FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, horizon ORDER BY session) AS h FROM outcomes WHERE horizon = 5) WHERE h >= 300 AND actual_return IS NOT NULL")
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).where("horizon = 5").withColumn("history_sessions", F.row_number().over(Window.partitionBy("instrument_id").orderBy("session")))
    return models.trainable(rows, "actual_return").select("instrument_id", "session")


@query("p14_triggers", REGION + EWM + MACD + ALL_SIGNALS + " SELECT DISTINCT rule, true AS is_trigger FROM signals UNION ALL SELECT * FROM (VALUES ('hs_top|broken', true), ('fib_up_golden|wick', true), ('fib_up_golden|body', false), ('hammer|none', false), ('hammer', true))")
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = all_signals(bars(spark, sf_dir)).select("rule").distinct()
    more = spark.createDataFrame([(r,) for r in ("hs_top|broken", "fib_up_golden|wick", "fib_up_golden|body", "hammer|none", "hammer")], "rule string")
    return own.unionByName(more).select("rule", quality.is_trigger(F.col("rule")).alias("is_trigger"))


@query("p16_coverage", fx.prelude("nation") + ", c AS (SELECT date, count(DISTINCT instrument_id) AS n FROM panel_nation WHERE date <= DATE '2001-10-15' GROUP BY 1 HAVING count(DISTINCT instrument_id) >= 0.4 * 25) SELECT max(date) AS session, arg_max(n, date) AS instruments FROM c")
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.chosen_session(fx.panel(spark, sf_dir, "nation"), F.lit("2001-10-15").cast("date"), 25, share=0.4)


@query("p17_timeliness", SESSIONS + fx.FORECASTS + " SELECT session, count(DISTINCT instrument_id) AS instruments, CASE WHEN max(made_at) < session + INTERVAL 1 DAY THEN 'in_time' ELSE 'too_late' END AS timely, count(DISTINCT instrument_id) < 0.8 * 5 AS partial FROM forecasts GROUP BY session")
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_day = fx.forecasts(spark, sf_dir).groupBy("session").agg(F.count_distinct("instrument_id").alias("instruments"), F.max("made_at").alias("made_at"))
    deadline = F.date_add("session", 1).cast("timestamp")
    return by_day.select("session", "instruments", quality.timely(F.col("made_at"), deadline).alias("timely"), quality.partial(F.col("instruments"), F.lit(5)).alias("partial"))


MISSING = ", spans AS (SELECT instrument_id, min(date) AS lo FROM panel_nation GROUP BY 1), gone AS (SELECT s.instrument_id, d.date FROM spans s JOIN (SELECT DISTINCT date FROM panel_nation) d ON d.date >= s.lo ANTI JOIN panel_nation p ON p.instrument_id = s.instrument_id AND p.date = d.date)"


@query("p18_missing_days", fx.prelude("nation") + MISSING + " SELECT instrument_id, count(*) AS missing, min(date) AS first, max(date) AS last FROM gone GROUP BY 1")
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir, "nation")
    return quality.missing_counts(rows, rows.select("date").distinct())


@query("f11_gaps_islands", fx.prelude("nation") + MISSING + ", i AS (SELECT *, date - (row_number() OVER (PARTITION BY instrument_id ORDER BY date))::INTEGER AS g FROM gone) SELECT instrument_id, min(date) AS first, max(date) AS last, count(*) AS days FROM i GROUP BY instrument_id, g")
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir, "nation")
    return quality.missing_runs(rows, rows.select("date").distinct())


@query("f11_history_ok", fx.prelude("nation") + ", s AS (SELECT instrument_id, date, date - lag(date) OVER (PARTITION BY instrument_id ORDER BY date) - 1 AS gap FROM panel_nation WHERE date <= DATE '2001-01-01') SELECT instrument_id, count(*) AS days, coalesce(max(gap), 0) AS longest_gap, count(*) >= 730 AND coalesce(max(gap), 0) <= 3 AS ok FROM s GROUP BY 1")
def f11_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.history_continuous(fx.panel(spark, sf_dir, "nation"), F.lit("2001-01-01").cast("date"))


@query("f12_eligible", fx.prelude("nation") + ", r AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY date DESC) AS k FROM panel_nation) SELECT instrument_id, count(*) AS days, round(quantile_cont(close * volume, 0.5) FILTER (k <= 60), 4) AS median_dollars, count(*) >= 730 AND quantile_cont(close * volume, 0.5) FILTER (k <= 60) >= 50000 AS ok FROM r GROUP BY 1")
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.liquid(fx.panel(spark, sf_dir, "nation"), 730, 50_000.0)
    return found.withColumn("median_dollars", F.round("median_dollars", 4))


@query("p21_delisted", fx.prelude("nation") + ", ses AS (SELECT DISTINCT date FROM panel_nation ORDER BY date DESC LIMIT 4) SELECT instrument_id, max(date) AS last FROM panel_nation GROUP BY 1 HAVING max(date) < (SELECT min(date) FROM ses)")
def p21(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir, "nation")
    return quality.delisted(rows, rows.select("date").distinct(), 3)


@query("p13_segments", fx.prelude("nation", "universe") + " SELECT segment, count(*) AS rows FROM panel_nation JOIN universe USING (instrument_id) GROUP BY 1")
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, cross = quality.by_segment(fx.panel(spark, sf_dir, "nation"), fx.universe(spark, sf_dir))
    count = lambda t, s: t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("segment"), "rows")
    return count(main, "main").unionByName(count(cross, "cross"))


@query("p19_tracked_signals", FULL_SHOCK + ", l AS (SELECT instrument_id, date, concat_ws(',', CASE WHEN volume_z > 4 THEN 'volume' END, CASE WHEN move_sigma > 4 THEN 'move' END) AS s FROM shock WHERE enough) SELECT instrument_id, date, s AS signals FROM l WHERE s <> ''")
def p19(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.shocks import signal_list
    from tidemark.plans.measure import shock_frame

    rows = shock_frame(spark, sf_dir).select(*KEYS, quality.tracked_signals(signal_list(), ["volume", "move"]).alias("signals"))
    return rows.where("signals <> ''")


UPSERT_SQL = """,
    old AS (SELECT instrument_id, date, close FROM panel_region WHERE date < DATE '2001-01-01'),
    new AS (SELECT instrument_id, date, close * 2 AS close FROM panel_region WHERE date >= DATE '2000-12-01' AND instrument_id <> 'CZ00002'),
    kept AS (SELECT * FROM old WHERE instrument_id <> 'CZ00003')"""


@query("k02_upsert", REGION + UPSERT_SQL + " SELECT instrument_id, date, round(close, 6) AS close FROM new UNION ALL SELECT instrument_id, date, round(close, 6) FROM kept ANTI JOIN new USING (instrument_id, date)")
def k02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir).select(*KEYS, "close")
    old = rows.where("date < '2001-01-01'")
    new = rows.where("date >= '2000-12-01' and instrument_id <> 'CZ00002'").withColumn("close", F.col("close") * 2)
    return rounded(upsert.upsert(old, new, spark.createDataFrame([("CZ00003",)], "instrument_id string")))


@query("k05_actions_merge", REGION + ", arrived AS (SELECT *, 1 AS a FROM actions_region UNION ALL SELECT instrument_id, date, dividend * 2, split_ratio, 2 FROM actions_region WHERE month(date) = 6) SELECT instrument_id, date, round(dividend, 6) AS dividend, split_ratio FROM arrived QUALIFY row_number() OVER (PARTITION BY instrument_id, date ORDER BY a DESC) = 1")
def k05(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = fx.actions(spark, sf_dir).withColumn("arrival", F.lit(1))
    later = first.where(F.month("date") == 6).withColumns({"dividend": F.col("dividend") * 2, "arrival": F.lit(2)})
    return rounded(upsert.keep_last(first.unionByName(later), [F.col("arrival").desc()]).drop("arrival"))


@query("p07_new_splits", REGION + " SELECT DISTINCT instrument_id FROM actions_region a WHERE split_ratio <> 1 AND split_ratio <> 0 AND date >= DATE '2001-01-01'")
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.actions(spark, sf_dir)
    return quality.newly_split(rows, rows.where("date < '2001-01-01'"))


SOURCES = ", offered AS (SELECT ticker, date, 1 AS source_rank, close FROM panel_nation JOIN universe USING (instrument_id) WHERE segment = 'main' AND asset_class = 'equity' UNION ALL SELECT ticker, date, 2, close * 2 FROM panel_nation JOIN universe USING (instrument_id) WHERE segment = 'main' UNION ALL SELECT ticker, date, 3, close * 4 FROM panel_nation JOIN universe USING (instrument_id)), best AS (SELECT ticker, min(source_rank) AS source_rank FROM offered GROUP BY 1)"


def offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir, "nation").drop("sector").join(fx.universe(spark, sf_dir).select("instrument_id", "ticker", "segment", "asset_class"), "instrument_id")
    part = lambda t, rank, factor: t.select("ticker", "date", F.lit(rank).alias("source_rank"), (F.col("close") * factor).alias("close"))
    return part(rows.where("segment = 'main' and asset_class = 'equity'"), 1, 1.0).unionByName(part(rows.where("segment = 'main'"), 2, 2.0)).unionByName(part(rows, 3, 4.0))


@query("s22_source_fallback", fx.prelude("nation", "universe") + SOURCES + " SELECT ticker, date, source_rank, round(close, 6) AS close FROM offered JOIN best USING (ticker, source_rank)")
def s22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(upsert.by_priority(offered(spark, sf_dir)))


@query("s22_served", fx.prelude("nation", "universe") + SOURCES + " SELECT u.ticker, source_rank AS served_by FROM universe u LEFT JOIN best USING (ticker)")
def s22_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.served(fx.universe(spark, sf_dir), offered(spark, sf_dir))


@query("s05_bond_price", fx.prelude("macro") + " SELECT date, round(exp(yield_10y / 1e7 / 100), 6) AS close, round(100 * ln(exp(yield_10y / 1e7 / 100)), 6) AS back FROM macro")
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.macro(spark, sf_dir).select("date", (F.col("yield_10y") / 1e7).alias("close"))
    priced = upsert.as_price(rows, ["close"])
    back = upsert.as_yield(priced, ["close"]).select("date", F.col("close").alias("back"))
    return rounded(priced.join(back, "date"))


@query("s11_wide_to_long", REGION + " SELECT date, instrument_id AS ticker, round(close, 6) AS close, volume FROM panel_region")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider's wide frame, one column for each field and ticker, back to rows."""
    wide = bars(spark, sf_dir).groupBy("date").pivot("instrument_id", BASKET).agg(F.first("close").alias("close"), F.first("volume").alias("volume"))
    return rounded(feeds.wide_to_long(wide, BASKET, ["close", "volume"]))


@query("s16_pivot_series", fx.prelude("macro") + " SELECT date, round(vix, 6) AS vix, round(yield_10y, 6) AS yield_10y FROM macro WHERE vix IS NOT NULL OR yield_10y IS NOT NULL")
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.macro(spark, sf_dir)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    observed = rows.select("date", F.explode(F.array(F.struct(F.lit("vix").alias("series"), text("vix").alias("value")), F.struct(F.lit("yield_10y").alias("series"), text("yield_10y").alias("value")))).alias("o")).select("date", "o.*")
    return rounded(feeds.pivot_series(observed, ["vix", "yield_10y"]))


@query("j12_scd2", fx.prelude("nation", "universe") + ", hist AS (SELECT instrument_id, 'OLD' || ticker AS old, DATE '1990-01-01' AS a, DATE '1998-12-31' AS b FROM universe) SELECT p.instrument_id, p.date, coalesce(h.old, u.ticker) AS ticker FROM panel_nation p JOIN universe u USING (instrument_id) LEFT JOIN hist h ON h.instrument_id = p.instrument_id AND p.date BETWEEN h.a AND h.b")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.resolve import ticker_on

    names = fx.universe(spark, sf_dir)
    history = names.select("instrument_id", F.concat(F.lit("OLD"), "ticker").alias("ticker"), F.lit("1990-01-01").cast("date").alias("valid_from"), F.lit("1998-12-31").cast("date").alias("valid_to"))
    return ticker_on(fx.panel(spark, sf_dir, "nation").select(*KEYS), history, names)


@query("j11_event_window", SESSIONS + fx.FORECASTS + """, ev AS (SELECT 'e' || lpad(row_number() OVER (ORDER BY d)::VARCHAR, 3, '0') AS event_id, d::DATE AS day FROM (SELECT unnest(generate_series(DATE '1995-02-03', DATE '2001-10-01', INTERVAL 45 DAY)) AS d)),
    placed AS (SELECT event_id, min(s.date) AS on_session FROM ev JOIN sessions s ON s.date >= day GROUP BY 1),
    w AS (SELECT DISTINCT session, target_session FROM forecasts WHERE horizon <= 60 AND target_session IS NOT NULL)
    SELECT w.session, w.target_session, coalesce(string_agg(event_id, ',' ORDER BY on_session, event_id), '') AS calendar_flag FROM w LEFT JOIN placed ON on_session > w.session AND on_session <= w.target_session GROUP BY 1, 2""")  # fmt: skip
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit("1995-02-03").cast("date"), F.lit("2001-10-01").cast("date"), F.expr("INTERVAL 45 DAYS"))).alias("day"))
    events = days.select(F.concat(F.lit("e"), F.lpad(F.row_number().over(Window.orderBy("day")).cast("string"), 3, "0")).alias("event_id"), "day")
    rows = fx.forecasts(spark, sf_dir).where("horizon <= 60 and target_session is not null").select("session", "target_session").distinct()
    return calendars.events_in_window(rows, events, fx.sessions(fx.panel(spark, sf_dir)))


RATES = ", rates AS (SELECT date, right(instrument_id, 1) AS currency, close AS rate FROM panel_region), pairs AS (SELECT a.c || b.c AS instrument_id, a.c AS base, b.c AS quote FROM (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) a(c) JOIN (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) b(c) ON a.c = '1' AND b.c <> '1' OR a.c <> '1' AND b.c <> '1' AND a.c < b.c)"


def fx_pairs(spark: SparkSession) -> DataFrame:
    codes = spark.createDataFrame([(str(i),) for i in range(1, 6)], "currency string")
    return upsert.pairs_of(codes, "1").withColumn("instrument_id", F.concat("base", "quote"))


@query("j15_cross_rates", REGION + RATES + " SELECT p.instrument_id, b.date, round(q.rate / b.rate, 6) AS close FROM pairs p JOIN rates b ON b.currency = p.base JOIN rates q ON q.currency = p.quote AND q.date = b.date WHERE b.date >= DATE '1996-01-01' OR p.base <> '1'")
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = bars(spark, sf_dir).select("date", F.substring("instrument_id", -1, 1).alias("currency"), F.col("close").alias("rate"))
    pairs = fx_pairs(spark).withColumn("starts", F.when(F.col("base") == "1", F.lit("1996-01-01").cast("date")))
    return rounded(upsert.cross_rates(rates, pairs))


@query("a32_fx_pairs", "SELECT a.c AS base, b.c AS quote, a.c || b.c AS instrument_id FROM (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) a(c) JOIN (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) b(c) ON a.c = '1' AND b.c <> '1' OR a.c <> '1' AND b.c <> '1' AND a.c < b.c")
def a32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_pairs(spark)


@query("j16_spreads", fx.prelude("macro") + " SELECT 'SPREAD' AS instrument_id, date, round(yield_10y - yield_2y, 6) AS value FROM macro WHERE yield_10y IS NOT NULL AND yield_2y IS NOT NULL UNION ALL SELECT 'TEN', date, round(yield_10y, 6) FROM macro WHERE yield_10y IS NOT NULL")
def j16(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = spark.createDataFrame([("SPREAD", "yield_10y-yield_2y"), ("TEN", "yield_10y")], "instrument_id string, spec string")
    return rounded(upsert.spread_series(fx.macro(spark, sf_dir).select("date", "yield_10y", "yield_2y"), specs))


@query("t03_top_by_volume", fx.prelude("nation") + ", v AS (SELECT instrument_id AS symbol, quantile_cont(close * volume, 0.5) AS dollars FROM panel_nation GROUP BY 1) SELECT row_number() OVER (ORDER BY symbol = 'CZ00025' DESC, dollars DESC, symbol) AS rank, symbol, round(dollars, 4) AS dollars FROM v QUALIFY rank <= 10")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    volumes = fx.panel(spark, sf_dir, "nation").groupBy(F.col("instrument_id").alias("symbol")).agg(F.percentile(F.col("close") * F.col("volume"), F.lit(0.5)).alias("dollars"))
    return upsert.top_by_volume(volumes, 10, ["CZ00025"]).select(F.col("rank").cast("long").alias("rank"), "symbol", F.round("dollars", 4).alias("dollars"))


@query("t04_top_contributions", OUT + ", p AS (SELECT forecast_id, unnest([{'f': 'a', 'v': expected_return}, {'f': 'b', 'v': scale}, {'f': 'c', 'v': prob_up - 0.5}, {'f': 'd', 'v': 0.0}]) AS x FROM forecasts WHERE horizon = 5), r AS (SELECT forecast_id, x.f AS feature, x.v AS v, row_number() OVER (PARTITION BY forecast_id ORDER BY abs(x.v) DESC, x.f) AS k FROM p WHERE x.v <> 0) SELECT forecast_id, string_agg(feature, ',' ORDER BY k) AS features FROM r WHERE k <= 2 GROUP BY 1")
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.forecasts(spark, sf_dir).where("horizon = 5")
    part = lambda n, x: F.struct(F.lit(n).alias("feature"), x.alias("value"))
    parts = F.array(part("a", F.col("expected_return")), part("b", F.col("scale")), part("c", F.col("prob_up") - 0.5), part("d", F.lit(0.0)))
    top = scalar.top_contributions(parts, 2)
    return rows.select("forecast_id", F.array_join(F.transform(top, lambda p: p["feature"]), ",").alias("features"))


@query("t06_stride", SESSIONS + ", d AS (SELECT date FROM sessions WHERE (idx - 1) % 12 = 0) SELECT instrument_id, date FROM panel_region WHERE date IN (SELECT date FROM d)")
def t06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.every_nth_day(bars(spark, sf_dir), 12).select(*KEYS)


@query("t07_one_per_company", fx.prelude("universe") + ", n AS (SELECT ticker, ticker || ' Class A' AS name, 1 AS rank FROM universe UNION ALL SELECT ticker || '.B', ticker || ' Class B', 2 FROM universe) SELECT ticker, name FROM n WHERE rank = 1")
def t07(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fx.universe(spark, sf_dir)
    rows = names.select("ticker", F.concat("ticker", F.lit(" Class A")).alias("name"), F.lit(1).alias("rank")).unionByName(names.select(F.concat("ticker", F.lit(".B")).alias("ticker"), F.concat("ticker", F.lit(" Class B")).alias("name"), F.lit(2).alias("rank")))
    return upsert.one_per_company(rows, F.col("rank")).select("ticker", "name")


@query("t08_union_by_name", fx.prelude("nation", "universe") + " SELECT instrument_id, ticker, NULL::VARCHAR AS segment FROM universe WHERE asset_class = 'etf' UNION ALL SELECT instrument_id, NULL, segment FROM universe WHERE asset_class = 'equity'")
def t08(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fx.universe(spark, sf_dir)
    return names.where("asset_class = 'etf'").select("instrument_id", "ticker").unionByName(names.where("asset_class = 'equity'").select("instrument_id", "segment"), allowMissingColumns=True)


@query("t09_calendar_difference", SESSIONS + " SELECT date FROM sessions EXCEPT SELECT date FROM panel_region WHERE instrument_id = 'CZ00001'")
def t09(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir)
    return fx.sessions(rows).select("date").subtract(rows.where("instrument_id = 'CZ00001'").select("date"))


# Calendars.

EASTER = "(WITH y AS (SELECT unnest(generate_series(1995, 2025))::INTEGER AS y), a AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y), b AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM a), l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM b), m AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM l) SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS e FROM m)"
TARGET = f"e AS MATERIALIZED {EASTER}, hol AS (SELECT make_date(y, 1, 1) AS d FROM e UNION ALL SELECT (e - 2)::DATE FROM e UNION ALL SELECT (e + 1)::DATE FROM e UNION ALL SELECT make_date(y, 5, 1) FROM e UNION ALL SELECT make_date(y, 12, 25) FROM e UNION ALL SELECT make_date(y, 12, 26) FROM e), cal AS MATERIALIZED (SELECT d::DATE AS date, row_number() OVER (ORDER BY d) AS idx FROM (SELECT unnest(generate_series(DATE '1999-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6 AND d::DATE NOT IN (SELECT d FROM hol))"


@query("c05_target_calendar", f"WITH {TARGET} SELECT date, idx, ((date + INTERVAL '14 hours 10 minutes')::TIMESTAMP AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC')::TIMESTAMP AS close_at FROM cal")
def c05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.sessions(spark, "TARGET", "1999-01-01", "2024-12-31").select("date", F.col("idx").cast("long").alias("idx"), F.col("close_at").cast("timestamp_ntz").alias("close_at"))


@query("c01_xnys_calendar")
def c01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange sessions with their closes, early ones too (a test holds them against known days)."""
    return calendars.sessions(spark, "XNYS", "2000-01-03", "2026-12-31")


@query("c06_ust_calendar")
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.sessions(spark, "UST", "1990-01-02", "2026-12-31")


@query("c02_last_closed", f"WITH {TARGET} SELECT max(date) AS session FROM cal WHERE date + INTERVAL '12 hours 10 minutes' <= TIMESTAMP '2024-07-10 12:10:00'")
def c02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.last_closed(calendars.sessions(spark, "TARGET", "1999-01-01", "2024-12-31"), F.lit("2024-07-10 12:10:00").cast("timestamp"))


CLOSES_SQL = f"""WITH {TARGET},
    closes AS (SELECT date, ((date + INTERVAL '14 hours 10 minutes')::TIMESTAMP AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC')::TIMESTAMP AS close_at FROM cal),
    booked AS (SELECT (o_orderdate::DATE + INTERVAL 7 YEAR)::TIMESTAMP + to_minutes(o_orderkey % 1440) AS created_at FROM orders)"""


def booked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A moment for every order: its day, seven years on, and a minute of it."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.unix_date(F.add_months(F.col("o_orderdate").cast("date"), 84)) * F.lit(86400).cast("long")
    return rows.select((day + F.col("o_orderkey") % 1440 * 60).cast("timestamp").alias("created_at"))


@query("c05_order_sessions", CLOSES_SQL + " SELECT c.date AS start_session, count(*) AS orders FROM booked b ASOF JOIN closes c ON b.created_at <= c.close_at GROUP BY 1")
def c05_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the settlement session that is the first to close after them."""
    placed = calendars.start_session(booked(spark, sf_dir), calendars.sessions(spark, "TARGET", "1999-01-01", "2024-12-31"))
    return placed.groupBy("start_session").agg(F.count(F.lit(1)).alias("orders"))


@query("c02_order_last_closed", CLOSES_SQL + " SELECT c.date AS session, count(*) AS orders FROM booked b ASOF JOIN closes c ON b.created_at >= c.close_at GROUP BY 1")
def c02_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the last settlement session that had closed when they came."""
    ends = calendars.sessions(spark, "TARGET", "1999-01-01", "2024-12-31").select(F.col("close_at").alias("created_at"), F.col("date").alias("session"))
    found = as_of(booked(spark, sf_dir), ends, ["session"], on="created_at")
    return found.where("session is not null").groupBy("session").agg(F.count(F.lit(1)).alias("orders"))


@query("c03_sessions_back", SESSIONS + " SELECT date AS session FROM sessions WHERE idx = (SELECT max(idx) FROM sessions WHERE date <= DATE '2000-05-14') - 10")
def c03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.sessions_back(fx.sessions(bars(spark, sf_dir)), F.lit("2000-05-14").cast("date"), 10)


@query("c03_session_lag", SESSIONS + " SELECT count(*) AS lag FROM sessions WHERE date > DATE '2000-05-14' AND date <= DATE '2000-06-01'")
def c03_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.session_lag(fx.sessions(bars(spark, sf_dir)), F.lit("2000-05-14").cast("date"), F.lit("2000-06-01").cast("date"))


@query("c04_target_session", SESSIONS + ", h AS (SELECT instrument_id, date AS session, unnest([1, 5, 20, 60, 120]) AS horizon FROM panel_region) SELECT h.*, t.date AS target_session FROM h JOIN sessions s ON s.date = h.session LEFT JOIN sessions t ON t.idx = s.idx + h.horizon")
def c04(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir)
    asked = rows.select("instrument_id", F.col("date").alias("session"), F.explode(F.array(*map(F.lit, fx.HORIZONS))).alias("horizon"))
    return calendars.with_target(asked, fx.sessions(rows))


@query("c07_start_session", SESSIONS + ", closes AS (SELECT date, date + INTERVAL 16 HOUR AS close_at FROM sessions) SELECT instrument_id, date, (SELECT min(c.date) FROM closes c WHERE c.close_at >= p.date + INTERVAL 15 HOUR + (day(p.date) % 3) * INTERVAL 1 HOUR) AS start_session FROM panel_region p")
def c07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir).select(*KEYS)
    hours = lambda n: F.make_interval(hours=n)
    calendar = fx.sessions(rows).withColumn("close_at", F.col("date").cast("timestamp") + hours(F.lit(16)))
    asked = rows.withColumn("created_at", F.col("date").cast("timestamp") + hours(F.lit(15) + F.dayofmonth("date") % 3))
    return calendars.start_session(asked, calendar).select(*KEYS, "start_session")


@query("c10_missed_days", SESSIONS + " SELECT date AS session FROM sessions WHERE date + INTERVAL 30 HOUR <= TIMESTAMP '2001-06-30 00:00:00' AND idx % 9 = 0")
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = fx.sessions(bars(spark, sf_dir))
    manifests = calendar.where("idx % 9 <> 0").select(F.col("date").alias("session"))
    deadline = F.col("date").cast("timestamp") + F.expr("INTERVAL 30 HOURS")
    return calendars.missed(calendar, manifests, F.lit("2001-06-30 00:00:00").cast("timestamp"), deadline)


FOLDS = ", folds AS (SELECT k AS fold, 756 + k * 252 AS start FROM (SELECT unnest(range(100))::INTEGER AS k) WHERE 756 + k * 252 + 252 <= (SELECT max(idx) FROM sessions)), fd AS (SELECT fold, a.date AS train_end, b.date AS test_start, c.date AS test_end, a.idx AS end_idx FROM folds JOIN sessions a ON a.idx = greatest(0, start - 21) + 1 JOIN sessions b ON b.idx = start + 1 JOIN sessions c ON c.idx = start + 252)"


@query("c11_folds", SESSIONS + FOLDS + " SELECT fold, train_end, test_start, test_end FROM fd")
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.walk_forward(fx.sessions(bars(spark, sf_dir)), 20)


@query("c11_train_rows", SESSIONS + FOLDS + " SELECT fold, count(*) AS rows FROM panel_region p JOIN sessions s USING (date) JOIN fd ON s.idx + 20 <= end_idx GROUP BY 1")
def c11_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir)
    calendar = fx.sessions(rows)
    return calendars.trainable_by(rows, calendars.walk_forward(calendar, 20), calendar, 20).groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


# Patterns and confluence.


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = regime.wide_returns(log_returns(spark, sf_dir), BASKET)
    return patterns.prepared(bars(spark, sf_dir), regime.regime(wide, BASKET[0], BASKET))


def family(name: str):
    return lambda spark, sf_dir: patterns.family_events(patterns.prepared(bars(spark, sf_dir)), name)


for _key, _name in (("x01_levels", "levels"), ("x02_candle_events", "candles"), ("x04_breakouts", "breakouts"), ("x05_head_shoulders", "head_shoulders"), ("x06_fibonacci", "fibonacci"), ("x07_trendlines", "trendlines"), ("w27_topdown", "topdown")):
    query(_key)(family(_name))


@query("x08_pattern_events")
def x08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.pattern_events(ready(spark, sf_dir))


@query("x09_without_candles")
def x09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.pattern_events(ready(spark, sf_dir), exclude=("candles",))


LOCK_SQL = """,
    ev AS MATERIALIZED (SELECT s.instrument_id, s.rule, s.date, s.direction, r.k, row_number() OVER (PARTITION BY s.instrument_id, s.rule ORDER BY s.date) AS i FROM signals s JOIN (SELECT instrument_id, date, row_number() OVER (PARTITION BY instrument_id ORDER BY date) AS k FROM panel_region) r USING (instrument_id, date)),
    locked AS (
        SELECT instrument_id, rule, i, k AS last, true AS keep FROM ev WHERE i = 1
        UNION ALL
        SELECT e.instrument_id, e.rule, e.i, CASE WHEN e.k - l.last >= 5 THEN e.k ELSE l.last END, e.k - l.last >= 5 FROM locked l JOIN ev e ON e.instrument_id = l.instrument_id AND e.rule = l.rule AND e.i = l.i + 1)"""


@query("x03_event_lock", REGION + EWM + MACD + ALL_SIGNALS + LOCK_SQL + " SELECT e.instrument_id, e.rule, e.date, e.direction FROM ev e JOIN locked l USING (instrument_id, rule, i) WHERE l.keep")
def x03(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    return patterns.lock_events(all_signals(prices), prices)


@query("x10_context_masks")
def x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.masks(ready(spark, sf_dir))


@query("x11_triggers")
def x11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confluence.triggers(ready(spark, sf_dir), all_signals(bars(spark, sf_dir)))


@query("x12_combinations", "WITH c AS (SELECT unnest(range(6))::INTEGER AS i, unnest(['trend', 'level', 'structure', 'htf', 'calm', 'volume']) AS n), m AS (SELECT unnest(range(1, 64))::INTEGER AS m) SELECT m AS combo_mask, string_agg(n, '+' ORDER BY i) AS contexts FROM m JOIN c ON (m >> i) & 1 = 1 GROUP BY m HAVING count(*) <= 3")
def x12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confluence.combos(spark)


HASHED = ", hashed AS (SELECT instrument_id, date, rule AS trigger, direction, (day(date) * 7 + month(date) * 5) % 64 AS mask FROM signals)"


def hashed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with a mask by date, for the join alone."""
    return all_signals(bars(spark, sf_dir)).select(*KEYS, F.col("rule").alias("trigger"), "direction", ((F.dayofmonth("date") * 7 + F.month("date") * 5) % 64).cast("long").alias("mask"))


@query(
    "j20_bitmask_combos",
    REGION
    + EWM
    + MACD
    + ALL_SIGNALS
    + HASHED
    + ", c AS (SELECT unnest(range(6))::INTEGER AS i, unnest(['trend', 'level', 'structure', 'htf', 'calm', 'volume']) AS n), combos AS (SELECT m, string_agg(n, '+' ORDER BY i) AS contexts FROM (SELECT unnest(range(1, 64))::INTEGER AS m) JOIN c ON (m >> i) & 1 = 1 GROUP BY m HAVING count(*) <= 3) SELECT trigger || '+' || contexts AS combo, count(*) AS n FROM hashed JOIN combos ON (mask & m) = m AND (m & CASE WHEN trigger IN ('close_above_ema200', 'close_below_ema200') THEN 1 ELSE 0 END) = 0 GROUP BY 1",
)
def j20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confluence.with_combos(hashed_events(spark, sf_dir)).groupBy("combo").agg(F.count(F.lit(1)).alias("n"))


@query("a17_pattern_arena")
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = bars(spark, sf_dir)
    return rounded(evaluate.arena(patterns.pattern_events(ready(spark, sf_dir)), prices, (5, 20)))


# Lab and models.


def lab_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).select("instrument_id", F.col("session").alias("date"), "horizon", "prob_up", F.col("actual_return").alias("y"))


LAB_SQL = """,
    lr AS (SELECT instrument_id, session AS date, prob_up, exp(actual_return) - 1 AS ret FROM outcomes WHERE horizon = 20),
    reb AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS k FROM (SELECT DISTINCT date FROM lr)) WHERE k % 20 = 0),
    seen AS (SELECT lr.*, u.segment FROM lr JOIN reb USING (date) LEFT JOIN universe u USING (instrument_id)),
    uni AS (SELECT 'all' AS universe, * FROM seen UNION ALL SELECT segment, * FROM seen WHERE segment IS NOT NULL),
    daily AS (SELECT universe, date, threshold, avg(ret) AS hold, avg(ret) FILTER (prob_up >= threshold) AS gross, count(*) FILTER (prob_up >= threshold) AS positions FROM uni, (VALUES (0.50::DOUBLE), (0.55), (0.60), (0.65)) t(threshold) GROUP BY 1, 2, 3),
    per AS (SELECT universe, threshold, cost, date, positions, coalesce(gross, 0) - cost * (positions > 0)::INT AS strategy, hold FROM daily, (VALUES (0.0::DOUBLE), (0.0005), (0.001)) c(cost))"""
LAB = fx.prelude("region", "sessions", "universe") + fx.OUTCOMES + LAB_SQL


@query("g20_lab_periods", LAB + " SELECT universe, threshold, cost, 20 AS horizon, date, positions, round(strategy, 6) AS strategy, round(hold, 6) AS hold FROM per")
def g20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lab.periods(lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), 20, lab.grid(spark)))


@query(
    "g21_lab_summary",
    LAB
    + """, cv AS (SELECT *, product(1 + strategy) OVER w AS sc, product(1 + hold) OVER w AS hc FROM per WINDOW w AS (PARTITION BY universe, threshold, cost ORDER BY date ROWS UNBOUNDED PRECEDING)),
    dd AS (SELECT *, sc / max(sc) OVER w - 1 AS sd, hc / max(hc) OVER w - 1 AS hd FROM cv WINDOW w AS (PARTITION BY universe, threshold, cost ORDER BY date ROWS UNBOUNDED PRECEDING))
    SELECT universe, threshold, cost, count(*) AS periods, round(min(sd), 6) AS max_drawdown, round(min(hd), 6) AS bh_max_drawdown, round(avg((strategy > hold)::INT), 6) AS share_better,
           count(*) FILTER (positions = 0) AS cash_periods, round(avg(strategy - hold), 6) AS excess_per_period FROM dd GROUP BY 1, 2, 3""",
)
def g21(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lab.summary(lab.periods(lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), 20, lab.grid(spark)))
    return rounded(found.select("universe", "threshold", "cost", "periods", "max_drawdown", "bh_max_drawdown", "share_better", "cash_periods", "excess_per_period"))


@query(
    "w29_thinned_curves",
    LAB.replace("horizon = 20", "horizon = 5").replace("k % 20", "k % 5")
    + """, curves AS (SELECT *, product(1 + strategy) OVER w AS sc, product(1 + hold) OVER w AS hc FROM per WINDOW w AS (PARTITION BY universe, threshold, cost ORDER BY date ROWS UNBOUNDED PRECEDING)),
    placed AS (
        SELECT *, sc / max(sc) OVER w - 1 AS sd, hc / max(hc) OVER w - 1 AS hd, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY universe, threshold, cost) AS n
        FROM curves WINDOW w AS (PARTITION BY universe, threshold, cost ORDER BY date ROWS UNBOUNDED PRECEDING))
    SELECT universe, threshold, cost, 5 AS horizon, date, positions, round(strategy, 6) AS strategy, round(hold, 6) AS hold, round(sc, 6) AS strategy_curve, round(hc, 6) AS hold_curve,
           round(sd, 6) AS strategy_drawdown, round(hd, 6) AS hold_drawdown
    FROM placed WHERE n <= 120 OR i = n - 1 OR floor(ceil(i / ((n - 1) / 119)) * ((n - 1) / 119)) = i""",
)
def w29(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lab.periods(lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), 5, lab.grid(spark))
    return rounded(lab.thinned(lab.curves(table)))


def two_labs_sql() -> str:
    """The periods of two horizons, one set of tables each, as rows of a comparison."""
    parts = [re.sub(r"\b(lr|reb|seen|uni|daily|per)\b", rf"\1_{h}", LAB_SQL.replace("horizon = 20", f"horizon = {h}").replace("k % 20", f"k % {h}")) for h in (5, 20)]
    rows = " UNION ALL ".join(f"SELECT universe, threshold, cost, {h} AS horizon, date AS session, strategy AS m, hold AS b, 'excess_return' AS metric FROM per_{h}" for h in (5, 20))
    return fx.prelude("region", "sessions", "universe") + fx.OUTCOMES + parts[0] + parts[1] + f", v AS ({rows}), "


@query("a09_lab", two_labs_sql() + records_sql("v", ["universe", "threshold", "cost", "horizon", "metric"], judged=False))
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of two horizons, compared with holding and corrected together."""
    rows, names, grid = lab_rows(spark, sf_dir), fx.universe(spark, sf_dir), lab.grid(spark)
    table = lab.periods(rows, names, 5, grid).unionByName(lab.periods(rows, names, 20, grid))
    keys = ["universe", "threshold", "cost", "horizon"]
    long = table.select(*keys, F.col("date").alias("day"), F.col("strategy").alias("model"), F.col("hold").alias("base"))
    found = evaluate.corrected(evaluate.compared(evaluate.daily_cells(long, keys), keys), [])
    return comparable(found.withColumn("verdict", evaluate.verdict(F.lit("excess_return"))))


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = with_tr(spark, sf_dir)
    targets = returns.with_targets(prices, [5]).select(*KEYS, "y_5")
    return technical.features(prices).join(targets, KEYS)


G08_SQL = SCENARIO_SQL + """, tr5 AS (SELECT f.*, o.actual_return AS y, o.expected_return AS m FROM forecasts f JOIN outcomes o USING (forecast_id) WHERE f.horizon = 5),
    base AS (SELECT avg((y > 0)::INT) AS br, avg(y) AS bm FROM tr5), band AS (SELECT quantile_cont(abs((y - bm) / greatest(sqrt(5 / 252.0) * vol_20, 1e-4)), 0.9) AS q FROM tr5, base),
    bins AS (SELECT sign(f.expected_return)::INTEGER AS bin, count(*) AS n, avg((y > 0)::INT) AS r, avg(y) AS mm FROM tr5 f GROUP BY 1 HAVING count(*) >= 100)
    SELECT 'momentum' AS baseline, bin, round(r, 6) AS rate, round(mm, 6) AS mean, round(q, 6) AS band_q FROM bins, band UNION ALL SELECT 'naive', NULL, round(br, 6), round(bm, 6), round(q, 6) FROM base, band"""


@query("g08_baseline_fit", G08_SQL)
def g08(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).where("horizon = 5").withColumns({"y_5": F.col("actual_return"), "ret_20": F.col("expected_return")})
    fitted = models.fit_baselines(rows, "y_5", 5).where("baseline in ('momentum', 'naive')")
    return rounded(fitted.select("baseline", "bin", "rate", "mean", "band_q"))


@query("m09_baseline_predict")
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).where("horizon = 5").withColumns({"y_5": F.col("actual_return"), "ret_20": F.col("expected_return")})
    plain = rows.drop("expected_return", "prob_up", "band_low", "band_high")
    found = models.predict_baseline(plain, models.fit_baselines(rows, "y_5", 5), "momentum", 5)
    return rounded(found.select("forecast_id", "expected_return", "prob_up", "band_low", "band_high"))


FEATURES = ["ret_5", "ret_20", "vol_20", "vol_60", "rsi_14", "macd_hist", "ema_dist_20", "bb_width_20"]


#: Trees of the queries below; a production fit takes 400, at the same 63 leaves.
ROUNDS = 12


def fitted(spark: SparkSession, sf_dir: str, kind: str) -> tuple[models.HorizonModel, DataFrame]:
    # Fits and calibrations read the rows many times.
    rows = stored(model_rows(spark, sf_dir).where("history_sessions >= 300"), "history")
    train, calibration, test = (rows.where(c) for c in ("date < '1999-01-01'", "date >= '1999-01-10' and date < '2000-06-01'", "date >= '2000-06-10'"))
    trees = {"rounds": ROUNDS, "rate": 0.1}
    options = {"trees": trees, "ensemble": {"trees": trees}}.get(kind, {})
    return models.fit_horizon(train.where("y_5 is not null"), calibration, FEATURES, 5, kind, **options), test


GAINS_SQL = REGION + TR + features_sql() + f""", labelled AS (
        SELECT instrument_id, date, lead(ln(tr_close), 5) OVER (PARTITION BY instrument_id ORDER BY date) - ln(tr_close) AS y FROM tr),
    known AS (SELECT f.*, y - avg(y) OVER () AS r FROM features f JOIN labelled USING (instrument_id, date) WHERE history_sessions >= 300 AND date < DATE '1999-01-01' AND y IS NOT NULL),
    long AS MATERIALIZED (UNPIVOT (SELECT r, {", ".join(FEATURES)} FROM known) ON {", ".join(FEATURES)} INTO NAME feature VALUE x),
    cuts AS (SELECT feature, unnest(list_distinct(quantile_cont(x, {[i / 255 for i in range(1, 255)]}))) AS cut FROM long GROUP BY 1),
    sides AS (SELECT c.feature, cut, sum(r) FILTER (x <= cut) AS gl, count(*) FILTER (x <= cut) AS nl, sum(r) AS g, count(*) AS n FROM cuts c JOIN long l ON l.feature = c.feature GROUP BY 1, 2),
    gains AS (SELECT *, gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) - g * g / (n + 1) AS gain FROM sides WHERE nl >= 500 AND n - nl >= 500)
    SELECT feature, round(cut, 6) AS cut, nl::DOUBLE AS rows_left, round(gain, 6) AS gain FROM gains QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, cut) = 1"""


@query("m05_first_gains", GAINS_SQL)
def m05_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each feature the cut that splits all training rows best."""
    train = model_rows(spark, sf_dir).where("history_sessions >= 300 and date < '1999-01-01'")
    return rounded(spark.createDataFrame(boosting.root_splits(train, FEATURES, "y_5"), "feature string, cut double, rows_left double, gain double"))


@query("m05_gbt_conformal")
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir, "trees")
    return rounded(model.predict(test).select(*KEYS, "y_5", "expected_return", "scale", "prob_up_raw", "prob_up", "band_low", "band_high"))


@query("m08_linear_conformal")
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir, "linear")
    return rounded(model.predict(test).select(*KEYS, "y_5", "expected_return", "scale", "prob_up_raw", "prob_up", "band_low", "band_high"))


@query("m08_network_conformal")
def m08_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir, "network")
    return rounded(model.predict(test).select(*KEYS, "y_5", "expected_return", "scale", "prob_up_raw", "prob_up", "band_low", "band_high"))


@query("m08_ensemble_conformal")
def m08_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of trees, linear model and network, calibrated as one."""
    model, test = fitted(spark, sf_dir, "ensemble")
    return rounded(model.predict(test).select(*KEYS, "y_5", "expected_return", "scale", "prob_up_raw", "prob_up", "band_low", "band_high"))


@query("m07_contributions")
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir, "trees")
    found = model.points.contributions(test.select(*KEYS, *FEATURES))
    return found.select(*KEYS, F.to_json(scalar.top_contributions(F.col("contributions"), 6)).alias("contributions"))


@query("a24_record_export", OUT + " SELECT strftime(target_session, '%Y-%m') AS month, count(*) AS rows FROM outcomes GROUP BY 1 HAVING max(session) >= DATE '2001-06-01' OR strftime(max(target_session), '%Y-%m') NOT LIKE '1996%'")
def a24(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).withColumn("resolved_at", F.col("session").cast("timestamp"))
    there = rows.where("year(target_session) = 1996").select(F.date_format("target_session", "yyyy-MM").alias("month")).distinct()
    return record.months_to_write(rows, there, F.lit("2001-06-08").cast("date"))


@query("g07_sector_names", fx.prelude("nation", "universe") + " SELECT date, count(*) AS n FROM panel_nation JOIN universe USING (instrument_id) WHERE asset_class = 'equity' GROUP BY 1")
def g07_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir, "nation").drop("sector").withColumns({"ret_20": F.lit(0.0), "ema_dist_50": F.lit(0.0)})
    named = cross_section.with_sector_relative(rows, fx.universe(spark, sf_dir))
    return named.where("asset_class = 'equity'").groupBy("date").agg(F.count(F.lit(1)).alias("n"))


