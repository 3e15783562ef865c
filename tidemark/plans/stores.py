"""Queries over stored tables: what sources read, sinks write and payloads hold, each made from the fixture tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import calendars, quality, scalar
from tidemark.operators import cross_section, models, record, upsert
from tidemark.plans.measure import OUT, outcomes
from tidemark.plans.panel import KEYS, REGION, bars
from tidemark.plans.base import query, rounded
from tidemark.session import scratch
from tidemark.sources import feeds, sinks, tables
from tidemark.sources import fixtures as fx

NATION = fx.prelude("nation")


def fine(df: DataFrame) -> DataFrame:
    """Doubles to nine digits: prices of two digits over small quantities have no tie there, so both engines round alike."""
    return df.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def priced(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """The panel in the columns of stored prices."""
    rows = fx.panel(spark, sf_dir, level)
    return rows.select(*KEYS, "open", "high", "low", "close", F.col("close").alias("adj_close"), F.col("volume").cast("double").alias("volume"), F.lit("fixture").alias("source"), F.lit("2002-01-01").cast("timestamp").alias("fetched_at"), F.lit("ok").alias("quality"))


def stored_prices(spark: SparkSession, sf_dir: str) -> str:
    root = scratch(spark, "prices")
    sinks.write_years(priced(spark, sf_dir), root)
    return root


@query("s01_year_scan", NATION + " SELECT instrument_id, date, round(close, 9) AS close, year(date)::INTEGER AS year FROM panel_nation WHERE year(date) = 1997")
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fine(tables.read_years(spark, stored_prices(spark, sf_dir), [1997]).select(*KEYS, "close", "year"))


@query("s02_stored_years", NATION + " SELECT DISTINCT year(date)::INTEGER AS year FROM panel_nation")
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(y,) for y in tables.stored_years(spark, stored_prices(spark, sf_dir))], "year int")


@query("s03_many_years", NATION + " SELECT year(date)::INTEGER AS year, count(*) AS rows, count(DISTINCT instrument_id) AS instruments, round(sum(close), 4) AS total FROM panel_nation WHERE year(date) BETWEEN 1996 AND 1999 GROUP BY 1")
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.read_years(spark, stored_prices(spark, sf_dir), range(1996, 2000))
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("instrument_id").alias("instruments"), F.round(F.sum("close"), 4).alias("total"))


CLASS_SQL = "CASE WHEN right(instrument_id, 1) IN ('1', '2', '3') THEN 'crypto' WHEN right(instrument_id, 1) IN ('4', '5', '6') THEN 'fx' ELSE 'bonds' END"


def class_of(id_col: str = "instrument_id") -> Column:
    """A made-up asset class of each nation."""
    last = F.substring(id_col, -1, 1)
    return F.when(last.isin("1", "2", "3"), "crypto").when(last.isin("4", "5", "6"), "fx").otherwise("bonds")


@query("s04_asset_loads", NATION + f" SELECT {CLASS_SQL} AS asset_class, instrument_id, date, round(close, 9) AS close FROM panel_nation WHERE year(date) >= 1999")
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each class under a folder of its own, loaded apart."""
    rows, found = priced(spark, sf_dir), None
    for name in ("crypto", "fx", "bonds"):
        root = scratch(spark, f"prices-{name}")
        sinks.write_years(rows.where(class_of() == name), root)
        part = tables.read_years(spark, root, [1999, 2000, 2001]).withColumn("asset_class", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return fine(found.select("asset_class", *KEYS, "close"))


@query("s06_table_or_none", fx.prelude("universe") + " SELECT 'there' AS path, count(*) AS rows FROM universe UNION ALL SELECT 'missing', NULL")
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "universe")
    sinks.write_table(fx.universe(spark, sf_dir), path)
    found = tables.try_read(spark, path)
    rows = found.select(F.lit("there").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    return rows if tables.try_read(spark, f"{path}-missing") is not None else rows.unionByName(spark.createDataFrame([("missing", None)], "path string, rows long"))


PACKAGE = T.StructType([T.StructField("forecast_id", T.StringType()), T.StructField("session", T.DateType()), T.StructField("horizon", T.IntegerType()), T.StructField("prob_up", T.DoubleType()), T.StructField("implied_status", T.StringType())])


@query("s07_packages_of_all_ages", OUT + " SELECT forecast_id, session, horizon, prob_up, CASE WHEN year(session) >= 1999 THEN 'ok' END AS implied_status FROM forecasts")
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages of before 1999 lack a column that later ones have."""
    rows, root = fx.forecasts(spark, sf_dir).select("forecast_id", "session", "horizon", "prob_up"), scratch(spark, "packages")
    sinks.save_package(rows.where("year(session) < 1999"), f"{root}/1998/old")
    sinks.save_package(rows.where("year(session) >= 1999").withColumn("implied_status", F.lit("ok")), f"{root}/2001/new")
    return rounded(tables.read_packages(spark, root, PACKAGE))


@query("s08_outcome_scan", OUT + " SELECT year(target_session)::INTEGER AS year, resolution_type, count(*) AS rows, round(sum(brier), 4) AS brier FROM outcomes WHERE year(target_session) IN (1996, 1998) GROUP BY 1, 2")
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "outcomes")
    rows = outcomes(spark, sf_dir).select("instrument_id", "session", "target_session", "horizon", "brier", "resolution_type")
    sinks.write_years(rows, root, "target_session")
    found = tables.read_years(spark, root, [1996, 1998], rows.schema)
    return found.groupBy("year", "resolution_type").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("brier"), 4).alias("brier"))


@query("s09_universe_csv", fx.prelude("universe") + " SELECT instrument_id, ticker, '' AS name, 'crypto' AS asset_class, sector, valid_from, valid_to, segment FROM universe")
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, path = fx.universe(spark, sf_dir), scratch(spark, "universe")
    text = names.withColumns({"name": F.lit(None).cast("string"), "exchange_calendar": F.lit("XNYS"), "source_symbol": F.col("ticker")})
    text.select(*(F.col(c).cast("string").alias(c) for c in tables.UNIVERSE)).write.option("header", True).csv(path)
    return tables.read_universe(spark, path, {"asset_class": "crypto"}).select("instrument_id", "ticker", "name", "asset_class", "sector", "valid_from", "valid_to", "segment")


@query("s10_manifests", OUT + " SELECT session, list_sort(list(DISTINCT horizon))::VARCHAR AS horizons, count(DISTINCT instrument_id) AS instruments, count(*) AS forecasts FROM forecasts GROUP BY 1")
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, root = fx.forecasts(spark, sf_dir), scratch(spark, "manifests")
    made = sinks.manifest(rows.select("forecast_id", "session", "horizon", "instrument_id", "prob_up"), F.lit("2002-01-01").cast("timestamp"), "main", "v1")
    # A folder a month with its sessions' manifests.
    months = made.groupBy(F.date_format("session", "yyyy-MM").alias("month")).agg(F.to_json(F.collect_list(F.struct(*made.columns))).alias("value"))
    sinks.write_documents(months, root, "month")
    kind = "session string, horizons array<int>, instruments long, forecasts long"
    found = tables.read_manifests(spark, f"{root}/*/*", kind)
    return found.select("session", F.concat(F.lit("["), F.array_join(F.col("horizons").cast("array<string>"), ", "), F.lit("]")).alias("horizons"), "instruments", "forecasts")


@query("s12_json_prices", NATION + " SELECT instrument_id AS ticker, date, round(close, 9) AS close, round(close + 1, 9) AS adj_close, CASE WHEN day(date) = 3 THEN 0.5 ELSE 0.0 END AS dividend, CASE WHEN day(date) = 7 THEN 2.0 ELSE 0.0 END AS split_ratio FROM panel_nation")
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array a ticker and year, of raw bars with dividends and split factors."""
    rows = fx.panel(spark, sf_dir, "nation")
    bar = F.struct(F.concat(F.col("date").cast("string"), F.lit("T00:00:00.000Z")).alias("date"), "open", "high", "low", "close", (F.col("close") + 1).alias("adjClose"), F.col("volume").cast("double").alias("volume"), F.when(F.dayofmonth("date") == 3, 0.5).otherwise(0.0).alias("divCash"), F.when(F.dayofmonth("date") == 7, 2.0).otherwise(1.0).alias("splitFactor"))
    landed = rows.groupBy(F.col("instrument_id").alias("ticker"), F.year("date").alias("y")).agg(F.to_json(F.collect_list(bar)).alias("payload"))
    return fine(feeds.json_prices(landed).select("ticker", "date", "close", "adj_close", "dividend", "split_ratio"))


@query("s13_two_adjustments", NATION + " SELECT instrument_id AS ticker, date, round(close, 9) AS close, CASE WHEN day(date) <> 5 THEN round(close * 0.9, 9) END AS adj_close FROM panel_nation")
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = fx.panel(spark, sf_dir, "nation").select(F.col("instrument_id").alias("ticker"), "date", "close")
    full = split.where(F.dayofmonth("date") != 5).withColumn("close", F.col("close") * 0.9)
    return fine(feeds.two_adjustments(split, full).select("ticker", "date", "close", "adj_close"))


@query("s14_rate_csv", REGION + ", r AS (SELECT date, right(instrument_id, 1) AS currency, round(close, 6) AS rate FROM panel_region WHERE day(date) <> 13) SELECT * FROM r UNION ALL SELECT DISTINCT date, 'EUR', 1.0 FROM r")
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed reference rates; a dot stands for no observation."""
    path = scratch(spark, "rates")
    value = F.when(F.dayofmonth("date") == 13, "-").otherwise(F.round("close", 6).cast("string"))
    bars(spark, sf_dir).select(F.col("date").cast("string").alias("TIME_PERIOD"), F.substring("instrument_id", -1, 1).alias("CURRENCY"), value.alias("OBS_VALUE")).write.option("header", True).csv(path)
    return rounded(feeds.rate_csv(spark, path, "EUR"))


@query("s15_curve", fx.prelude("macro") + ' SELECT date AS "Date", round(yield_10y, 6) AS "10 Yr", round(CASE WHEN day(date) <> 9 THEN yield_10y / 2 END, 6) AS "Real 10 Yr" FROM macro')
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nominal yields with the real ones of the days that have them; where the real table is missing only nominal ones come."""
    rows = fx.macro(spark, sf_dir)
    nominal = rows.select(F.col("date").alias("Date"), F.col("yield_10y").alias("10 Yr"))
    real = rows.where("dayofmonth(date) <> 9").select(F.col("date").alias("Date"), (F.col("yield_10y") / 2).alias("10 Yr"))
    assert feeds.curve_csv(nominal, None).columns == nominal.columns
    found = feeds.curve_csv(nominal, real)
    return found.select("Date", *(F.round(c, 6).alias(c) for c in ("10 Yr", "Real 10 Yr")))


def landed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An RSS payload an hour and type of event: every third link is on another host, every fourth without a date; one type's payloads have a doctype."""
    rows = fx.read(spark, sf_dir, "events")
    host = F.when(F.col("event_id") % 3 == 0, "other.org").otherwise("news.example.org")
    moment = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.date_format("ts", "E, d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    item = F.concat(F.lit("<item><title>event "), F.col("event_id").cast("string"), F.lit("</title><link>https://"), host, F.lit("/"), F.col("event_id").cast("string"), F.lit("</link><pubDate>"), moment, F.lit("</pubDate></item>"))
    packed = rows.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.array_join(F.collect_list(item), "").alias("items"), F.first("event_type").alias("kind"))
    head = F.when(F.col("kind") == "view", "<!DOCTYPE rss><rss><channel>").otherwise("<rss><channel>")
    return packed.select(F.concat(head, "items", F.lit("</channel></rss>")).alias("payload"))


ITEMS_SQL = "WITH items AS (SELECT 'event ' || event_id AS title, 'https://news.example.org/' || event_id AS link, date_trunc('second', ts) AS published FROM events WHERE event_id % 3 <> 0 AND event_id % 4 <> 0 AND event_type <> 'view')"


@query("s17_feed_items", ITEMS_SQL + " SELECT 'official' AS source, title, link, published FROM items")
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_items(landed_items(spark, sf_dir), "official", "news.example.org")


@query("f14_news_windows", ITEMS_SQL + """, s AS (SELECT DISTINCT ts::DATE AS session FROM events)
    SELECT session, link, published, row_number() OVER (PARTITION BY session ORDER BY published DESC, link)::INTEGER AS rank FROM items JOIN s ON published >= session - INTERVAL 1 DAY AND published <= session + INTERVAL 30 HOUR QUALIFY rank <= 10""")
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = feeds.feed_items(landed_items(spark, sf_dir), "official", "news.example.org")
    days = fx.read(spark, sf_dir, "events").select(F.to_date("ts").alias("session")).distinct()
    return feeds.news_windows(items, days).select("session", "link", "published", "rank")


@query("s23_conform", NATION + " SELECT instrument_id AS ticker, date, round(close, 9) AS close, CASE WHEN day(date) <> 4 THEN volume::DOUBLE END AS volume, 'offer' AS source FROM panel_nation WHERE day(date) NOT IN (2, 3)")
def s23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider's frame of text columns, some without a close, some with words for numbers."""
    rows = fx.panel(spark, sf_dir, "nation")
    day = F.dayofmonth("date")
    close = F.when(day == 2, None).when(day == 3, "n/a").otherwise(F.col("close").cast("string"))
    frame = rows.select(F.col("instrument_id").alias("ticker"), F.col("date").cast("string").alias("date"), *(F.col(c).cast("string").alias(c) for c in ("open", "high", "low")), close.alias("close"), close.alias("adj_close"), F.when(day == 4, "many").otherwise(F.col("volume").cast("string")).alias("volume"))
    return fine(tables.conform(frame, "offer").select("ticker", "date", "close", "volume", "source"))


@query("k01_rewrite_years", NATION + " SELECT instrument_id, date, round(CASE WHEN year(date) = 2000 THEN close * 2 ELSE close END, 9) AS close FROM panel_nation")
def k01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing a year again replaces that year alone."""
    root = stored_prices(spark, sf_dir)
    sinks.write_years(priced(spark, sf_dir).where("year(date) = 2000").withColumn("close", F.col("close") * 2), root)
    return fine(tables.read_years(spark, root).select(*KEYS, "close"))


@query("k03_table", fx.prelude("universe") + " SELECT * FROM universe")
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "table")
    sinks.write_table(fx.universe(spark, sf_dir), path)
    return tables.try_read(spark, path)


@query("k04_outcome_years", OUT + " SELECT year(target_session)::INTEGER AS year, count(*) AS rows, round(sum(actual_return), 4) AS total FROM outcomes WHERE NOT (year(target_session) = 1997 AND horizon = 5) GROUP BY 1")
def k04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years are written, then one again without a horizon."""
    root = scratch(spark, "outcomes")
    rows = outcomes(spark, sf_dir).select("instrument_id", "session", "target_session", "horizon", "actual_return")
    sinks.write_years(rows, root, "target_session")
    sinks.write_years(rows.where("year(target_session) = 1997 and horizon <> 5"), root, "target_session")
    found = tables.read_years(spark, root, None, rows.schema)
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("actual_return"), 4).alias("total"))


@query("k06_month_files", OUT + " SELECT strftime(target_session, '%Y-%m') AS month, 'csv' AS kind, count(*) AS rows FROM outcomes WHERE year(target_session) = 1996 GROUP BY 1 UNION ALL SELECT strftime(target_session, '%Y-%m'), 'parquet', count(*) FROM outcomes WHERE year(target_session) = 1996 GROUP BY 1")
def k06(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "months")
    rows = outcomes(spark, sf_dir).where("year(target_session) = 1996").withColumn("resolved_at", F.col("session").cast("timestamp")).select("forecast_id", "instrument_id", "session", "target_session", "horizon", "brier", "resolved_at")
    nothing = spark.createDataFrame([], "month string")
    sinks.write_months(rows, nothing, root, F.lit("2001-06-08").cast("date"))
    read = {"csv": spark.read.option("header", True).csv(f"{root}/csv"), "parquet": spark.read.parquet(f"{root}/parquet")}
    parts = [t.groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit(k)) for k, t in read.items()]
    return parts[0].unionByName(parts[1]).select("month", "kind", "rows")


@query("k11_patch_outcomes", OUT + " SELECT forecast_id AS id, CASE WHEN horizon = 5 THEN 'old' ELSE 'new' END AS outcome FROM outcomes WHERE horizon IN (5, 20)")
def k11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of five days are resolved already; a second patch of all changes nothing."""
    rows = outcomes(spark, sf_dir).where("horizon in (5, 20)").select(F.col("forecast_id").alias("id"), "horizon")
    at = lambda day: F.lit(day).cast("timestamp")
    entries = rows.withColumns({"outcome": F.when(F.col("horizon") == 5, "old"), "resolved_at": F.when(F.col("horizon") == 5, at("2001-01-01"))})
    fresh = lambda name, day: rows.select("id", F.lit(name).alias("outcome"), at(day).alias("resolved_at"))
    once = sinks.patched(entries, fresh("new", "2001-02-01"))
    return sinks.patched(once, fresh("newer", "2001-03-01")).select("id", "outcome")


@query("p06_canonical_actions", fx.prelude("nation", "universe") + " SELECT instrument_id, date, round(CASE WHEN day(date) = 6 THEN 0 ELSE dividend END, 6) AS dividend, round(split_ratio, 6) AS split_ratio FROM actions_nation JOIN universe USING (instrument_id) WHERE segment = 'main'")
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider actions by ticker; tickers of the cross segment are not known."""
    names = fx.universe(spark, sf_dir)
    raw = fx.actions(spark, sf_dir, "nation").join(names.select("instrument_id", "ticker"), "instrument_id")
    text = raw.select("ticker", "date", F.when(F.dayofmonth("date") == 6, "unknown").otherwise(F.col("dividend").cast("string")).alias("dividend"), "split_ratio")
    return rounded(quality.canonical_actions(text, names.where("segment = 'main'"), F.lit("2002-01-01").cast("timestamp")).drop("fetched_at"))


@query("p10_to_yield", fx.prelude("macro") + " SELECT date, round(yield_10y / 1e4, 9) AS close FROM macro WHERE yield_10y IS NOT NULL")
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = upsert.as_price(fx.macro(spark, sf_dir).where("yield_10y is not null").select("date", (F.col("yield_10y") / 1e4).alias("close")), ["close"])
    # Nine digits: rounding at six would fall on ties of two-digit averages.
    return upsert.as_yield(levels, ["close"]).withColumn("close", F.round("close", 9))


@query("p12_feature_columns", "SELECT unnest(['open', 'high', 'low', 'close', 'volume']) AS feature")
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir).withColumns({"volume": F.col("volume").cast("double"), "y_5": F.lit(0.0), "history_sessions": F.lit(1.0), "regime": F.lit("calm")})
    return spark.createDataFrame([(c,) for c in models.feature_columns(rows)], "feature string")


@query("p20_in_scope", OUT + ", o AS (SELECT forecast_id, CASE WHEN horizon = 5 THEN 'crypto' ELSE 'fx' END AS scope FROM outcomes) SELECT 'with' AS kind, count(*) AS rows FROM o WHERE scope = 'fx' UNION ALL SELECT 'without', count(*) FROM o")
def p20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).select("forecast_id", F.when(F.col("horizon") == 5, "crypto").otherwise("fx").alias("scope"))
    count = lambda t, kind: quality.in_scope(t, "fx").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "rows")
    return count(rows, "with").unionByName(count(rows.drop("scope"), "without"))


@query("f10_symbols", fx.prelude("universe") + " SELECT translate(ticker, '_0123456789', 'XABCDEFGHIJ') AS ticker, translate(ticker, '_0123456789', 'XABCDEFGHIJ') AS display, true AS listed FROM universe")
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider symbols with a number and a quote currency back to tickers, found again in a document and by exact name."""
    names = fx.universe(spark, sf_dir).select(F.translate("ticker", "_0123456789", "XABCDEFGHIJ").alias("ticker"))
    symbol = F.concat("ticker", F.lit("77-USD"))
    text = F.concat(F.lit("see `"), "ticker", F.lit("` and `x`"))
    quoted = scalar.listed_symbols(text)
    known = scalar.exact_name(F.col("ticker"), F.array(F.concat(F.col("ticker"), F.lit(" Cash")), F.lower(F.col("ticker")))) == 1
    return names.select("ticker", scalar.display_ticker(symbol).alias("display"), (F.array_contains(quoted, F.col("ticker")) & known).alias("listed"))


@query("f13_rule_parts", "SELECT rule, split_part(rule, '|', 1) AS name, CASE WHEN contains(rule, '|') THEN split_part(rule, '|', 2) END AS variant, split_part(combo, '+', 1) AS trigger, array_to_string(string_split(combo, '+')[2:], ',') AS contexts FROM (SELECT event_type || CASE WHEN event_id % 2 = 0 THEN '|wick' ELSE '' END AS rule, event_type || CASE WHEN event_id % 3 = 0 THEN '+trend+htf' WHEN event_id % 3 = 1 THEN '+calm' ELSE '' END AS combo FROM events)")
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    rows = fx.read(spark, sf_dir, "events").select(F.concat("event_type", F.when(n % 2 == 0, "|wick").otherwise("")).alias("rule"), F.concat("event_type", F.when(n % 3 == 0, "+trend+htf").when(n % 3 == 1, "+calm").otherwise("")).alias("combo"))
    trigger, contexts = scalar.combo_parts(F.col("combo"))
    return rows.select("rule", scalar.rule_name(F.col("rule")).alias("name"), scalar.rule_variant(F.col("rule")).alias("variant"), trigger.alias("trigger"), F.array_join(contexts, ",").alias("contexts"))


@query("j03_by_date", fx.prelude("region", "sessions", "macro") + """, b AS (SELECT date, avg((close > open)::INT) AS up_share FROM panel_region GROUP BY 1), m AS (SELECT date, vix FROM macro)
    SELECT p.instrument_id, p.date, round(b.up_share, 6) AS up_share, round(m.vix, 6) AS vix, CASE WHEN s.idx % 2 = 0 THEN 'calm' END AS regime FROM panel_region p JOIN b USING (date) LEFT JOIN m USING (date) JOIN sessions s USING (date)""")
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for a day joins every instrument's row of it."""
    rows = bars(spark, sf_dir)
    breadth = rows.groupBy("date").agg(F.avg((F.col("close") > F.col("open")).cast("int")).alias("up_share"))
    regimes = fx.sessions(rows).where("idx % 2 = 0").select("date", F.lit("calm").alias("regime"))
    return rounded(cross_section.by_date(rows.select(*KEYS), breadth, fx.macro(spark, sf_dir).select("date", "vix"), regimes))


@query("t05_arena_order", OUT + ", a AS (SELECT horizon, regime, avg(hit) - avg(baseline_hit) AS delta FROM outcomes WHERE regime IS NOT NULL GROUP BY 1, 2) SELECT horizon, regime, row_number() OVER (PARTITION BY horizon ORDER BY round(delta, 9) DESC, regime)::INTEGER AS place FROM a")
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes(spark, sf_dir).where("regime is not null").groupBy("horizon", "regime").agg(F.round(F.avg("hit") - F.avg("baseline_hit"), 9).alias("delta"))
    return record.placed(rows, "regime").select("horizon", "regime", "place")


@query("c09_calendar_rows", "WITH d AS (SELECT unnest(generate_series(DATE '2024-03-25', DATE '2024-04-12', INTERVAL 1 DAY))::DATE AS day), s AS (SELECT day FROM d WHERE isodow(day) < 6 AND day NOT IN (DATE '2024-03-29', DATE '2024-04-01')) SELECT day, 'session' AS kind, 'TARGET' AS what FROM s UNION ALL SELECT t.day, 'target', 'h5' FROM (SELECT day, row_number() OVER (ORDER BY day) AS i FROM s) t WHERE i = 8 UNION ALL SELECT DATE '2024-04-05', 'event', 'nfp'")
def c09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions, scheduled events and the days on which open forecasts fall due, as rows of one calendar."""
    days = calendars.sessions(spark, "TARGET", "2024-03-25", "2024-04-12")
    events = spark.sql("SELECT * FROM VALUES ('nfp', DATE '2024-04-05'), ('nfp', DATE '2024-06-07') AS t(kind, day)")
    due = spark.sql("SELECT DATE '2024-03-27' AS session, 5 AS horizon UNION ALL SELECT DATE '2024-03-27', 5")
    return calendars.calendar_rows(days, "TARGET", events, calendars.with_target(due, days))
