"""Provider payloads as tables: landed files in, rows out. Fetching them is not the engine's work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BARS = ("open", "high", "low", "close", "adj_close", "volume")

#: An item of elements without attributes, children, references or characters that XML alters or forbids.
FLAT_ITEM = r"^<item>[ \n\t]*(?:<([A-Za-z]+)>[^<&\]\r\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]*+</\1>[ \n\t]*)*</item>$"


def wide_to_long(wide: DataFrame, tickers: Sequence[str], fields: Sequence[str], date: str = "date") -> DataFrame:
    """One column for each ticker and field, named ticker_field, to date, ticker and fields; bars without any value are dropped."""
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("ticker"), *(F.col(f"`{t}_{f}`").alias(f) for f in fields)) for t in tickers]))
    long = wide.select(date, each.alias("b")).select(date, "b.*")
    return long.where(F.coalesce(*fields).isNotNull())


def split_actions(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars, and the days with a dividend or a split."""
    some = (F.coalesce("dividend", F.lit(0.0)) != 0) | (F.coalesce("split_ratio", F.lit(0.0)) != 0)
    return long.drop("dividend", "split_ratio"), long.where(some).select("ticker", "date", "dividend", "split_ratio")


def json_prices(landed: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """Rows of a JSON array of raw bars with adjClose, divCash and splitFactor; a factor of 1 is no split."""
    schema = "array<struct<date:string,open:double,high:double,low:double,close:double,adjClose:double,volume:double,divCash:double,splitFactor:double>>"
    rows = landed.select(ticker, F.explode(F.from_json(payload, schema)).alias("r"))
    factor = F.when(F.col("r.splitFactor") != 1, F.col("r.splitFactor")).otherwise(0.0)
    return rows.select(ticker, F.to_date(F.substring("r.date", 1, 10)).alias("date"), "r.open", "r.high", "r.low", "r.close", F.col("r.adjClose").alias("adj_close"), "r.volume", F.coalesce("r.divCash", F.lit(0.0)).alias("dividend"), F.coalesce(factor, F.lit(0.0)).alias("split_ratio"))


def fetch_status(code: Column) -> Column:
    """What a provider's answer means for its next use."""
    return F.when(code == 404, "empty").when(code.isin(401, 403), "blocked").when((code == 429) | (code >= 500), "unavailable").otherwise("ok")


def two_adjustments(split_adjusted: DataFrame, fully_adjusted: DataFrame) -> DataFrame:
    """Split-adjusted bars with the fully adjusted close of the same day, if there is one."""
    return split_adjusted.join(fully_adjusted.select("ticker", "date", F.col("close").alias("adj_close")), ["ticker", "date"], "left")


def rate_csv(spark: SparkSession, path: str, home: str) -> DataFrame:
    """Landed reference rates (TIME_PERIOD, CURRENCY, OBS_VALUE) to date, currency, rate, with the home currency at 1."""
    rows = spark.read.option("header", True).csv(path).select(F.to_date("TIME_PERIOD").alias("date"), F.col("CURRENCY").alias("currency"), F.col("OBS_VALUE").try_cast("double").alias("rate")).where("rate is not null")
    return rows.unionByName(rows.select("date").distinct().select("date", F.lit(home).alias("currency"), F.lit(1.0).alias("rate")))


def curve_csv(nominal: DataFrame, real: DataFrame | None) -> DataFrame:
    """Nominal and, where it could be had, real yields by date; real columns are marked as such."""
    if real is None:
        return nominal
    marked = real.withColumnsRenamed({c: f"Real {c}" for c in real.columns if c != "Date"})
    return nominal.join(marked, "Date", "left")


def pivot_series(observed: DataFrame, series: Sequence[str]) -> DataFrame:
    """(date, series, value as text) to one column a series; a dot is a missing value. Days without any value are left out."""
    values = observed.withColumn("value", F.when(F.col("value") != ".", F.col("value").try_cast("double"))).where("value is not null")
    return values.groupBy("date").pivot("series", list(series)).agg(F.first("value"))


def feed_items(landed: DataFrame, source: str, host: str, payload: str = "payload") -> DataFrame:
    """source, title, link, published of an RSS payload's items: no doctype or entities, https and the exact host, a parsable date."""
    safe = landed.where(~F.upper(payload).contains("<!DOCTYPE") & ~F.upper(payload).contains("<!ENTITY"))
    # Item by item, as a title may be several text nodes; what is commented out is no item.
    bare = F.regexp_replace(payload, r"(?s)<!--.*?-->", "")
    items = safe.select(F.explode(F.regexp_extract_all(bare, F.lit(r"(?s)<item(?:\s[^>]*)?>.*?</item>"), F.lit(0))).alias("item"))
    # In a flat item a tag's text is what stands in it; only others are parsed as XML, once a tag.
    flat = F.col("item").rlike(FLAT_ITEM)
    plain = lambda tag: F.regexp_extract("item", f"<{tag}>([^<]*)</{tag}>", 1)
    text = lambda tag: F.trim(F.when(flat, plain(tag)).otherwise(F.xpath_string("item", F.lit(f"/item/{tag}[1]"))))
    rows = items.select(text("title").alias("title"), text("link").alias("link"), text("pubDate").alias("published")).where("title <> '' and link <> '' and published <> ''")
    moment = F.try_to_timestamp(F.regexp_replace(F.regexp_replace("published", r"^\w{3}, ", ""), r" (GMT|UT|UTC)$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z"))
    kept = rows.withColumn("published", moment).where(F.col("published").isNotNull() & F.col("link").startswith("https://") & (F.parse_url("link", F.lit("HOST")) == host))
    return kept.select(F.lit(source).alias("source"), F.substring(F.trim("title"), 1, 200).alias("title"), F.trim("link").alias("link"), "published")


def news_windows(items: DataFrame, sessions: DataFrame, most: int = 10) -> DataFrame:
    """Each session's newest items from the day before it to six in the morning after it: session, item columns, rank.

    An item's day says which three sessions' windows it can be in, so the join is by day.
    """
    near = items.withColumn("session", F.explode(F.array(*[F.date_add(F.to_date("published"), k) for k in (-1, 0, 1)])))
    low, high = F.date_sub("session", 1).cast("timestamp"), F.date_add("session", 1).cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    inside = near.join(sessions.select("session"), "session", "left_semi").where((F.col("published") >= low) & (F.col("published") <= high))
    rank = F.row_number().over(Window.partitionBy("session").orderBy(F.col("published").desc(), "link"))
    return inside.withColumn("rank", rank).where(F.col("rank") <= most)


def in_news_window(items: DataFrame, session: Column, most: int = 10) -> DataFrame:
    """One session's window."""
    day = items.sparkSession.range(1).select(session.cast("date").alias("session"))
    return news_windows(items, day, most).drop("session", "rank").orderBy(F.col("published").desc(), "link")


def implied_table(calls: DataFrame) -> DataFrame:
    """Risk-neutral probability, volatility and band of each chain: id, horizon, spot, rate, years and rows of strike, bid, ask, iv, open_interest.

    status: no_spot, no_rate, stale_session (where rows carry ``chain_session`` and ``session`` and these differ), no_chain,
    illiquid, no_expiry, bad_price or ok, in that order. The two neighbouring strikes whose middle is nearest the spot decide.
    """
    from tidemark.functions.scalar import implied_probability
    from tidemark.operators.rolling import ratio

    keys = ["instrument_id", "horizon"]
    own = Window.partitionBy(*keys).orderBy("strike")
    fields = ("strike", "bid", "ask", "iv", "open_interest")
    known = calls.where("strike is not null and bid is not null and ask is not null")
    stale = F.col("chain_session") != F.col("session") if {"chain_session", "session"} <= set(calls.columns) else F.lit(False)
    known = known.withColumn("__stale", F.coalesce(stale, F.lit(False)))
    pairs = known.withColumns({f"next_{c}": F.lead(c).over(own) for c in fields}).withColumn("chain", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    distance = F.abs((F.col("strike") + F.col("next_strike")) / 2 - F.col("spot"))
    nearest = F.row_number().over(Window.partitionBy(*keys).orderBy(distance.asc_nulls_last(), "strike"))
    pair = pairs.withColumn("__r", nearest).where("__r = 1")

    def usable(p: str) -> Column:
        bid, ask = F.col(f"{p}bid"), F.col(f"{p}ask")
        return (bid > 0) & (ask > 0) & (ask >= bid) & ((ask - bid) / ((bid + ask) / 2) <= 0.25) & (F.coalesce(f"{p}open_interest", F.lit(0)) >= 100)

    middle = lambda p: (F.col(f"{p}bid") + F.col(f"{p}ask")) / 2
    prob = implied_probability(F.col("strike"), middle(""), F.col("next_strike"), middle("next_"), F.col("rate"), F.col("years"))
    status = F.when(F.col("spot").isNull(), "no_spot").when(F.col("rate").isNull(), "no_rate").when(F.col("__stale"), "stale_session").when(F.col("chain") < 2, "no_chain").when(~F.coalesce(usable("") & usable("next_"), F.lit(False)), "illiquid").when(F.col("years") <= 0, "no_expiry").when(~prob.between(0.01, 0.99), "bad_price").otherwise("ok")
    weight = F.least(F.greatest(ratio(F.col("spot") - F.col("strike"), F.col("next_strike") - F.col("strike")), F.lit(0.0)), F.lit(1.0))
    iv = F.coalesce("iv", F.lit(0.0)) + (F.coalesce("next_iv", F.lit(0.0)) - F.coalesce("iv", F.lit(0.0))) * weight
    found = pair.withColumns({"status": status, "__prob": prob, "__iv": F.when((iv > 0.01) & (iv < 3), iv)})
    t = F.col("horizon") / 252
    ok = F.col("status") == "ok"
    drift, wide = (F.col("rate") - F.col("__iv") ** 2 / 2) * t, 1.6448536269514722 * F.col("__iv") * F.sqrt(t)
    return found.select(*keys, "status", F.when(ok, F.col("__prob")).alias("prob_up"), F.when(ok, F.col("__iv")).alias("iv"), F.when(ok, drift - wide).alias("band_low"), F.when(ok, drift + wide).alias("band_high"))


def attach_implied(forecasts: DataFrame, implied: DataFrame, missing: str = "fetch_failed") -> DataFrame:
    """Forecasts with the implied columns; instruments without any get a status that says so."""
    named = implied.select("instrument_id", "horizon", *(F.col(c).alias(f"implied_{c}") for c in ("status", "prob_up", "iv", "band_low", "band_high")))
    return forecasts.join(named, ["instrument_id", "horizon"], "left").withColumn("implied_status", F.coalesce("implied_status", F.lit(missing)))


def rate_on(macro: DataFrame, session: Column, series: str = "yield_3m") -> DataFrame:
    """rate: the series' last value up to the session, as a fraction."""
    return macro.where((F.col("date") <= session) & F.col(series).isNotNull()).agg((F.max_by(series, "date") / 100).alias("rate"))
