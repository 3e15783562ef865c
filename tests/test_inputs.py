"""Calendars, feeds, merges, tables and streams."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from dateutil.easter import easter
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import calendars, quality, scalar
from tidemark.operators import record, shocks, upsert
from tidemark.sources import feeds, sinks, tables
from tidemark.streaming import bars as streams

DAY = date(2024, 1, 1)


def test_easter(spark):
    got = spark.range(1990, 2060).select("id", calendars.easter(F.col("id")).alias("e")).collect()
    assert all(r.e == easter(r.id) for r in got)


def test_exchange_holidays(spark):
    days = {r.date: r.close_at for r in calendars.sessions(spark, "XNYS", "2021-01-01", "2024-12-31").collect()}
    shut = [date(2024, 1, 1), date(2024, 1, 15), date(2024, 2, 19), date(2024, 3, 29), date(2024, 5, 27), date(2024, 6, 19), date(2024, 7, 4), date(2024, 9, 2), date(2024, 11, 28), date(2024, 12, 25), date(2021, 12, 24), date(2023, 1, 2), date(2022, 12, 26)]
    assert not set(shut) & set(days)
    # New Year's Day 2022 fell on a Saturday: the Friday before was a session. Juneteenth 2021 wasn't kept yet.
    assert date(2021, 12, 31) in days and date(2021, 6, 18) in days
    assert len([d for d in days if d.year == 2024]) == 252
    assert days[date(2024, 7, 3)] == datetime(2024, 7, 3, 17, 0) and days[date(2024, 11, 29)] == datetime(2024, 11, 29, 18, 0)
    assert days[date(2024, 7, 5)] == datetime(2024, 7, 5, 20, 0) and days[date(2024, 1, 5)] == datetime(2024, 1, 5, 21, 0)


def test_sessions_and_targets(spark):
    cal = calendars.sessions(spark, "TARGET", "2024-03-25", "2024-04-05")
    assert [r.date.day for r in cal.orderBy("date").collect()] == [25, 26, 27, 28, 2, 3, 4, 5]
    rows = spark.createDataFrame([(date(2024, 3, 28), 1), (date(2024, 3, 28), 4), (date(2024, 3, 28), 5), (date(2024, 3, 29), 1)], "session date, horizon int")
    got = {(r.session.day, r.horizon): r.target_session for r in calendars.with_target(rows, cal).collect()}
    assert got == {(28, 1): date(2024, 4, 2), (28, 4): date(2024, 4, 5), (28, 5): None, (29, 1): None}
    asked = spark.createDataFrame([(1, datetime(2024, 3, 28, 13, 10)), (2, datetime(2024, 3, 28, 13, 11)), (3, datetime(2024, 3, 31, 0, 0))], "id int, created_at timestamp")
    found = {r.id: r.start_session for r in calendars.start_session(asked, cal).collect()}
    assert found == {1: date(2024, 3, 28), 2: date(2024, 4, 2), 3: date(2024, 4, 2)}


KEYS = st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 6)), max_size=8, unique=True)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=KEYS, new=KEYS, replaced=st.sets(st.sampled_from("ABC"), max_size=2))
def test_upsert(spark, old, new, replaced):
    schema = "instrument_id string, date date, close double"
    rows = lambda keys, v: spark.createDataFrame([(i, DAY + timedelta(d), v) for i, d in keys], schema)
    drop = spark.createDataFrame([(r,) for r in sorted(replaced)], "instrument_id string")
    got = {(r.instrument_id, (r.date - DAY).days): r.close for r in upsert.upsert(rows(old, 1.0), rows(new, 2.0), drop).collect()}
    assert got == {k: 1.0 for k in old if k[0] not in replaced} | dict.fromkeys(new, 2.0)


def test_as_of_with_ties_and_missing_values(spark):
    right = spark.createDataFrame([("A", DAY, 1.0), ("A", DAY + timedelta(2), None), ("A", DAY + timedelta(4), 3.0), ("B", DAY, 9.0)], "k string, date date, v double")
    left = spark.createDataFrame([("A", DAY - timedelta(1)), ("A", DAY), ("A", DAY + timedelta(1)), ("A", DAY + timedelta(3)), ("A", DAY + timedelta(9)), ("C", DAY)], "k string, date date")
    got = {(r.k, (r.date - DAY).days): r.v for r in shocks.as_of(left, right, ["v"], by=["k"]).collect()}
    assert got == {("A", -1): None, ("A", 0): 1.0, ("A", 1): 1.0, ("A", 3): None, ("A", 9): 3.0, ("C", 0): None}
    plain = {(r.date - DAY).days: r.v for r in shocks.as_of(left.where("k = 'A'").select("date"), right.where("k = 'A'").drop("k"), ["v"]).collect()}
    assert plain == {-1: None, 0: 1.0, 1: 1.0, 3: None, 9: 3.0}


def test_feeds(spark):
    payload = '[{"date":"2024-01-02T00:00:00Z","open":1,"high":2,"low":0.5,"close":1.5,"adjClose":1.4,"volume":10,"divCash":0.1,"splitFactor":1.0},{"date":"2024-01-03","close":2,"splitFactor":2.0}]'
    got = feeds.json_prices(spark.createDataFrame([("A", payload)], "ticker string, payload string")).orderBy("date").collect()
    assert [(r.date.day, r.close, r.dividend, r.split_ratio) for r in got] == [(2, 1.5, 0.1, 0.0), (3, 2.0, 0.0, 2.0)]
    status = spark.createDataFrame([(c,) for c in (200, 401, 404, 429, 503)], "c int").select(feeds.fetch_status(F.col("c")).alias("s"))
    assert [r.s for r in status.collect()] == ["ok", "blocked", "empty", "unavailable", "unavailable"]
    item = "<item><title>{t}</title><link>{l}</link><pubDate>{d}</pubDate></item>"
    good = "<rss><channel>" + item.format(t="Rates held", l="https://www.ecb.example/a", d="Tue, 02 Jan 2024 13:45:00 GMT") + item.format(t="x", l="http://www.ecb.example/a", d="Tue, 02 Jan 2024 13:45:00 GMT") + item.format(t="y", l="https://evil.example/a", d="Tue, 02 Jan 2024 13:45:00 GMT") + item.format(t="z", l="https://www.ecb.example/b", d="soon") + "</channel></rss>"
    bad = '<!DOCTYPE rss [<!ENTITY a "b">]>' + good
    rows = feeds.feed_items(spark.createDataFrame([(good,), (bad,)], "payload string"), "ecb", "www.ecb.example").collect()
    assert [(r.title, r.published) for r in rows] == [("Rates held", datetime(2024, 1, 2, 13, 45))]


def test_implied_probability_of_a_synthetic_chain(spark):
    from math import exp, log, sqrt
    from statistics import NormalDist

    n, spot, vol, rate, years = NormalDist().cdf, 100.0, 0.25, 0.03, 0.25

    def call(k):
        d1 = (log(spot / k) + (rate + vol * vol / 2) * years) / (vol * sqrt(years))
        return spot * n(d1) - k * exp(-rate * years) * n(d1 - vol * sqrt(years))

    rows = [("A", 20, spot, rate, years, k, call(k) * 0.99, call(k) * 1.01, vol, 500) for k in (90.0, 95.0, 99.0, 101.0, 105.0)]
    rows += [("B", 20, spot, rate, years, k, call(k) * 0.5, call(k) * 1.5, vol, 500) for k in (99.0, 101.0)]
    rows += [("C", 20, spot, rate, years, 99.0, 1.0, 1.1, vol, 500)]
    chains = spark.createDataFrame(rows, "instrument_id string, horizon int, spot double, rate double, years double, strike double, bid double, ask double, iv double, open_interest long")
    got = {r.instrument_id: r for r in feeds.implied_table(chains).collect()}
    assert (got["A"].status, got["B"].status, got["C"].status) == ("ok", "illiquid", "no_chain")
    d2 = (rate - vol * vol / 2) * years / (vol * sqrt(years))
    assert got["A"].prob_up == pytest.approx(n(d2), abs=0.01) and got["A"].iv == pytest.approx(vol)
    assert got["A"].band_low < 0 < got["A"].band_high and got["B"].prob_up is None


def test_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("A", date(2023, 12, 29), 1.0), ("A", date(2024, 1, 2), 2.0)], "instrument_id string, date date, close double")
    full = rows.select("instrument_id", "date", *(F.lit(1.0).alias(c) for c in ("open", "high", "low")), "close", F.lit(1.0).alias("adj_close"), F.lit(1.0).alias("volume"), F.lit("s").alias("source"), F.current_timestamp().alias("fetched_at"), F.lit("ok").alias("quality"))
    root = str(tmp_path / "prices")
    assert tables.read_years(spark, root).count() == 0 and tables.try_read(spark, root) is None
    sinks.write_years(full, root)
    sinks.write_years(full.where("year(date) = 2024").withColumn("close", F.lit(5.0)), root)
    assert tables.stored_years(spark, root) == [2023, 2024]
    assert sorted(r.close for r in tables.read_years(spark, root).collect()) == [1.0, 5.0]
    assert tables.read_years(spark, root, [2023]).count() == 1
    path = str(tmp_path / "package")
    assert sinks.save_package(rows, path) == "saved" and sinks.save_package(rows, path) == "already_saved"
    with pytest.raises(ValueError, match="missing"):
        tables.conform(rows, "s")
    (tmp_path / "u.csv").write_text("instrument_id,ticker,name,asset_class,sector,exchange_calendar,valid_from,valid_to,segment,source_symbol\nCZ00001,AAA,Name,,,XNYS,2020-01-01,,main,AAA\n")
    r = tables.read_universe(spark, str(tmp_path / "u.csv"), {"asset_class": "crypto"}).first()
    assert (r.asset_class, r.sector, r.valid_from, r.valid_to) == ("crypto", "", date(2020, 1, 1), None)
    (tmp_path / "m.json").write_text('{"session": "2024-01-02", "horizons": [5, 20], "sha256": "x"}')
    assert tables.read_manifests(spark, str(tmp_path / "*.json")).first().horizons == [5, 20]


def test_outcomes_are_patched_once(spark):
    entries = spark.createDataFrame([(1, None, None), (2, "kept", DAY), (3, None, None)], "id long, outcome string, resolved_at date")
    fresh = lambda name: spark.createDataFrame([(1, name, DAY), (2, name, DAY)], "id long, outcome string, resolved_at date")
    once = sinks.patched(entries, fresh("new"))
    assert sorted(map(tuple, sinks.patched(once, fresh("newer")).collect())) == [(1, "new", DAY), (2, "kept", DAY), (3, None, None)]


def test_implied_statuses_keep_their_order(spark):
    rows = [(n, 20, spot, rate, DAY, DAY if n != "C" else DAY - timedelta(1), k, 1.0, 1.1, 0.2, 500) for n, spot, rate in (("A", None, 0.02), ("B", 100.0, None), ("C", 100.0, 0.02)) for k in (95.0, 105.0)]
    table = spark.createDataFrame(rows, "instrument_id string, horizon int, spot double, rate double, session date, chain_session date, strike double, bid double, ask double, iv double, open_interest long").withColumn("years", F.lit(0.1))
    assert {r.instrument_id: r.status for r in feeds.implied_table(table).collect()} == {"A": "no_spot", "B": "no_rate", "C": "stale_session"}


def test_package_hash_ignores_order_and_sees_change(spark):
    rows = spark.createDataFrame([(f"f{i}", DAY, 0.1 * i) for i in range(50)], "forecast_id string, session date, p double")
    one, two = (record.content_hash(r, ["forecast_id"]).first().sha256 for r in (rows, rows.repartition(7).orderBy(F.rand())))
    assert one == two != record.content_hash(rows.withColumn("p", F.when(F.col("forecast_id") == "f3", 9.0).otherwise(F.col("p"))), ["forecast_id"]).first().sha256


def test_quality_and_text(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5, 10.0), (None, 2.0, 0.5, 1.5, None), (1.0, 2.0, 1.2, 1.5, 10.0), (1.0, 1.4, 0.5, 1.5, 1.0), (1.0, 2.0, 0.5, -1.0, 1.0), (1.0, 2.0, 0.5, 1.5, -1.0)], "open double, high double, low double, close double, volume double")
    assert [r.q for r in rows.select(quality.quality().alias("q")).collect()] == ["ok", "ok", "suspect", "suspect", "suspect", "suspect"]
    one = spark.range(1).select(scalar.rule_name(F.lit("hammer|at_level")).alias("a"), scalar.rule_variant(F.lit("hammer|at_level")).alias("b"), scalar.rule_variant(F.lit("hammer")).alias("c"), scalar.display_ticker(F.lit("UNI7083-USD")).alias("d"), scalar.combo_parts(F.lit("hammer+trend+htf"))[1].alias("e"), scalar.listed_symbols(F.lit("`BTC` and `ETH`")).alias("f")).first()
    assert tuple(one) == ("hammer", "at_level", None, "UNI", ["trend", "htf"], ["BTC", "ETH"])


def test_streaming_bars_equal_batch(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i * 7), i % 3, "ab"[i % 2], float(i % 11), "{}") for i in range(200)]
    table = spark.createDataFrame(rows, streams.EVENTS)
    for k in range(4):
        table.where(F.col("event_id").between(50 * k, 50 * k + 49)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = streams.bars(streams.event_stream(spark, str(tmp_path / "in"))).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.event_type, r.start): (r.open, r.high, r.low, r.close, r.volume) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {}
    for _, t, _, kind, v, _ in rows:
        o, h, low, _, n = want.get((kind, t.replace(minute=0)), (v, v, v, v, 0))
        want[(kind, t.replace(minute=0))] = (o, max(h, v), min(low, v), v, n + 1)
    assert got and all(want[k] == v for k, v in got.items()) and len(got) > 30


def test_split_factor_and_screens(spark):
    acts = spark.createDataFrame([("A", DAY, 2.0), ("A", DAY + timedelta(5), 3.0), ("A", DAY + timedelta(9), 1.0)], "instrument_id string, date date, split_ratio double")
    lots = spark.createDataFrame([("A", DAY, DAY + timedelta(9)), ("A", DAY - timedelta(1), DAY + timedelta(4)), ("B", DAY, DAY)], "instrument_id string, entered date, until date")
    got = sorted(r.factor for r in upsert.split_factor(lots, acts).collect())
    assert got == [1.0, 2.0, 3.0]
    assert pd.Series(scalar.FORECASTS.hex).str.len().iloc[0] == 32
