"""Daily panels made from the trade tables: the inputs of the panel queries.

``prelude`` holds the same definitions in DuckDB's SQL, for the twins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import to_digits
from tidemark.session import stored

HORIZONS = (1, 5, 20, 60, 120)
#: A total order of the trades of a day.
TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_WRITTEN: ContextVar[dict[tuple, DataFrame] | None] = ContextVar("written", default=None)


@contextmanager
def written_once() -> Iterator[None]:
    """Inside, tables made from trades and orders are written when first asked for and read back after: each base table is read once, however often a flow asks."""
    if _WRITTEN.get() is not None:
        yield
        return
    mark = _WRITTEN.set({})
    try:
        yield
    finally:
        _WRITTEN.reset(mark)


def once(name: str, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written once for each key inside ``written_once``; outside of it just that."""
    found = _WRITTEN.get()
    if found is None:
        return make()
    if (name, *key) not in found:
        found[(name, *key)] = stored(make(), name)
    return found[(name, *key)]


def identifier(key: Column) -> Column:
    """CZ and five digits."""
    return F.concat(F.lit("CZ"), F.lpad((key + 1).cast("string"), 5, "0"))


def trades(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Trades with the instrument they belong to: a region, or a nation with its region as the sector."""
    lines = read(spark, sf_dir, "lineitem").select(*TRADE_ORDER, "l_returnflag", F.to_date("l_shipdate").alias("date"))
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    places = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = "n_regionkey" if level == "region" else "n_nationkey"
    places = places.select("n_nationkey", identifier(F.col(key)).alias("instrument_id"), F.col("r_name").alias("sector"))
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))


def trade_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each nation and day with a trade, which bars and actions of nations and regions are put together from in one reading of the trades.

    first and last are the day's trades by their total order; dividend and split_ratio are null on a day without an action.
    Structs are aggregated by sorting, and only a single number is sorted by radix, so a nation and day are one: ``cell``.
    """

    def make() -> DataFrame:
        order = F.struct(*TRADE_ORDER)
        price = F.col("l_extendedprice") / F.col("l_quantity")
        pays = (F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 50 == 0)
        splits = F.col("l_orderkey") % 997 == 0
        lines = read(spark, sf_dir, "lineitem").select(*TRADE_ORDER, "l_returnflag", F.to_date("l_shipdate").alias("date"))
        supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        # Days and nations are 32 bits each; no ship date lies on the day that stands for none, three million years back.
        day = F.coalesce(F.unix_date("date"), F.lit(-(1 << 30))).cast("long")
        days = (
            lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy((F.shiftleft(day, 32) + F.col("s_nationkey").cast("int")).alias("cell"))
            .agg(
                F.min("s_nationkey").alias("s_nationkey"),
                F.min("date").alias("date"),
                F.min(order).alias("first"),
                F.max(order).alias("last"),
                F.max(price).alias("high"),
                F.min(price).alias("low"),
                F.sum("l_quantity").alias("volume"),
                F.count_if(pays | splits).alias("acts"),
                F.sum(F.when(pays, 0.01 * price).when(splits, 0.0)).alias("dividend"),
                F.product(F.when(splits, 2.0).when(pays, 1.0)).alias("split_ratio"),
            )
        )
        places = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        places = places.select("n_nationkey", identifier(F.col("n_nationkey")).alias("nation"), identifier(F.col("n_regionkey")).alias("region"), F.col("r_name").alias("sector"))
        return days.join(places, F.col("s_nationkey") == F.col("n_nationkey")).drop("cell", "s_nationkey", "n_nationkey")

    return once("trade_days", (sf_dir,), make)


def panel(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """instrument_id, date, open, high, low, close, volume, sector: one bar a day, opened and closed in trade order."""
    price = lambda trade: F.col(f"{trade}.l_extendedprice") / F.col(f"{trade}.l_quantity")

    def make() -> DataFrame:
        rows = trade_days(spark, sf_dir).groupBy(F.col(level).alias("instrument_id"), "date")
        days = rows.agg(*(F.min(c).alias(c) for c in ("first", "low", "sector")), *(F.max(c).alias(c) for c in ("last", "high")), F.sum("volume").alias("volume"))
        return days.select("instrument_id", "date", price("first").alias("open"), "high", "low", price("last").alias("close"), "volume", "sector")

    return once("panel", (sf_dir, level), make)


def actions(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """instrument_id, date, dividend, split_ratio: some returned trades pay, a few orders split two for one."""

    def make() -> DataFrame:
        rows = trade_days(spark, sf_dir).where("acts > 0")
        return rows.groupBy(F.col(level).alias("instrument_id"), "date").agg(F.sum("dividend").alias("dividend"), F.product("split_ratio").alias("split_ratio"))

    return once("actions", (sf_dir, level), make)


MACRO_SERIES = {"yield_10y": "1", "yield_2y": "2", "yield_3m": "3", "dollar_index": "4"}


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, vix and four sparser series."""

    def make() -> DataFrame:
        orders = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), "o_totalprice", "o_orderpriority")
        some = [F.avg(F.when(F.col("o_orderpriority").startswith(p), F.col("o_totalprice"))).alias(name) for name, p in MACRO_SERIES.items()]
        return orders.groupBy("date").agg(F.avg("o_totalprice").alias("vix"), *some)

    return once("macro", (sf_dir,), make)


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each nation: instrument_id, ticker, asset_class, sector, segment, valid_from, valid_to."""
    places = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    return places.select(
        identifier(key).alias("instrument_id"),
        F.col("n_name").alias("ticker"),
        F.when(key % 5 == 0, "etf").otherwise("equity").alias("asset_class"),
        F.col("r_name").alias("sector"),
        F.when(key % 4 == 0, "cross").otherwise("main").alias("segment"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key * 7).cast("int")).alias("valid_from"),
        F.when(key % 6 == 0, F.lit("2001-01-01").cast("date")).alias("valid_to"),
    )


def sessions(panel: DataFrame) -> DataFrame:
    """date and its dense index: one row a day, so one task is enough."""
    return panel.select("date").distinct().withColumn("idx", F.row_number().over(Window.orderBy("date")))


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly bars of their value by type."""
    order = F.struct("ts", "event_id")
    return (
        read(spark, sf_dir, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count(F.lit(1)).alias("volume"))
    )


_PANEL = """
    trades_{level} AS (
        SELECT 'CZ' || lpad(({key} + 1)::VARCHAR, 5, '0') AS instrument_id, r_name AS sector, l_shipdate::DATE AS date,
               l_extendedprice / l_quantity AS price, lineitem.*
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    panel_{level} AS (
        SELECT instrument_id, date,
               first(price ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS open,
               max(price) AS high, min(price) AS low,
               last(price ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS close,
               sum(l_quantity) AS volume, min(sector) AS sector
        FROM trades_{level} GROUP BY 1, 2),
    actions_{level} AS (
        SELECT instrument_id, date,
               sum(CASE WHEN l_returnflag = 'R' AND l_orderkey % 50 = 0 THEN 0.01 * price ELSE 0.0 END) AS dividend,
               product(CASE WHEN l_orderkey % 997 = 0 THEN 2.0 ELSE 1.0 END) AS split_ratio
        FROM trades_{level} WHERE l_returnflag = 'R' AND l_orderkey % 50 = 0 OR l_orderkey % 997 = 0 GROUP BY 1, 2)"""

_MACRO = """
    macro AS (
        SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS vix,
               avg(o_totalprice) FILTER (o_orderpriority LIKE '1%') AS yield_10y,
               avg(o_totalprice) FILTER (o_orderpriority LIKE '2%') AS yield_2y,
               avg(o_totalprice) FILTER (o_orderpriority LIKE '3%') AS yield_3m,
               avg(o_totalprice) FILTER (o_orderpriority LIKE '4%') AS dollar_index
        FROM orders GROUP BY 1)"""

_UNIVERSE = """
    universe AS (
        SELECT 'CZ' || lpad((n_nationkey + 1)::VARCHAR, 5, '0') AS instrument_id, n_name AS ticker,
               CASE WHEN n_nationkey % 5 = 0 THEN 'etf' ELSE 'equity' END AS asset_class, r_name AS sector,
               CASE WHEN n_nationkey % 4 = 0 THEN 'cross' ELSE 'main' END AS segment,
               (DATE '1995-01-01' + (n_nationkey * 7)::INTEGER)::DATE AS valid_from,
               CASE WHEN n_nationkey % 6 = 0 THEN DATE '2001-01-01' END AS valid_to
        FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def prelude(*parts: str) -> str:
    """Leading CTEs for a twin: any of region, nation, macro, universe, sessions (of the region panel)."""
    text = {
        "region": _PANEL.format(level="region", key="r_regionkey"),
        "nation": _PANEL.format(level="nation", key="n_nationkey"),
        "macro": _MACRO,
        "universe": _UNIVERSE,
        "sessions": "\n    sessions AS (SELECT date, row_number() OVER (ORDER BY date) AS idx FROM (SELECT DISTINCT date FROM panel_region))",
    }
    return "WITH RECURSIVE" + ",".join(text[p] for p in parts)


def thinned(panel: DataFrame, every: int = 97) -> DataFrame:
    """The panel without every 97th bar of an instrument, so that some targets have no price."""
    n = F.row_number().over(Window.partitionBy("instrument_id").orderBy("date"))
    return panel.withColumn("__n", n).where(F.col("__n") % every != 0).drop("__n")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast package for every region, day and horizon, from past returns alone."""
    return once("forecasts", (sf_dir,), lambda: _forecasts(spark, sf_dir))


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = Window.partitionBy("instrument_id").orderBy("date")
    back = lambda n: over.rowsBetween(1 - n, 0)
    bars = panel(spark, sf_dir)
    rows = bars.select("instrument_id", F.col("date").alias("session"), "date", "close", F.row_number().over(over).alias("n"), (F.ln("close") - F.lag(F.ln("close")).over(over)).alias("ret"))
    up = (F.col("ret") > 0).cast("int")
    rows = rows.withColumns(
        {
            "vol_20": F.when(F.count("ret").over(back(20)) == 20, F.stddev_samp("ret").over(back(20)) * F.sqrt(F.lit(252.0))),
            "up_20": F.when(F.count("ret").over(back(20)) == 20, F.avg(up).over(back(20))),
            "mean_60": F.when(F.count("ret").over(back(60)) >= 20, F.avg("ret").over(back(60))),
            "rate": F.avg(up).over(over.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    days = sessions(bars)
    at = days.select(F.col("date").alias("session"), "idx")
    target = days.select(F.col("idx").alias("__to"), F.col("date").alias("target_session"))
    rows = rows.where("n >= 21").withColumn("horizon", F.explode(F.array(*map(F.lit, HORIZONS)))).join(at, "session")
    rows = rows.withColumn("__to", F.col("idx") + F.col("horizon")).join(target, "__to", "left")
    clip = lambda x: to_digits(F.least(F.greatest(x, F.lit(0.01)), F.lit(0.99)), 6)
    scale = F.greatest(F.sqrt(F.col("horizon") / F.lit(252.0)) * F.col("vol_20"), F.lit(1e-4))
    rows = rows.withColumns({"expected_return": F.col("mean_60") * F.col("horizon"), "scale": scale})
    return rows.select(
        F.concat_ws("|", "instrument_id", F.col("session").cast("string"), F.col("horizon").cast("string")).alias("forecast_id"),
        "instrument_id",
        "session",
        "horizon",
        "target_session",
        "close",
        "expected_return",
        "scale",
        "vol_20",
        clip(0.5 + 0.6 * (F.col("up_20") - 0.5)).alias("prob_up"),
        clip(F.col("rate")).alias("baseline_prob"),
        (F.col("expected_return") - 1.645 * F.col("scale")).alias("band_low"),
        (F.col("expected_return") + 1.645 * F.col("scale")).alias("band_high"),
        F.when(F.col("n") % 7 != 0, F.element_at(F.array(F.lit("calm"), F.lit("normal"), F.lit("stressed")), (F.col("n") % 3 + 1).cast("int"))).alias("regime"),
        (F.col("n") % 50 == 0).alias("withheld"),
        F.when(F.col("n") % 11 == 0, "failed").otherwise("ok").alias("shock_status"),
        F.when(F.col("n") % 13 == 0, "move").otherwise("").alias("shock_signals"),
        F.when(F.col("idx") % 17 == 0, "vix").otherwise("").alias("shock_market"),
        (F.col("session").cast("timestamp") + F.expr("INTERVAL 22 HOURS")).alias("made_at"),
    )


#: The same in DuckDB, after the CTEs region and sessions: forecasts, thin_tr (total return of the thinned panel), outcomes.
FORECASTS = """,
    fbase AS (
        SELECT instrument_id, date AS session, close, row_number() OVER w AS n, ln(close) - lag(ln(close)) OVER w AS ret
        FROM panel_region WINDOW w AS (PARTITION BY instrument_id ORDER BY date)),
    fstat AS (
        SELECT *, CASE WHEN count(ret) OVER a = 20 THEN stddev_samp(ret) OVER a * sqrt(252.0) END AS vol_20,
               CASE WHEN count(ret) OVER a = 20 THEN avg((ret > 0)::INT) OVER a END AS up_20,
               CASE WHEN count(ret) OVER b >= 20 THEN avg(ret) OVER b END AS mean_60, avg((ret > 0)::INT) OVER c AS rate
        FROM fbase WINDOW a AS (PARTITION BY instrument_id ORDER BY session ROWS 19 PRECEDING),
            b AS (PARTITION BY instrument_id ORDER BY session ROWS 59 PRECEDING), c AS (PARTITION BY instrument_id ORDER BY session ROWS UNBOUNDED PRECEDING)),
    fh AS (SELECT *, unnest([1, 5, 20, 60, 120]) AS horizon FROM fstat WHERE n >= 21),
    forecasts AS MATERIALIZED (
        SELECT instrument_id || '|' || session || '|' || horizon AS forecast_id, instrument_id, session, horizon, t.date AS target_session, close,
               mean_60 * horizon AS expected_return, greatest(sqrt(horizon / 252.0) * vol_20, 1e-4) AS scale, vol_20,
               round(least(greatest(0.5 + 0.6 * (up_20 - 0.5), 0.01), 0.99), 6) AS prob_up, round(least(greatest(rate, 0.01), 0.99), 6) AS baseline_prob,
               mean_60 * horizon - 1.645 * greatest(sqrt(horizon / 252.0) * vol_20, 1e-4) AS band_low,
               mean_60 * horizon + 1.645 * greatest(sqrt(horizon / 252.0) * vol_20, 1e-4) AS band_high,
               CASE WHEN n % 7 <> 0 THEN ['calm', 'normal', 'stressed'][n % 3 + 1] END AS regime, n % 50 = 0 AS withheld,
               CASE WHEN n % 11 = 0 THEN 'failed' ELSE 'ok' END AS shock_status, CASE WHEN n % 13 = 0 THEN 'move' ELSE '' END AS shock_signals,
               CASE WHEN s.idx % 17 = 0 THEN 'vix' ELSE '' END AS shock_market, session + INTERVAL 22 HOUR AS made_at
        FROM fh JOIN sessions s ON s.date = session LEFT JOIN sessions t ON t.idx = s.idx + horizon)"""
OUTCOMES = (
    FORECASTS
    + """,
    thin AS (SELECT * FROM panel_region QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY date) % 97 <> 0),
    thin_tr AS MATERIALIZED (
        SELECT *, exp(sum(ln(g)) OVER (PARTITION BY instrument_id ORDER BY date ROWS UNBOUNDED PRECEDING)) AS tr FROM (
            SELECT p.*, coalesce((p.close + coalesce(a.dividend, 0)) / lag(p.close) OVER (PARTITION BY p.instrument_id ORDER BY p.date), 1.0) AS g
            FROM thin p LEFT JOIN actions_region a USING (instrument_id, date))),
    ended AS (
        SELECT f.*, s.tr AS start_tr, e.tr AS end_tr, e.date AS end_date
        FROM forecasts f JOIN thin_tr s ON s.instrument_id = f.instrument_id AND s.date = f.session
        ASOF JOIN thin_tr e ON e.instrument_id = f.instrument_id AND f.target_session >= e.date
        WHERE f.target_session IS NOT NULL),
    outcomes AS MATERIALIZED (
        SELECT * EXCLUDE (start_tr, end_tr, end_date), y AS actual_return, ((prob_up > 0.5) = (y > 0))::INT::DOUBLE AS hit, ((baseline_prob > 0.5) = (y > 0))::INT::DOUBLE AS baseline_hit,
               power(prob_up - (y > 0)::INT, 2) AS brier, power(baseline_prob - (y > 0)::INT, 2) AS baseline_brier,
               (band_low <= y AND y <= band_high)::INT::DOUBLE AS covered, CASE WHEN end_date = target_session THEN 'normal' ELSE 'delisted_or_halted' END AS resolution_type
        FROM (SELECT *, ln(end_tr / start_tr) AS y FROM ended WHERE end_date > session))"""
)
