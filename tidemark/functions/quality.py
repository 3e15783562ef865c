"""Row quality, canonical rows, filters over validity and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 1e-9
KEYS = ["instrument_id", "date"]


def _true(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def quality() -> Column:
    """ok or suspect, from open, high, low, close and volume. A comparison with a missing value finds no fault."""
    low, high = F.least("open", "close"), F.greatest("open", "close")
    both = F.col("open").isNotNull() & F.col("close").isNotNull()
    faults = [F.col("close") <= 0, both & (F.col("low") > low + TOLERANCE), both & (F.col("high") < high - TOLERANCE), F.col("low") > F.col("high"), F.col("volume") < 0]
    bad = F.lit(False)
    for f in faults:
        bad = bad | _true(f)
    return F.when(bad, "suspect").otherwise("ok")


def hard_faults(rows: DataFrame, last: Column) -> DataFrame:
    """Keys that occur twice or lie after the last session: fault, instrument_id, date, rows."""
    twice = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").withColumn("fault", F.lit("duplicate"))
    ahead = rows.where(F.col("date") > last).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows")).withColumn("fault", F.lit("future"))
    return twice.unionByName(ahead).select("fault", *KEYS, "rows")


def require_sound(rows: DataFrame, last: Column) -> DataFrame:
    """``rows``, or an error that names a fault."""
    bad = hard_faults(rows, last).first()
    if bad is not None:
        raise ValueError(f"{bad['fault']} rows for {bad['instrument_id']} on {bad['date']}")
    return rows


def on_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows on session days."""
    return rows.join(sessions.select("date"), "date", "left_semi")


def off_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows that ``on_sessions`` drops."""
    return rows.join(sessions.select("date"), "date", "left_anti")


def closed(rows: DataFrame, last: Column) -> DataFrame:
    return rows.where(F.col("date") <= last)


def keep_first(rows: DataFrame, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """One row for each key, the first in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*(keys or KEYS)).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def canonical(raw: DataFrame, ids: DataFrame, sessions: DataFrame, last: Column, fetched_at: Column, order: list[Column]) -> DataFrame:
    """Provider rows (ticker, date, bars) as canonical prices: known ids, closed sessions, one row a key, with quality."""
    mapped = raw.join(ids.select("ticker", "instrument_id"), "ticker")
    kept = keep_first(on_sessions(closed(mapped, last), sessions), order)
    return kept.withColumns({"fetched_at": fetched_at, "quality": quality()}).drop("ticker")


def canonical_actions(raw: DataFrame, ids: DataFrame, fetched_at: Column) -> DataFrame:
    """Provider actions with known ids; missing amounts are 0."""
    amount = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    return raw.join(ids.select("ticker", "instrument_id"), "ticker").select("instrument_id", "date", amount("dividend").alias("dividend"), amount("split_ratio").alias("split_ratio"), fetched_at.alias("fetched_at"))


def newly_split(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Instruments with a split that the stored actions lack: their whole history is to be replaced."""
    splits = lambda t: t.where((F.col("split_ratio") != 0) & (F.col("split_ratio") != 1)).select(*KEYS)
    return splits(fresh).join(splits(stored), KEYS, "left_anti").select("instrument_id").distinct()


def active_on(universe: DataFrame, day: Column) -> DataFrame:
    return universe.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") >= day)))


def universe_faults(universe: DataFrame, classes: list[str], segments: list[str]) -> DataFrame:
    """fault, what: ids off the pattern or repeated, tickers active twice, unknown classes and segments."""
    rows = lambda t, fault, what: t.select(F.lit(fault).alias("fault"), F.col(what).alias("what"))
    repeated = lambda t, c: t.groupBy(c).count().where("count > 1")
    parts = [
        rows(universe.where(~F.col("instrument_id").rlike(r"^CZ\d{5}$")), "id", "instrument_id"),
        rows(repeated(universe, "instrument_id"), "repeated id", "instrument_id"),
        rows(repeated(universe.where("valid_to is null"), "ticker"), "repeated ticker", "ticker"),
        rows(universe.where(~F.col("asset_class").isin(classes)), "class", "asset_class"),
        rows(universe.where(~F.col("segment").isin(segments)), "segment", "segment"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def coverage(rows: DataFrame) -> DataFrame:
    """date, instruments: how many have a row."""
    return rows.groupBy("date").agg(F.count_distinct("instrument_id").alias("instruments"))


def chosen_session(rows: DataFrame, expected: Column, universe_size: int, share: float = 0.8) -> DataFrame:
    """The newest day up to ``expected`` with enough of the universe: session, instruments."""
    enough = coverage(rows).where((F.col("date") <= expected) & (F.col("instruments") >= share * universe_size))
    return enough.agg(F.max("date").alias("session"), F.max_by("instruments", "date").alias("instruments"))


def timely(made_at: Column, deadline: Column) -> Column:
    return F.when(made_at < deadline, "in_time").otherwise("too_late")


def partial(instruments: Column, universe_size: Column, share: float = 0.8) -> Column:
    return instruments < share * universe_size


def missing_days(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """instrument_id, date of every calendar day from an instrument's first to the table's last day that it lacks."""
    spans = rows.groupBy("instrument_id").agg(F.min("date").alias("low"))
    last = rows.agg(F.max("date").alias("high"))
    wanted = spans.join(calendar.select("date"), F.col("date") >= F.col("low")).crossJoin(F.broadcast(last)).where("date <= high")
    return wanted.select(*KEYS).join(rows.select(*KEYS), KEYS, "left_anti")


def missing_counts(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    return missing_days(rows, calendar).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("missing"), F.min("date").alias("first"), F.max("date").alias("last"))


def delisted(rows: DataFrame, sessions: DataFrame, gap: int) -> DataFrame:
    """instrument_id, last: instruments without a row on any of the last ``gap`` + 1 sessions."""
    edge = sessions.orderBy(F.col("date").desc()).limit(gap + 1).agg(F.min("date").alias("edge"))
    return rows.groupBy("instrument_id").agg(F.max("date").alias("last")).crossJoin(F.broadcast(edge)).where("last < edge").drop("edge")


def tracked_signals(signals: Column, tracked: list[str]) -> Column:
    """A comma list without what isn't tracked."""
    return F.array_join(F.filter(F.split(signals, ","), lambda s: s.isin(tracked)), ",")


def in_scope(table: DataFrame, scope: str) -> DataFrame:
    """Rows of a scope; a table without the column has one scope only."""
    return table.where(F.col("scope") == scope) if "scope" in table.columns else table


def by_segment(rows: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Main rows and cross rows."""
    named = rows.join(universe.select("instrument_id", "segment"), "instrument_id", "left")
    return named.where(~F.coalesce(F.col("segment") == "cross", F.lit(False))).drop("segment"), named.where(F.col("segment") == "cross").drop("segment")


def is_trigger(rule: Column) -> Column:
    """Rules that may start a combination: all shoulders, retracements on wicks, and other rules without a variant."""
    return F.when(rule.startswith("hs_"), True).when(rule.startswith("fib_"), rule.endswith("|wick")).otherwise(~rule.contains("|"))


def history_continuous(rows: DataFrame, as_of: Column, least_days: int = 730, most_missing: int = 3) -> DataFrame:
    """instrument_id, days, longest_gap, ok: enough days up to ``as_of``, and no long run of missing ones."""
    before = rows.where(F.col("date") <= as_of)
    step = F.datediff("date", F.lag("date").over(Window.partitionBy("instrument_id").orderBy("date"))) - 1
    stats = before.withColumn("gap", step).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.max("gap"), F.lit(0)).cast("long").alias("longest_gap"))
    return stats.withColumn("ok", (F.col("days") >= least_days) & (F.col("longest_gap") <= most_missing))


def missing_runs(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """instrument_id, first, last, days of each run of missing calendar days: islands of date minus rank."""
    gone = missing_days(rows, calendar)
    island = F.date_sub("date", F.row_number().over(Window.partitionBy("instrument_id").orderBy("date")))
    return gone.withColumn("island", island).groupBy("instrument_id", "island").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("days")).drop("island")


def liquid(rows: DataFrame, least_days: int, least_dollars: float, last_n: int = 60) -> DataFrame:
    """instrument_id, days, median_dollars, ok: eligibility by history and by the median traded value of the last days."""
    recent = F.row_number().over(Window.partitionBy("instrument_id").orderBy(F.col("date").desc()))
    valued = rows.withColumns({"rank": recent, "dollars": F.col("close") * F.col("volume")})
    stats = valued.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("days"), F.percentile(F.when(F.col("rank") <= last_n, F.col("dollars")), F.lit(0.5)).alias("median_dollars"))
    return stats.withColumn("ok", (F.col("days") >= least_days) & (F.col("median_dollars") >= least_dollars))
