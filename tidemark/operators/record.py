"""The public record: exports, daily cells, worst forecasts, post-mortems, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import number

LEAST_RESOLVED, BAD_GAP = 30, 0.05
SECTOR_MISSES, SECTOR_EXCESS = 5, 0.10


def enriched(outcomes: DataFrame, forecasts: DataFrame, universe: DataFrame) -> DataFrame:
    """Outcomes with ticker and withheld; packages without the mark withheld nothing."""
    named = outcomes.join(universe.select("instrument_id", F.col("ticker").alias("__t")), "instrument_id", "left").withColumn("ticker", F.coalesce("__t", "instrument_id")).drop("__t")
    if "withheld" in named.columns:
        return named.withColumn("withheld", F.coalesce("withheld", F.lit(False)))
    marks = forecasts.groupBy("forecast_id").agg(F.bool_or("withheld").alias("withheld")) if "withheld" in forecasts.columns else None
    if marks is None:
        return named.withColumn("withheld", F.lit(False))
    return named.join(marks, "forecast_id", "left").withColumn("withheld", F.coalesce("withheld", F.lit(False)))


def heat_cells(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("horizon", "target_session").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").cast("long").alias("hits"), F.sum("baseline_hit").cast("long").alias("baseline_hits"))


def worst(outcomes: DataFrame, per_horizon: int = 200, tie: str = "instrument_id") -> DataFrame:
    """The largest Brier scores of each horizon; of equal ones the newer first."""
    order = Window.partitionBy("horizon").orderBy(F.col("brier").desc(), F.col("target_session").desc(), F.col("session").desc(), tie)
    return outcomes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_horizon)


def months_to_write(outcomes: DataFrame, existing: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """month, rows: months with a row resolved in the last days, or without a file."""
    by_month = outcomes.groupBy(F.date_format("target_session", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.max("resolved_at").alias("newest"))
    missing = by_month.join(existing.select("month", F.lit(True).alias("there")), "month", "left")
    return missing.where(F.col("there").isNull() | (F.col("newest") >= F.date_sub(now, days))).select("month", "rows")


def standout_sectors(rows: DataFrame) -> DataFrame:
    """target_session, horizon and the sector whose share of misses exceeds its share of all most, if by enough."""
    keys = ["target_session", "horizon"]
    named = rows.withColumn("sector", F.coalesce("sector", F.lit("—")))
    by_sector = named.groupBy(*keys, "sector").agg(F.count(F.lit(1)).alias("all_n"), F.count_if(F.col("hit") < 0.5).alias("misses"))
    day = Window.partitionBy(*keys)
    shares = by_sector.withColumns({"overall_share": F.col("all_n") / F.sum("all_n").over(day), "miss_share": F.try_divide(F.col("misses"), F.sum("misses").over(day))})
    excess = F.round(F.col("miss_share") - F.col("overall_share"), 6)
    kept = shares.withColumn("excess", excess).where((F.col("misses") >= SECTOR_MISSES) & (F.col("excess") >= SECTOR_EXCESS))
    best = F.row_number().over(day.orderBy(F.col("excess").desc(), F.col("misses").desc(), "sector"))
    return kept.withColumn("__r", best).where("__r = 1").select(*keys, "sector", "misses", F.round("miss_share", 4).alias("miss_share"), F.round("overall_share", 4).alias("overall_share"), F.round("excess", 4).alias("excess"))


def postmortems(outcomes: DataFrame, universe: DataFrame) -> DataFrame:
    """Facts of every day and horizon on which the model stood at least five points under its baseline."""
    keys = ["target_session", "horizon"]
    rows = outcomes.join(universe.select("instrument_id", "sector"), "instrument_id", "left")
    miss = F.col("hit") < 0.5
    stats = rows.groupBy(*keys).agg(
        F.min("session").alias("made_on"),
        F.count(F.lit(1)).alias("n"),
        F.sum("hit").cast("long").alias("hits"),
        F.sum("baseline_hit").cast("long").alias("baseline_hits"),
        F.count_if(miss).alias("misses"),
        F.count_if(miss & (F.col("prob_up") > 0.5)).alias("misses_expected_rise"),
        F.count_if(miss & (F.col("prob_up") <= 0.5)).alias("misses_expected_fall"),
        F.round(F.exp(F.percentile("actual_return", F.lit(0.5))) - 1, 6).alias("market_median_return"),
        F.count_if(F.col("actual_return") > 0).alias("market_rose"),
    )
    bad = stats.where((F.col("n") >= LEAST_RESOLVED) & (F.round((F.col("hits") - F.col("baseline_hits")) / F.col("n"), 9) <= -BAD_GAP))
    regimes = rows.where(miss).groupBy(*keys, F.coalesce("regime", F.lit("unknown")).alias("regime")).agg(F.count(F.lit(1)).alias("k"))
    modal = regimes.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("k").desc(), "regime"))).where("__r = 1").select(*keys, "regime", "k")
    found = bad.join(modal, keys, "left").withColumn("regime_share", F.round(F.col("k") / F.col("misses"), 4)).drop("k")
    sector = standout_sectors(rows.join(bad.select(*keys), keys, "left_semi"))
    return found.join(sector.select(*keys, F.col("sector").alias("sector"), F.col("excess").alias("sector_excess")), keys, "left")


def last_n(prices: DataFrame, n: int) -> DataFrame:
    """The last n days of each instrument."""
    rank = F.row_number().over(Window.partitionBy("instrument_id").orderBy(F.col("date").desc()))
    return prices.withColumn("back", rank).where(F.col("back") <= n)


def history_documents(prices: DataFrame, n: int = 1460) -> DataFrame:
    """instrument_id, document: the last n days as JSON of parallel arrays."""
    day = F.struct("date", *(number(F.col(c), 4).alias(c) for c in ("open", "high", "low", "close", "volume")))
    packed = last_n(prices, n).groupBy("instrument_id").agg(F.array_sort(F.collect_list(day)).alias("d"))
    return packed.select("instrument_id", F.to_json(F.struct(*(F.col(f"d.{c}").alias(c) for c in ("date", "open", "high", "low", "close", "volume")))).alias("document"))


def instrument_documents(universe: DataFrame, prices: DataFrame, forecasts: DataFrame, outcomes: DataFrame, n: int = 250) -> DataFrame:
    """instrument_id, document: meta, the last closes, the latest forecasts and the record, nested in one JSON."""
    closes = last_n(prices, n).groupBy("instrument_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("date", number(F.col("close")).alias("close")))), lambda x: x["close"]).alias("closes"))
    newest = Window.partitionBy("instrument_id", "horizon").orderBy(F.col("session").desc())
    latest = forecasts.withColumn("__r", F.row_number().over(newest)).where("__r = 1")
    now = latest.groupBy("instrument_id").agg(F.array_sort(F.collect_list(F.struct("horizon", "session", "target_session", number(F.col("prob_up")).alias("prob_up"), number(F.col("band_low"), 6).alias("band_low"), number(F.col("band_high"), 6).alias("band_high")))).alias("forecasts"))
    record = outcomes.groupBy("instrument_id", "horizon").agg(F.count(F.lit(1)).alias("n"), number(F.avg("hit")).alias("hit"), number(F.avg("baseline_hit")).alias("baseline_hit"))
    by_id = record.groupBy("instrument_id").agg(F.array_sort(F.collect_list(F.struct("horizon", "n", "hit", "baseline_hit"))).alias("record"))
    joined = universe.join(closes, "instrument_id").join(now, "instrument_id", "left").join(by_id, "instrument_id", "left")
    return joined.select("instrument_id", F.to_json(F.struct("instrument_id", "ticker", "sector", "closes", "forecasts", "record")).alias("document"))


def screener(universe: DataFrame, prices: DataFrame, outcomes: DataFrame, spark_n: int = 60, least: int = 30) -> DataFrame:
    """One row an instrument: last close, its change, the spark line's ends, and skill 1 - Brier / baseline Brier from 30 outcomes on."""
    recent = last_n(prices, spark_n).groupBy("instrument_id").agg(F.max_by("close", "date").alias("close"), F.min_by("close", "date").alias("spark_first"), F.max(F.when(F.col("back") == 2, F.col("close"))).alias("previous"), F.count(F.lit(1)).alias("spark_n"))
    skill = outcomes.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= least, 1 - F.try_divide(F.avg("brier"), F.avg("baseline_brier"))).alias("skill"))
    joined = universe.join(recent, "instrument_id").join(skill, "instrument_id", "left")
    return joined.select("instrument_id", "ticker", "close", (F.col("close") / F.col("previous") - 1).alias("change"), "spark_first", "spark_n", F.coalesce("n", F.lit(0)).alias("n"), "skill")


def verdict_documents(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """horizon, document: all records of a horizon as one JSON array, in order of the keys."""
    row = F.struct(*keys, *(number(F.col(c), 4).alias(c) for c in ("value", "baseline_value", "delta", "p_value_fdr")), "n", "n_tests", "verdict")
    return records.groupBy("horizon").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("document"))


def placed(rows: DataFrame, *ties: str) -> DataFrame:
    """Add place: 1 for the largest delta of a horizon, equal ones in the order of ``ties``."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("horizon").orderBy(F.col("delta").desc_nulls_last(), *ties)))


def questions(prices: DataFrame, horizon: int, window: int = 120, least_past: int = 60) -> DataFrame:
    """instrument_id, date, closes, after, baseline_prob, up: blind windows normalised to 100, with the past-only base rate."""
    over = Window.partitionBy("instrument_id").orderBy("date")
    rows = prices.withColumns({"n": F.row_number().over(over), "rose": (F.col("close") > F.lag("close", horizon).over(over)).cast("double")})
    rows = rows.withColumns(
        {
            "before": F.collect_list("close").over(over.rowsBetween(1 - window, 0)),
            "later": F.collect_list("close").over(over.rowsBetween(1, horizon)),
            "rate": F.avg("rose").over(over.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    ok = rows.where((F.col("n") > window) & (F.size("later") == horizon) & (F.size("before") == window) & (F.col("n") > horizon + least_past))
    level = lambda a: F.transform(a, lambda v: F.round(v / F.col("close") * 100, 2))
    return ok.select("instrument_id", "date", level("before").alias("closes"), level("later").alias("after"), F.round(F.least(F.greatest("rate", F.lit(0.01)), F.lit(0.99)), 4).alias("baseline_prob"), (F.element_at("later", -1) > F.col("close")).alias("up"))


def seeded_sample(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows in the order of a hash of seed and keys: the same rows on every run and in every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in keys))
    return rows.orderBy(F.md5(text), *keys).limit(n)


def canonical(name: str, kind: str) -> Column:
    """``name=value`` as every engine writes it: doubles with nine digits, days as YYYY-MM-DD, a missing value as null."""
    c = F.col(name)
    text = c.cast("decimal(38,9)").cast("string") if kind in ("double", "float") else c.cast("string")
    return F.concat(F.lit(f"{name}="), F.coalesce(text, F.lit("null")))


def content_hash(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per session a fingerprint of its rows that depends on no order of rows or files: session, rows, sha256."""
    text = F.concat_ws("|", *(canonical(c, t) for c, t in sorted(rows.dtypes)))
    lines = rows.select("session", F.sha2(text, 256).alias("line"))
    # Sums of hash parts are order-free and need one row a session, not the rows themselves.
    part = lambda i: F.sum(F.conv(F.substring("line", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)"))
    found = lines.groupBy("session").agg(F.count(F.lit(1)).alias("rows"), *(part(i).alias(f"h{i}") for i in range(5)))
    return found.select("session", "rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), *(F.col(f"h{i}").cast("string") for i in range(5))), 256).alias("sha256"))


def archive(forecasts: DataFrame, manifests: DataFrame) -> DataFrame:
    """session, rows, verified, verdict: each package's fingerprint against its manifest; a mismatch is never archived as good."""
    found = content_hash(forecasts, ["forecast_id"])
    joined = manifests.select("session", F.col("sha256").alias("stated")).join(found, "session", "left")
    return joined.select("session", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(F.col("stated") == F.col("sha256"), F.lit(False)).alias("verified"))
