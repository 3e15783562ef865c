"""Shock signals of instruments and of the market, their scope, and calm windows after a forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.returns import log_change, total_return
from tidemark.operators.ranks import ranged
from tidemark.operators.rolling import by_instrument, guarded, positive_ln, ratio

VOLUME_Z, GAP_SIGMA, MOVE_SIGMA, CROSS_SIGMA, VIX_JUMP = 4.0, 3.0, 4.0, 2.5, 0.20
CROSS_LEAST, LEAST_ROWS, AFTER = 3, 22, 5
SCOPE_SHARE, SECTOR_LEAST = 0.30, 5


def _positive(x: Column) -> Column:
    return F.when(x > 0, x)


def instrument_frame(prices: DataFrame, actions: DataFrame) -> DataFrame:
    """Every day's three signals, from rows before it, with the volatility before and after.

    instrument_id, date, volume_z, gap_sigma, move_sigma, move_s60, enough, sigma_before, vol_after, flag.
    """
    rows = total_return(prices, actions)
    rows = rows.withColumns({"r": log_change("tr_log"), "n": F.row_number().over(by_instrument())})
    past = lambda stat, x, n, least: guarded(stat, F.col(x), n, least, end=-1)
    rows = rows.withColumns(
        {
            "s60": past(F.stddev_samp, "r", 60, 20),
            "s20": past(F.stddev_samp, "r", 20, 20),
            "v_mean": past(F.avg, "volume", 60, 21),
            "v_std": past(F.stddev_samp, "volume", 60, 21),
            "vol_after": guarded(F.stddev_samp, F.col("r"), AFTER, end=AFTER),
            "before": F.lag("close").over(by_instrument()),
        }
    )
    split = actions.where((F.col("split_ratio").isNotNull()) & (F.col("split_ratio") != 1)).select("instrument_id", "date", F.lit(True).alias("split")).distinct()
    rows = rows.join(split, ["instrument_id", "date"], "left")
    gap = ratio(F.abs(positive_ln(ratio(F.col("open"), F.col("before")))), _positive(F.col("s60")))
    named = {
        "volume_z": ratio(F.col("volume") - F.col("v_mean"), _positive(F.col("v_std"))),
        "gap_sigma": F.when(F.col("split").isNull(), gap),
        "move_sigma": ratio(F.abs("r"), _positive(F.col("s20"))),
        "move_s60": ratio(F.abs("r"), _positive(F.col("s60"))),
        "enough": F.col("n") >= LEAST_ROWS,
    }
    rows = rows.withColumns(named)
    loud = [F.coalesce(F.col(c) > limit, F.lit(False)) for c, limit in (("volume_z", VOLUME_Z), ("gap_sigma", GAP_SIGMA), ("move_sigma", MOVE_SIGMA))]
    flag = F.col("enough") & (loud[0] | loud[1] | loud[2])
    return rows.select("instrument_id", "date", *named, F.col("s20").alias("sigma_before"), "vol_after", flag.alias("flag"))


def signal_list() -> Column:
    """The signals of a row of instrument_frame as a comma list."""
    named = [F.when(F.col(c) > limit, F.lit(n)) for n, c, limit in (("volume", "volume_z", VOLUME_Z), ("gap", "gap_sigma", GAP_SIGMA), ("move", "move_sigma", MOVE_SIGMA))]
    return F.when(F.col("enough"), F.concat_ws(",", *named)).otherwise("")


def as_of(left: DataFrame, right: DataFrame, columns: Sequence[str], by: Sequence[str] = (), on: str = "date") -> DataFrame:
    """Each left row with the right columns of the last right row up to its moment.

    Both sides are sorted together into ranges of key and moment, so that one key with many rows, or no key at
    all, is many tasks; the last right row of each range is carried into the ranges after it. A
    right row that carries a missing value still counts as the last one.
    """
    marks = right.select(*by, on, F.struct(*columns).alias("__v"), F.lit(0).alias("__side"))
    kind = marks.schema["__v"].dataType
    points = left.select(*by, on, F.lit(None).cast(kind).alias("__v"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    both = ranged(marks.withColumn("__row", F.lit(None).cast(points.schema["__row"].dataType)).unionByName(points), *by, on, "__side")
    # Keys may be null; structs compare nulls as equal.
    key = F.struct(*by) if by else F.lit(0)
    placed = both.withColumn("__key", key)
    last = placed.where("__side = 0").groupBy("__key", "__range").agg(F.max_by("__v", on).alias("__own"))
    ranges = placed.select("__key", "__range").distinct().join(last, ["__key", "__range"], "left")
    before = F.last("__own", ignorenulls=True).over(Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    carried = ranges.select("__key", "__range", before.alias("__earlier"))
    over = Window.partitionBy("__key", "__range").orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = placed.withColumn("__v", F.last("__v", ignorenulls=True).over(over)).where("__side = 1")
    found = found.join(carried, ["__key", "__range"], "left").withColumn("__v", F.coalesce("__v", "__earlier"))
    return found.select("__row.*", *(F.col(f"__v.{c}").alias(c) for c in columns))


def vix_change(macro: DataFrame) -> DataFrame:
    """date, vix_change of days that have a value, over the last such day."""
    known = macro.where("vix is not null").select("date", "vix")
    return known.select("date", (ratio(F.col("vix"), F.lag("vix").over(Window.orderBy("date"))) - 1).alias("vix_change"))


def market_frame(frame: DataFrame, market: str, basket: Sequence[str], macro: DataFrame) -> DataFrame:
    """The market's days: sigma_before, vol_after, cross_count, cross, vix_change, vix, market_flag, withheld."""
    moved = (F.col("move_s60") > CROSS_SIGMA) & F.col("enough")
    counts = frame.where(F.col("instrument_id").isin(list(basket))).groupBy("date").agg(F.count_if(F.coalesce(moved, F.lit(False))).alias("cross_count"))
    days = frame.where(F.col("instrument_id") == market).select("date", "sigma_before", "vol_after")
    found = as_of(days.join(counts, "date", "left"), vix_change(macro), ["vix_change"])
    found = found.withColumn("cross_count", F.coalesce("cross_count", F.lit(0)))
    found = found.withColumns({"cross": F.col("cross_count") >= CROSS_LEAST, "vix": F.coalesce(F.col("vix_change") > VIX_JUMP, F.lit(False))})
    return found.withColumns({"market_flag": F.col("vix") | F.col("cross"), "withheld": F.col("vix") & F.col("cross")})


def classified(frame: DataFrame, market: DataFrame, universe: DataFrame) -> DataFrame:
    """Scope, persistence and tractability of every instrument's day, and whether the day's forecasts are withheld."""
    rows = frame.select("instrument_id", "date", signal_list().alias("signals")).join(universe.select("instrument_id", "asset_class", "sector"), "instrument_id", "left")
    rows = rows.join(market.select("date", "vix", "cross"), "date", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("vix", "cross")})
    loud, equity = F.col("signals") != "", F.col("asset_class") == "equity"
    day, group = Window.partitionBy("date"), Window.partitionBy("date", "sector")
    country = F.coalesce(F.count_if(loud & equity).over(day) >= SCOPE_SHARE * F.count_if(equity).over(day), F.lit(False)) & (F.count_if(equity).over(day) > 0)
    sector = F.col("sector").isNotNull() & (F.count(F.lit(1)).over(group) >= SECTOR_LEAST) & (F.avg(loud.cast("int")).over(group) >= SCOPE_SHARE)
    rows = rows.withColumns({"__country": country, "__sector": sector})
    on_market = F.col("vix") | F.col("cross")
    wide = F.when(on_market, "global_macro").when(F.col("__country"), "country")
    count = F.size(F.filter(F.split("signals", ","), lambda s: s != ""))
    unknowable = F.col("vix") & F.col("cross")
    return rows.select(
        "instrument_id",
        "date",
        "signals",
        F.coalesce(wide, F.when(loud & F.col("__sector"), "sector").when(loud, "instrument")).alias("shock_scope"),
        F.when(on_market | (count >= 2), "days").when(count == 1, "intraday_noise").alias("shock_persistence"),
        F.when(unknowable, "unknowable").otherwise("priceable").alias("shock_tractability"),
        unknowable.alias("withheld"),
    )


def broad_count(frame: DataFrame, tracked: Sequence[str], least: int, sigma: float = CROSS_SIGMA) -> DataFrame:
    """date, moved, broad: how many of the tracked series moved, and whether that many did; for markets without equities."""
    moved = F.coalesce((F.col("move_sigma") > sigma) & F.col("enough"), F.lit(False))
    return frame.where(F.col("instrument_id").isin(list(tracked))).groupBy("date").agg(F.count_if(moved).alias("moved")).withColumn("broad", F.col("moved") >= least)


def calm_windows(keys: DataFrame, flags: DataFrame, market: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """instrument_id, date, horizon, calm of ``keys``: no signal of the instrument or the market on the h rows after; null while open."""
    joined = flags.select("instrument_id", "date", F.coalesce("flag", F.lit(False)).alias("own")).join(market.select("date", F.col("market_flag").alias("wide")), "date", "left")
    rows = joined.withColumn("loud", (F.col("own") | F.coalesce("wide", F.lit(False))).cast("int"))
    for h in horizons:
        ahead = by_instrument().rowsBetween(1, h)
        rows = rows.withColumn(f"calm_{h}", F.when(F.count("loud").over(ahead) == h, F.sum("loud").over(ahead) == 0))
    calm = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"calm_{h}").alias("calm")) for h in horizons])
    long = rows.select("instrument_id", "date", F.explode(calm).alias("c")).select("instrument_id", "date", "c.*")
    return keys.select("instrument_id", "date", "horizon").join(long, ["instrument_id", "date", "horizon"], "left")


def paired_control(frame: DataFrame) -> DataFrame:
    """instrument_id, day, model, base: flagged days against the share of that day's unflagged instruments whose volatility rose too."""
    usable = frame.where("vol_after is not null and sigma_before > 0").withColumn("rose", (F.col("vol_after") > F.col("sigma_before")).cast("double"))
    base = usable.where("not flag").groupBy("date").agg(F.avg("rose").alias("base"))
    return usable.where("flag").join(base, "date").select("instrument_id", F.col("date").alias("day"), F.col("rose").alias("model"), "base")


def day_control(market: DataFrame, flag: str, factor: float = 1.0) -> DataFrame:
    """day, model, base: flagged market days against the share of the unflagged ones, over the whole period."""
    usable = market.where("vol_after is not null and sigma_before > 0")
    rose = F.col("vol_after") >= factor * F.col("sigma_before") if factor > 1 else F.col("vol_after") > F.col("sigma_before")
    marked = usable.withColumns({"rose": rose.cast("double"), "on": F.coalesce(F.col(flag), F.lit(False))})
    base = marked.where("not on").agg(F.avg("rose").alias("base"))
    return marked.where("on").crossJoin(F.broadcast(base)).where("base is not null").select(F.col("date").alias("day"), F.col("rose").alias("model"), "base")


def calendar_flags(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """date, kinds: sessions whose next session is the first on or after an official event."""
    placed = events.join(sessions.select(F.col("date").alias("s"), "idx"), F.col("s") >= F.col("day")).groupBy("event_id", "kind").agg(F.min("idx").alias("on"))
    before = sessions.select("date", (F.col("idx") + 1).alias("on"))
    return placed.join(before, "on").groupBy("date").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
