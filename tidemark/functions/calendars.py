"""Trading calendars by rule, and arithmetic on sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar, by the anonymous algorithm."""
    y = year.cast("int")
    div = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = y % 19, div(y, 100), y % 100
    d, e = div(b, 4), b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i, k = div(c, 4), c % 4
    m = (32 + 2 * e + 2 * i - h - k) % 7
    n = div(a + 11 * h + 22 * m, 451)
    month, day = div(h + m - 7 * n + 114, 31), (h + m - 7 * n + 114) % 31 + 1
    return F.make_date(y, month, day)


def _weekday(d: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(d)


def fixed_date(month: int, day: int) -> Callable[[Column], Column]:
    return lambda y: F.make_date(y, F.lit(month), F.lit(day))


def nth_weekday(month: int, weekday: int, n: int) -> Callable[[Column], Column]:
    """The n-th such weekday of a month; n = -1 the last."""

    def rule(y: Column) -> Column:
        first = F.make_date(y, F.lit(month), F.lit(1))
        if n > 0:
            return F.date_add(first, F.pmod(F.lit(weekday) - _weekday(first), F.lit(7)) + 7 * (n - 1))
        last = F.last_day(first)
        return F.date_sub(last, F.pmod(_weekday(last) - F.lit(weekday), F.lit(7)))

    return rule


def observed(rule: Callable[[Column], Column], saturday_before: bool = True) -> Callable[[Column], Column]:
    """A holiday on Sunday moves to Monday; on Saturday to Friday, or nowhere."""

    def moved(y: Column) -> Column:
        d = rule(y)
        on_saturday = F.date_sub(d, 1) if saturday_before else F.lit(None).cast("date")
        return F.when(_weekday(d) == 6, F.date_add(d, 1)).when(_weekday(d) == 5, on_saturday).otherwise(d)

    return moved


def from_easter(days: int) -> Callable[[Column], Column]:
    return lambda y: F.date_add(easter(y), days)


def since(year: int, rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda y: F.when(y >= year, rule(y))


#: Holidays by calendar: fixed rules.
HOLIDAYS: dict[str, list[Callable[[Column], Column]]] = {
    "TARGET": [fixed_date(1, 1), from_easter(-2), from_easter(1), fixed_date(5, 1), fixed_date(12, 25), fixed_date(12, 26)],
    "XNYS": [
        observed(fixed_date(1, 1), saturday_before=False),
        nth_weekday(1, 0, 3),
        nth_weekday(2, 0, 3),
        from_easter(-2),
        nth_weekday(5, 0, -1),
        since(2022, observed(fixed_date(6, 19))),
        observed(fixed_date(7, 4)),
        nth_weekday(9, 0, 1),
        nth_weekday(11, 3, 4),
        observed(fixed_date(12, 25)),
    ],
    "UST": [
        observed(fixed_date(1, 1)),
        nth_weekday(1, 0, 3),
        nth_weekday(2, 0, 3),
        from_easter(-2),
        nth_weekday(5, 0, -1),
        since(2021, observed(fixed_date(6, 19))),
        observed(fixed_date(7, 4)),
        nth_weekday(9, 0, 1),
        nth_weekday(10, 0, 2),
        observed(fixed_date(11, 11)),
        nth_weekday(11, 3, 4),
        observed(fixed_date(12, 25)),
    ],
}
#: Local close and zone of each calendar; 24/7 ends its day at midnight UTC.
CLOSES = {"XNYS": ("16:00", "America/New_York"), "TARGET": ("14:10", "Europe/Berlin"), "UST": ("15:30", "America/New_York"), "24/7": ("24:00", "UTC")}
#: Days after Thanksgiving and before Christmas and Independence Day on which the exchange shuts early.
EARLY_CLOSE = "13:00"


def holidays(spark: SparkSession, code: str, first: str, last: str) -> DataFrame:
    years = days_between(spark, first, last).select(F.year("date").alias("y")).distinct()
    # New Year's Day may be kept on the last day of the year before.
    wide = years.unionByName(years.select((F.col("y") + 1).alias("y"))).distinct()
    return wide.select(F.explode(F.array_compact(F.array(*[rule(F.col("y")) for rule in HOLIDAYS.get(code, [])]))).alias("date")).distinct() if HOLIDAYS.get(code) else wide.where("false").select(F.lit(None).cast("date").alias("date"))


def sessions(spark: SparkSession, code: str, first: str, last: str) -> DataFrame:
    """date, idx, close_at (UTC) of a calendar's sessions."""
    days = days_between(spark, first, last)
    if code != "24/7":
        days = days.where(_weekday(F.col("date")) < 5).join(holidays(spark, code, first, last), "date", "left_anti")
    clock, zone = CLOSES[code]
    if code == "24/7":
        close = F.date_add("date", 1).cast("timestamp")
    else:
        early = F.lit(False)
        if code == "XNYS":
            y = F.year("date")
            thanksgiving = nth_weekday(11, 3, 4)(y)
            christmas_eve = (F.month("date") == 12) & (F.dayofmonth("date") == 24)
            july_third = (F.month("date") == 7) & (F.dayofmonth("date") == 3)
            early = (F.col("date") == F.date_add(thanksgiving, 1)) | christmas_eve | july_third
        local = F.concat_ws(" ", F.col("date").cast("string"), F.when(early, EARLY_CLOSE).otherwise(clock))
        close = F.to_utc_timestamp(F.to_timestamp(local, "yyyy-MM-dd HH:mm"), zone)
    return days.withColumn("close_at", close).withColumn("idx", F.row_number().over(Window.orderBy("date")))


def last_closed(calendar: DataFrame, now: Column) -> DataFrame:
    """session: the last whose close has passed."""
    return calendar.where(F.col("close_at") <= now).agg(F.max("date").alias("session"))


def sessions_back(calendar: DataFrame, end: Column, count: int) -> DataFrame:
    """session: ``count`` sessions before the last one up to ``end``."""
    upto = calendar.where(F.col("date") <= end).withColumn("back", F.row_number().over(Window.orderBy(F.col("date").desc())) - 1)
    return upto.where(F.col("back") == count).select(F.col("date").alias("session"))


def session_lag(calendar: DataFrame, available: Column, expected: Column) -> DataFrame:
    """lag: sessions in (available, expected]."""
    return calendar.agg(F.count(F.when((F.col("date") > available) & (F.col("date") <= expected), 1)).alias("lag"))


def with_target(rows: DataFrame, calendar: DataFrame, session: str = "session", horizon: str = "horizon") -> DataFrame:
    """Add target_session: so many sessions on, null past the calendar's end."""
    start = calendar.select(F.col("date").alias(session), F.col("idx").alias("__at"))
    end = calendar.select(F.col("idx").alias("__to"), F.col("date").alias("target_session"))
    placed = rows.join(start, session, "left").withColumn("__to", F.col("__at") + F.col(horizon))
    return placed.join(end, "__to", "left").drop("__at", "__to")


def start_session(rows: DataFrame, calendar: DataFrame, created: str = "created_at") -> DataFrame:
    """Add start_session: the first whose close is not before the moment.

    A table of one row a day says which session is next and which follows it,
    so each row needs one equal-day join.
    """
    ends = calendar.agg(F.date_sub(F.min("date"), 7).alias("low"), F.max("date").alias("high"))
    spine = ends.select(F.explode(F.sequence("low", "high")).alias("day")).join(calendar.select(F.col("date").alias("day"), "idx"), "day", "left")
    ahead = spine.withColumn("idx", F.first("idx", ignorenulls=True).over(Window.orderBy("day").rowsBetween(0, Window.unboundedFollowing)))
    nearest = calendar.select("idx", F.col("date").alias("__one"), F.col("close_at").alias("__close"), F.lead("date").over(Window.orderBy("idx")).alias("__two"))
    table = ahead.join(nearest, "idx").select(F.col("day").alias("__day"), "__one", "__close", "__two")
    found = rows.withColumn("__day", F.to_date(created)).join(table, "__day", "left")
    return found.withColumn("start_session", F.when(F.col(created) <= F.col("__close"), F.col("__one")).otherwise(F.col("__two"))).drop("__day", "__one", "__close", "__two")


def calendar_days_offset(calendar: DataFrame, day: Column, n: int) -> DataFrame:
    """session: the n-th after (or before, for n < 0) the last one up to ``day``."""
    base = calendar.where(F.col("date") <= day).agg(F.max("idx").alias("at"))
    return calendar.crossJoin(F.broadcast(base)).where(F.col("idx") == F.col("at") + n).select(F.col("date").alias("session"))


def missed(calendar: DataFrame, manifests: DataFrame, now: Column, deadline: Column) -> DataFrame:
    """session of every calendar day whose deadline has passed without a package."""
    return calendar.where(deadline <= now).join(manifests.select(F.col("session").alias("date")), "date", "left_anti").select(F.col("date").alias("session"))


def walk_forward(calendar: DataFrame, horizon: int, test: int = 252, least: int = 756) -> DataFrame:
    """fold, train_end, test_start, test_end: an expanding window that ends h + 1 sessions before each test window."""
    ends = calendar.agg(F.max("idx").alias("n"))
    starts = F.sequence(F.lit(least), F.col("n") - test, F.lit(test))
    folds = ends.where(F.col("n") >= least + test).select(F.posexplode(starts).alias("fold", "start"))
    at = lambda name: calendar.select(F.col("idx").alias(f"__{name}"), F.col("date").alias(name))
    # idx counts from 1, so position p has idx p + 1.
    placed = folds.withColumns({"__train_end": F.greatest(F.lit(0), F.col("start") - horizon - 1) + 1, "__test_start": F.col("start") + 1, "__test_end": F.col("start") + test})
    for name in ("train_end", "test_start", "test_end"):
        placed = placed.join(at(name), f"__{name}").drop(f"__{name}")
    return placed.select("fold", "train_end", "test_start", "test_end")


def trainable_by(rows: DataFrame, folds: DataFrame, calendar: DataFrame, horizon: int) -> DataFrame:
    """(row, fold) where the row's label ends by the fold's train_end."""
    idx = calendar.select("date", "idx")
    ended = folds.join(idx.withColumnsRenamed({"date": "train_end", "idx": "__end"}), "train_end")
    placed = rows.join(idx, "date")
    return placed.join(F.broadcast(ended.select("fold", "__end")), F.col("idx") + horizon <= F.col("__end")).drop("idx", "__end")


def every_nth_day(rows: DataFrame, stride: int) -> DataFrame:
    """Rows of every stride-th distinct day, from the first. Days are numbered apart: one row a day."""
    days = rows.select("date").distinct().withColumn("__n", F.row_number().over(Window.orderBy("date")) - 1)
    return rows.join(days.where(F.col("__n") % stride == 0).select("date"), "date", "left_semi")


#: Scheduled events by kind: fixed dates of a published schedule's form; real use passes its own table.
EVENT_KINDS = ("fomc", "cpi", "nfp", "ecb")


def events_in_window(rows: DataFrame, events: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add calendar_flag: ids, by session and id, of events whose first session on or after their day lies in (session, target_session]."""
    placed = events.join(calendar.select(F.col("date").alias("__session")), F.col("__session") >= F.col("day")).groupBy("event_id").agg(F.min("__session").alias("on_session"))
    windows = rows.select("session", "target_session").distinct()
    inside = windows.join(placed, (F.col("on_session") > F.col("session")) & (F.col("on_session") <= F.col("target_session")))
    listed = inside.groupBy("session", "target_session").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("on_session", "event_id"))), lambda e: e["event_id"]), ",").alias("calendar_flag"))
    return rows.join(listed, ["session", "target_session"], "left").withColumn("calendar_flag", F.coalesce("calendar_flag", F.lit("")))


def upcoming(events: DataFrame, after: Column, days: int = 45) -> DataFrame:
    return events.where((F.col("day") > after) & (F.col("day") <= F.date_add(after, days))).orderBy("day", "event_id")


def uncovered_kinds(events: DataFrame, end: Column) -> DataFrame:
    """kind, until: kinds whose schedule ends before ``end``."""
    return events.groupBy("kind").agg(F.max("day").alias("until")).where(F.col("until") < end)


def calendar_rows(calendar: DataFrame, code: str, events: DataFrame, due: DataFrame) -> DataFrame:
    """day, kind, what: sessions, events within the calendar, and each (target session, horizon) of open forecasts once."""
    within = calendar.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    row = lambda t, day, kind, what: t.select(F.col(day).alias("day"), F.lit(kind).alias("kind"), what.alias("what"))
    inside = events.join(F.broadcast(within), F.col("day").between(F.col("low"), F.col("high")))
    ends = due.where("target_session is not null").select("target_session", "horizon").distinct()
    parts = (row(calendar, "date", "session", F.lit(code)), row(inside, "day", "event", F.col("kind")), row(ends, "target_session", "target", F.concat(F.lit("h"), F.col("horizon").cast("string"))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
