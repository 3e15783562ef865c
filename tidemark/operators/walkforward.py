"""Walk-forward measurement of ridge families: every fold of every horizon from one scan.

A fold trains on all days up to its edge, so folds are nested, and what a ridge needs
of its rows is their sums of products. Days are given the first fold that trains on
them; partitions add up the products of (1, values, gaps, label) by horizon and first
fold; and the running sums over folds hold each fold's moments, whatever it fills gaps
with: a filled feature is value + median * gap, a linear map of what was summed. Medians
of a fold's own rows come from one ranking for all folds. The driver solves systems of a
handful of unknowns; rows are scored where they lie, by joining a row a fold.

Bands and probabilities follow in the same way for all folds at once: exact quantiles of
the errors by rank, the share of past errors below a point by ranking both together, and
an isotonic fit on a grid of a thousand shares.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendars
from tidemark.functions.assets import Asset
from tidemark.functions.scalar import horizon_scale
from tidemark.operators.ranks import quantiles, shares, staged_quantiles
from tidemark.session import stored

NOMINAL, LOW, HIGH, GRID = 0.90, 0.01, 0.99, 1000
#: The statistical control's inputs: an instrument's own returns and volatility.
AR_INPUTS = ("ret_1", "ret_5", "ret_20", "ret_60", "vol_20")
ALPHA = 1.0
GROUP = ["family", "horizon", "fold"]


def fold_plan(calendar: DataFrame, horizons: Sequence[int], asset: Asset) -> DataFrame:
    """horizon, fold, end, edge, first, last: labels end by ``end``, training days by ``edge``, the calibration window lies between, tests from first to last."""
    out = None
    at = calendar.select("date", "idx")
    for h in horizons:
        folds = calendars.walk_forward(calendar, h, asset.test_sessions, asset.train_sessions)
        for name, to in (("train_end", "end"), ("test_start", "first"), ("test_end", "last")):
            folds = folds.join(at.withColumnsRenamed({"date": name, "idx": to}), name)
        part = folds.select(F.lit(h).alias("horizon"), "fold", (F.col("end") - h).alias("end"), (F.col("end") - h - asset.calibration_sessions).alias("edge"), "first", "last")
        out = part if out is None else out.unionByName(part)
    return out


def latest_plan(calendar: DataFrame, horizons: Sequence[int], asset: Asset) -> DataFrame:
    """The one fold of each horizon whose test is the last session: what a daily package is made from."""
    end = calendar.agg(F.max("idx").alias("m"))
    return end.select(F.explode(F.array(*map(F.lit, horizons))).alias("horizon"), F.lit(0).alias("fold"), F.col("m")).select("horizon", "fold", (F.col("m") - F.col("horizon")).alias("end"), (F.col("m") - F.col("horizon") - asset.calibration_sessions).alias("edge"), F.col("m").alias("first"), F.col("m").alias("last"))


def roles(rows: DataFrame, calendar: DataFrame, horizons: Sequence[int], asset: Asset, plan: DataFrame | None = None) -> DataFrame:
    """date, horizon, fold, role: what each day is to each fold; a training day has its first fold only.

    One row for each day, horizon and role: bounded by the calendar.
    """
    plan = stored(fold_plan(calendar, horizons, asset) if plan is None else plan, "folds")
    labelled = F.array_compact(F.array(*(F.when(F.col(f"y_{h}").isNotNull(), F.lit(h)) for h in horizons)))
    days = rows.select("date", F.explode(labelled).alias("horizon")).distinct().join(calendar.select("date", "idx"), "date")
    days = stored(days.withColumn("n", F.row_number().over(Window.partitionBy("horizon").orderBy("date")) - 1), "days")
    stride = F.greatest(F.lit(1), F.floor(F.col("horizon") / 5))
    kept = days.where(F.col("n") % stride == 0).join(F.broadcast(plan.select("horizon", "fold", "edge")), "horizon").where("idx <= edge")
    train = kept.groupBy("date", "horizon").agg(F.min("fold").alias("fold")).withColumn("role", F.lit("train"))
    window = days.join(F.broadcast(plan), "horizon").where("idx > edge and idx <= end")
    half = F.ntile(2).over(Window.partitionBy("horizon", "fold").orderBy("date"))
    calibration = window.select("date", "horizon", "fold", F.when(half == 1, "band").otherwise("prob").alias("role"))
    test = calendar.select("date", "idx").join(F.broadcast(plan), F.col("idx").between(F.col("first"), F.col("last"))).select("date", "horizon", "fold", F.lit("test").alias("role"))
    return stored(train.select("date", "horizon", "fold", "role").unionByName(calibration).unionByName(test), "roles")


def placed_rows(rows: DataFrame, days: DataFrame, features: Sequence[str], horizons: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """keys, horizon, fold, role, x (features in order), vol_20, y; every role but the test needs a label."""
    y = F.coalesce(*(F.when(F.col("horizon") == h, F.col(f"y_{h}")) for h in horizons))
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    ready = rows.select(*keys, F.array(*clean).alias("x"), "vol_20", *(F.col(f"y_{h}").cast("double").alias(f"y_{h}") for h in horizons))
    long = ready.join(F.broadcast(days), "date").select(*keys, "horizon", "fold", "role", "x", "vol_20", y.alias("y"))
    return long.where("role = 'test' or y is not null")


def sums_of_products(train: DataFrame, n_features: int) -> dict[tuple[int, int], np.ndarray]:
    """For each (horizon, first fold) the matrix of sums of products of (1, values, gaps, y, y > 0), gaps counting 0 among the values."""
    size = 2 * n_features + 3

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            h, fold, y = (batch.column(c).to_numpy() for c in ("horizon", "fold", "y"))
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), n_features)
            gaps = np.isnan(x)
            z = np.column_stack([np.ones(len(y)), np.where(gaps, 0, x), gaps, y, y > 0])
            for key in set(zip(h.tolist(), fold.tolist(), strict=True)):
                on = z[(h == key[0]) & (fold == key[1])]
                total[key] = total.get(key, 0) + on.T @ on
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k, _ in rows], pa.int32()) for i in range(2)] + [pa.array([m.ravel() for _, m in rows], pa.list_(pa.float64()))], names=["horizon", "fold", "m"])

    parts = train.select("horizon", "fold", "x", "y").mapInArrow(add, "horizon int, fold int, m array<double>")
    cells = parts.select("horizon", "fold", F.posexplode("m").alias("at", "v")).groupBy("horizon", "fold", "at").agg(F.sum("v").alias("v"))
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in cells.collect():  # folds times the square of the features
        out.setdefault((r["horizon"], r["fold"]), np.zeros(size * size))[r["at"]] = r["v"]
    return {k: m.reshape(size, size) for k, m in out.items()}


@dataclass
class Ridge:
    """Weights on features as they come, after gaps take ``medians``."""

    weights: np.ndarray
    medians: np.ndarray
    intercept: float
    n: int
    base_rate: float


def ridge(moments: np.ndarray, medians: np.ndarray, use: Sequence[int], alpha: float = ALPHA) -> Ridge:
    """The ridge on standardised features (population deviation, 0 counts as 1) from a fold's sums of products."""
    p = len(medians)
    n = moments[0, 0]
    fill = np.zeros((p, len(moments)))
    for i in range(p):
        fill[i, 1 + i], fill[i, 1 + p + i] = 1.0, medians[i]
    one = np.eye(len(moments))[0]
    y = np.eye(len(moments))[2 * p + 1]
    a = fill[list(use)]
    mean, y_mean = a @ moments @ one / n, y @ moments @ one / n
    cov = a @ moments @ a.T - n * np.outer(mean, mean)
    with_y = a @ moments @ y - n * mean * y_mean
    sd = np.sqrt(np.maximum(np.diag(cov) / n, 0))
    # Rounding leaves a trace of a deviation where all values are one.
    sd = np.where(sd > 1e-12 * np.maximum(1, np.abs(mean)), sd, 1.0)
    w = np.linalg.solve(cov / np.outer(sd, sd) + alpha * np.eye(len(sd)), with_y / sd) / sd
    weights = np.zeros(p)
    weights[list(use)] = w
    return Ridge(weights, medians, float(y_mean - w @ mean), int(n), float(moments[2 * p + 2, 0] / n))


def fit_folds(train: DataFrame, features: Sequence[str], families: dict[str, Sequence[str]]) -> dict[tuple[str, int, int], Ridge]:
    """The ridge of each (family, horizon, fold) that has a training row."""
    own = sums_of_products(train, len(features))
    p = len(features)
    horizons = sorted({h for h, _ in own})
    folds = range(max((f for _, f in own), default=-1) + 1)
    gappy = [c for i, c in enumerate(features) if sum(m[1 + p + i, 0] for m in own.values()) > 0]
    medians: dict[tuple[int, int, str], float] = {}
    if gappy:
        long = train.select("horizon", "fold", F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col("x")[features.index(c)].alias("v")) for c in gappy))).alias("f")).select("horizon", "fold", "f.*")
        medians = {(r["horizon"], r["stage"], r["feature"]): r["quantiles"][0] for r in staged_quantiles(long, ["horizon", "feature"], "v", "fold", [0.5], list(folds)).collect()}
    out = {}
    for h in horizons:
        so_far = 0
        for f in folds:
            so_far = so_far + own[(h, f)] if (h, f) in own else so_far
            if isinstance(so_far, int):
                continue
            fill = np.array([medians.get((h, f, c), 0.0) for c in features])
            for name, columns in families.items():
                out[(name, h, f)] = ridge(so_far, fill, [features.index(c) for c in columns])
    return out


def scored_points(rows: DataFrame, models: dict[tuple[str, int, int], Ridge], families: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """keys, family, horizon, fold, role, point, scale, y, base_rate: each family's point of each row, and of several families their mean."""
    spark = rows.sparkSession
    by_fold: dict[tuple[int, int], dict] = {}
    for (name, h, f), m in models.items():
        by_fold.setdefault((h, f), {"medians": m.medians, "base_rate": m.base_rate})[name] = m
    table = [(h, f, found["base_rate"], found["medians"].tolist(), [[*found[n].weights.tolist(), found[n].intercept] for n in families]) for (h, f), found in by_fold.items()]
    weights = spark.createDataFrame(table, "horizon int, fold int, base_rate double, medians array<double>, w array<array<double>>")
    # A row a fold: bounded by folds and features.
    joined = rows.join(F.broadcast(weights), ["horizon", "fold"])
    n = len(next(iter(models.values())).medians) if models else 0
    filled = [F.coalesce(F.col("x")[i], F.col("medians")[i]) for i in range(n)]
    point = lambda k: sum((F.col("w")[k][i] * x for i, x in enumerate(filled)), F.col("w")[k][n])
    ready = joined.select(*keys, "horizon", "fold", "role", "y", "base_rate", horizon_scale(F.col("vol_20"), F.col("horizon")).alias("scale"), *(point(k).alias(f"p{k}") for k in range(len(families))))
    each = [F.struct(F.lit(name).alias("family"), F.col(f"p{k}").alias("point")) for k, name in enumerate(families)]
    if len(families) > 1:
        each.append(F.struct(F.lit("ensemble").alias("family"), (sum((F.col(f"p{k}") for k in range(1, len(families))), F.col("p0")) / len(families)).alias("point")))
    return ready.withColumn("m", F.explode(F.array(*each))).select(*keys, "m.family", "horizon", "fold", "role", "m.point", "scale", "y", "base_rate")


def isotonic(x: np.ndarray, up: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rising fit of up / n over sorted ``x`` by pooling neighbours, read off at every grid share by interpolation."""
    blocks: list[list[float]] = []  # sum, weight, first x, last x
    for at, s, w in zip(x, up, n, strict=True):
        blocks.append([s, w, at, at])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s1, w1, _, b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s1, blocks[-1][1] + w1, blocks[-1][2], b]
    ends = [e for s, w, a, b in blocks for e in ((a, s / w), (b, s / w))]
    return np.interp(np.arange(GRID + 1), [e[0] for e in ends], [e[1] for e in ends])


def calibrated(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The test rows with prob_up and bands, by the band of the older half of the calibration days and the probabilities of the newer."""
    error = (F.col("y") - F.col("point")) / F.col("scale")
    band = points.where("role = 'band'").select(*GROUP, error.alias("value"))
    sizes = quantiles(band.withColumn("value", F.abs("value")), GROUP, "value", [NOMINAL]).select(*GROUP, F.col("quantiles")[0].alias("band_q"))
    asks = points.where("role in ('prob', 'test')").withColumn("value", -F.col("point") / F.col("scale"))
    placed = shares(band, asks, GROUP, "value").where("marks > 0").withColumn("k", F.round((1 - F.col("upto") / F.col("marks")) * GRID).cast("int"))
    placed = stored(placed, "placed")
    cells = placed.where("role = 'prob'").groupBy(*GROUP, "k").agg(F.sum((F.col("y") > 0).cast("long")).alias("up"), F.count(F.lit(1)).alias("n"))

    def fit(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("k")
        found = isotonic(g["k"].to_numpy(float), g["up"].to_numpy(float), g["n"].to_numpy(float))
        return pd.DataFrame({**dict(zip(GROUP, key, strict=True)), "k": np.arange(GRID + 1), "prob": found})

    # A group holds a row for each grid share at most.
    curves = cells.groupBy(*GROUP).applyInPandas(fit, "family string, horizon int, fold int, k int, prob double")
    done = placed.where("role = 'test'").join(curves, [*GROUP, "k"]).join(F.broadcast(sizes), GROUP)
    width = F.col("band_q") * F.col("scale")
    prob = lambda c: F.least(F.greatest(F.col(c), F.lit(LOW)), F.lit(HIGH))
    return done.select(*keys, F.col("y").alias("actual_return"), F.col("point").alias("expected_return"), "scale", prob("prob").alias("prob_up"), (F.col("point") - width).alias("band_low"), (F.col("point") + width).alias("band_high"), "family", prob("base_rate").alias("baseline_prob"), "fold", "horizon")


def walk_forward_scores(rows: DataFrame, calendar: DataFrame, features: Sequence[str], horizons: Sequence[int], asset: Asset, families: dict[str, Sequence[str]] | None = None, keys: Sequence[str] = ("instrument_id", "date"), plan: DataFrame | None = None) -> DataFrame:
    """Scored test rows of all folds and horizons: each ridge family's, and of several their ensemble's, with the naive baseline's probability. ``plan`` takes the place of the expanding folds.

    ``rows`` has keys, the features, vol_20 and y_h. A fold without a labelled row to fit or to calibrate on has no score.
    """
    families = families or {"linear": features}
    rows = stored(rows, "backtest")
    placed = placed_rows(rows, roles(rows, calendar, horizons, asset, plan), features, horizons, keys)
    models = fit_folds(placed.where("role = 'train'"), list(features), families)
    return calibrated(stored(scored_points(placed.where("role <> 'train'"), models, list(families), keys), "points"), keys)
