"""Walk-forward models: baselines, linear, tree and network regressors, conformal bands, calibrated probabilities.

The linear model is a ridge from one pass of sums of products; trees are grown leaf by
leaf (see ``boosting``); the network descends by gradients of whole batches, summed over
all tasks at every step. Gaps take the exact training
median (trees learn a side for them), every feature is standardised by its population deviation. Numbers
are this library's own, the protocol is fixed: fit on the past, a first half of the calibration window
for the band, a second for the probabilities. Models of every kind are stored alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import horizon_scale, sign_bin
from tidemark.operators.boosting import Boosted, fit_boosted
from tidemark.operators.ranks import quantiles
from tidemark.operators.walkforward import ALPHA, ridge, sums_of_products
from tidemark.session import discard, scratch, stored

NOMINAL, LEAST_BIN, LEAST_HISTORY = 0.90, 100, 300
BASELINES = {"naive": None, "momentum": "ret_20", "sector": "sector_ret_20", "buy_hold": None}
LOW, HIGH = 0.01, 0.99


def trainable(rows: DataFrame, target: str) -> DataFrame:
    return rows.where(F.col(target).isNotNull() & (F.col("history_sessions") >= LEAST_HISTORY))


def feature_columns(rows: DataFrame) -> list[str]:
    """Numeric columns that are no key, label or history."""
    return [c for c, t in rows.dtypes if t in ("double", "float") and not c.startswith("y_") and c not in ("history_sessions",)]


def fit_baselines(train: DataFrame, target: str, horizon: int) -> DataFrame:
    """baseline, bin, rate, mean, base_rate, base_mean, band_q: bins of fewer than 100 rows are left out; without a known error the band is null."""
    y, scale = F.col(target), horizon_scale(F.col("vol_20"), F.lit(horizon))
    base = train.agg(F.avg((y > 0).cast("double")).alias("base_rate"), F.avg(y).alias("base_mean"))
    with_base = train.crossJoin(F.broadcast(base))
    sizes = with_base.select(F.lit(0).alias("all"), F.abs((y - F.col("base_mean")) / scale).alias("size"))
    band = quantiles(sizes, ["all"], "size", [NOMINAL]).agg(F.max(F.col("quantiles")[0]).alias("band_q"))  # always one row
    parts = None
    for name, column in BASELINES.items():
        if column is None:
            part = base.select(F.lit(name).alias("baseline"), F.lit(None).cast("int").alias("bin"), F.col("base_rate").alias("rate"), F.col("base_mean").alias("mean"))
        elif column in train.columns:
            part = train.groupBy(sign_bin(F.col(column)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg((y > 0).cast("double")).alias("rate"), F.avg(y).alias("mean")).where(F.col("n") >= LEAST_BIN).select(F.lit(name).alias("baseline"), "bin", "rate", "mean")
        else:
            continue
        parts = part if parts is None else parts.unionByName(part)
    return parts.crossJoin(F.broadcast(base)).crossJoin(F.broadcast(band))


def predict_baseline(rows: DataFrame, fitted: DataFrame, name: str, horizon: int) -> DataFrame:
    """expected_return, prob_up, band_low, band_high of one baseline; a bin without a fit takes the base."""
    column = BASELINES[name]
    bins = sign_bin(F.col(column)) if column else F.lit(None).cast("int")
    own = fitted.where(F.col("baseline") == name).select(F.col("bin").alias("__bin"), "rate", "mean")
    base = fitted.select("base_rate", "base_mean", "band_q").distinct()
    # The fitted table has one row a bin at most.
    found = rows.withColumn("__at", bins).join(F.broadcast(own), F.col("__at").eqNullSafe(F.col("__bin")), "left").crossJoin(F.broadcast(base))
    scale = horizon_scale(F.col("vol_20"), F.lit(horizon))
    point = F.coalesce("mean", "base_mean")
    prob = F.least(F.greatest(F.coalesce("rate", "base_rate"), F.lit(LOW)), F.lit(HIGH))
    return found.select(*rows.columns, point.alias("expected_return"), prob.alias("prob_up"), (point - F.col("band_q") * scale).alias("band_low"), (point + F.col("band_q") * scale).alias("band_high"))


@dataclass
class Scaling:
    """Gaps to the exact median, less the mean, over the population deviation (0 counts as 1)."""

    features: list[str]
    medians: np.ndarray
    means: np.ndarray
    deviations: np.ndarray

    @classmethod
    def fit(cls, train: DataFrame, features: Sequence[str]) -> Scaling:
        features = list(features)
        known = train.select(*(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in features))
        medians = {r["feature"]: r["quantiles"][0] for r in quantiles(known.unpivot([], features, "feature", "value"), ["feature"], "value", [0.5]).collect()}
        filled = {c: F.coalesce(F.col(c), F.lit(float(medians.get(c, 0.0)))) for c in features}
        stats = known.agg(*(f(x).alias(f"{c}__{name}") for c, x in filled.items() for name, f in (("mean", F.avg), ("sd", F.stddev_pop)))).first()
        column = lambda of, none: np.array([stats[f"{c}__{of}"] or none for c in features], float)
        return cls(features, np.array([medians.get(c, 0.0) for c in features], float), column("mean", 0.0), column("sd", 1.0))

    def values(self) -> list[Column]:
        """The standardised features as columns."""
        one = lambda c, m, mean, sd: (F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(float(m))) - F.lit(float(mean))) / F.lit(float(sd))
        return [one(*row) for row in zip(self.features, self.medians, self.means, self.deviations, strict=True)]

    def table(self) -> list[tuple[str, int, list[float]]]:
        return [(f"scaling.{name}", 0, getattr(self, name).tolist()) for name in ("medians", "means", "deviations")]

    @classmethod
    def read(cls, features: list[str], found: dict) -> Scaling:
        return cls(features, *(np.array(found[(f"scaling.{name}", 0)], float) for name in ("medians", "means", "deviations")))


@dataclass
class Linear:
    """Ridge on standardised features."""

    scaling: Scaling
    weights: np.ndarray
    intercept: float
    kind = "linear"

    def transform(self, rows: DataFrame) -> DataFrame:
        terms = (x * F.lit(float(w)) for x, w in zip(self.scaling.values(), self.weights, strict=True))
        return rows.withColumn("point", sum(terms, F.lit(float(self.intercept))))

    def contributions(self, rows: DataFrame) -> DataFrame:
        """Add contributions: an array of (feature, value), each standardised feature times its weight. Exact for this model."""
        parts = [F.struct(F.lit(f).alias("feature"), (x * F.lit(float(w))).alias("value")) for f, x, w in zip(self.scaling.features, self.scaling.values(), self.weights, strict=True)]
        return rows.withColumn("contributions", F.array(*parts))

    def table(self) -> list[tuple[str, int, list[float]]]:
        return [*self.scaling.table(), ("linear.weights", 0, self.weights.tolist()), ("linear.intercept", 0, [self.intercept])]

    @classmethod
    def read(cls, features: list[str], rows: Sequence[tuple]) -> Linear:
        found = {(kind, stage): values for kind, stage, values in rows}
        return cls(Scaling.read(features, found), np.array(found[("linear.weights", 0)], float), found[("linear.intercept", 0)][0])


def fit_linear(train: DataFrame, features: Sequence[str], target: str, alpha: float = ALPHA) -> Linear:
    """The ridge by one pass of sums of products; medians and deviations are exact."""
    scaling = Scaling.fit(train, features)
    x = F.array(*(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(float(m))) for c, m in zip(features, scaling.medians, strict=True)))
    rows = train.where(F.col(target).isNotNull()).select(F.lit(0).alias("horizon"), F.lit(0).alias("fold"), x.alias("x"), F.col(target).cast("double").alias("y"))
    moments = sums_of_products(rows, len(features)).get((0, 0))
    if moments is None:
        return Linear(scaling, np.zeros(len(features)), 0.0)
    found = ridge(moments, scaling.medians, range(len(features)), alpha)
    return Linear(scaling, found.weights * scaling.deviations, float(found.intercept + found.weights @ scaling.means))


@dataclass
class Ensemble:
    """The equal-weight mean of several models' points."""

    members: list
    kind = "ensemble"

    def transform(self, rows: DataFrame) -> DataFrame:
        out, names = rows, []
        for i, m in enumerate(self.members):
            names.append(f"__point_{i}")
            out = m.transform(out).withColumnRenamed("point", names[-1])
        return out.withColumn("point", sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)).drop(*names)

    def table(self) -> list[tuple[str, int, list[float]]]:
        return [(f"{i}/{m.kind}/{kind}", stage, values) for i, m in enumerate(self.members) for kind, stage, values in m.table()]

    @classmethod
    def read(cls, features: list[str], rows: Sequence[tuple]) -> Ensemble:
        own: dict[int, tuple[str, list]] = {}
        for kind, stage, values in rows:
            i, model, rest = kind.split("/", 2)
            own.setdefault(int(i), (model, []))[1].append((rest, stage, values))
        return cls([KINDS[model].read(features, parts) for _, (model, parts) in sorted(own.items())])


def fit_points(train: DataFrame, features: Sequence[str], target: str, kind: str, **options) -> object:
    """A regressor that adds ``point``: linear, trees, network or the ensemble of the three, whose options go by member."""
    if kind == "ensemble":
        return Ensemble([fit_points(train, features, target, k, **options.get(k, {})) for k in ("trees", "linear", "network")])
    if kind not in FITS:
        raise ValueError(kind)
    return FITS[kind](train, features, target, **options)


#: Past errors stand in a model as so many evenly spaced exact quantiles, at every size.
ERROR_LEVELS = [i / 1000 for i in range(1001)]


@dataclass
class Curve:
    """A rising piecewise-linear map of probabilities, flat beyond its ends."""

    x: np.ndarray
    y: np.ndarray

    def of(self, column: Column) -> Column:
        x, y = self.x, self.y

        @F.pandas_udf(T.DoubleType())
        def read(raw: pd.Series) -> pd.Series:
            return pd.Series(np.interp(raw.to_numpy(float), x, y) if len(x) else np.full(len(raw), 0.5))

        return read(column)


@dataclass
class HorizonModel:
    """A fitted point model with its band and its calibrated probabilities."""

    points: object  # adds ``point`` by transform()
    errors: list[float]
    band_q: float
    calibrator: Curve
    horizon: int

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add expected_return, scale, prob_up_raw, prob_up, band_low, band_high."""
        scaled = self.points.transform(rows).withColumn("scale", horizon_scale(F.col("vol_20"), F.lit(self.horizon)))
        raw = scaled.withColumn("prob_up_raw", raw_probability(self.errors)(F.col("point"), F.col("scale")))
        done = raw.withColumn("calibrated", self.calibrator.of(F.col("prob_up_raw")))
        prob = F.least(F.greatest(F.col("calibrated"), F.lit(LOW)), F.lit(HIGH))
        band = F.lit(self.band_q) * F.col("scale")
        return done.select(*rows.columns, F.col("point").alias("expected_return"), "scale", "prob_up_raw", prob.alias("prob_up"), (F.col("point") - band).alias("band_low"), (F.col("point") + band).alias("band_high"))


def raw_probability(errors: Sequence[float]):
    """Share of past normalised errors that would leave the return above 0, as a vectorised function of point and scale."""
    ordered = np.array(errors)

    @F.pandas_udf(T.DoubleType())
    def share(point: pd.Series, scale: pd.Series) -> pd.Series:
        return pd.Series(1.0 - np.searchsorted(ordered, -point / scale, side="right") / max(1, len(ordered)))

    return share


def fit_horizon(train: DataFrame, calibration: DataFrame, features: Sequence[str], horizon: int, kind: str = "trees", **options) -> HorizonModel:
    """Fit on train; band from the older half of the calibration days, probabilities from the newer."""
    target = f"y_{horizon}"
    train, calibration = (d.where(F.col(target).isNotNull()) for d in (train, calibration))
    return calibrated(fit_points(train, features, target, kind, **options), calibration, horizon)


def calibrated(points, calibration: DataFrame, horizon: int) -> HorizonModel:
    """Band and probabilities of a point model; the calibration rows are predicted once."""
    target = f"y_{horizon}"
    days = calibration.select("date").distinct().withColumn("half", F.ntile(2).over(Window.orderBy("date")))
    scored = points.transform(calibration.where(F.col(target).isNotNull()).join(days, "date")).withColumn("scale", horizon_scale(F.col("vol_20"), F.lit(horizon)))
    scored = stored(scored.select("half", "point", "scale", F.col(target).alias("y")), "calibration")
    errors = scored.where("half = 1").select(((F.col("y") - F.col("point")) / F.col("scale")).alias("error")).withColumn("size", F.abs("error"))
    found = {r["what"]: list(r["quantiles"]) for r in quantiles(errors.unpivot([], ["error", "size"], "what", "value"), ["what"], "value", ERROR_LEVELS).collect()}
    past = found.get("error", [])
    newer = scored.where("half = 2").select(raw_probability(past)(F.col("point"), F.col("scale")).alias("prob_up_raw"), (F.col("y") > 0).cast("double").alias("up"))
    fitted = IsotonicRegression(featuresCol="prob_up_raw", labelCol="up").fit(newer)
    calibrator = Curve(fitted.boundaries.toArray(), fitted.predictions.toArray())
    return HorizonModel(points, past, found["size"][ERROR_LEVELS.index(NOMINAL)] if found else 0.0, calibrator, horizon)


def ensemble(predictions: Sequence[DataFrame], keys: Sequence[str] = ("instrument_id", "date")) -> DataFrame:
    """Equal-weight mean of several models' numbers: all double columns."""
    union = predictions[0]
    for p in predictions[1:]:
        union = union.unionByName(p)
    return union.groupBy(*keys).agg(*(F.avg(c).alias(c) for c, t in predictions[0].dtypes if t == "double"))


@dataclass
class Network:
    """A small two-layer regressor over standardised features."""

    scaling: Scaling
    layers: list[tuple[np.ndarray, np.ndarray]]
    shift: float
    spread: float
    kind = "network"

    def transform(self, rows: DataFrame) -> DataFrame:
        layers, shift, spread = self.layers, self.shift, self.spread

        @F.pandas_udf(T.DoubleType())
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(forward(np.column_stack([c.to_numpy(float) for c in columns]), layers)[-1][:, 0] * spread + shift)

        return rows.withColumn("point", predict(*self.scaling.values()))

    def table(self) -> list[tuple[str, int, list[float]]]:
        return [
            *self.scaling.table(),
            ("network.output", 0, [self.shift, self.spread]),
            *(row for i, (a, b) in enumerate(self.layers) for row in ((f"network.weights.{a.shape[0]}x{a.shape[1]}", i, a.ravel().tolist()), ("network.bias", i, b.tolist()))),
        ]

    @classmethod
    def read(cls, features: list[str], rows: Sequence[tuple]) -> Network:
        found = {(kind, stage): values for kind, stage, values in rows}
        weights = {stage: np.array(v, float).reshape([int(n) for n in kind.rpartition(".")[2].split("x")]) for (kind, stage), v in found.items() if kind.startswith("network.weights")}
        layers = [(weights[i], np.array(found[("network.bias", i)], float)) for i in sorted(weights)]
        return cls(Scaling.read(features, found), layers, *found[("network.output", 0)])


def forward(x: np.ndarray, layers: list) -> list[np.ndarray]:
    out = [x]
    for i, (a, b) in enumerate(layers):
        z = out[-1] @ a + b
        out.append(np.maximum(z, 0) if i < len(layers) - 1 else z)
    return out


def slopes(x: np.ndarray, t: np.ndarray, layers: list) -> list[np.ndarray]:
    """Gradients of half the summed squared error, layer by layer: weights, then bias."""
    seen = forward(x, layers)
    back, found = seen[-1] - t[:, None], []
    for i in reversed(range(len(layers))):
        found[:0] = [seen[i].T @ back, back.sum(0)]
        back = (back @ layers[i][0].T) * (seen[i] > 0)
    return found


def summed_slopes(rows: DataFrame, layers: list) -> tuple[int, list[np.ndarray]]:
    """How many rows there are, and their summed gradients: a task adds up its own rows by slices, and each number's sum over tasks is a group.

    ``rows`` has x (an array) and t. What comes to the driver is one number a weight.
    """

    def partial(batches):
        count, total = 0, None
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float)
            if len(x):
                own = np.concatenate([g.ravel() for g in slopes(x, np.asarray(batch.column("t"), float), layers)])
                count, total = count + len(x), own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total)), pa.int32()), pa.array(np.r_[float(count), total])], ["at", "value"])

    found = dict(rows.select("x", "t").mapInArrow(partial, "at int, value double").groupBy("at").agg(F.sum("value")).collect())
    flat, shapes, out = [found.get(i, 0.0) for i in range(sum(p.size for layer in layers for p in layer))], [p.shape for layer in layers for p in layer], []
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(np.reshape(flat[:size], shape))
        flat = flat[size:]
    return int(found.get(-1, 0)), out


#: A step takes the rows of one of so many parts, dealt by a hash of the key; a part grows with the data and is spread over all tasks.
BATCHES = 4


def fit_network(
    train: DataFrame, features: Sequence[str], target: str, hidden: tuple[int, int] = (64, 32), epochs: int = 15, seed: int = 7,
    keys: Sequence[str] = ("instrument_id", "date"), rate: float = 0.01, decay: float = 1e-4,
) -> Network:
    """So many Adam steps an epoch as there are batches, each on the mean gradient of its whole batch, summed over all tasks.

    All training rows take part once an epoch. The number of steps doesn't depend on the number of rows.
    """
    spark = train.sparkSession
    train = stored(train.select(*dict.fromkeys([*keys, *features, target])), "training")
    scaling = Scaling.fit(train, features)
    mean, spread = train.agg(F.avg(F.col(target).cast("double")), F.stddev_pop(F.col(target).cast("double"))).first()
    mean, spread = mean or 0.0, spread or 1.0
    batch = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(BATCHES))
    ready = train.where(F.col(target).isNotNull()).select(batch.alias("batch"), F.array(*scaling.values()).alias("x"), ((F.col(target).cast("double") - mean) / spread).alias("t"))
    path = scratch(spark, "network")
    ready.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    parts = [part for part in (spark.read.schema(ready.schema).parquet(path).where(F.col("batch") == i) for i in range(BATCHES)) if not part.isEmpty()]
    sizes, start = [len(features), *hidden, 1], np.random.default_rng(seed)
    params = [p for a, b in zip(sizes, sizes[1:], strict=False) for p in (start.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    layers = list(zip(params[::2], params[1::2], strict=True))
    for _ in range(epochs):
        for part in parts:
            step += 1
            n, total = summed_slopes(part, layers)
            for p, g, m, v in zip(params, total, first, second, strict=True):
                g = g / n + (decay * p if p.ndim == 2 else 0.0)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    discard(path, spark)
    return Network(scaling, layers, mean, spread)


#: Models by kind, and what fits them.
KINDS = {"linear": Linear, "trees": Boosted, "network": Network, "ensemble": Ensemble}
FITS = {"linear": fit_linear, "trees": fit_boosted, "network": fit_network}


def kind_of(points: object) -> str:
    return next(name for name, kind in KINDS.items() if isinstance(points, kind))


def save_models(models: dict[int, HorizonModel], features: Sequence[str], path: str) -> None:
    """All horizons' models of any kind as one table a horizon (kind, part, stage, parameters), small whatever they were fitted on."""
    spark = SparkSession.active()
    for h, m in models.items():
        kind, curve = kind_of(m.points), m.calibrator
        rows = [(kind, part, stage, [float(v) for v in values]) for part, stage, values in m.points.table()]
        rows += [(kind, "band", 0, [float(m.band_q)]), (kind, "errors", 0, [float(v) for v in m.errors]), (kind, "curve.x", 0, curve.x.tolist()), (kind, "curve.y", 0, curve.y.tolist())]
        rows += [(kind, f"feature.{name}", i, []) for i, name in enumerate(features)]
        spark.createDataFrame(rows, "kind string, part string, stage int, parameters array<double>").write.mode("overwrite").parquet(f"{path}/h{h}")


def load_models(spark: SparkSession, path: str, horizons: Sequence[int], core: Sequence[int] = (5, 20, 60)) -> dict[int, HorizonModel]:
    """Saved models by horizon, ready to predict. A core horizon must be there; an extended one that was never saved is left out."""
    found = {}
    for h in horizons:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/h{h}")
        if h not in core and not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            continue
        rows = spark.read.parquet(f"{path}/h{h}").collect()
        own = {r["part"]: list(r["parameters"]) for r in rows if r["part"] in ("band", "errors", "curve.x", "curve.y")}
        features = [r["part"].partition(".")[2] for r in sorted((r for r in rows if r["part"].startswith("feature.")), key=lambda r: r["stage"])]
        parts = [(r["part"], r["stage"], list(r["parameters"])) for r in rows if r["part"] not in own and not r["part"].startswith("feature.")]
        found[h] = HorizonModel(KINDS[rows[0]["kind"]].read(features, parts), own["errors"], own["band"][0], Curve(np.array(own["curve.x"]), np.array(own["curve.y"])), h)
    return found
