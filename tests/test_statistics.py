"""Bootstrap, correction, verdicts, rolling windows, models."""

from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import bootstrap, boosting, evaluate, models, ranks, resolve, returns, rolling, shocks, technical

DAY = date(2020, 1, 1)


def panel(spark, values, name="A"):
    return spark.createDataFrame([(name, DAY + timedelta(i), v) for i, v in enumerate(values)], "instrument_id string, date date, close double")


def test_exponential_mean_ages_over_gaps(spark):
    x = [1.0, None, 2.0, 3.0, None, None, 4.0]
    got = rolling.exponential_means(panel(spark, x), {"m": ("close", 0.5, 1)}, ["instrument_id", "date"]).orderBy("date").collect()
    want = pd.Series(x, dtype=float).ewm(alpha=0.5, adjust=False, min_periods=1).mean()
    assert np.allclose([r.m for r in got], want, equal_nan=True)


@pytest.mark.parametrize("alpha", [2 / 201, 1 / 14, 0.5, 0.99])
def test_exponential_means_over_blocks_equal_one_walk(spark, alpha):
    rng = np.random.default_rng(11)
    n = 900
    whole = rng.normal(size=n).cumsum() + 50
    gaps, late, short, none = whole.copy(), whole.copy(), whole[:3].copy(), np.full(300, np.nan)
    gaps[rng.random(n) < 0.3] = np.nan
    gaps[100:420] = np.nan  # more than two blocks without a value
    late[:200] = np.nan
    series = {"whole": whole, "gaps": gaps, "late": late, "short": short, "none": none}
    rows = [(k, DAY + timedelta(int(i) * (3 if k == "whole" else 1)), None if np.isnan(v) else float(v), float(i)) for k, x in series.items() for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "instrument_id string, date date, close double, other double").repartition(7)
    found = rolling.exponential_means(table, {"m": ("close", alpha, 14), "o": ("other", 0.1, 1)}, ["instrument_id", "date"]).orderBy("date").toPandas()
    assert len(found) == len(rows) and list(found.columns) == ["instrument_id", "date", "close", "other", "m", "o"]
    for k, x in series.items():
        got = found[found.instrument_id == k]
        assert np.allclose(got.m.astype(float), pd.Series(x).ewm(alpha=alpha, adjust=False, min_periods=14).mean(), rtol=1e-10, equal_nan=True)
        assert np.allclose(got.o, pd.Series(np.arange(len(x), dtype=float)).ewm(alpha=0.1, adjust=False).mean(), rtol=1e-10)
    empty = rolling.exponential_means(table.limit(0), {"m": ("close", alpha, 14)}, ["instrument_id", "date"])
    assert empty.count() == 0
    with pytest.raises(ValueError, match="alpha"):
        rolling.exponential_means(table, {"m": ("close", 1.0, 1)}, ["instrument_id", "date"])


def test_guarded_windows_want_every_row(spark):
    x = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    got = [r.s for r in panel(spark, x).select("date", rolling.guarded(F.stddev_samp, F.col("close"), 3).alias("s")).orderBy("date").collect()]
    want = pd.Series(x, dtype=float).rolling(3).std()
    assert [g is None for g in got] == want.isna().tolist() and got[-1] == pytest.approx(want.iloc[-1])


def test_total_return_with_dividends_and_gaps(spark):
    prices = panel(spark, [100.0, 110.0, None, 121.0, 121.0])
    paid = spark.createDataFrame([("A", DAY + timedelta(1), 5.0), ("A", DAY + timedelta(1), 6.0)], "instrument_id string, date date, dividend double")
    got = [r.tr_close for r in returns.total_return(prices, paid).orderBy("date").collect()]
    assert np.allclose(got, [1.0, 1.21, 1.21, 1.21, 1.21])


def test_returns_hold_where_total_return_is_beyond_a_double(spark):
    """Dividends of twice the price a day: e^1.1 a day, past e^709 after some 650 days."""
    n = 900
    rng = np.random.default_rng(3)
    close = (100 * np.exp(rng.normal(0, 0.01, n))).tolist()
    prices = panel(spark, close).withColumns({c: F.col("close") for c in ("open", "high", "low")} | {"volume": F.lit(1.0)})
    paid = prices.select("instrument_id", "date", F.lit(200.0).alias("dividend"), F.lit(1.0).alias("split_ratio"))
    step = pd.Series([np.nan, *np.log((np.array(close[1:]) + 200) / np.array(close[:-1]))])
    total = returns.total_return(prices, paid)
    assert total.where("tr_close = double('inf')").count() > 100
    rows = returns.with_targets(total, [5], "tr_log").orderBy("date").toPandas()
    assert np.allclose(rows.y_5, step[::-1].rolling(5).sum()[::-1].shift(-1), equal_nan=True)
    made = technical.features(total, "tr_log").orderBy("date").toPandas()
    assert np.allclose(made.ret_20, step.rolling(20).sum(), equal_nan=True)
    assert np.allclose(made.vol_20, step.rolling(20).std() * np.sqrt(252), equal_nan=True)
    frame = shocks.instrument_frame(prices, paid).orderBy("date").toPandas()
    assert np.allclose(frame.sigma_before.astype(float), step.rolling(20).std().shift(1), equal_nan=True)


def test_outcomes_beyond_a_double(spark):
    """Back from beyond is minus infinity, which is no rise; between two ends beyond is no number, a rise in every engine."""
    inf = float("inf")
    series = spark.createDataFrame([("A", DAY + timedelta(i), v) for i, v in enumerate([1.0, inf, inf, 2.0])], "instrument_id string, date date, tr_close double")
    due = spark.createDataFrame([("A", DAY + timedelta(i), DAY + timedelta(i + 1), 0.6, 0.5, -1.0, 1.0) for i in range(3)], "instrument_id string, session date, target_session date, prob_up double, baseline_prob double, band_low double, band_high double")
    got = resolve.resolve_due(due, series, F.lit("2100-01-01").cast("date")).orderBy("session").collect()
    assert [str(r.actual_return) for r in got] == ["inf", "nan", "-inf"]
    assert [r.hit for r in got] == [1.0, 1.0, 0.0] and [r.covered for r in got] == [0.0, 0.0, 0.0]


def test_baselines_stay_without_a_known_error(spark):
    rows = spark.createDataFrame([(float("nan"), 0.1, 0.2)] * 120, "y_5 double, vol_20 double, ret_20 double")
    got = {(r.baseline, r.bin): (r.rate, r.band_q) for r in models.fit_baselines(rows, "y_5", 5).collect()}
    assert got == {("naive", None): (1.0, None), ("momentum", 1): (1.0, None), ("buy_hold", None): (1.0, None)}


def test_expanding_rank_equals_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 20, 80).astype(float).tolist()
    x[5] = None
    got = [r.p for r in ranks.with_expanding_ranks(panel(spark, x), {"p": "close"}, 10).orderBy("date").collect()]
    want = pd.Series(x, dtype=float).expanding(min_periods=10).rank(pct=True)
    assert np.allclose(np.array(got, float), want, equal_nan=True)


def test_quantiles_equal_numpy(spark):
    """Over many ranges, with ties, a hot key, a key of one value, a null key and values that are missing."""
    rng = np.random.default_rng(4)
    rows = [("hot", float(v)) for v in rng.integers(0, 300, 4000)] + [("few", 2.0), ("few", 1.0), ("one", 7.0), (None, 3.0), (None, 4.0), ("few", None), ("few", float("nan")), ("none", None)]
    levels = [0.0, 0.005, 0.1, 0.5, 0.9, 0.995, 1.0]
    table = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: (r.n, r.quantiles) for r in ranks.quantiles(table, ["k"], "v", levels).collect()}
    for key in ("hot", "few", "one", None):
        own = np.array([v for k, v in rows if k == key and v is not None and v == v])
        assert got[key][0] == len(own) and np.allclose(got[key][1], np.quantile(own, levels))
    assert set(got) == {"hot", "few", "one", None}


def test_standardiser_equals_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(3, 2, (300, 2))
    x[::7, 0] = np.nan
    rows = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": 1.5})
    ready = spark.createDataFrame(rows)
    got = np.array([r.x for r in ready.select(F.array(*models.Scaling.fit(ready, ["a", "b", "c"]).values()).alias("x")).collect()])
    x[:, 0] = np.where(np.isnan(x[:, 0]), np.nanmedian(x[:, 0]), x[:, 0])
    want = np.column_stack([(x - x.mean(0)) / x.std(0), np.zeros(300)])
    assert np.allclose(np.sort(got, axis=0), np.sort(want, axis=0))


@pytest.mark.parametrize("cut", [60, 120])
def test_features_never_see_the_future(spark, cut):
    rng = np.random.default_rng(cut)
    n = 160
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
    rows = pd.DataFrame({"instrument_id": "A", "date": [DAY + timedelta(i) for i in range(n)], "open": c * 1.001, "high": c * 1.01, "low": c * 0.99, "close": c, "volume": rng.uniform(1e3, 2e3, n), "tr_close": c})
    other = rows.copy()
    other.loc[cut:, ["open", "high", "low", "close", "tr_close"]] *= rng.uniform(0.5, 2, (n - cut, 1))
    a, b = (technical.features(spark.createDataFrame(r)).orderBy("date").limit(cut).toPandas() for r in (rows, other))
    pd.testing.assert_frame_equal(a, b)


def test_bootstrap_finds_no_difference_where_there_is_none(spark):
    rows = []
    for seed in range(60):
        rng = np.random.default_rng(seed)
        shared = np.convolve(rng.normal(size=219), np.ones(20) / 20, "valid")
        rows += [(seed, 20, DAY + timedelta(i), 40, float(d * 40), 0.0, float(d * 40), float(d * d * 40)) for i, d in enumerate(shared + rng.normal(0, 0.2, 200))]
    cells = spark.createDataFrame(rows, "seed int, horizon int, day date, n long, model double, base double, d double, dd double")
    found = evaluate.compared(cells, ["seed"], 20, reps=400).collect()
    assert len(found) == 60 and sum(r.p_value < 0.05 for r in found) <= 12


def test_bootstrap_repetitions_by_hand(spark):
    rng = np.random.default_rng(2)
    d, n = rng.normal(size=9), rng.integers(1, 5, 9)
    u, w = bootstrap.draws(0, 30, 9, 7)
    got = bootstrap.chunk_means(np.cumsum(d), np.cumsum(n), 3, 9, u, w)
    for r in range(30):
        days: list[int] = []
        for j in range(9):
            length = 1 + int(np.floor(w[r, j] / np.log(1 - 1 / 3)))
            days += [(int(u[r, j] * 9) + k) % 9 for k in range(min(length, 9 - len(days)))]
        assert len(days) == 9 and got[r] == pytest.approx(d[days].sum() / n[days].sum())


def test_normal_quantile_in_sql(spark):
    ps = [0.9, 0.5, 0.2, 1e-3, 1e-9, 1e-14, 1.0, 0.0, None]
    rows = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.z for r in rows.select(F.expr(bootstrap.z_of_p_sql("p")).alias("z")).collect()]
    for p, z in zip(ps, got, strict=True):
        assert z == pytest.approx(8.0 if not p else abs(NormalDist().inv_cdf(p / 2)), abs=1e-9)


def test_comparison_and_effective_size(spark):
    rng = np.random.default_rng(1)
    rows = [(5, "direction_accuracy", DAY + timedelta(d), float(m), float(b)) for d in range(120) for m, b in zip(rng.random(20) < 0.6, rng.random(20) < 0.5, strict=True)]
    long = spark.createDataFrame(rows, "horizon int, metric string, day date, model double, base double")
    r = evaluate.records(long, ["horizon", "metric"], []).first()
    assert r.n == 2400 and 1 <= r.n_eff <= 2400 and r.verdict == "better_significant"
    assert r.delta == pytest.approx(np.mean([m - b for *_, m, b in rows]))
    few = evaluate.records(long.limit(20), ["horizon", "metric"], []).first()
    assert few.verdict == "too_early" and few.p_value is None and few.n_tests == 1


def test_correction_by_hand(spark):
    ps = [0.01, 0.04, 0.03, 0.03, None, 0.8]
    rows = spark.createDataFrame([(i, 5, p) for i, p in enumerate(ps)] + [(9, 1, 0.04)], "i int, horizon int, p_value double")
    got = {r.i: (r.p_value_fdr, r.n_tests) for r in evaluate.corrected(rows, []).collect()}
    known = sorted(p for p in ps if p is not None)
    want = {p: min(1.0, min(q * len(known) / (k + 1) for k, q in enumerate(known) if q >= p)) for p in known}
    for i, p in enumerate(ps):
        assert got[i] == ((pytest.approx(want[p]) if p is not None else None), 6)
    assert got[9] == (0.04, 1)


@pytest.mark.parametrize(
    ("metric", "delta", "n", "n_eff", "p", "want"),
    [
        ("direction_accuracy", 0.1, 29, 29.0, 0.001, "too_early"),
        ("direction_accuracy", 0.1, 100, 50.0, 0.01, "better_significant"),
        ("direction_accuracy", 0.1, 100, 20.0, 0.01, "better_not_significant"),
        ("direction_accuracy", 0.004, 100, 50.0, 0.5, "same"),
        ("direction_accuracy", -0.1, 100, 50.0, 0.01, "worse"),
        ("brier", -0.1, 100, 50.0, 0.01, "better_significant"),
        ("brier", 0.1, 100, 50.0, 0.01, "worse"),
        ("coverage", 0.02, 100, 50.0, 0.01, "same"),
        ("coverage", -0.03, 100, 50.0, 0.01, "worse"),
        ("direction_accuracy", 0.1, 100, 50.0, None, "better_not_significant"),
    ],
)
def test_verdicts(spark, metric, delta, n, n_eff, p, want):
    row = spark.createDataFrame([(metric, delta, n, n_eff, p)], "metric string, delta double, n long, n_eff double, p_value_fdr double")
    assert row.select(evaluate.verdict(F.col("metric")).alias("v")).first().v == want


def test_observations_needed(spark):
    row = spark.createDataFrame([(0.02, 400.0, 0.3), (0.0, 400.0, 0.3), (0.02, 1.0, 0.3)], "delta double, n_eff double, p_value double")
    got = [r.o for r in row.select(evaluate.observations_needed().alias("o")).collect()]
    z = abs(NormalDist().inv_cdf(0.15))
    assert got == [int(np.ceil((2.801585219 / z * 20) ** 2)), 0, 0]


def test_conformal_band_covers(spark):
    rng = np.random.default_rng(3)
    n = 1200
    x = rng.normal(size=n)
    rows = pd.DataFrame({"instrument_id": "A", "date": [DAY + timedelta(i) for i in range(n)], "x": x, "vol_20": 0.2, "y_5": 0.02 * x + 0.02 * rng.normal(size=n)})
    rows.loc[::50, "x"] = None
    table = spark.createDataFrame(rows)
    parts = [table.where(f"date < '{DAY + timedelta(500)}'"), table.where(f"date >= '{DAY + timedelta(500)}' and date < '{DAY + timedelta(900)}'"), table.where(f"date >= '{DAY + timedelta(900)}'")]
    for kind in ("linear", "trees", "network"):
        options = {"rounds": 12, "rate": 0.3, "least_rows": 20, "leaves": 8} if kind == "trees" else {}
        got = models.fit_horizon(parts[0], parts[1], ["x"], 5, kind, **options).predict(parts[2]).toPandas()
        inside = ((got.band_low <= got.y_5) & (got.y_5 <= got.band_high)).mean()
        assert 0.84 <= inside <= 0.96
        assert got.prob_up.between(0.01, 0.99).all()
        assert ((got.prob_up > 0.5) == (got.y_5 > 0)).mean() > 0.6
    network = models.fit_network(parts[0], ["x"], "y_5", epochs=6)
    found = network.transform(parts[2]).toPandas()
    assert np.corrcoef(found.point, found.y_5)[0, 1] > 0.5
    again = models.fit_network(parts[0].repartition(5), ["x"], "y_5", epochs=6)
    assert all(np.allclose(p, q) for one, two in zip(network.layers, again.layers, strict=True) for p, q in zip(one, two, strict=True))
    fitted = models.fit_horizon(parts[0], parts[1], ["x"], 5, "linear")
    share = fitted.points.contributions(parts[2]).first().contributions
    assert [c.feature for c in share] == ["x"]


@pytest.mark.parametrize("kind", ["linear", "trees", "network", "ensemble"])
def test_saved_models_predict_as_before(spark, tmp_path, monkeypatch, kind):
    rng = np.random.default_rng(5)
    n = 900
    rows = pd.DataFrame({"instrument_id": "A", "date": [DAY + timedelta(i) for i in range(n)], "x": rng.normal(size=n), "z": rng.normal(size=n), "vol_20": 0.2})
    rows["y_5"] = 0.02 * rows.x + 0.02 * rng.normal(size=n)
    rows.loc[::40, "z"] = None
    table = spark.createDataFrame(rows)
    monkeypatch.setitem(models.FITS, "trees", lambda *a: boosting.fit_boosted(*a, rounds=2, leaves=5, least_rows=30))
    monkeypatch.setitem(models.FITS, "network", lambda *a: models.fit_network(*a, epochs=1))
    model = models.fit_horizon(table.where(f"date < '{DAY + timedelta(400)}'"), table.where(f"date >= '{DAY + timedelta(400)}'"), ["x", "z"], 5, kind)
    models.save_models({5: model}, ["x", "z"], str(tmp_path / "m"))
    loaded = models.load_models(spark, str(tmp_path / "m"), (5, 120), core=(5,))
    assert set(loaded) == {5} and models.kind_of(loaded[5].points) == kind
    one, two = (m.predict(table).orderBy("date").toPandas() for m in (model, loaded[5]))
    pd.testing.assert_frame_equal(one, two)
    with pytest.raises(Exception, match="h20|PATH_NOT_FOUND"):
        models.load_models(spark, str(tmp_path / "m"), (20,), core=(20,))


def test_network_slopes_over_tasks_equal_one_process(spark):
    rng = np.random.default_rng(8)
    x, t = rng.normal(size=(300, 3)), rng.normal(size=300)
    layers = [(rng.normal(size=(a, b)), rng.normal(size=b)) for a, b in ((3, 5), (5, 4), (4, 1))]
    rows = spark.createDataFrame([(v.tolist(), float(y)) for v, y in zip(x, t, strict=True)], "x array<double>, t double")
    n, got = models.summed_slopes(rows.repartition(9), layers)
    want = models.slopes(x, t, layers)
    assert n == 300 and all(np.allclose(g, w, rtol=0, atol=1e-9) for g, w in zip(got, want, strict=True))
    # Against differences of the loss itself.
    loss = lambda: 0.5 * ((models.forward(x, layers)[-1][:, 0] - t) ** 2).sum()
    for i, at in ((0, (1, 2)), (1, (4, 0)), (2, (3, 0))):
        w, eps = layers[i][0], 1e-6
        w[at] += eps
        up = loss()
        w[at] -= 2 * eps
        down = loss()
        w[at] += eps
        assert got[2 * i][at] == pytest.approx((up - down) / (2 * eps), rel=1e-4)
    assert models.summed_slopes(rows.limit(0), layers)[0] == 0


def test_linear_fit_equals_ridge(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 2)) * [1.0, 3.0] + [0.5, -2.0]
    x[::17, 1] = np.nan
    y = np.nan_to_num(x) @ [0.3, -0.1] + rng.normal(size=400) * 0.2
    table = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y_5": y}))
    fitted = models.fit_points(table, ["a", "b"], "y_5", "linear")
    got = fitted.contributions(fitted.transform(table)).orderBy("a").toPandas()
    filled = np.where(np.isnan(x), np.nanmedian(x, 0), x)
    z = (filled - filled.mean(0)) / filled.std(0)
    w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean()))
    order = np.argsort(x[:, 0])
    assert np.allclose(got.point, (z @ w + y.mean())[order])
    assert np.allclose([[c["value"] for c in r] for r in got.contributions], (z * w)[order])
