"""Folds from one scan, leaf-wise trees, Shapley values and ranks by ranges, against plain numpy."""

from datetime import date, timedelta
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.assets import Asset
from tidemark.operators import boosting, ranks, shocks, walkforward
from tidemark.sources import feeds

DAY = date(2020, 1, 1)
SMALL = Asset("small", "", "", 30, 40, 80, 0, 0, 0, (), 0, 0, 0, "")


def panel(days=230, names=4, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"I{k}", DAY + timedelta(d), rng.normal(), None if rng.random() < 0.1 else rng.normal() * 3, 0.2) for d in range(days) for k in range(names)]
    table = pd.DataFrame(rows, columns=["instrument_id", "date", "a", "b", "vol_20"])
    for h in (1, 10):
        table[f"y_{h}"] = 0.02 * table.a - 0.01 * table.b.fillna(0) + rng.normal(size=len(table)) * 0.02
        last = DAY + timedelta(days - h)
        table.loc[table.date >= last, f"y_{h}"] = np.nan
    return table


@pytest.fixture(scope="module")
def walked(spark):
    table = panel()
    rows = spark.createDataFrame(table).select(*(F.nanvl(c, F.lit(None)).alias(c) if t == "double" else F.col(c) for c, t in spark.createDataFrame(table).dtypes))
    days = sorted(table.date.unique())
    calendar = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "date date, idx int")
    placed = walkforward.placed_rows(rows, walkforward.roles(rows, calendar, (1, 10), SMALL), ["a", "b"], (1, 10), ["instrument_id", "date"])
    families = {"both": ["a", "b"], "one": ["a"]}
    models = walkforward.fit_folds(placed.where("role = 'train'"), ["a", "b"], families)
    scores = walkforward.walk_forward_scores(rows, calendar, ["a", "b"], (1, 10), SMALL, families).toPandas()
    return table, days, models, scores


def by_fold(table, days, h, fold):
    """Train, band, probability and test rows of one fold, as a protocol that goes fold by fold has them."""
    idx = {d: i + 1 for i, d in enumerate(days)}
    start = SMALL.train_sessions + fold * SMALL.test_sessions
    end = max(0, start - h - 1) + 1
    known = table[table[f"y_{h}"].notna()]
    at = known.date.map(idx)
    eligible = known[at + h <= end]
    edge = end - h - SMALL.calibration_sessions
    early = eligible[eligible.date.map(idx) <= edge]
    kept = sorted(known.date.unique())[:: max(1, h // 5)]
    window = sorted(eligible[eligible.date.map(idx) > edge].date.unique())
    half = -(-len(window) // 2)
    test = table[table.date.map(idx).between(start + 1, start + SMALL.test_sessions)]
    return early[early.date.isin(kept)], eligible[eligible.date.isin(window[:half])], eligible[eligible.date.isin(window[half:])], test


def fitted(train, columns, h):
    x = train[columns].to_numpy(float)
    median = np.nanmedian(x, 0)
    filled = np.where(np.isnan(x), median, x)
    mean, sd = filled.mean(0), filled.std(0)
    z, y = (filled - mean) / sd, train[f"y_{h}"].to_numpy(float)
    w = np.linalg.solve(z.T @ z + np.eye(len(columns)), z.T @ (y - y.mean()))
    return lambda rows: (np.where(np.isnan(rows[columns].to_numpy(float)), median, rows[columns].to_numpy(float)) - mean) / sd @ w + y.mean()


@pytest.mark.parametrize("h", [1, 10])
def test_every_fold_equals_its_own_fit(walked, h):
    table, days, models, scores = walked
    folds = range((len(days) - SMALL.train_sessions) // SMALL.test_sessions)
    assert {(n, hh, f) for n, hh, f in models if hh == h} == {(n, h, f) for n in ("both", "one") for f in folds}
    for fold in folds:
        train, band, prob, test = by_fold(table, days, h, fold)
        points = {}
        for name, columns in (("both", ["a", "b"]), ("one", ["a"])):
            point = points[name] = fitted(train, columns, h)
            assert models[(name, h, fold)].n == len(train)
            got = scores[(scores.family == name) & (scores.horizon == h) & (scores.fold == fold)].sort_values(["date", "instrument_id"])
            want = test.sort_values(["date", "instrument_id"])
            assert np.allclose(got.expected_return, point(want))
            scale = max(np.sqrt(h / 252) * 0.2, 1e-4)
            errors = (band[f"y_{h}"] - point(band)) / scale
            width = np.quantile(errors.abs(), 0.9) * scale
            assert np.allclose(got.band_high - got.expected_return, width)
            assert np.allclose(got.baseline_prob, np.clip((train[f"y_{h}"] > 0).mean(), 0.01, 0.99))
            # Rising in the point, within bounds, and the newer half's own share on the whole.
            order = got.sort_values("expected_return").prob_up.to_numpy()
            assert (np.diff(order) >= -1e-12).all() and order.min() >= 0.01 and order.max() <= 0.99
        together = scores[(scores.family == "ensemble") & (scores.horizon == h) & (scores.fold == fold)].sort_values(["date", "instrument_id"])
        assert np.allclose(together.expected_return, (points["both"](want) + points["one"](want)) / 2)


def test_isotonic_pools_neighbours():
    x, up, n = np.array([100.0, 300, 500, 800]), np.array([1.0, 4, 2, 9]), np.array([4.0, 5, 10, 10])
    curve = walkforward.isotonic(x, up, n)
    assert curve[100] == 0.25 and curve[300] == curve[500] == pytest.approx(6 / 15) and curve[1000] == 0.9 and (np.diff(curve) >= 0).all()


def grown(x, y, leaves, least, ridge=1.0):
    """Best-first growth by trying every cut of every leaf: (leaf rows, value) of each leaf."""
    open_ = [np.arange(len(y))]

    def best(rows):
        out = None
        for f in range(x.shape[1]):
            gone = np.isnan(x[rows, f])
            for cut in np.unique(x[rows, f][~gone]):
                for side in (True, False) if gone.any() else (True,):
                    low = np.where(gone, side, x[rows, f] <= cut)
                    if min(low.sum(), (~low).sum()) >= least:
                        g = lambda r: y[r].sum() ** 2 / (len(r) + ridge)
                        gain = g(rows[low]) + g(rows[~low]) - g(rows)
                        if gain > 1e-12 and (out is None or gain > out[0] + 1e-12):
                            out = (gain, rows[low], rows[~low])
        return out

    while len(open_) < leaves:
        found = [(b[0], i, b) for i, r in enumerate(open_) if (b := best(r))]
        if not found:
            break
        _, i, b = max(found, key=lambda t: (t[0], -t[1]))
        open_[i : i + 1] = [b[1], b[2]]
    return sorted((sorted(r.tolist()), y[r].sum() / (len(r) + ridge)) for r in open_)


def trees_of(spark, x, y, **options):
    rows = pd.DataFrame(x, columns=[f"f{i}" for i in range(x.shape[1])]).assign(instrument_id="A", date=[DAY + timedelta(i) for i in range(len(y))], y=y)
    table = spark.createDataFrame(rows).repartition(3)
    return boosting.fit_boosted(table, [f"f{i}" for i in range(x.shape[1])], "y", bag=1, feature_share=1, **options), table


def test_first_tree_is_best_first_growth(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(160, 3)).round(1)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) ** 2 + (x[:, 1] > 0.5) + np.isnan(x[:, 2]) + rng.normal(size=160) * 0.1
    y -= y.mean()
    model, table = trees_of(spark, x, y, rounds=1, leaves=9, rate=1.0, least_rows=6)
    tree = model.trees[0]
    at = tree.leaves(x, False)
    got = sorted((np.flatnonzero(at == k).tolist(), tree.value[k]) for k in np.unique(at))
    want = grown(x, y, 9, 6)
    assert [r for r, _ in got] == [r for r, _ in want] and np.allclose([v for _, v in got], [v for _, v in want])
    assert len(got) == 9 and all(r == len(rows) for (rows, _), r in zip(got, [tree.rows[k] for k in sorted(np.unique(at), key=lambda k: np.flatnonzero(at == k).tolist())], strict=True))
    assert np.allclose(model.transform(table).orderBy("date").toPandas().point, model.predict(x))


def test_rounds_lower_the_error_over_rewrites(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REWRITE", 2)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1]
    model, _ = trees_of(spark, x, y, rounds=5, leaves=6, rate=0.5, least_rows=10)
    now, errors = np.full(len(y), model.base), []
    for t in model.trees:
        # Each tree's leaves hold the mean residual that the trees before leave.
        at, left = t.leaves(x, False), y - now
        for k in np.unique(at):
            assert t.value[k] == pytest.approx(0.5 * left[at == k].sum() / ((at == k).sum() + 1))
        now = now + np.array(t.value)[at]
        errors.append(((y - now) ** 2).mean())
    assert len(model.trees) == 5 and all(a > b for a, b in zip(errors, errors[1:], strict=False))


def test_shapley_values_equal_all_subsets(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 8))
    x[rng.random(x.shape) < 0.05] = np.nan
    y = np.nan_to_num(x[:, 0] * x[:, 1]) + np.nan_to_num(x[:, 2]) + rng.normal(size=300) * 0.1
    model, table = trees_of(spark, x, y, rounds=2, leaves=12, rate=0.5, least_rows=8)

    def expected(tree, row, known, at=0):
        f = tree.feature[at]
        if f < 0:
            return tree.value[at]
        kids = (tree.left[at], tree.right[at])
        if f in known:
            low = tree.missing_left[at] if np.isnan(row[f]) else row[f] <= tree.cut[at]
            return expected(tree, row, known, kids[0 if low else 1])
        return sum(tree.rows[k] * expected(tree, row, known, k) for k in kids) / tree.rows[at]

    got = [[c["value"] for c in r.contributions] for r in model.contributions(table).orderBy("date").collect()]
    for i in range(0, 300, 60):
        want = np.zeros(8)
        for f in range(8):
            others = [k for k in range(8) if k != f]
            for size in range(8):
                for s in combinations(others, size):
                    weight = factorial(size) * factorial(7 - size) / factorial(8)
                    want[f] += weight * sum(expected(t, x[i], {*s, f}) - expected(t, x[i], set(s)) for t in model.trees)
        assert np.allclose(got[i], want)
        mean = model.base + sum(expected(t, x[i], set()) for t in model.trees)
        assert sum(got[i]) == pytest.approx(model.predict(x[i : i + 1])[0] - mean)


def test_shares_and_staged_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(s), float(v)) for k, s, v in zip(rng.integers(0, 2, 400), rng.integers(0, 4, 400), rng.integers(0, 30, 400), strict=True)]
    table = spark.createDataFrame(rows, "k int, fold int, v double").repartition(5)
    got = ranks.shares(table, table.withColumn("at", F.col("fold")), ["k"], "v", "fold", [0, 1, 2, 3]).collect()
    assert len(got) == 400
    for r in got:
        past = [v for k, s, v in rows if k == r.k and s < r["at"]]
        assert (r.marks, r.below, r.upto) == (len(past), sum(v < r.v for v in past), sum(v <= r.v for v in past))
    for strict in (False, True):
        found = {(r.k, r.stage): (r.n, r.quantiles) for r in ranks.staged_quantiles(table, ["k"], "v", "fold", [0.5, 0.9], [0, 1, 2, 3], strict).collect()}
        for k in (0, 1):
            for s in range(4):
                past = [v for kk, ss, v in rows if kk == k and (ss < s or ss == s and not strict)]
                assert found.get((k, s)) == ((len(past), [pytest.approx(np.quantile(past, q)) for q in (0.5, 0.9)]) if past else None)


def test_expanding_ranks_by_hand(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAF", 4)
    rng = np.random.default_rng(8)
    rows = [(k, DAY + timedelta(i), None if rng.random() < 0.1 else float(rng.integers(0, 9)), float(rng.normal())) for k in ("a", None) for i in range(75)]
    table = spark.createDataFrame(rows, "k string, date date, v double, w double").repartition(4)
    got = {(r.k, r.date): (r.rv, r.rw) for r in ranks.with_expanding_ranks(table, {"rv": "v", "rw": "w"}, 5, ["k"]).collect()}
    assert len(got) == len(rows)
    for k, d, *values in rows:
        for at, x in enumerate(values):
            past = [r[2 + at] for r in rows if r[0] == k and r[1] <= d and r[2 + at] is not None]
            want = None if x is None or len(past) < 5 else (sum(p < x for p in past) + (sum(p == x for p in past) + 1) / 2) / len(past)
            assert got[(k, d)][at] == (None if want is None else pytest.approx(want))


def test_as_of_carries_over_ranges(spark):
    rng = np.random.default_rng(12)
    right = [(k, DAY + timedelta(int(i)), None if rng.random() < 0.2 else float(i)) for k in ("a", None) for i in sorted(rng.choice(400, 30, replace=False))]
    left = [(k, DAY + timedelta(i), i) for k in ("a", None, "b") for i in range(0, 400, 3)]
    r, l = spark.createDataFrame(right, "k string, date date, v double"), spark.createDataFrame(left, "k string, date date, i int")
    got = {(x.k, x.i): x.v for x in shocks.as_of(l, r, ["v"], ["k"]).collect()}
    for k, d, i in left:
        past = [x for x in right if x[0] == k and x[1] <= d]
        assert got[(k, i)] == (past[-1][2] if past else None)
    assert {x.i: x.v for x in shocks.as_of(l.where("k = 'a'"), r.where("k = 'a'"), ["v"]).collect()} == {i: got[("a", i)] for k, _, i in left if k == "a"}


def test_feed_titles_keep_their_links(spark):
    date_ = "<pubDate>Tue, 02 Jan 2024 13:45:00 GMT</pubDate>"
    item = lambda t, n: f"<item><title>{t}</title><link>https://e.example/{n}</link>{date_}</item>"
    feed = "<rss><channel>" + item("a<!-- c -->b", 1) + item("<![CDATA[c & d]]>", 2) + item("e<b>f</b>g", 3) + f"<item><title> </title><link>https://e.example/4</link>{date_}</item>" + item("h", 5) + "</channel></rss>"
    got = feeds.feed_items(spark.createDataFrame([(feed,)], "payload string"), "x", "e.example").collect()
    assert sorted((r.title, r.link[-1]) for r in got) == [("ab", "1"), ("c & d", "2"), ("efg", "3"), ("h", "5")]


def test_flat_items_read_as_xml_does(spark):
    """Items without markup in their texts are read without an XML parser, to the same texts; anything else is not flat."""
    flat = ["<item><title>a</title><link>b</link></item>", "<item>\n <title>first</title><title>second</title>\n</item>", "<item><title></title></item>", "<item><title> x > y </title></item>", "<item></item>", "<item><TITLE>n</TITLE><title>o</title></item>"]
    other = ["<item><title>a &amp; b</title></item>", "<item><title>e<b>f</b>g</title></item>", '<item><title lang="en">a</title></item>', "<item><![CDATA[c]]></item>", "<item>t<title>a</title></item>", "<item><title>a\r\nb</title></item>"]
    rows = spark.createDataFrame([(x,) for x in flat + other], "item string")
    got = rows.select(F.col("item").rlike(feeds.FLAT_ITEM).alias("flat"), F.regexp_extract("item", "<title>([^<]*)</title>", 1).alias("plain"), F.xpath_string("item", F.lit("/item/title[1]")).alias("xml")).collect()
    assert [r.flat for r in got] == [True] * len(flat) + [False] * len(other)
    assert all(r.plain == r.xml for r in got if r.flat)
