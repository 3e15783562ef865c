"""Path-dependent events: nothing changes when the future is cut off, and hand-built cases."""

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import patterns as P


def walk(seed, n=1500):
    rng = np.random.default_rng(seed)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.015, n)))
    o = np.r_[c[0], c[:-1]] * np.exp(rng.normal(0, 0.003, n))
    h = np.maximum(o, c) * (1 + abs(rng.normal(0, 0.006, n)))
    low = np.minimum(o, c) * (1 - abs(rng.normal(0, 0.006, n)))
    return bars(o, h, low, c)


def bars(o, h, low, c):
    o, h, low, c = (np.asarray(x, float) for x in (o, h, low, c))
    before = np.r_[np.nan, c[:-1]]
    tr = np.fmax(h - low, np.fmax(abs(h - before), abs(low - before)))
    atr = np.r_[np.nan, pd.Series(tr).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean().to_numpy()[:-1]]
    return P.Bars(np.busday_offset("2010-01-04", np.arange(len(c))), o, h, low, c, atr)


def cut(b, n):
    return P.Bars(*(x[:n] for x in (b.date, b.open, b.high, b.low, b.close, b.atr)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_future_changes_nothing(seed):
    b = walk(seed)
    rng = np.random.default_rng(seed)
    flags = {p: rng.random(len(b)) < 0.02 for p in P.PATTERNS}
    full = P.all_events(b, P.level_walk(b), flags)
    assert len({r for _, r, _ in full}) > 40
    for n in (400, 777, 1201):
        short = cut(b, n)
        events = P.all_events(short, P.level_walk(short), {p: f[:n] for p, f in flags.items()})
        assert sorted(events) == sorted(e for e in full if e[0] < n)


def test_one_direction_a_rule():
    b = walk(4)
    events = P.all_events(b, P.level_walk(b), {p: np.zeros(len(b), bool) for p in P.PATTERNS})
    ways = {}
    for _, rule, way in events:
        assert ways.setdefault(rule, way) == way


def test_pivots_take_the_first_of_equals():
    x = np.array([1, 2, 3, 4, 5, 9, 9, 5, 4, 3, 2, 1, 0], float)
    found = P.turns(x, 5)
    assert found.row.tolist() == [5] and found.known.tolist() == [10]
    for seed in range(5):
        x = np.random.default_rng(seed).integers(0, 6, 200).astype(float)
        assert P.turns(x, 5).row.tolist() == [p for p in range(5, 195) if x[p - 5 : p + 6].argmax() == 5]


def test_lock_counts_from_the_last_kept():
    kept = P.locked([(0,), (3,), (5,), (9,), (10,)], lambda e: 0)
    assert [d for d, in kept] == [0, 5, 10]


def test_levels_need_two_pivots_and_break():
    base = np.full(120, 100.0)
    low = base - 1
    for p in (30, 50):
        low[p] = 95.0
    low[80] = 95.2  # touch
    close = base.copy()
    close[100:] = 80.0
    low[100:] = 79.0
    b = bars(base, base + 1, low, close)
    levels = P.level_walk(b)
    assert [(d, s, n) for d, s, n, _ in levels.touches if s == 1][:1] == [(80, 1, 3)]
    assert any(s == 1 and d == 100 for d, s, _ in levels.breaks)
    assert not levels.near[1][54] and levels.near[1][80]
    assert (100, "breakout_down", "short") in P.breakouts(b, levels)


def test_head_and_shoulders_is_never_early():
    for seed in range(8):
        b = walk(seed, 800)
        for day, _, state, _ in P.head_and_shoulders(b):
            assert day >= P.WIDTH and state in ("forming", "broken", "retested", "failed")


def test_structure_from_windows_equals_the_walk(spark):
    from tidemark.operators import pivots

    b = walk(6, 400)
    rows = pd.DataFrame({"instrument_id": "A", "date": pd.to_datetime(b.date).date, "open": b.open, "high": b.high, "low": b.low, "close": b.close})
    prices = spark.createDataFrame(rows)
    found = pivots.pivots(prices)
    states = [r.state for r in pivots.structure_states(prices, found).orderBy("date").collect()]
    assert states == P.daily_structure(b).tolist()
    breaks = sorted((r.date, r.rule, r.variant) for r in pivots.structure_breaks(prices, found).collect())
    assert breaks == sorted((rows["date"][d], r, v) for d, r, v, _ in P.structure_breaks(b))
