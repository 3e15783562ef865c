"""Parameters of the asset classes: fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Asset:
    name: str
    calendar: str
    history_from: str
    calibration_sessions: int
    test_sessions: int
    train_sessions: int
    train_rows: int
    calibration_rows: int
    leaf_rows: int
    baselines: tuple[str, ...]
    regime_history: int
    broad_least: int  # how many tracked series make a move broad
    broad_of: int
    deadline: str


ASSETS = {
    a.name: a
    for a in (
        Asset("equity", "XNYS", "2005-01-03", 252, 504, 756, 10_000, 1_000, 500, ("naive", "momentum", "sector", "buy_hold"), 252, 3, 5, "next session's open"),
        Asset("crypto", "24/7", "2014-09-17", 365, 730, 730, 3_000, 1_000, 100, ("naive", "momentum"), 365, 5, 10, "six hours after the day's end"),
        Asset("fx", "TARGET", "1999-01-04", 252, 504, 756, 3_000, 1_000, 100, ("naive", "momentum"), 252, 4, 7, "six hours after the fixing"),
        Asset("bonds", "UST", "1990-01-02", 252, 504, 756, 3_000, 1_000, 100, ("naive", "momentum"), 252, 3, 5, "six hours after the snapshot"),
    )
}
HORIZONS = (1, 5, 20, 60, 120)


def train_stride(horizon: int) -> int:
    """Labels of neighbouring days overlap: a longer horizon needs fewer of them."""
    return max(1, horizon // 5)
