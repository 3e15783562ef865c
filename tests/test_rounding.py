"""Rounding as the SQL rounds."""

import duckdb
from pyspark.sql import functions as F

from tidemark.functions import scalar


def test_shares_are_rounded_as_in_sql(spark):
    """Shares of 1 to 2,560 days that end in a tie at six digits, which the double times a million often is not."""
    pairs = [(k, n) for n in (128, 640, 1280, 1600, 2560) for k in range(1, n)]
    shares = spark.createDataFrame(pairs, "k int, n int").select("k", "n", scalar.to_digits(F.col("k") / F.col("n"), 6).alias("s"), F.round(F.col("k") / F.col("n"), 6).alias("decimal")).collect()
    text = ", ".join(f"({k}, {n})" for k, n in pairs)
    want = {(k, n): s for k, n, s in duckdb.connect().sql(f"SELECT k, n, round(k / n, 6) FROM (VALUES {text}) t(k, n)").fetchall()}
    assert all(r.s == want[r.k, r.n] for r in shares)
    assert any(r.decimal != want[r.k, r.n] for r in shares)
