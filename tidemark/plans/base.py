"""What plan modules register their queries with, and how both engines' numbers are compared."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.fixtures import written_once

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its twin where SQL has one. Within a call bars, actions and series are made from the base tables once."""

    def add(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with written_once():
                return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, as both engines are compared; NaN to null."""
    return df.select(*(F.round(F.nanvl(F.col(c), F.lit(None).cast("double")), DIGITS).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def comparable(df: DataFrame) -> DataFrame:
    """``rounded``, with an effective size to two digits (it is a ratio of two variances) and differences of nothing without a sign."""
    fields = {"n_eff": F.round("n_eff", 2)} if "n_eff" in df.columns else {}
    fields |= {c: F.round(c, DIGITS) + 0.0 for c in ("delta",) if c in df.columns}
    return rounded(df.withColumns(fields))
