"""Bars and actions: what they are, and how often a flow reads the trades they are made from."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import registry
from tidemark.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture
def reads(monkeypatch):
    seen, read = [], fx.read
    monkeypatch.setattr(fx, "read", lambda spark, sf_dir, table: seen.append(table) or read(spark, sf_dir, table))
    return seen


NAMES = ("a26_screener", "a27_documents", "a34_document_keys", "m08_linear_conformal")


@pytest.mark.parametrize("name", NAMES)
def test_trades_are_read_once(spark, reads, name):
    registry.QUERIES[name](spark, SF)
    assert reads.count("lineitem") == 1
    assert reads.count("orders") <= 2  # the macro series and the official days
    assert fx._WRITTEN.get() is None


@pytest.mark.parametrize("level", ["region", "nation"])
def test_bars_and_actions_are_those_of_the_trades(spark, level):
    order = F.struct(*fx.TRADE_ORDER)
    rows = fx.trades(spark, SF, level)
    bars = rows.groupBy("instrument_id", "date").agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("l_quantity").alias("volume"), F.min("sector").alias("sector"))
    pays, splits = (F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 50 == 0), F.col("l_orderkey") % 997 == 0
    acts = rows.where(pays | splits).groupBy("instrument_id", "date").agg(F.round(F.sum(F.when(pays, 0.01 * F.col("price")).otherwise(0.0)), 9).alias("dividend"), F.product(F.when(splits, 2.0).otherwise(1.0)).alias("split_ratio"))
    with fx.written_once():
        own, paid = fx.panel(spark, SF, level), fx.actions(spark, SF, level).withColumn("dividend", F.round("dividend", 9))
        assert own.exceptAll(bars).isEmpty() and bars.exceptAll(own).isEmpty() and not own.isEmpty()
        assert paid.exceptAll(acts).isEmpty() and acts.exceptAll(paid).isEmpty() and not paid.isEmpty()


def test_trades_are_sorted_by_a_single_number(spark):
    plan = fx.trade_days(spark, SF)._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"Sort \[(.*?)\], (?:true|false)", plan)
    assert sorts and all(order.count("NULLS") == 1 for order in sorts)


def test_days_of_nations_stay_apart_and_a_missing_day_is_one(spark, tmp_path):
    for table in ("supplier", "nation", "region"):
        fx.read(spark, SF, table).write.parquet(f"{tmp_path}/{table}.parquet")
    early, late = "TIMESTAMP '0001-01-01'", "TIMESTAMP '9999-12-31 23:59:59'"
    day = F.expr(f"CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN {early} WHEN 2 THEN {late} WHEN 3 THEN TIMESTAMP '1969-12-31 12:00:00' ELSE l_shipdate END")
    fx.read(spark, SF, "lineitem").withColumn("l_shipdate", day).write.parquet(f"{tmp_path}/lineitem.parquet")
    order = F.struct(*fx.TRADE_ORDER)
    same = fx.trades(spark, str(tmp_path), "nation").groupBy(F.col("instrument_id").alias("nation"), "date").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.sum("l_quantity").alias("volume"))
    own = fx.trade_days(spark, str(tmp_path)).select("nation", "date", "first", "last", "volume")
    assert own.exceptAll(same).isEmpty() and same.exceptAll(own).isEmpty()
    assert own.where("date is null").count() == own.select("nation").distinct().count()
