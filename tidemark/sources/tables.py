"""Stored tables: partitioned prices, packages whose columns have grown, universes, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICES = T.StructType(
    [
        T.StructField("instrument_id", T.StringType()),
        T.StructField("date", T.DateType()),
        *(T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "adj_close", "volume")),
        T.StructField("source", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("quality", T.StringType()),
    ]
)
ACTIONS = T.StructType([T.StructField("instrument_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("dividend", T.DoubleType()), T.StructField("split_ratio", T.DoubleType()), T.StructField("source", T.StringType()), T.StructField("fetched_at", T.TimestampType())])
UNIVERSE = ("instrument_id", "ticker", "name", "asset_class", "sector", "exchange_calendar", "valid_from", "valid_to", "segment", "source_symbol")


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def try_read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None where there is no file; a table that can't be read is an error."""
    fs, at = _files(spark, path)
    if not fs.exists(at) or not fs.getContentSummary(at).getFileCount():
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_years(spark: SparkSession, root: str, years: Sequence[int] | None = None, schema: T.StructType = PRICES) -> DataFrame:
    """Rows under ``root/year=YYYY``; other years' folders are not listed. Nothing stored gives an empty table."""
    full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType())])
    found = try_read(spark, root, full)
    if found is None:
        return spark.createDataFrame([], full)
    return found if years is None else found.where(F.col("year").isin(list(years)))


def stored_years(spark: SparkSession, root: str) -> list[int]:
    """The years that have a partition, in order: names of folders are listed, rows aren't read."""
    fs, at = _files(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()] if fs.exists(at) else []
    return sorted(int(n.removeprefix("year=")) for n in names if n.startswith("year=") and n.removeprefix("year=").isdigit())


def read_packages(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Packages of all ages, in folders of any depth, in the columns of ``schema``; what an old one lacks is null."""
    fs, at = _files(spark, root)
    if not fs.exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)


def read_universe(spark: SparkSession, path: str, pins: dict[str, str] | None = None) -> DataFrame:
    """A universe CSV: text columns with '' for nothing, dates, valid_to null while active. ``pins`` fixes columns such as asset_class."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in UNIVERSE])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    text = {c: F.coalesce(c, F.lit("")) for c in UNIVERSE if not c.startswith("valid_")}
    dated = {c: F.to_date(F.nullif(F.col(c), F.lit(""))) for c in ("valid_from", "valid_to")}
    return rows.withColumns(text | dated | {c: F.lit(v) for c, v in (pins or {}).items()})


def read_ticker_history(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("header", True).csv(path)
    return rows.select("instrument_id", "ticker", F.to_date("valid_from").alias("valid_from"), F.to_date(F.nullif(F.col("valid_to"), F.lit(""))).alias("valid_to"))


def read_manifests(spark: SparkSession, glob: str, schema: str | None = None) -> DataFrame:
    """One row a JSON manifest, newest session first; a file holds one or an array of them. With a schema files are read once."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(glob).withColumn("session", F.to_date("session")).orderBy(F.col("session").desc())


def conform(frame: DataFrame, source: str) -> DataFrame:
    """Provider rows with the columns and types of prices, without rows that have no close."""
    repeated = {c for c in frame.columns if frame.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"repeated columns: {sorted(repeated)}")
    wanted = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    if missing := [c for c in wanted if c not in frame.columns]:
        raise ValueError(f"missing columns: {missing}")
    typed = [F.col("ticker").cast("string").alias("ticker"), F.col("date").try_cast("date").alias("date"), *(F.col(c).try_cast("double").alias(c) for c in wanted[2:])]
    return frame.select(*typed, F.lit(source).alias("source")).where(F.col("close").isNotNull() & ~F.isnan("close"))
