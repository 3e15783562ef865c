"""Writes: yearly partitions, write-once packages, monthly exports, JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.record import content_hash, months_to_write


def write_years(rows: DataFrame, root: str, date: str = "date") -> None:
    """One folder a year, in key order; only the years that ``rows`` holds are replaced. A year is written by as many tasks as its share of the rows."""
    keyed = rows.withColumn("year", F.year(date)).repartitionByRange("year", "instrument_id", date).sortWithinPartitions("year", "instrument_id", date)
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(root)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_package(rows: DataFrame, path: str) -> str:
    """Write a package that must not exist yet: saved or already_saved."""
    at = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).exists(at):
        return "already_saved"
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return "saved"


def manifest(rows: DataFrame, made_at: Column, family: str, version: str) -> DataFrame:
    """One manifest row a session: horizons, instruments, rows and the fingerprint of its content."""
    facts = rows.groupBy("session").agg(F.sort_array(F.collect_set("horizon")).alias("horizons"), F.count_distinct("instrument_id").alias("instruments"))
    return content_hash(rows, ["forecast_id"]).join(facts, "session").select("session", made_at.alias("made_at"), F.lit(family).alias("model_family"), F.lit(version).alias("model_version"), "horizons", "instruments", F.col("rows").alias("forecasts"), "sha256")


def write_months(outcomes: DataFrame, existing: DataFrame, root: str, now: Column) -> DataFrame:
    """CSV and Parquet of the months that changed lately or have no file; returns the months written."""
    wanted = months_to_write(outcomes, existing, now)
    keyed = outcomes.withColumn("month", F.date_format("target_session", "yyyy-MM")).join(wanted.select("month"), "month", "left_semi")
    shown = keyed.select(*(F.format_string("%.6g", c).alias(c) if t == "double" else F.col(c) for c, t in keyed.dtypes))
    for kind, table in (("csv", shown), ("parquet", keyed)):
        table.repartitionByRange("month", "instrument_id", "session").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy("month").format(kind).save(f"{root}/{kind}")
    return wanted


def patched(entries: DataFrame, fresh: DataFrame, key: str = "id", stamp: str = "resolved_at") -> DataFrame:
    """``entries`` with the fresh outcome's columns where none is stamped yet: what is resolved stays as it was, so a second run changes nothing."""
    fields = [c for c in fresh.columns if c != key]
    known = fresh.select(key, *(F.col(c).alias(f"__new_{c}") for c in fields))
    takes = F.col(stamp).isNull() & F.col(f"__new_{stamp}").isNotNull()
    kept = {c: F.when(takes, F.col(f"__new_{c}")).otherwise(F.col(c)) for c in fields}
    return entries.join(known, key, "left").select(*(kept[c].alias(c) if c in kept else F.col(c) for c in entries.columns))


def write_documents(documents: DataFrame, root: str, key: str = "instrument_id") -> None:
    """JSON documents, one folder a key. There is one row a key, so it is written where it is."""
    documents.write.mode("overwrite").partitionBy(key).text(root)
