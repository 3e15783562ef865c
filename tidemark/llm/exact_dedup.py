"""Exact deduplication as a stateful stream.

A streaming aggregation keyed by the SHA-256 of the text keeps, in RocksDB and
with no expiry, one small record for each digest: the largest identifier seen,
the locator (file and row) of its content, and how many rows carried it. Map
side partial aggregation means a text copied a billion times reaches its state
partition as one row a task. Digests only nominate: every hit's full text is
then compared with the text that the state's locator points to, and digests
whose texts differ are grouped again by the text itself.

Defined results: null text is the empty text; very long texts are digested and
compared whole; null identifiers rank lowest;
rows that repeat an identifier count as rows of their own, and the locator
decides which one stays; an empty table gives an empty result; other columns of
the table are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch, stored

#: Disk-backed state. Each partition would otherwise set 4 MB of disk aside for a log of a few kilobytes.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    """32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _located(table: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """digest, text and where: (id, file, row), which orders the rows that share a digest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    where = F.struct(F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return table.select(digest(text).alias("digest"), text.alias("text"), where.alias("at"))


def _watched(spark: SparkSession, path: str) -> str:
    """``path`` as a stream source takes it: a folder as it is, a lone file as a pattern that matches it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    return path if folder else f"{path[:-1]}[{path[-1]}]"


def digest_state(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None, bytes_per_trigger: int = 256 << 30) -> DataFrame:
    """Run the stream over all files at ``path`` that ``checkpoint`` has not seen; return the state.

    One row for each digest: digest, keep (id, file, row), group_size. The same
    checkpoint may be given again after more files arrive; each file is read
    once.
    """
    checkpoint = checkpoint or scratch(spark, "exact-dedup")
    schema = spark.read.parquet(path).select(id_col, text_col).schema
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_trigger)).parquet(_watched(spark, path))
    seen = _located(source, id_col, text_col, digest).groupBy("digest").agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        run = seen.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        _, value = (state.schema[k].dataType for k in ("key", "value"))
        return state.select("key.digest", F.col(f"value.`{value[0].name}`").alias("keep"), F.col(f"value.`{value[1].name}`").alias("group_size"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None, bytes_per_trigger: int = 256 << 30) -> DataFrame:
    """One row for each row of the Parquet table at ``path``: id, keep_id, group_size, kept, text_sha256."""
    state = digest_state(spark, path, id_col, text_col, digest, checkpoint, bytes_per_trigger)
    table = spark.read.parquet(path).select(id_col, text_col, "_metadata")
    rows = _located(table, id_col, text_col, digest)

    # Full bytes are compared for digests that were hit more than once. These rows are kept aside, so that all texts are shuffled once only.
    hits = stored(rows.join(state.where("group_size > 1"), "digest").select("digest", "text", "at", "keep"), "dedup-hits")
    holders = hits.where(F.col("at") == F.col("keep")).select("digest", F.col("text").alias("held"))
    # Made distinct only once written: an aggregate right above the join would forbid Spark to split a hot digest's rows.
    collided = stored(hits.join(holders, "digest").where(F.col("text") != F.col("held")).select("digest"), "dedup-collisions").distinct()

    sha = F.sha2("text", 256).alias("text_sha256")
    found = rows.select("digest", "at", sha).join(state, "digest")
    if not collided.isEmpty():
        found = found.join(collided, "digest", "left_anti").unionByName(_by_text(rows.join(collided, "digest", "left_semi")))
    return found.select(F.col("at.id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size", F.coalesce(F.col("at") == F.col("keep"), F.lit(False)).alias("kept"), "text_sha256")


def _by_text(rows: DataFrame) -> DataFrame:
    """The same columns for digests that stand for several texts: grouped by digest and text."""
    keys = ["digest", "text"]
    groups = rows.groupBy(*keys).agg(F.max("at").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, keys).select("digest", "at", F.sha2("text", 256).alias("text_sha256"), "keep", "group_size")
