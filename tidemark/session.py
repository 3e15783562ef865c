"""Session defaults and the shared working folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder and runs on one machine (tests, a laptop).
LOCAL_SHARED_DIR = "/tmp/checkpoints/tidemark"


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` overrides any default."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else, on one machine only, a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = LOCAL_SHARED_DIR
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def modest_batches(spark: SparkSession, limit: str = "4m") -> None:
    """From now on rows go to Python in Arrow batches of about ``limit``: whole texts can be long, and each task holds several batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, label)
    # This codec works on heap buffers; others keep a direct one for each file they touch until the next full collection.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let the driver notice that finished steps' shuffles are referenced no more, so that executors delete their files now."""
    gc.collect()
    spark._jvm.System.gc()


def discard(df_or_path: DataFrame | str, spark: SparkSession) -> None:
    """Delete a scratch table that nothing reads any more."""
    paths = [df_or_path] if isinstance(df_or_path, str) else df_or_path.inputFiles()
    roots = {p if isinstance(df_or_path, str) else p.rsplit("/", 1)[0] for p in paths}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)
