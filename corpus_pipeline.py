"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns a DataFrame; ``run`` writes each to the shared folder as Parquet
and hands the reread table on. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import decontaminated
from tidemark.llm.minhash import near_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, SHARDS
from tidemark.llm.sharding import shard
from tidemark.llm.toxicity import fit_toxicity, toxic_free
from tidemark.session import stored

TOXIC_FROM = 0.7


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.7 by a model of the labelled ones.

    Null and empty texts are scored as empty, long ones whole; rows that repeat an id are scored each by its own
    text; an empty table stays empty; other columns pass untouched.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic_free(docs, model, TOXIC_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8.

    A group's document is the one with its smallest id. Rows that share an id are judged by their own
    texts: unlike ones all stay, of equal ones one does; where such a row is linked with a row of another
    id, that one stays if its id is no repeated one. Rows without an id all stay. Other columns may have any
    name and type.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("again"))
    unnamed = docs.where("doc_id is null")
    if again.isEmpty():
        kept = near_dedup(docs, shingle_words=5, percent=80).where("kept and doc_id is not null").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(unnamed)
    # A text under a repeated id has a node of its own, after all plain ids.
    own = F.col("doc_id").cast("long")
    node = F.when(F.col("again").isNull(), own).otherwise(F.xxhash64(own, "text").bitwiseAND(F.lit((1 << 63) - 1).cast("long")))
    rows = docs.where("doc_id is not null").select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    rows = stored(rows.join(again, F.col("doc_id") == F.col("again"), "left").select(node.alias("node"), "text", "row"), "nodes")
    kept = near_dedup(rows, "node", shingle_words=5, percent=80).where("kept").select("node").distinct()
    plain = [F.col(f"row.`{c}`") for c, t in docs.dtypes if "map<" not in t]
    one = rows.join(kept, "node", "left_semi").groupBy("node").agg(F.min_by("row", F.xxhash64(*plain)).alias("row"))
    return one.select("row.*").select(*docs.columns).unionByName(unnamed)


def leave_out_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none, long ones are searched whole; rows that repeat an id go or stay by
    their own texts; an empty table stays empty, an empty benchmark removes nothing; other columns pass untouched.
    """
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(docs: DataFrame) -> DataFrame:
    """What an operator reads, and the whole row beside it, so that no column of either clashes."""
    return docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__row"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its repetitions, a part of one counting as one.

    A document of no words counts for none, but the mix has no reason to reject it: it stays once. So do null texts.
    A null source is a source. Rows that repeat an id are mixed each for itself, in the order of their ids and sizes
    where their hashes tie; an empty table stays empty; other columns pass untouched.
    """
    taken = mix(packed(docs), MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED, keep=["__row"])
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.ceil(F.col("taken") / F.col("size"))).cast("int")
    return taken.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))).select("__row.*")


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, best-fit-decreasing by bytes, and their slot in it.

    A null text counts as empty; equal texts, however many or long, share a shard; rows that repeat an id have
    slots of their own; an empty table has no shards; a column that is named like one of the new ones gives way to it.
    """
    found = shard(packed(docs), SHARDS, keep=["__row"])
    made = [c for c in found.columns if c != "__row"]
    return found.select(*(F.col(f"__row.{c}") for c in docs.columns if c not in made), *made)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_duplicates),
    ("decontaminate", leave_out_benchmark),
    ("mix", mix_sources),
    ("shard", into_shards),
]

#: The trained classifier has no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
