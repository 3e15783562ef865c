"""Labels for the trained operators: the held-out fold and the bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import modest_batches


def held_out(id_col: Column) -> Column:
    """True for the third whose label no model may see; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of about ``bound`` labelled rows at most, picked by a hash of the id.

    Only ids and labels are joined to the texts, and there are about ``bound``
    of them, so they are broadcast.
    """
    modest_batches(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("double").alias("y"))
    share = min(1.0, bound / max(1, known.count()))
    grains = 1 << 30
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(grains)) < int(share * grains))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(picked), "id")
