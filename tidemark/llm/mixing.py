"""Mixing sources to target weights by capped water-filling.

Every source asks for its share of the words by weight, and may repeat its own
words ``max_epochs`` times at most. A source that would pass that cap is
clamped to it and its excess goes to the others by weight, until none is
above. The fixed point has a closed form: with sources in order of cap over
weight, the clamped ones are a prefix, and two running sums give the water
level. Each source then takes its documents whole as many times as the target
holds, plus a seeded sample for the fraction: documents in order of a hash, up
to the word budget, the one across the boundary giving the part that fits.

The order by hash is cut into ``2**12`` hash ranges; running sums over range
totals find the range with the boundary, and only its rows are ranked. No
source, however large, is sorted in one task. Only DataFrame functions are used.

Defined results: null or empty texts have size 0 and take 0; very long texts are
counted whole; a null source is a source of its own that ranks last; equal
(source, hash, id, size) rows are interchangeable; an empty table gives an empty
result; other columns, whatever their names, are carried only where ``keep``
names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash that name a range.
RANGE_DIGITS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """(source, source_size) to (source, source_size, target). One row for each source.

    Weights repeat over the sources in code point order, null last. The result
    shares out the total of all sizes.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", weight)
    capped = ranked.withColumn("cap", (F.col("source_size") * max_epochs).cast("double")).withColumn("need", F.col("cap") / F.col("weight"))
    by_need = Window.orderBy("need", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left_words = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(by_need), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_need), F.lit(0.0))
    # The level if every source before this one is clamped; the first source that it doesn't drown sets it.
    stepped = capped.withColumn("try", left_words / left_weight)
    level = F.min(F.when(F.col("try") <= F.col("need"), F.struct("need", "rank", "try"))).over(everything)["try"]
    return stepped.withColumn("level", level).select("source", "source_size", F.when(F.col("need") <= F.col("level"), F.col("cap")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: list[int], max_epochs: int = 3, seed: str = "tidemark", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Each row with size, source_size, target and taken: the words the mix takes of it, repeats counted."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(*(F.col(c).alias(f"kept_{c}") for c in keep or []), F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), order.alias("h"))
    rows = rows.withColumn("range", F.substring("h", 1, RANGE_DIGITS))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)

    # epochs: whole repetitions; budget: words of the fraction.
    fitted = targets.withColumn("epochs", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long"))
    fitted = fitted.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")).withColumn("source", F.struct("source"))
    before = F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.withColumn("before", before).withColumn("source", F.struct("source"))
    plan = starts.join(fitted, "source").select("source", "range", "source_size", "target", "epochs", F.greatest(F.col("budget") - F.col("before"), F.lit(0)).alias("room"), "range_size")
    # Structs compare null sources as equal, and stay equi-join keys.
    joined = rows.withColumn("source", F.struct("source")).join(plan, ["source", "range"])

    whole = joined.where("room = 0 or room >= range_size").withColumn("extra", F.when(F.col("room") == 0, F.lit(0)).otherwise(F.col("size")))
    used = F.coalesce(F.sum("size").over(Window.partitionBy("source", "range").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = joined.where("room > 0 and room < range_size").withColumn("used", used)
    cut = cut.withColumn("extra", F.greatest(F.least(F.col("room") - F.col("used"), F.col("size")), F.lit(0))).drop("used")
    taken = whole.unionByName(cut)
    named = [F.col(f"kept_{c}").alias(c) for c in keep or []] or [F.col("id").alias(id_col)]
    return taken.select(*named, "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"))
