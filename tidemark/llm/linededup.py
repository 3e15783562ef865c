"""Substring deduplication by hashing lines and paragraphs.

A text is cut without gaps into pieces, each a run up to and with the next full
stop, exclamation mark, question mark or line break. A piece of at least one
word is a unit: it is normalised by lower case and single spaces and stands
under a 128-bit digest. Of equal units in the whole table the one with the
smallest (rank column, unit number) is the occurrence that stays; the others
are repeats.

What is removed is a passage: a line, a paragraph or a part of one whose units
are all repeats, neighbours of one another, and of ``least_words`` words
together. Whole lines and paragraphs are such runs, and so is a passage that was
pasted into the middle of a line, where a digest of the whole line would miss
it; a stock phrase or a heading of a few words stays, as it is no passage
(``least_words=1`` removes every repeated unit). Removed spans carry their
offsets in the original text, in code points.

Units are cut once and written. A common line is one skewed join key and one row
a task in the grouping; no group is ever gathered, and runs are found within
one text at a time.

Defined results: null and empty texts and texts of separators alone have no
units; very long texts are cut whole, their units are rows like any others; a
null rank comes first; equal rows with the same rank are the same occurrence and
stay or go together; other rows with the same rank are told apart by their texts
and ordered by unit number, of equal ones all stay; an empty table gives an empty
result; other columns pass untouched and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import modest_batches, stored

PIECE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
LEAST_WORDS = 15


def units(text: str) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(number, start, end, words, digest) of each unit."""
    number = 0
    for m in PIECE.finditer(text):
        words = m.group().lower().encode().split()
        if words:
            yield number, m.start(), m.end(), len(words), hashlib.blake2b(b" ".join(words), digest_size=16).digest()
            number += 1


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], []
        for i, text in enumerate(batch.column(2)):
            for u in units(text.as_py() or ""):
                rows.append(i)
                found.append(u)
        cols = list(zip(*found, strict=True)) if found else [()] * 5
        at = pa.array(rows, pa.int64())
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["rank", "body", "unit", "start", "end", "words", "digest"])


def _repeats(docs: DataFrame, rank_col: str, text_col: str, least_words: int) -> DataFrame:
    """The removed spans, with ``body``, the hash of the text they are in."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(rank_col).cast("long").alias("rank"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    cut = stored(rows.mapInArrow(_cut, "rank long, body long, unit int, start long, end long, words int, digest binary"), "units")
    at = F.struct("rank", "unit")
    # Written, so that the join deals both sides anew and Spark can split a common line's rows.
    firsts = stored(cut.groupBy("digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).where(F.col("first") != F.col("last")).select("digest", "first"), "firsts")
    found = cut.join(firsts, "digest").where(at != F.col("first")).drop("digest")
    # Neighbouring repeats share the difference of their number and their order among the text's repeats.
    text = Window.partitionBy("rank", "body")
    placed = found.withColumn("run", F.col("unit") - F.dense_rank().over(text.orderBy("unit"))).withColumn("copy", F.row_number().over(Window.partitionBy("rank", "body", "run", "unit").orderBy("start")))
    size = F.sum(F.when(F.col("copy") == 1, F.col("words"))).over(Window.partitionBy("rank", "body", "run"))
    return placed.withColumn("run_words", size).where(F.col("run_words") >= least_words)


def repeated_units(docs: DataFrame, rank_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Every removed span: rank column, unit, start, end, words, run_words (words of its whole passage), kept_in, kept_unit."""
    found = _repeats(docs, rank_col, text_col, least_words)
    return found.select(F.col("rank").alias(rank_col), "unit", "start", "end", "words", "run_words", F.col("first.rank").alias("kept_in"), F.col("first.unit").alias("kept_unit"))


def dedup_units(docs: DataFrame, rank_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text. One text's own spans meet in one row, which its length bounds."""
    removed = _repeats(docs, rank_col, text_col, least_words)
    spans = removed.groupBy(F.col("rank").alias("__rank"), F.col("body").alias("__body")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    same = docs[rank_col].cast("long").eqNullSafe(F.col("__rank")) & (F.xxhash64(docs[text_col]) == F.col("__body"))
    # What stays runs from the end of each span to the start of the next.
    ends, starts = F.array_prepend(F.col("__spans.end"), F.lit(0)), F.array_append(F.col("__spans.start"), F.length(docs[text_col]).cast("long"))
    kept = F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(docs[text_col], (a + 1).cast("int"), (b - a).cast("int"))), "")
    text = F.when(F.col("__spans").isNull(), docs[text_col]).otherwise(kept)
    return docs.join(spans, same, "left").select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])
