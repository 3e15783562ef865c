"""How filters overlap, for every order in which they may be applied.

Each document gets one bit a filter (it fails), read from its whole text in one pass;
texts are not shuffled. The bits, two label bits and the part then stand in packed
bitmaps, one set for each part in a batch of rows, and for each of the 2**n subsets of
filters the documents that pass all of it are one AND-NOT more than those of a smaller
subset. Their population counts (all, good, toxic) are summed over partitions: a part
has 2**n rows of counts at any size, and every figure of every order is a difference
of two of them.

The five filters: A under 100 words; B 100 * distinct words < 80 * words; C 100 * A-Z
> 10 * code points; D any of ``#$%&*|``; E the same text under a smaller doc_id. Words
are told apart within a text by 64-bit hashes, texts by SHA-256.

Defined results: a null text is empty; very long texts are read whole; a null lang
is the part ''; a null doc_id is neither smaller nor larger than another, so E never
holds for it nor through it, and it has no label; rows that repeat a doc_id are
documents of their own, with that id's labels, and none is E through the other; of
several label rows of one id the largest value counts, a null label is 0; an empty
table has no parts and so no rows; other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.wordhash import buffers, pieces, word_hashes
from tidemark.session import modest_batches, stored

FILTERS = "ABCDE"
MARKS = b"#$%&*|"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def text_failures(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3: whether each text fails A, B, C, D."""
    data, offsets = buffers(texts)
    hashes, first, _ = word_hashes(texts, lower=False)
    words = np.diff(first)
    of = np.repeat(np.arange(len(words)), words)
    order = np.lexsort((hashes, of))
    new = np.ones(len(order), bool)
    new[1:] = (of[order][1:] != of[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(of[order][new], minlength=len(words))
    upper, points = _sums((data >= 65) & (data <= 90), offsets), _sums((data & 0xC0) != 0x80, offsets)
    marked = _sums(np.isin(data, np.frombuffer(MARKS, np.uint8)), offsets)
    fails = [words < 100, 100 * distinct < 80 * words, 100 * upper > 10 * points, marked > 0]
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        texts = batch.column(2)
        data, offsets = buffers(texts)
        digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(text_failures(texts), pa.int32())], names=["id", "part", "digest", "fails"])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails) of each document; bit i of ``fails`` is the i-th filter."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    seen = stored(rows.mapInArrow(_read, f"id {kind}, part string, digest binary, fails int"), "audit-bits")
    # A copied text's rows meet in one partial minimum a task; the join is by id too, so that its copies are dealt apart.
    firsts = seen.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return seen.join(firsts, ["digest", "id"], "left").select("id", "part", F.col("fails").bitwiseOR(F.when(copy, F.lit(16)).otherwise(F.lit(0))).alias("fails"))


def subset_counts(fails: np.ndarray, good: np.ndarray, toxic: np.ndarray, n_filters: int) -> np.ndarray:
    """For each subset of filters (bit i: the i-th): documents that pass all of it, and of them the good and the toxic."""
    bits = [np.packbits((fails >> i) & 1) for i in range(n_filters)]
    labels = [np.packbits(good), np.packbits(toxic)]
    alive = [np.packbits(np.ones(len(fails), np.uint8))]
    out = np.empty((1 << n_filters, 3), np.int64)
    for subset in range(1 << n_filters):
        if subset:
            low = (subset & -subset).bit_length() - 1
            alive.append(alive[subset & (subset - 1)] & ~bits[low])
        out[subset] = [np.bitwise_count(x).sum() for x in (alive[-1], *(alive[-1] & y for y in labels))]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column(0).dictionary_encode()
        codes = parts.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        fails, good, toxic = (batch.column(i).to_numpy()[order] for i in (1, 2, 3))
        cuts = np.searchsorted(codes[order], np.arange(len(parts.dictionary) + 1))
        for part, a, b in zip(parts.dictionary, cuts[:-1], cuts[1:], strict=True):
            counts = subset_counts(fails[a:b], good[a:b], toxic[a:b], len(FILTERS))
            yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * len(counts)), pa.array(np.arange(len(counts), dtype=np.int32)), *(pa.array(c) for c in counts.T)], names=["part", "subset", "n", "good", "toxic"])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(*(F.coalesce(F.max(c), F.lit(0)).cast("int").alias(c) for c in ("quality", "toxic")))
    good, toxic = (F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)).alias(c) for c in ("quality", "toxic"))
    bits = failures(docs, id_col, text_col, part_col).join(known, "id", "left").select("part", "fails", good, toxic)
    counted = bits.mapInArrow(_count, "part string, subset int, n long, good long, toxic long")
    counts = counted.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    # 2**n rows a part, then a row for each step of each order.
    table = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", F.struct("n", "good", "toxic")))).alias("at"))
    everything = (1 << len(FILTERS)) - 1
    steps = [
        (order, step + 1, sum(1 << FILTERS.index(f) for f in order[:step]), 1 << FILTERS.index(order[step]))
        for order in map("".join, permutations(FILTERS))
        for step in range(len(FILTERS))
    ]
    plan = F.expr("array(" + ", ".join(f"struct('{o}' as filter_order, {s} as step, {b} as before, {f} as filter)" for o, s, b, f in steps) + ")")
    rows = table.withColumn("s", F.explode(plan)).select("part", "at", "s.*")

    def n(subset: object, what: str = "n"):
        return F.col("at")[subset][what]

    after, rest = F.col("before") + F.col("filter"), F.lit(everything) - F.col("filter")
    removed = n(F.col("before")) - n(after)
    return rows.select(
        "part", "filter_order", "step", n(after).alias("kept"), removed.alias("removed"),
        (n(F.lit(0)) - n(F.col("filter")) - removed).alias("redundant"),
        (n(rest) - n(F.lit(everything))).alias("unique_fails"),
        (n(F.col("before"), "good") - n(after, "good")).alias("good_lost"),
        (n(F.col("before"), "toxic") - n(after, "toxic")).alias("toxic_lost"),
        F.sum(removed).over(Window.partitionBy("part", "filter")).alias("shapley"),
    )
