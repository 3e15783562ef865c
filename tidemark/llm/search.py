"""Ranked lexical search over a sharded inverted index.

Documents are cut into shards of about ``SHARD_BYTES`` of text where they lie; texts
are not shuffled. In a shard documents are ordered by doc_id, and each term has one
row of postings: gaps between the numbers of its documents and its occurrences in
them, as variable-length bytes. The index is written once and holds every term of
every document.

A search joins the items' terms to the index, so that only their postings move, to
the task of their shard. There they are read document at a time: a heap of cursors,
one for each term, gives the smallest document that any of them stands on; all
cursors on it add to its score; a second heap, bounded by ``k`` and keyed by score
then document, keeps the best. Terms that even together can't lift a document above
the worst one kept leave the heap and are only looked up (their greatest
contribution in the shard is known), which changes no result. The shards' best are
then merged for each item.

Scores are 64-bit integers: of a term's weight floor(1000 ln((2N+2)/(2df+1))) times
its saturated share (10**9 tf) div (1000 tf + 20 m), with m = 50 + (50 n N) div L.

Defined results: null texts and texts without a term are in no result and don't
count in N; a text is one posting list's entry however long; equal scores stand by
ascending doc_id, null last; rows that repeat a doc_id are documents of their own;
rows of items that share an item_id are one item with all their terms, null being
an id like others; items without terms, and items whose terms no document holds,
have no rows; either table may be empty; other columns are never read, whatever
their names.
"""

from __future__ import annotations

import heapq
import uuid
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tokens import SHARD_BYTES, byte_map, coded, shards, unvarint, varint
from tidemark.session import modest_batches, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (item, term) pairs of the items that a task searches for at a time.
BLOCK_TERMS = 50_000


def _postings(docs: pa.Table, shard: str, columns: list[str], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row for the documents (ids in order, terms in each), then one for each term."""
    docs = docs.take(pc.sort_indices(docs, sort_keys=[("id", "ascending")]))
    of, codes, words = coded(docs.column("text").combine_chunks(), byte_map(True))
    sizes = np.bincount(of, minlength=docs.num_rows)

    def rows(n: int, **made: pa.Array) -> pa.RecordBatch:
        kinds = {"shard": pa.string(), "term": pa.string(), "docs": pa.int32(), "postings": pa.binary(), "ids": pa.list_(id_type), "sizes": pa.list_(pa.int64())}
        made["shard"] = pa.array([shard] * n)
        return pa.RecordBatch.from_arrays([made.get(c, pa.nulls(n, kinds[c])) for c in columns], names=columns)

    ids = docs.column("id").combine_chunks()
    yield rows(1, ids=pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(id_type)), sizes=pa.array([sizes], pa.list_(pa.int64())))
    if not len(codes):
        return
    pairs, tf = np.unique(codes * docs.num_rows + of, return_counts=True)
    code, doc = pairs // docs.num_rows, pairs % docs.num_rows
    first = np.flatnonzero(np.diff(code, prepend=-1))
    gaps = np.diff(doc, prepend=0)
    gaps[first] = doc[first]
    data, starts = varint(np.stack([gaps, tf], 1).ravel())
    cuts = np.append(starts[:-1][2 * first], starts[-1])
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
    counts = pa.array(np.diff(np.append(first, len(code))), pa.int32())
    for at in range(0, len(first), 20_000):
        part = slice(at, at + 20_000)
        yield rows(len(first[part]), term=words.take(pa.array(code[first[part]])), docs=counts[part], postings=held[part])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index: (shard, term, docs, postings) for each term of a shard, and (shard, ids, sizes) once for each shard, with a null term."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("shard", T.StringType()), T.StructField("term", T.StringType()), T.StructField("docs", T.IntegerType()), T.StructField("postings", T.BinaryType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("sizes", T.ArrayType(T.LongType()))])
    columns = schema.fieldNames()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, limit=shard_bytes):
            # A task that is run again writes its shards anew under new names, and only one run's files stay.
            yield from _postings(part, uuid.uuid4().hex, columns, part.schema.field("id").type)

    return stored(rows.mapInArrow(build, schema), "search-index")


def top_of_shard(lists: list[tuple[list[int], list[int], int]], k: int) -> list[tuple[int, int]]:
    """The ``k`` best (score, document) over posting lists of (documents ascending, contributions, their greatest), ties to the smaller document."""
    lists = sorted(lists, key=lambda x: x[2])
    reach, total = [], 0
    for _, _, most in lists:
        total += most
        reach.append(total)  # all that the lists up to this one can add
    at = [0] * len(lists)
    best: list[tuple[int, int]] = []
    least, idle = 0, 0  # lists before ``idle`` are only looked up
    cursors = [(docs[0], i) for i, (docs, _, _) in enumerate(lists) if docs]
    heapq.heapify(cursors)
    while cursors:
        doc, score = cursors[0][0], 0
        while cursors and cursors[0][0] == doc:
            i = cursors[0][1]
            docs, adds, _ = lists[i]
            score += adds[at[i]]
            at[i] += 1
            if at[i] < len(docs):
                heapq.heapreplace(cursors, (docs[at[i]], i))
            else:
                heapq.heappop(cursors)
        for i in range(idle - 1, -1, -1):
            if score + reach[i] <= least:
                break
            docs, adds, _ = lists[i]
            at[i] = bisect_left(docs, doc, at[i])
            if at[i] < len(docs) and docs[at[i]] == doc:
                score += adds[at[i]]
        if score <= least:
            continue
        if len(best) < k:
            heapq.heappush(best, (score, -doc))
        else:
            heapq.heapreplace(best, (score, -doc))
        if len(best) == k:
            least, was = best[0][0], idle
            while idle < len(lists) and reach[idle] <= least:
                idle += 1
            if idle > was:
                cursors = [c for c in cursors if c[1] >= idle]
                heapq.heapify(cursors)
    return [(score, -doc) for score, doc in best]


def _search(found: pa.Table, docs: pa.Table, n_docs: int, n_terms: int, k: int, names: list[str]) -> pa.Table:
    """The best of one shard for the items of one block."""
    sizes = docs.column("sizes").combine_chunks().flatten().to_numpy().astype(np.int64)
    ids, m = docs.column("ids").combine_chunks().flatten(), 50 + (50 * sizes * n_docs) // n_terms
    lists, items = defaultdict(list), {}
    for weight, postings, wanted in zip(found.column("weight").to_pylist(), found.column("postings"), found.column("items").to_pylist(), strict=True):
        read = unvarint(postings.as_py())
        at, tf = np.cumsum(read[0::2]), read[1::2]
        adds = weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[at]))
        one = (at.tolist(), adds.tolist(), int(adds.max()))
        for x in wanted:
            key = repr(x["item"])
            items[key] = x["item"]
            lists[key].append(one)
    made: tuple[list, list, list] = ([], [], [])
    for key, of in lists.items():
        for score, doc in top_of_shard(of, k):
            for to, x in zip(made, (items[key], doc, score), strict=True):
                to.append(x)
    kind = found.schema.field("items").type.value_type.field("item").type
    return pa.Table.from_arrays([pa.array(made[0], kind), ids.take(pa.array(made[1], pa.int64())), pa.array(made[2], pa.int64())], names=names)


def search(index: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each item with a score above 0: item column, rank, id column, score."""
    shard_rows, term_rows = index.where("term is null").select(F.col("shard").alias("home"), "ids", "sizes"), index.where("term is not null")
    n_docs, n_terms = shard_rows.select(F.explode("sizes").alias("n")).agg(F.coalesce(F.count_if(F.col("n") > 0), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()

    terms = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(TERM), F.lit(0))
    wanted = stored(items.select(F.col(item_col).alias("item"), F.explode(F.array_distinct(terms)).alias("term")).distinct(), "search-terms")
    blocks = max(1, ceil(wanted.count() / BLOCK_TERMS))
    df = term_rows.select("term", "docs").join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    asked = wanted.withColumn("block", F.pmod(F.hash("item"), F.lit(blocks))).groupBy("term", "block").agg(F.collect_list(F.struct("item")).alias("items"))
    asked = stored(asked.join(df.withColumn("weight", weight), "term").where("weight > 0").select("term", "block", "items", "weight"), "search-weights")

    found = term_rows.select("shard", "term", "postings").join(asked, "term").select("shard", "block", "weight", "items", "postings")
    beside = shard_rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    item_type, id_type = wanted.schema["item"].dataType, index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("item", item_type), T.StructField("id", id_type), T.StructField("score", T.LongType())])

    def each(postings: pa.Table, docs: pa.Table) -> pa.Table:
        if not postings.num_rows:
            kinds = (found_item(postings), docs.schema.field("ids").type.value_type, pa.int64())
            return pa.Table.from_arrays([pa.array([], x) for x in kinds], names=["item", "id", "score"])
        return _search(postings, docs, n_docs, n_terms, k, ["item", "id", "score"])

    def found_item(t: pa.Table) -> pa.DataType:
        return t.schema.field("items").type.value_type.field("item").type

    best = found.groupBy("shard", "block").cogroup(beside.groupBy("home", "block")).applyInArrow(each, schema)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``search`` for ``items`` over an index of ``docs``."""
    return search(build_index(docs, id_col, text_col), items, k, id_col, item_col, text_col)
