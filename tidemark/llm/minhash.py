"""Near-duplicate removal: one-permutation MinHash, banded buckets, star-shaped edges.

1. Each text becomes the sorted set of its word shingles' 64-bit hashes. One
   permutation: the top bits of a hash pick its bin and the smallest hash of a
   bin is its value; an empty bin borrows from the bin that its own fixed
   sequence of hashes (the same for every text) finds non-empty first: optimal
   densification.
2. Texts with equal sets form a class; only its smallest identifier goes on. So
   a text copied a million times is one row from here.
3. ``bands`` keys of ``rows`` bins each. In each bucket a hub is paired with
   each other member: a star, one pair fewer than members. The hub is the first
   in one order of all ids, so the bands of a group mostly agree on it. Pairs
   whose set sizes alone rule the threshold out are not formed.
4. Every pair is confirmed on the two full sets.
5. Links merge components. Every bucket that still holds several gets a second
   star, from the member with the most confirmed links.
6. The members of all buckets that hold several components after that, whatever
   their size, are joined exactly: two sets that reach the threshold share one
   of the first hashes of each in any one order of all hashes (here from rare
   to frequent), so a join on those, cut by sizes and places, has every pair of
   different components that is a link. Nothing is left to the choice of hubs.

With 40 bands of 5 rows a pair at similarity 0.8 shares no bucket with
probability ``(1 - 0.8**5)**40``, about 1e-7.

Defined results: null and empty texts and texts of separators alone have no
shingles, are linked with nothing and stay; very long texts are compared whole; a
null identifier is never linked and stays; repeated rows share their class; an
identifier with several texts has the links of them all; of several least
identifiers none can tie; an empty table gives an empty result. Only the two
named columns are read, whatever the others' names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.wordhash import mix64, pieces, shingle_set, word_hashes
from tidemark.session import discard, modest_batches, stored, sweep

#: Frequencies are summed in 2**SLOT_BITS slots by the top bits of a hash. Any order is exact; hashes that share a slot only count as more frequent.
SLOT_BITS = 20


@lru_cache
def probes(bins: int, block: int, width: int) -> np.ndarray:
    """Row i: the bins that bin i tries, attempts block*width to (block+1)*width."""
    attempt = np.arange(block * width, (block + 1) * width, dtype=np.uint64)
    seed = np.arange(1, bins + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return ((mix64(seed[:, None] + mix64(attempt)[None, :]) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of a sorted, non-empty hash set, densified."""
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    # Sorted by hash is sorted by bin: the first of each run is the bin's smallest.
    first = np.flatnonzero(np.concatenate(([True], bin_of[1:] != bin_of[:-1])))
    full = np.zeros(bins, bool)
    full[bin_of[first]] = True
    out = np.zeros(bins, np.uint64)
    out[bin_of[first]] = mix64(hashes[first])
    empty, block, width = np.flatnonzero(~full), 0, 64
    while len(empty):
        tried = probes(bins, block, width)[empty]
        found = full[tried]
        hit = found.any(axis=1)
        out[empty[hit]] = out[tried[hit, found[hit].argmax(axis=1)]]
        empty, block = empty[~hit], block + 1
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    table = sig.reshape(bands, rows)
    for k in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, k])
    return keys


SIGNED = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType(), False))])


def _signed(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, starts, _ = word_hashes(batch.column(1))
            sizes, a, b, keys = [], [], [], []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                s = shingle_set(words[lo:hi], n)
                sizes.append(len(s))
                # 128 bits that stand for the whole set.
                a.append(np.add.reduce(mix64(s)) if len(s) else np.uint64(0))
                b.append(np.add.reduce(mix64(s ^ np.uint64(0xA0761D6478BD642F))) if len(s) else np.uint64(0))
                keys.append(band_keys(signature(s, bands * rows), bands, rows) if len(s) else np.zeros(0, np.uint64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(b, np.uint64).view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in SIGNED])

    return run


def signed(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """(id, n, set_a, set_b, bands) of each row."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_signed(n, bands, rows), SIGNED)


def _confirm(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # the hub's text and set; rows come sorted by hub from the join
        for batch in pieces(batches):
            hubs, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            words, starts, _ = word_hashes(batch.column(3))
            keep = np.zeros(len(hubs), bool)
            for i in range(len(hubs)):
                # An id may stand for several texts, so it is the text that is compared.
                text = batch.column(2)[i].as_buffer()
                if last is None or text is None or not text.equals(last):
                    last, held = text, shingle_set(word_hashes(batch.column(2).slice(i, 1))[0], n)
                mine = shingle_set(words[starts[i] : starts[i + 1]], n)
                at = np.minimum(np.searchsorted(held, mine), len(held) - 1)
                both = int(np.count_nonzero(held[at] == mine)) if len(held) else 0
                keep[i] = both > 0 and 100 * both >= percent * (len(held) + len(mine) - both)
            yield pa.RecordBatch.from_arrays([pa.array(hubs[keep]), pa.array(members[keep])], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The (hub, member) pairs whose full sets reach the threshold."""
    # Each member's text travels once for each of its few pairs, the hub's once.
    with_member = pairs.join(texts.select(F.col("id").alias("member"), F.col("text").alias("member_text")), "member")
    with_both = with_member.join(texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text")), "hub")
    return with_both.select("hub", "member", "hub_text", "member_text").mapInArrow(_confirm(n, percent), "a long, b long")


def _open(members: DataFrame, hot: int, *more: Column) -> DataFrame:
    """(bucket, parts, ...) of each bucket that holds several components. ``parts`` is 1, or more in a bucket of over ``hot`` members."""
    found = members.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("c"), *more).where("low < high")
    return stored(found.withColumn("parts", F.ceil(F.col("c") / hot)).drop("low", "high", "c"), "open")


def _dealt(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """``members`` joined to their bucket's row, a hot bucket's in parts by id.

    A member is in one bucket a band, so there are at most bands * members / hot hot
    buckets, and ``hot`` grows with the members: their list is small at any size.
    """
    hot = buckets.where("parts > 1").select("bucket", "parts")
    marked = members.join(F.broadcast(hot), "bucket", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0))).drop("parts")
    copies = buckets.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return marked.join(copies, ["bucket", "part"]).drop("part")


def _stars(members: DataFrame, order: Column, percent: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """A star in every bucket that holds several components.

    ``members`` has bucket, id, n and comp. Returns the (bucket, id, n) rows of those
    buckets and the distinct (hub, member) pairs between components that sizes allow.
    """
    hub = F.min(F.struct(order.alias("o"), F.struct("id", "n", "comp").alias("hub"))).getField("hub")
    mixed = stored(_dealt(members.select("bucket", "id", "n", "comp"), _open(members, hot, hub.alias("h"))), "mixed")
    small, large = F.least("n", "h.n"), F.greatest("n", "h.n")
    pairs = mixed.where((F.col("h.comp") != F.col("comp")) & (small * 100 >= large * percent))
    return mixed.select("bucket", "id", "n"), pairs.select(F.col("h.id").alias("hub"), F.col("id").alias("member")).distinct()


def _slots(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in pieces(batches):
            words, starts, _ = word_hashes(batch.column(0))
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                slots, counts = np.unique(shingle_set(words[lo:hi], n) >> np.uint64(64 - SLOT_BITS), return_counts=True)
                total[slots.astype(np.int64)] += counts
        slots = np.flatnonzero(total)
        for at in range(0, len(slots), 1 << 16):
            part = slots[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["slot", "count"])

    return run


FIRSTS = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "comp", "n", "place", "gram")])


def _firsts(frequency, n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = frequency.value
        for batch in pieces(batches):
            words, starts, _ = word_hashes(batch.column(2))
            sizes, grams = [], []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                s = shingle_set(words[lo:hi], n)
                # A set of threshold similarity shares at least percent of this one's hashes.
                first = len(s) and len(s) + (-percent * len(s)) // 100 + 1
                order = np.lexsort((s, counts[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]))[:first]
                sizes.append(len(s))
                grams.append(s[order])
            times = [len(g) for g in grams]
            row = np.repeat(np.arange(batch.num_rows), times)
            places = np.concatenate([np.arange(t) for t in times]) if times else row
            flat = np.concatenate(grams).view(np.int64) if grams else row
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(np.array(sizes, np.int64)[row]), pa.array(places), pa.array(flat)], names=FIRSTS.names)

    return run


def exact_pairs(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(hub, member) pairs of (id, comp, text) rows in different components: every pair whose full sets reach the threshold is among them."""
    spark = texts.sparkSession
    summed = texts.select("text").mapInArrow(_slots(n), "slot long, count long").groupBy("slot").agg(F.sum("count").alias("count")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int32)
    counts[summed["slot"].to_numpy()] = np.minimum(summed["count"].to_numpy(), np.iinfo(np.int32).max)
    firsts = stored(texts.select("id", "comp", "text").mapInArrow(_firsts(spark.sparkContext.broadcast(counts), n, percent), FIRSTS), "firsts")
    # Pairs within a hash's largest component are never formed, so a large group costs its size times its strangers.
    by_comp = firsts.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("c"))
    top = by_comp.groupBy("gram").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("gram", "top")
    shared = stored(firsts.join(top, "gram"), "shared")
    discard(firsts, spark)
    x, y = shared.where("comp <> top").alias("x"), shared.alias("y")
    c = lambda name: F.col(name)
    between = (c("x.gram") == c("y.gram")) & (c("x.comp") != c("y.comp")) & ((c("y.comp") == c("y.top")) | (c("x.id") < c("y.id")))
    sizes = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    # At the first hash that two sets share, what is left of each from there on bounds all that they share.
    places = F.least(c("x.n") - c("x.place"), c("y.n") - c("y.place")) * (100 + percent) >= (c("x.n") + c("y.n")) * percent
    return x.join(y, between & sizes & places).select(F.least("x.id", "y.id").alias("hub"), F.greatest("x.id", "y.id").alias("member")).distinct()


def _merged(linked: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component) after more links: components of the graph whose nodes are the components so far."""
    of = lambda c: linked.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    named = found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    above = components(named)
    # Nodes that had no link so far are components of their own.
    fresh = above.join(linked.select(F.col("component").alias("node")), "node", "left_anti")
    moved = linked.join(above.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return stored(moved.unionByName(fresh.select("node", "component")), "components")


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80, bands: int = 40, rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, n, rep) with their class representative, and (node, component) of linked representatives."""
    spark = docs.sparkSession
    modest_batches(spark)
    marks = stored(signed(docs, id_col, text_col, shingle_words, bands, rows), "signatures")
    same = ["n", "set_a", "set_b"]
    filled = marks.where("n > 0 and id is not null")
    classes = stored(filled.groupBy(*same).agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands")), "classes")
    rows_with_rep = marks.select("id", *same).join(classes.drop("bands"), same, "left").select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep")).alias("rep"))

    hot = max(64, classes.count() // 1024)
    # An id of several rows may stand for several classes; its buckets then hold them all.
    banded = classes.select(F.col("rep").alias("id"), "n", F.col("rep").alias("comp"), F.explode("bands").alias("bucket"))
    # The first star follows one order of all ids, so that the bands of a group mostly agree on its hub.
    common = lambda k: F.xxhash64("id", F.lit(k))
    mixed, pairs = _stars(banded, common(0), percent, hot)
    wanted = mixed.select("id").distinct()
    texts = stored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi").dropDuplicates(["id", "text"]), "candidates")
    links = stored(confirmed(pairs, texts, shingle_words, percent), "confirmed")
    sweep(spark)
    linked = stored(components(links), "components")
    placed = lambda rows: rows.join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id"))
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    before, (mixed, pairs) = mixed, _stars(placed(mixed).join(degree, "id", "left"), F.struct(-F.coalesce("degree", F.lit(0)), common(1)), percent, hot)
    discard(before, spark)
    linked = _merged(linked, stored(confirmed(pairs, texts, shingle_words, percent), "confirmed"))
    sweep(spark)
    # What two stars leave open is finished exactly.
    members = _dealt(mixed, _open(placed(mixed), hot)).select("id").distinct()
    left = stored(placed(texts.join(members, "id", "left_semi")).select("id", "comp", "text"), "left")
    pairs = exact_pairs(left, shingle_words, percent)
    linked = _merged(linked, stored(confirmed(pairs, left, shingle_words, percent), "confirmed"))
    sweep(spark)
    discard(left, spark)
    discard(texts, spark)
    discard(mixed, spark)
    return rows_with_rep, linked


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80, bands: int = 40, rows: int = 5) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (smallest reachable id), kept."""
    ids, linked = near_links(docs, id_col, text_col, shingle_words, percent, bands, rows)
    found = ids.join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
