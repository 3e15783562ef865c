"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal keys (here: equal texts) form a group that no shard boundary
may cut. Groups go by falling size into the shard with the tightest remaining
capacity, found in a treap keyed by (remaining, bin). For a fixed number of
shards the capacity is the smallest that a search from the fair share upwards
finds.

Groups of one size may stand in for one another, so what is packed is the
histogram (size, number of groups): the tightest bin that takes one group of a
size stays the tightest as long as it takes another, so each step of the
packing fills one bin with as many groups of the size as fit. Every group is
packed as best-fit-decreasing packs it, one by one, and groups of one size are
handed to their bins in the order of their digests. Different sizes that add up
to ``b`` bytes are at most ``sqrt(2 b)``; nothing else comes to the driver.

Neither ranks nor slots sort a size or a shard in one task: rows are counted by
hash range, running sums of the counts give each range its first number, and
only ranges are ranked. Rows of one group are dealt over hash ranges of their
identifiers, so that a group that holds a third of all rows is many small cells.
Texts are read once, for their sizes and digests, or, where whole rows are kept,
travel once, to their cell.

Defined results: null text has size 1 (no bytes plus 1) and groups with the
empty text; a very long text is one group like any other, and a group of more
than a fair share makes its shard that large; repeated rows each get a slot;
ties in size go by digest, ties within a group by identifier, equal rows are
interchangeable; an empty table gives an empty result; other columns, whatever
their names, are carried only where ``keep`` names them.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

RANGES = 8192


class _Node:
    __slots__ = ("key", "left", "priority", "right")

    def __init__(self, key: tuple[int, int], priority: float):
        self.key, self.priority, self.left, self.right = key, priority, None, None


class RemainingTree:
    """A treap over (remaining capacity, bin)."""

    def __init__(self, seed: int = 1):
        self.root: _Node | None = None
        self.rng = random.Random(seed)

    def _split(self, node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
        """Keys below ``key``, and the rest."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        below, node.left = self._split(node.left, key)
        return below, node

    def _merge(self, a: _Node | None, b: _Node | None) -> _Node | None:
        if a is None or b is None:
            return a or b
        if a.priority > b.priority:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, key: tuple[int, int]) -> None:
        below, rest = self._split(self.root, key)
        self.root = self._merge(self._merge(below, _Node(key, self.rng.random())), rest)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest key whose remaining capacity is at least ``size``."""
        below, rest = self._split(self.root, (size, -1))
        if rest is None:
            self.root = below
            return None
        node = rest
        while node.left is not None:
            node = node.left
        _, more = self._split(rest, (node.key[0], node.key[1] + 1))
        self.root = self._merge(below, more)
        return node.key


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Bins of (size, number of groups) rows: (size, bin, number) in the order of filling; None if a size or the bin count doesn't fit.

    Bins are opened as needed and numbered from 0.
    """
    tree, bins, filled = RemainingTree(), 0, []
    for size, number in sorted(sizes, reverse=True):
        if size > capacity:
            return None
        while number:
            found = tree.take_tightest(size)
            if found is None:
                if most is not None and bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            here = min(number, found[0] // size)
            filled.append((size, found[1], here))
            tree.add((found[0] - here * size, found[1]))
            number -= here
    return filled


def pack_into(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """The packing into ``shards`` bins at the smallest capacity that is found: steps that double from the fair share, then bisection."""
    total, largest = sum(s * n for s, n in sizes), max((s for s, _ in sizes), default=0)
    low = high = max(largest, -(-total // shards))
    step, best = 1, best_fit_decreasing(sizes, high, shards)
    while best is None:
        low, high, step = high + 1, high + step, step * 2
        best = best_fit_decreasing(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _before(count: str, *by: str) -> Column:
    """Running sum of ``count`` over the hash ranges of ``by`` before this one."""
    return F.coalesce(F.sum(count).over(Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _packed(groups: DataFrame, shards: int) -> DataFrame:
    """(digest, bytes) of all groups to (digest, shard)."""
    spark = groups.sparkSession
    histogram = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("number"))
    sizes = histogram.toArrow()
    sized, ranks, bins, at = [], [], [], 0
    for size, bin_no, number in pack_into(list(zip(sizes["bytes"].to_pylist(), sizes["number"].to_pylist(), strict=True)), shards):
        at = at if sized[-1:] == [size] else 0
        sized.append(size)
        ranks.append(at)
        bins.append(bin_no)
        at += number
    # The shards of a size with the rank among its groups from which each is filled.
    filled = spark.createDataFrame(pa.table({"bytes": pa.array(sized, pa.int64()), "rank": pa.array(ranks, pa.int64()), "shard": pa.array(bins, pa.int32())})).groupBy("bytes").agg(F.array_sort(F.collect_list(F.struct("rank", "shard"))).alias("fills"))
    ranged = groups.withColumn("range", F.pmod(F.xxhash64("digest"), F.lit(RANGES)))
    firsts = ranged.groupBy("bytes", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("first", _before("n", "bytes")).drop("n").join(filled, "bytes")
    ranked = ranged.withColumn("place", F.row_number().over(Window.partitionBy("bytes", "range").orderBy("digest")) - 1).join(firsts, ["bytes", "range"])
    own = F.filter("fills", lambda x: x["rank"] <= F.col("first") + F.col("place"))
    return ranked.select("digest", F.element_at(own, -1)["shard"].alias("shard"))


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row with size, text_crc32, shard and slot; equal texts share a shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *(F.col(c).alias(f"kept_{c}") for c in keep or []),
        F.col(id_col).alias("id"), byte_size(F.col(text_col)).alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(RANGES)).alias("part"),
    )
    if keep:
        narrow = stored(rows.select("digest", "part", "size"), "sizes")
    else:
        narrow = rows = stored(rows, "sizes")
    cells = stored(narrow.groupBy("digest", "part").agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("size")), "cells")
    placed = _packed(cells.groupBy("digest").agg(F.sum(F.col("rows") * F.col("size")).alias("bytes")), shards)
    # Slots run over a shard's cells by hash range of (digest, part).
    dealt = stored(cells.join(placed, "digest").withColumn("range", F.pmod(F.xxhash64("digest", "part"), F.lit(RANGES))).drop("size"), "dealt")
    firsts = dealt.groupBy("shard", "range").agg(F.sum("rows").alias("n")).withColumn("first", _before("n", "shard")).drop("n")
    within = F.coalesce(F.sum("rows").over(Window.partitionBy("shard", "range").orderBy("digest", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slots = dealt.withColumn("within", within).join(firsts, ["shard", "range"]).select("digest", "part", "shard", (F.col("first") + F.col("within")).alias("first"))
    rank = F.row_number().over(Window.partitionBy("digest", "part").orderBy("id"))
    found = rows.join(slots, ["digest", "part"]).withColumn("slot", (F.col("first") + rank - 1).cast("long"))
    named = [F.col(f"kept_{c}").alias(c) for c in keep or []] or [F.col("id").alias(id_col)]
    return found.select(*named, "size", "text_crc32", "shard", "slot")
