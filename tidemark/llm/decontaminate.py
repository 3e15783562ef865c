"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits. A seed is four words of a test
item, two and two, that stand side by side or with one other word in the middle;
texts are looked up in both forms. So a copy keeps a seed wherever two pairs of
its words stay around a substituted, a missing or an added word: contiguous
n-grams alone miss copies in which every fourth or fifth word is changed. Every
seed counts, however common; leaving out common ones would lose edited copies
whose rare words are just those that were edited.

One pass over the texts finds all seeds of a batch at once. Whether an item can
reach the score near its seeds is then bounded by how many of its words occur
there at all, which turns stock phrases away; what is left is aligned by
Smith-Waterman (match 2, mismatch -1, gap -1). The score is the alignment's over
that of an identical copy: substituting a third of the words leaves 0.5.

Test items come in blocks of at most ``block_bytes`` of text, or one longer item;
what is broadcast follows that bound and not the benchmark, and each further block
is a further pass over the texts. Texts are never shuffled.

Defined results: null or empty texts match nothing; items of fewer words than a
seed match nothing; very long texts and items are aligned whole around their
seeds; repeated rows match each for itself; several equal items match each under
its own id; of several places with the same score the first one is reported; empty
tables give an empty result, or all rows where clean rows are asked for; other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.wordhash import PRIME, mix64, pieces, word_hashes
from tidemark.session import modest_batches

MATCH, MISMATCH, GAP = 2, -1, 1
#: Words of a seed. Texts are held against a bit of each seed's hash before its whole.
SEED, FILTER_BITS = 4, 22
FILTER_MASK = np.uint64((1 << FILTER_BITS) - 1)


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best local alignment of two word sequences: its score and the index after its last word in ``words``."""
    row, ramp = np.zeros(len(words) + 1, np.int64), GAP * np.arange(len(words) + 1)
    best, end = 0, 0
    for word in item:
        step = row[:-1] + np.where(words == word, MATCH, MISMATCH)
        row[1:] = np.maximum(np.maximum(step, row[1:] - GAP), 0)
        # A gap along the row is a running maximum once each place is raised by its distance.
        row = np.maximum.accumulate(row + ramp) - ramp
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def seeds_of(words: np.ndarray) -> list[np.ndarray]:
    """Hashes of the four-word seeds that begin at each word: without and with a word left out in the middle."""
    out = []
    for span in (SEED, SEED + 1):
        n = max(0, len(words) - span + 1)
        h = np.zeros(n, np.uint64)
        for k in (0, 1, span - 2, span - 1):
            h = mix64(h * PRIME + words[k : k + n])
        out.append(h)
    return out


class Seeds:
    """One block of items with their seeds, as arrays."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.sizes = np.array([len(w) for w in words], np.int64)
        found = [seeds_of(w) for w in words]
        flat = [(i, g) for i, forms in enumerate(found) for g in forms]
        gram = np.concatenate([g for _, g in flat]) if flat else np.zeros(0, np.uint64)
        item = np.repeat(np.array([i for i, _ in flat], np.int32), [len(g) for _, g in flat])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for _, g in flat]) if flat else np.zeros(0, np.int32)
        order = np.lexsort((place, item, gram))
        gram, item, place = gram[order], item[order], place[order]
        # Of a seed's places in one item the first and the last suffice: the windows of those between lie inside their joint one.
        same = (gram[1:] == gram[:-1]) & (item[1:] == item[:-1])
        inner = np.zeros(len(gram), bool)
        inner[1:-1] = same[1:] & same[:-1]
        gram, self.item, self.place = gram[~inner], item[~inner], place[~inner]
        self.keys, self.first = np.unique(gram, return_index=True)
        self.last = np.append(self.first[1:], len(gram))
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.keys & FILTER_MASK] = True

    def starts(self, words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, item, word of the text where the item would begin) of every seed in the texts that begin at ``firsts``."""
        none = np.zeros(0, np.int64)
        if not len(self.keys):
            return none, none, none
        places, keys = [], []
        for grams, span in zip(seeds_of(words), (SEED, SEED + 1), strict=True):
            near = np.flatnonzero(self.maybe[grams & FILTER_MASK])
            at = np.minimum(np.searchsorted(self.keys, grams[near]), len(self.keys) - 1)
            real = self.keys[at] == grams[near]
            near, at = near[real], at[real]
            # A seed may not reach from one text into the next.
            whole = np.searchsorted(firsts, near, side="right") == np.searchsorted(firsts, near + span - 1, side="right")
            places.append(near[whole])
            keys.append(at[whole])
        place, key = np.concatenate(places), np.concatenate(keys)
        low, times = self.first[key], self.last[key] - self.first[key]
        # Each hit once for each (item, place) of its key.
        k = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
        at = np.repeat(place, times)
        text = np.searchsorted(firsts, at, side="right") - 1
        return tuple(np.unique(np.stack([text, self.item[k], at - self.place[k]], axis=1), axis=0).T) if len(k) else (none, none, none)

    def matches(self, words: np.ndarray, firsts: np.ndarray, least: float) -> list[tuple[int, int, float, int, int]]:
        """(text, item, score, first word, word after the last) of the best alignment of each item with each text that reaches ``least``."""
        text, item, start = self.starts(words, firsts)
        if not len(text):
            return []
        ends = np.append(firsts[1:], len(words))
        pad = np.maximum(8, self.sizes[item] // 2)
        low = np.maximum(firsts[text], start - pad)
        high = np.minimum(ends[text], start + self.sizes[item] + pad)
        # Windows of one item in one text that touch are one window; they are in order of their starts.
        fresh = np.ones(len(low), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])
        begin = np.flatnonzero(fresh)
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for a, b in zip(begin, np.append(begin[1:], len(low)), strict=True):
            t, i, here, to = int(text[a]), int(item[a]), int(low[a]), int(high[b - 1])
            target, around = self.words[i], words[here:to]
            # No alignment scores more than a match for each of the item's words that occur.
            if np.isin(target, around).sum() < least * len(target):
                continue
            score, stop = align(target, around)
            if score >= least * MATCH * len(target) and score > out.get((t, i), (0,))[0]:
                out[t, i] = (score, here, here + stop)
        found = []
        for (t, i), (score, here, stop) in out.items():
            _, back = align(self.words[i][::-1], words[here:stop][::-1])
            found.append((t, i, score / (MATCH * len(self.words[i])), stop - back - int(firsts[t]), stop - int(firsts[t])))
        return found


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[Seeds]:
    ids, texts, held = [], [], 0

    def block() -> Seeds:
        hashes, starts, _ = word_hashes(pa.array(texts, pa.string()), ascii_words_only=True)
        return Seeds(ids, [hashes[a:b] for a, b in pairwise(starts)])

    items = benchmark.select(F.col(item_col).alias("item"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    for r in items.toLocalIterator():
        ids.append(r["item"])
        texts.append(r["text"])
        held += len(r["text"].encode())
        if held >= block_bytes:
            yield block()
            ids, texts, held = [], [], 0
    if ids:
        yield block()


def _ready(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> Iterator:
    """Each block with its seeds, as a broadcast variable."""
    modest_batches(docs.sparkSession)
    for found in blocks(benchmark, item_col, item_text_col, block_bytes):
        yield docs.sparkSession.sparkContext.broadcast(found)


def _matched(seeds, least: float) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Seeds = seeds.value
        for batch in pieces(batches):
            words, starts, _ = word_hashes(batch.column(1), ascii_words_only=True)
            out = [(i, found.ids[m], len(found.words[m]), *rest) for i, m, *rest in found.matches(words, starts[:-1], least)]
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            ids = batch.column(0).take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())], names=["doc", "item", "item_words", "score", "start_word", "end_word"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.5, block_bytes: int = 8 << 20) -> DataFrame:
    """Each (document, item) whose best alignment reaches ``least``: id, item, item_words, score, start_word, end_word."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.lower(F.col(text_col)).alias("text"))
    found = None
    for seeds in _ready(docs, benchmark, item_col, item_text_col, block_bytes):
        part = rows.mapInArrow(_matched(seeds, least), "doc long, item long, item_words long, score double, start_word long, end_word long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc long, item long, item_words long, score double, start_word long, end_word long")
    return found.withColumnsRenamed({"doc": id_col, "item": item_col})


def _clean(seeds, least: float) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Seeds = seeds.value
        for batch in pieces(batches):
            words, starts, _ = word_hashes(batch.column(batch.num_columns - 1), ascii_words_only=True)
            keep = np.ones(batch.num_rows, bool)
            keep[[i for i, *_ in found.matches(words, starts[:-1], least)]] = False
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.5, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    out = docs
    for seeds in _ready(docs, benchmark, item_col, item_text_col, block_bytes):
        lowered = out.select("*", F.lower(F.col(text_col)).alias("__lowered"))
        out = lowered.mapInArrow(_clean(seeds, least), docs.schema)
    return out


