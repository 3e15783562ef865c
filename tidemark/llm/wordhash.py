"""Vectorised word hashes of whole texts, straight from Arrow buffers.

A word is a maximal run of bytes that are not separators; its 64-bit hash is a
polynomial in its bytes, each byte first mapped to a fixed random odd number,
then mixed. Work goes over the words in pieces of about ``PIECE`` bytes, so
memory follows the words of one batch and not the square of anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
PRIME = np.uint64(0x9E3779B97F4A7C15 | 5)
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache
def byte_values(lower: bool, ascii_words_only: bool) -> np.ndarray:
    """Value of each byte, 0 for separators. ``ascii_words_only``: ASCII marks separate words too."""
    values = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    for b in range(128):
        if b in SPACES or ascii_words_only and not chr(b).isalnum():
            values[b] = 0
    return values


@lru_cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """PRIME**i and its inverse modulo 2**64 for i < n."""
    up = np.full(n, PRIME, dtype=np.uint64)
    down = np.full(n, pow(int(PRIME), -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def pieces(batches: Iterator[pa.RecordBatch], column: int = -1, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of one text column, so that tables of its words stay small."""
    for batch in batches:
        texts = batch.column(column % batch.num_columns)
        _, offsets = buffers(texts)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
        if not batch.num_rows:
            yield batch


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array, lower: bool = True, ascii_words_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in order, the index of each text's first word (one more at the end), and each word's first byte."""
    data, offsets = buffers(texts)
    values = byte_values(lower, ascii_words_only)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    solid = (values != 0)[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = solid[firsts]
    starts = np.flatnonzero(begins)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        low, high = int(starts[at]), int(starts[to]) if to < len(starts) else len(data)
        size = 1 << max(20, int(high - low).bit_length())
        up, down = powers(size)
        # A word that ends with its text is cut off by the next word's start, as reduceat sums up to it.
        sums = np.add.reduceat(values[data[low:high]] * up[: high - low], starts[at:to] - low)
        hashes[at:to] = mix64(sums * down[starts[at:to] - low])
        at = to
    return hashes, np.searchsorted(starts, offsets), starts


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (one word more gives one run more)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix64(out * PRIME + words[k : len(words) - n + 1 + k])
    return out


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence, apart from every shingle's by its length."""
    out = np.array([len(words)], np.uint64)
    for w in words:
        out = mix64(out * PRIME + w)
    return out[0]


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``n`` words count as one shingle, none as no shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([sequence_hash(words)])
    return np.unique(shingle_hashes(words, n))
