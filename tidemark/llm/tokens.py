"""Words of whole texts as codes of a dictionary, straight from Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.wordhash import SPACES, buffers

#: Rows are taken together until their texts have about so many bytes; one longer text is taken alone.
SHARD_BYTES = 16 << 20


def byte_map(ascii_words_only: bool) -> np.ndarray:
    """Each byte lower-cased (A-Z only), separators as spaces. ``ascii_words_only``: ASCII marks separate words too."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    for b in range(128):
        if b in SPACES or ascii_words_only and not chr(b).isalnum():
            out[b] = 0x20
    return out


def coded(texts: pa.Array, mapping: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text of each word, its code, and the words by code. Codes follow the first appearance."""
    data, offsets = buffers(texts)
    clean = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(mapping[data]))
    lists = pc.ascii_split_whitespace(clean)
    parents, words = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
    # A separator at an end of a text leaves an empty word there.
    solid = pc.greater(pc.binary_length(words), 0)
    encoded = words.filter(solid).dictionary_encode()
    return parents[solid.to_numpy(zero_copy_only=False)].astype(np.int64), encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.cast(pa.string())


def shards(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SHARD_BYTES) -> Iterator[pa.Table]:
    """The same rows in tables of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        _, offsets = buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit - size, side="right")) - 1)
            held.append(batch.slice(at, to - at))
            size += int(offsets[to] - offsets[at])
            at = to
            if size >= limit or at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def varint(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as base-128 bytes, low part first, the top bit set on all but a number's last byte; and where each begins (one more at the end)."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << (7 * k)) if k < 9 else values >> np.uint64(63) > 0
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)
    left, at, last = values, starts[:-1], sizes - 1
    for k in range(int(sizes.max(initial=0))):
        on = sizes > k
        left, at, last, sizes = left[on], at[on], last[on], sizes[on]
        out[at + k] = (left & np.uint64(127)).astype(np.uint8) | np.where(last > k, 128, 0).astype(np.uint8)
        left = left >> np.uint64(7)
    return out, starts


def unvarint(data: bytes) -> np.ndarray:
    """The integers that ``varint`` wrote."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(raw < 128)
    if len(ends) == len(raw):
        return raw.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)
