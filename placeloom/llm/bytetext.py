"""Vectorised words, hashes and shingles over Arrow string columns, on UTF-8 bytes and without a Python loop per word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words end at these bytes: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64
_BLOCKS = 4  # of 8 bytes; longer words go through a cryptographic hash
_ONE_MORE = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def hash_ranges(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range.

    Up to 32 bytes are chained 8 at a time through a bijection, starting from the length, so ranges of equal length that
    differ in one block never meet; longer ranges take 8 bytes of BLAKE2b.
    """
    size = end - start
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    block = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # the 8 bytes from each place on
    out = mix(size.astype(np.uint64) * _ONE_MORE + U(1))
    short = size <= 8 * _BLOCKS
    for i in range(_BLOCKS):
        on = np.flatnonzero(short & (size > 8 * i)) if i else np.flatnonzero(short & (size > 0))
        if not len(on):
            break
        got = block[start[on] + 8 * i]
        rest = np.minimum(size[on] - 8 * i, 8).astype(np.uint64)
        got &= U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * rest)
        out[on] = mix((out[on] ^ got) + _ONE_MORE)
    long = np.flatnonzero(~short)
    if len(long):
        data = raw.tobytes() if len(long) > 64 else memoryview(np.ascontiguousarray(raw))
        digest = b"".join(hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True))
        out[long] = np.frombuffer(digest, np.uint64)
    return out


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and n+1 offsets from 0; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 300_000) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a piece holds about ``limit`` bytes of text (a single longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """Words of a piece of texts: ``start``/``end`` byte positions, ``doc`` row of each, ``count`` per row."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        self.raw, self.at, n = raw, at, len(raw)
        if not n:
            self.start = self.end = self.doc = np.zeros(0, np.int64)
            self.count = np.zeros(len(at) - 1, np.int64)
            return
        word = ~SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.count = np.diff(np.searchsorted(self.start, at))
        self.doc = np.repeat(np.arange(len(at) - 1), self.count)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of every word; A-Z count as a-z if ``lower``."""
        return hash_ranges(LOWER[self.raw] if lower else self.raw, self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k values, in order; len(h)-k+1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + h[i : i + n] + U(i + 1))
    return out


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k-word shingles, sorted within each row, and n+1 offsets; a row of 1..k-1 words has one shingle, all its words."""
    h, count = words.hashes(), words.count
    rows = len(count)
    first = np.concatenate([[0], np.cumsum(count)])
    run = window_hashes(h, k)
    inside = np.flatnonzero(words.doc[: len(run)] == words.doc[k - 1 :]) if len(run) else np.zeros(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < k))
    each = np.maximum(count - k + 1, 0)
    each[few] = 1
    at = np.concatenate([[0], np.cumsum(each)])
    value, doc = np.zeros(at[-1], np.uint64), np.repeat(np.arange(rows), each)
    whole = np.ones(len(value), bool)
    whole[at[few]] = False
    value[whole] = run[inside]
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            has = count[few] > i
            short[has] = mix(short[has] + h[first[few[has]] + i] + U(i + 1))
        value[at[few]] = mix(short ^ U(0xA5A5A5A5))
    for i in np.flatnonzero(each > 1).tolist():  # far faster than one sort by row and value
        value[at[i] : at[i + 1]].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows))]).astype(np.int64)
