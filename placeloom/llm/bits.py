"""Bit tables of hash prefixes, OR-ed together in tasks, so that a scan can leave out what no key of a table can equal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import U

MOST = 28  # bits of a prefix at most: 32 MB
_CHUNK = 16  # a task packs pieces of 2**16 bits


def prefix_bits(n: int, per_key: int = 16) -> int:
    """Length of the prefixes for ``n`` keys: ``per_key`` places for each, as far as MOST allows."""
    return min(MOST, max(_CHUNK, (per_key * max(n, 1) - 1).bit_length()))


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the prefixes of a long column ``h``: 2**``bits`` of them, 2**MOST at most, packed by tasks."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.unique(b.column(0).to_numpy().view(np.uint64) >> U(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((p >> _CHUNK).astype(np.int32)), pa.array((p & ((1 << _CHUNK) - 1)).astype(np.int32))], ["chunk", "p"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            chunk, p = (c.to_numpy() for c in b.columns)
            for c in np.unique(chunk).tolist():
                held.setdefault(c, np.zeros(1 << _CHUNK, bool))[p[chunk == c]] = True
        rows = [np.packbits(x, bitorder="little").tobytes() for x in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(rows, pa.binary())], ["chunk", "bits"])

    spread = keys.select("h").mapInArrow(places, "chunk int, p int").distinct().repartition(max(1, 1 << (bits - _CHUNK) >> 6), "chunk")
    table = np.zeros(1 << bits >> 3, np.uint8)
    size = 1 << _CHUNK >> 3
    for r in spread.mapInArrow(pack, "chunk int, bits binary").collect():  # 2**(MOST - _CHUNK) pieces of 8 KB at most
        table[r.chunk * size : (r.chunk + 1) * size] = np.frombuffer(bytes(r.bits), np.uint8)
    return table


def held(table: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Which hashes have a prefix that the table holds."""
    p = (h >> U(64 - bits)).astype(np.int64)
    return table[p >> 3] >> (p & 7).astype(np.uint8) & 1 == 1
