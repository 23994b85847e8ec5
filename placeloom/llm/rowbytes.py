"""Rows as byte strings that sort as the rows do: column by column from the left, nulls first, texts by their UTF-8 bytes.

A column is one byte (0 for null, 1 for a value) and its value: integers, dates and timestamps with the sign turned, big end first; doubles
with their bits turned so that they sort as numbers (zeros of both signs alike, not-a-number last); texts and binaries with zero
bytes escaped and two zeros as their end. Behind the columns stands a byte for each floating column that tells zeros apart, so a
row can be read back from its bytes whole. Columns go in and out as Arrow arrays, without a Python loop over rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SIGN = np.uint64(1 << 63)


def _fixed(kind: pa.DataType) -> pa.DataType | None:
    """The integers that hold a column's values, None for texts and binaries."""
    if pa.types.is_integer(kind) or pa.types.is_date(kind) or pa.types.is_timestamp(kind) or pa.types.is_boolean(kind):
        return pa.int64()
    if pa.types.is_floating(kind):
        return pa.float64()
    if pa.types.is_string(kind) or pa.types.is_binary(kind):
        return None
    raise ValueError(f"rows with a column of {kind} have no order here")


def check(schema: pa.Schema) -> None:
    """Raises an error if a column's type has no order here (lists, structs, maps, decimals)."""
    for field in schema:
        _fixed(field.type)


def _integers(column: pa.Array) -> np.ndarray:
    if pa.types.is_boolean(column.type):
        column = column.cast(pa.int8())
    if pa.types.is_date(column.type):
        column = column.cast(pa.int32())
    return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


def _ordered(column: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
    """Unsigned words that sort as the values do, and which values are a negative zero."""
    if not pa.types.is_floating(column.type):
        return _integers(column).view(np.uint64) ^ _SIGN, None
    x = pc.fill_null(column.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    minus = (x == 0) & np.signbit(x)
    x = np.where(np.isnan(x), np.nan, x + 0.0)
    bits = np.where(x == 0, 0.0, x).view(np.uint64)
    return np.where(bits & _SIGN != 0, ~bits, bits | _SIGN), minus


def _escaped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values with zeros escaped, and n+1 offsets."""
    raw = pc.fill_null(column.cast(pa.binary()), b"")
    raw = pc.replace_substring(raw, b"\x00", b"\x00\xff")
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    own = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return own, at - at[0]


def encode(columns: list[pa.Array], prefix: np.ndarray) -> pa.Array:
    """One binary a row: ``prefix`` (a byte matrix with a row each), then the row."""
    n = len(prefix)
    parts: list[tuple[np.ndarray, np.ndarray | None]] = [(prefix, None)]  # a matrix, or bytes with offsets
    zeros = []
    for column in columns:
        here = column.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)[:, None]
        if _fixed(column.type) is None:
            parts += [(here, None), _escaped(column), (np.zeros((n, 2), np.uint8), None)]
        else:
            words, minus = _ordered(column)
            value = words.astype(">u8").view(np.uint8).reshape(n, 8) * here
            parts.append((np.concatenate([here, value], axis=1), None))
            if minus is not None:
                zeros.append(minus.astype(np.uint8)[:, None])
    parts += [(z, None) for z in zeros]
    size = sum((x.shape[1] if at is None else np.diff(at)) for x, at in parts) + np.zeros(n, np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    out, place = np.zeros(offsets[-1], np.uint8), offsets[:-1].copy()
    for x, at in parts:
        if at is None:
            for j in range(x.shape[1]):
                out[place + j] = x[:, j]
            place += x.shape[1]
        else:
            size = np.diff(at)
            out[np.repeat(place - at[:-1], size) + np.arange(at[-1])] = x
            place += size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out)])


def decode(rows: list[bytes], skip: int, schema: pa.Schema) -> pa.RecordBatch:
    """The columns of ``schema`` from encoded rows, whose first ``skip`` bytes are something else."""
    n = len(rows)
    raw = np.frombuffer(b"".join(rows) + bytes(8), np.uint8)
    place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, n))])[:-1] + skip
    ends = np.flatnonzero((raw[:-1] == 0) & (raw[1:] == 0))
    got: list[tuple[pa.Field, np.ndarray, object]] = []
    for field in schema:
        here = raw[place] == 1
        place = place + 1
        if _fixed(field.type) is None:
            end = ends[np.searchsorted(ends, place)] if n else place
            size = end - place
            at = np.concatenate([[0], np.cumsum(size)])
            own = raw[np.repeat(place - at[:-1], size) + np.arange(at[-1])]
            value: object = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(own)])
            place = end + 2
        else:
            words = np.ascontiguousarray(raw[place[:, None] + np.arange(8)]).view(">u8").ravel().astype(np.uint64)
            value = words
            place = place + 8
        got.append((field, here, value))
    arrays = []
    for field, here, value in got:
        kind = field.type
        if _fixed(kind) is None:
            whole = pc.replace_substring(value, b"\x00\xff", b"\x00").cast(kind)
            arrays.append(pc.if_else(pa.array(here), whole, pa.scalar(None, kind)))
            continue
        if pa.types.is_floating(kind):
            bits = np.where(value & _SIGN != 0, value ^ _SIGN, ~value)
            x = bits.view(np.float64)
            x = np.where(raw[place] == 1, -0.0, x)
            place = place + 1
            arrays.append(pa.array(x, mask=~here).cast(kind))
            continue
        column = pa.array((value ^ _SIGN).view(np.int64), mask=~here)
        if pa.types.is_boolean(kind):
            column = column.cast(pa.int8())
        if pa.types.is_date(kind):
            column = column.cast(pa.int32())
        arrays.append(column.cast(kind))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
