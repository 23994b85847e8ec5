"""Exact duplicates by counting quotient filters: built per partition, merged losslessly, repeated fingerprints verified by bytes.

Each task fingerprints its texts and keeps them in counting quotient filters: a 64-bit fingerprint splits into a quotient, that
is its slot's home, and a remainder; remainders of a home stand sorted in one run, a repeated one once with a counter. As
a filter holds whole fingerprints, cutting it by ranges of quotients and merging the pieces of all tasks by sorted
remainders loses nothing. Fingerprints counted more than once send their documents to byte verification: the normalised
texts themselves are grouped, and a fingerprint shared by different texts keeps them apart.

Copies never meet in one task: rows are reduced by (text digest, salt) before the digest alone, and results return the same way.

Defined results: a null text counts as empty, so all null and empty texts are one group; white space [\\x20\\x09-\\x0D] never
matters; among equals the longest original text of a row with an id stays, then the smallest id; a null id stays only among null ids;
repeated ids keep a row each, and so do null ids alone; ids may be of any type that has an order; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import slices
from .rows import small
from placeloom.plans.scratch import Scratch

WHITE = b" \t\n\v\f\r"
U = np.uint64


class CountingQuotientFilter:
    """Fingerprints of 64 bits with exact counts; ``bits`` of them are the quotient."""

    def __init__(self, bits: int, homes: np.ndarray, ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.bits, self.homes, self.ends, self.remainders, self.counts = bits, homes, ends, remainders, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None, bits: int | None = None) -> CountingQuotientFilter:
        """Built from fingerprints in any order; ``bits`` defaults to about one slot per fingerprint."""
        order = None if counts is None else np.argsort(fingerprints, kind="stable")
        f = np.sort(fingerprints) if counts is None else fingerprints[order]
        new = np.ones(len(f), bool)
        new[1:] = f[1:] != f[:-1]
        first = np.flatnonzero(new)
        if counts is None:
            total = np.diff(first, append=len(f))
        else:
            total = np.add.reduceat(counts[order], first) if len(f) else np.zeros(0, np.int64)
        bits = max(1, int(max(len(first), 1) - 1).bit_length()) if bits is None else bits
        f = f[first]
        quotient = f >> U(64 - bits)
        start = np.ones(len(f), bool)
        start[1:] = quotient[1:] != quotient[:-1]
        at = np.flatnonzero(start)
        return cls(bits, quotient[at], np.append(at, len(f))[1:], f & U((1 << (64 - bits)) - 1), total)

    def fingerprints(self) -> np.ndarray:
        """All distinct fingerprints, ascending."""
        return np.repeat(self.homes, np.diff(self.ends, prepend=0)) << U(64 - self.bits) | self.remainders

    def count(self, fingerprint: int) -> int:
        home, rest = U(fingerprint >> (64 - self.bits)), U(fingerprint & ((1 << (64 - self.bits)) - 1))
        i = int(np.searchsorted(self.homes, home))
        if i == len(self.homes) or self.homes[i] != home:
            return 0
        a, b = (int(self.ends[i - 1]) if i else 0), int(self.ends[i])
        j = a + int(np.searchsorted(self.remainders[a:b], rest))
        return int(self.counts[j]) if j < b and self.remainders[j] == rest else 0

    def merge(self, *others: CountingQuotientFilter) -> CountingQuotientFilter:
        """The filter of all fingerprints of both: runs are merged in the order of remainders, counters are added."""
        every = [self, *others]
        return CountingQuotientFilter.of(np.concatenate([x.fingerprints() for x in every]), np.concatenate([x.counts for x in every]))

    def pieces(self, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(range, fingerprints, counts of those counted more than once by position) for each of 2**bits quotient ranges."""
        f = self.fingerprints()
        cut = np.searchsorted(f, np.arange(1, 1 << bits, dtype=np.uint64) << U(64 - bits)) if bits else np.zeros(0, np.int64)
        for i, (a, b) in enumerate(zip([0, *cut.tolist()], [*cut.tolist(), len(f)], strict=True)):
            if b > a:
                more = np.flatnonzero(self.counts[a:b] > 1)
                yield i, f[a:b].tobytes(), np.stack([more, self.counts[a:b][more]]).astype(np.int64).tobytes()

    @classmethod
    def piece(cls, fingerprints: bytes, counts: bytes) -> CountingQuotientFilter:
        f, c = np.frombuffer(fingerprints, np.uint64), np.frombuffer(counts, np.int64).reshape(2, -1)
        n = np.ones(len(f), np.int64)
        n[c[0]] = c[1]
        return cls.of(f, n)


def normalised(c: Column) -> Column:
    for w in WHITE.decode():
        c = F.replace(c, F.lit(w), F.lit(""))
    return c


def _digest_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, sha, points): digest of each normalised text, and the code points of the original."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for b in slices(batches, "t", 4_000_000):
            raw = [sha((t or b"").translate(None, WHITE)).digest() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pc.fill_null(pc.utf8_length(b.column(1)), 0).cast(pa.int64())], ["k", "sha", "points"])

    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {docs.schema[key].dataType.simpleString()}, sha binary, points long")


def repeated_fingerprints(rows: DataFrame, ranges: int) -> DataFrame:
    """(fp): fingerprints (first 8 bytes of ``sha``) that more than one row has, through per-partition filters.

    2**``ranges`` quotient ranges are merged apart from each other; a filter is closed at a million rows, whatever the task holds.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            got = list(CountingQuotientFilter.of(np.concatenate(held)).pieces(ranges)) if held else []
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary()), pa.array([x[2] for x in got], pa.binary())], ["part", "f", "c"])

        for b in batches:
            if b.num_rows:
                held.append(np.frombuffer(b"".join(x[7::-1] for x in b.column(0).to_pylist()), np.uint64))
                if sum(map(len, held)) > 1_000_000:
                    yield close()
        yield close()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[CountingQuotientFilter]] = {}
        for b in batches:
            for part, f, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                some = held.setdefault(part, [])
                some.append(CountingQuotientFilter.piece(f, c))
                # merged when those that wait outgrow the first: each fingerprint is merged as often as its filter doubles
                if sum(len(x.counts) for x in some[1:]) > max(len(some[0].counts), 250_000):
                    some[:] = [some[0].merge(*some[1:])]
        for some in held.values():
            x = some[0].merge(*some[1:])
            yield pa.RecordBatch.from_arrays([pa.array(x.fingerprints()[x.counts > 1].view(np.int64), pa.int64())], ["fp"])

    return rows.select("sha").mapInArrow(build, "part int, f binary, c binary").repartition(1 << ranges, "part").mapInArrow(merge, "fp long")


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 32, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: ``key``, keep_id, group_size, kept, text_sha256. With ``scratch`` the tables that it reads are parts of it."""
    scratch = scratch.part("dedupe") if scratch else Scratch(docs.sparkSession, "dedupe")
    rows = scratch.put(_digest_rows(docs, key, text))
    n = rows.count()
    repeated = scratch.put(repeated_fingerprints(rows, max(3, (n // 2_000_000).bit_length())), n)
    fp = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long")
    again = small(repeated)

    # byte verification: equal digests must be equal texts
    same = docs.select(normalised(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t")).withColumn("sha", F.unhex(F.sha2("t", 256)))
    same = same.withColumn("fp", fp).join(again, "fp", "left_semi").groupBy("sha", "t").agg(F.count(F.lit(1)).alias("n"))
    clash = same.groupBy("sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("group_size"))
    clash = clash.select("sha", "group_size", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256"))).alias("bad"))

    salt = F.pmod(F.hash("k"), F.lit(salts))
    part = rows.withColumn("fp", fp).join(again, "fp", "left_semi").withColumn("salt", salt)
    best = F.min(F.struct(F.col("k").isNull().alias("none"), (-F.col("points")).alias("points"), "k"))
    some = part.groupBy("sha", "salt").agg(best.alias("best"))
    group = some.groupBy("sha").agg(F.min("best").alias("best")).join(clash, "sha").where("bad is null")
    group = scratch.put(some.select("sha", "salt").join(group.select("sha", F.col("best.k").alias("keep"), "group_size"), "sha"), n)
    out = rows.withColumn("salt", salt).join(small(group, 100_000), ["sha", "salt"], "left")
    keep = F.coalesce("keep", "k")
    first = keep.eqNullSafe(F.col("k"))
    return out.select(F.col("k").alias(key), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), first.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
