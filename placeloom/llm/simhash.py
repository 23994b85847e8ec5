"""SimHash near duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

A fingerprint has 64 bits, each the majority over the XXH64 of a text's word shingles. Every bit place gets a vector of r + 1 bits,
never zero and dealt out evenly; mask t keeps the places whose vector has an odd product with t. Two fingerprints that differ in r
places or fewer leave a t other than zero that is orthogonal to the r vectors of those places, so mask t keeps none of them and the
pair meets in table t: 2**(r+1) - 1 tables find every pair.

Only distinct fingerprints are compared. A bucket is what agrees on its mask. Buckets that a task can compare whole
(``BLOCK`` fingerprints) are; larger ones are covered again by masks of the places that they leave open, which keeps the guarantee,
and so on: ten open places hold no more than a block of distinct fingerprints. Sizes are counted before rows of a bucket meet,
so no task gets a large one. Tasks return spanning forests of their links, not pairs.

Defined results: null, empty and white texts have fingerprint zero and link like any other; fewer than k words are one shingle;
equal fingerprints always link; ids may be of any type that has an order and go by rows: rows that repeat an id keep a row each; a null id
links like any other, names no component that has an id, and a component of null ids alone has a null name; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.operators.components import components, least_roots
from placeloom.plans.scratch import Scratch

from .bytetext import LOWER, U, Words, slices, text_bytes
from .rows import small

SEED = 42
BLOCK = 1024  # fingerprints that are compared with one another at once
_RUN = 24  # buckets up to this size are compared by shifts of the sorted column
_CHUNK = 1 << 16  # shingles whose bits are counted at once
_SALTS = 32

# XXH64's fixed values
_P1, _P2, _P3, _P4, _P5 = (U(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = SEED, longest: int = 256) -> np.ndarray:
    """XXH64 of each byte range, for all ranges together; ranges over ``longest`` bytes one by one."""
    size = end - start
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    halves = np.ndarray((len(raw) + 1,), "<u4", padded, strides=(1,))
    with np.errstate(over="ignore"):
        out = np.full(len(size), U(seed) + _P5, np.uint64)
        wide = np.flatnonzero((size >= 32) & (size <= longest))
        at = start.copy()
        if len(wide):
            acc = [np.full(len(wide), x, np.uint64) for x in (U(seed) + _P1 + _P2, U(seed) + _P2, U(seed), U(seed) - _P1)]
            for i in range(longest // 32):
                on = np.flatnonzero(size[wide] >= 32 * (i + 1))
                if not len(on):
                    break
                for j in range(4):
                    acc[j][on] = _round(acc[j][on], lanes[start[wide[on]] + 32 * i + 8 * j])
            h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for j in range(4):
                h = (h ^ _round(np.zeros(len(wide), np.uint64), acc[j])) * _P1 + _P4
            out[wide] = h
            at[wide] += size[wide] // 32 * 32
        out += size.astype(np.uint64)
        left = np.where(size <= longest, end - at, 0)
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            if not len(on):
                break
            out[on] = _rotl(out[on] ^ _round(np.zeros(len(on), np.uint64), lanes[at[on]]), 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        out[on] = _rotl(out[on] ^ (halves[at[on]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left > 0)
            if not len(on):
                break
            out[on] = _rotl(out[on] ^ (padded[at[on]].astype(np.uint64) * _P5), 11) * _P1
            at[on] += 1
            left[on] -= 1
        out = (out ^ (out >> U(33))) * _P2
        out = (out ^ (out >> U(29))) * _P3
        out ^= out >> U(32)
    data = memoryview(np.ascontiguousarray(raw))
    for i in np.flatnonzero(size > longest).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]], seed=seed)
    return out


def _spaced(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in lower case with one space behind each, and where each starts and ends there."""
    size = words.end - words.start
    start = np.concatenate([[0], np.cumsum(size + 1)])
    place = np.repeat(words.start - start[:-1], size + 1) + np.arange(start[-1])
    out = LOWER[words.raw[np.minimum(place, max(len(words.raw) - 1, 0))]] if len(words.raw) else np.zeros(0, np.uint8)
    out[start[1:] - 1] = 32
    return out, start[:-1], start[1:] - 1


def fingerprints_of(texts: pa.Array, k: int = 4, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text: a bit is set where over half of its k-word shingles, repeats included, have it in their hash."""
    words = Words(*text_bytes(texts))
    rows = len(words.count)
    ones, total = np.zeros((rows, 64), np.int64), np.maximum(words.count - k + 1, np.minimum(words.count, 1))
    if not len(words.start):
        return np.zeros(rows, np.uint64)
    raw, start, end = _spaced(words)
    first = np.concatenate([[0], np.cumsum(words.count)])
    doc = np.repeat(np.arange(rows), total)
    own = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(total)])[:-1], total)
    head = first[doc] + own
    tail = np.minimum(head + k, first[doc + 1]) - 1
    for i in range(0, len(doc), _CHUNK):
        a, b, d = head[i : i + _CHUNK], tail[i : i + _CHUNK], doc[i : i + _CHUNK]
        lo, hi = start[a[0]], end[b[-1]]
        h = xxh64(raw[lo:hi], start[a] - lo, end[b] - lo, seed)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.diff(d, prepend=-1))
        ones[d[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, k: int = 4, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, fp): each row's id and its fingerprint as a long of the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints_of(b.column(1), k, seed).view(np.int64))], ["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"k {kind}, fp long")


@lru_cache(maxsize=4096)
def covering_masks(fixed: int, radius: int) -> tuple[int, ...]:
    """For each table the places of ``fixed`` and those open places that its mask keeps."""
    vectors = (1 << (radius + 1)) - 1
    places = [p for p in range(64) if not fixed >> p & 1]
    masks = []
    for t in range(1, vectors + 1):
        kept = (1 << p for i, p in enumerate(places) if (t & (i % vectors + 1)).bit_count() & 1)
        masks.append(fixed | sum(kept))
    return tuple(masks)


def _covered(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, m, v): each row of (fp, m) under every mask that covers what mask ``m`` leaves open; ``v`` is what the mask keeps of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, fixed = (c.to_numpy().view(np.uint64) for c in b.columns)
            for m in np.unique(fixed):
                own = fp[fixed == m]
                masks = np.unique(np.array(covering_masks(int(m), radius), np.uint64))
                for i in range(0, len(own), 4096):
                    some = own[i : i + 4096]
                    out = np.tile(some, len(masks)), np.repeat(masks, len(some))
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (*out, out[0] & out[1])], ["fp", "m", "v"])

    return rows.select("fp", "m").mapInArrow(run, "fp long, m long, v long")


def _near(fp: np.ndarray, cut: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of fingerprints of one bucket that link; ``cut`` has the first position of each bucket and the end."""
    size = np.diff(cut)
    left, right = [], []
    bucket = np.repeat(np.arange(len(size)), size)
    run = np.flatnonzero((size <= _RUN)[bucket])
    for d in range(1, _RUN):
        run = run[run + d < cut[bucket[run] + 1]]
        if not len(run):
            break
        on = run[np.bitwise_count(fp[run] ^ fp[run + d]) <= radius]
        left.append(on)
        right.append(on + d)
    for i in np.flatnonzero(size > _RUN).tolist():
        own = fp[cut[i] : cut[i + 1]]
        open_ = np.arange(len(own))
        while len(open_) > 1:  # a spanning forest: what one fingerprint reaches, then the next
            todo = [open_[0]]
            rest = open_[1:]
            while todo and len(rest):
                at = todo.pop()
                near = np.bitwise_count(own[rest] ^ own[at]) <= radius
                met, rest = rest[near], rest[~near]
                left.append(np.full(len(met), cut[i] + at))
                right.append(cut[i] + met)
                todo += met.tolist()
            open_ = rest
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _compared(rows: DataFrame, radius: int, tasks: int) -> DataFrame:
    """(a, b): a spanning forest of the links in the buckets (m, v) of ``rows`` (fp, m, v), none of which is larger than a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def close(every: np.ndarray) -> pa.RecordBatch:
            change = np.flatnonzero((every[1:, 1:] != every[:-1, 1:]).any(1)) + 1
            fp = every[:, 0].view(np.uint64)
            a, b = _near(np.ascontiguousarray(fp), np.concatenate([[0], change, [len(fp)]]), radius)
            node, root = least_roots(every[a, 0], every[b, 0])
            on = node != root
            return pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(root[on])], ["a", "b"])

        for b in batches:
            held.append(np.stack([c.to_numpy() for c in b.columns], 1))
            if sum(map(len, held)) < 1 << 17:
                continue
            every = np.concatenate(held)
            last = np.flatnonzero((every[:, 1:] != every[-1, 1:]).any(1))  # the last bucket may go on in the next batch
            end = int(last[-1]) + 1 if len(last) else 0
            if end:
                yield close(every[:end])
            held = [every[end:]]
        if held and sum(map(len, held)):
            yield close(np.concatenate(held))

    return rows.repartition(tasks, "m", "v").sortWithinPartitions("m", "v").select("fp", "m", "v").mapInArrow(run, "a long, b long")


def near_links(distinct: DataFrame, radius: int, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect the fingerprints of ``distinct`` (fp, no repeats) which differ in ``radius`` places or fewer."""
    rows, links = distinct.select("fp", F.lit(0).cast("long").alias("m")), None
    n = distinct.count()
    if n < 2:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    while True:
        spread = _covered(rows, radius)
        count = spread.groupBy("m", "v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        sizes = scratch.put(count, n)
        met = spread.join(small(sizes), ["m", "v"])
        tasks = max(2 * distinct.sparkSession.sparkContext.defaultParallelism, n // 100_000)
        found = scratch.put(_compared(met.where(F.col("c") <= block), radius, tasks), n)
        links = found if links is None else links.unionAll(found)
        large = sizes.where(F.col("c") > block)
        if not large.limit(1).count():
            return links
        rows = scratch.put(met.where(F.col("c") > block).select("fp", "m"))


def near_components(docs: DataFrame, k: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(``key``, fingerprint, component_id): rows link when their fingerprints differ in ``radius`` bits or fewer.

    A component is named by its smallest id. With ``scratch`` the tables that the result reads are parts of it.
    """
    scratch = scratch.part("simhash") if scratch else Scratch(docs.sparkSession, "simhash")
    rows = scratch.put(fingerprints(docs, k, key=key, text=text))
    n = rows.count()
    # copies never meet in one task: rows are reduced by (fingerprint, salt), and results return the same way
    salt = F.pmod(F.hash("k"), F.lit(_SALTS))
    some = scratch.put(rows.groupBy("fp", salt.alias("salt")).agg(F.min("k").alias("k")), n)
    whole = scratch.put(some.groupBy("fp").agg(F.min("k").alias("k")), n)
    roots = components(near_links(whole, radius, scratch), scratch).withColumnRenamed("node", "fp")
    named = whole.join(small(roots), "fp", "left").select("fp", "k", F.coalesce("root", "fp").alias("root"))
    least = scratch.put(named.groupBy("root").agg(F.min("k").alias("component")), n)
    of = named.select("fp", "root").join(small(least), "root").select("fp", "component")
    back = scratch.put(some.select("fp", "salt").join(small(scratch.put(of, n)), "fp"), n)
    out = rows.withColumn("salt", salt).join(small(back), ["fp", "salt"])
    return out.select(F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
