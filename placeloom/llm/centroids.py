"""Centroid clustering by weighted deduplication: Lloyd's rounds over distinct quantised vectors, in integers.

Vectors are quantised to integers, equal ones are one row with a multiplicity, and each round reads the distinct rows only: tasks assign
them to the nearest centroid and return, per centroid, the sum of multiplicities and of components times multiplicity. Sums are
exact, so neither partitioning nor order matters. After the last round the assignments are joined back to the ids by vector.

A vector that many rows have meets as one row a task before it is shuffled. On the way back rows of vectors that are frequent take
their assignment from a broadcast, which is bounded: ``_FREQUENT`` vectors at most can have more than that share of the rows.

Defined results: null vectors, other lengths, and null, infinite or not-a-number components are left out; with fewer vectors than
centroids asked for there is one centroid a row; among equal hashes
(repeated ids) vectors start in the order of their packed bytes; a row with a null id is clustered, and starts only where rows with ids
do not suffice; repeated ids keep a row each; ids may be of any type with a text form; an empty table gives an empty result; other
columns are ignored. Components beyond 2**25 after quantising are an error, as sums of squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.plans.scratch import Scratch

_LARGEST = 1 << 25
_EXACT = 1 << 22  # components whose products sum exactly in doubles
_FREQUENT = 2000


def quantised(vectors: DataFrame, dims: int, scale: int, key: str, vector: str) -> DataFrame:
    """(k, q): ids and the components floor(scale * x) of usable vectors, packed as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            on = np.flatnonzero(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dims)
            x = lists.take(pa.array(on)).flatten().cast(pa.float64())
            x = x.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
            fine = np.isfinite(x).all(1)
            q = np.floor(scale * x[fine])
            if q.size and np.abs(q).max() > _LARGEST:
                raise ValueError(f"a quantised component is beyond {_LARGEST}")
            raw = np.ascontiguousarray(q.astype("<i4")).tobytes()
            packed = pa.Array.from_buffers(pa.binary(4 * dims), len(q), [None, pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(on[fine])), packed.cast(pa.binary())], ["k", "q"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("x")).mapInArrow(run, f"k {kind}, q binary")


def unpacked(packed: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest center of each row (the smaller one among equals), and the squared distance; exact."""
    fits = max(np.abs(x).max(initial=0), np.abs(centers).max(initial=0)) <= _EXACT
    both = (x.astype(np.float64) @ centers.T.astype(np.float64)).astype(np.int64) if fits else x @ centers.T
    gap = (x * x).sum(1)[:, None] - 2 * both + (centers * centers).sum(1)[None, :]
    best = gap.argmin(1)
    return best, gap[np.arange(len(x)), best]


def _totals(distinct: DataFrame, centers: np.ndarray) -> list:
    """(c, w, s0, s1, ...) for each centroid that has vectors: their number and the sums of their components."""
    dims = centers.shape[1]
    names = ["c", "w", *[f"s{i}" for i in range(dims)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centers), dims + 1), np.int64)
        for b in batches:
            if b.num_rows:
                x, w = unpacked(b.column(0), dims), b.column(1).to_numpy()
                best, _ = nearest(x, centers)
                order = np.argsort(best, kind="stable")
                cut = np.flatnonzero(np.diff(best[order], prepend=-1))
                total[best[order[cut]]] += np.add.reduceat(np.column_stack([w, x * w[:, None]])[order], cut, axis=0)
        on = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(on), *[pa.array(total[on, i]) for i in range(dims + 1)]], names)

    sums = distinct.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    wide = "decimal(38,0)"  # sums of all tasks may leave 64 bits
    return sums.groupBy("c").agg(*[F.sum(F.col(n).cast(wide)).alias(n) for n in names[1:]]).collect()  # a row a centroid


def start_rows(rows: DataFrame, count: int, seed: int, dims: int) -> np.ndarray:
    """The vectors whose SHA-256 of ``<seed>:<id>`` is smallest, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("k").cast("string")), 256)
    first = rows.select(rank.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(count).collect()
    return np.frombuffer(b"".join(bytes(r.q) for r in first), "<i4").reshape(-1, dims).astype(np.int64)


def moved(centers: np.ndarray, totals: list) -> np.ndarray:
    """Each centroid that has vectors goes to the floor of their mean; integers of any size, so no rounding."""
    out = centers.copy()
    for r in totals:
        out[r["c"]] = [int(r[f"s{i}"]) // int(r["w"]) for i in range(centers.shape[1])]
    return out


def cluster(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding", scratch: Scratch | None = None
) -> DataFrame:
    """(``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each usable vector.

    With ``scratch`` the tables that the result reads are parts of it.
    """
    scratch = scratch.part("centroids") if scratch else Scratch(vectors.sparkSession, "centroids")
    rows = scratch.put(quantised(vectors, dims, scale, key, vector))
    n = rows.count()
    distinct = scratch.put(rows.groupBy("q").agg(F.count(F.lit(1)).alias("n")), n)
    centers = start_rows(rows, clusters, seed, dims)
    for _ in range(rounds if len(centers) else 0):
        centers = moved(centers, _totals(distinct, centers))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                best, gap = nearest(unpacked(b.column(0), dims), centers)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best.astype(np.int32)), pa.array(gap)], ["q", "n", "cluster", "distance"])

    done = scratch.put(distinct.select("q", "n").mapInArrow(assign, "q binary, n long, cluster int, distance long"), n)
    inertia = {r["cluster"]: r["s"] for r in done.groupBy("cluster").agg(F.sum(F.col("n") * F.col("distance")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]

    often = F.col("n") > max(1, n // _FREQUENT)
    few = F.broadcast(done.where(often).select("q", F.struct("cluster", "distance").alias("often")))  # _FREQUENT rows at most
    rest = done.where(~often).select("q", "cluster", "distance")
    held = rows.join(few, "q", "left")
    # rows that have their assignment go by their id instead, and meet nothing
    alone = F.when(F.col("often").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("k"), F.lit(1 << 20)).cast("int"))
    out = held.withColumn("alone", alone).join(rest.withColumn("alone", F.lit(0)), ["q", "alone"], "left")
    picked = lambda c: F.coalesce(F.col(f"often.{c}"), F.col(c)).alias(c)
    out = out.select(F.col("k").alias(key), picked("cluster"), picked("distance"))
    sums = F.array(*[F.lit(inertia.get(i, 0)).cast("long") for i in range(max(1, len(centers)))])
    ends = F.array(*[F.lit(d) for d in digest or [""]])
    at = F.col("cluster") + 1
    return out.select(
        key, "cluster", "distance", F.element_at(sums, at).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.element_at(ends, at).alias("centroid_sha256"),
    )
