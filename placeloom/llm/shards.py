"""Sharding in Hilbert-curve order: rows close in several metadata dimensions share files, so that files prune on all of them.

Each dimension is quantised to ``bits`` bits, the cells are numbered along a Hilbert curve by DataFrame expressions alone,
and the ordered rows are cut into runs. The law is ``rows``: run sizes differ by one row at most.

No step needs one task to see all rows: rows are counted by (cell, bucket of a mixed key), the counts of at most
2**(dimensions * bits) cells are summed by one small window, and each row is numbered inside its own bucket. The number of buckets of
a cell follows the number of rows, ``PER_BUCKET`` on average where one cell holds them all.

Defined results: a null or NaN dimension counts as the lowest value; ties in the curve order are settled by the mixed key, then
the key itself; a null key, or one that is no number, is replaced by a hash of its row, so such rows spread over buckets; repeated
keys keep a row each (their order among themselves is not defined, their shard sizes are); an empty table gives an empty result; other
columns are carried as they are, but for those named like the new ones (``hilbert_index``, ``position``, ``shard``, ``slot``), which
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import hashable

PER_BUCKET = 50_000
_LEAST = 1024  # buckets
_SPREAD = 1103515245  # odd multiplier of the mixed key; products stay below 2**63


def hilbert_index(cells: list[Column], bits: int) -> list[tuple[str, Column]]:
    """Steps (name, expression) that turn cell numbers of ``bits`` bits into the curve index, in the last step ``h``.

    Each step refers to those before it, so it is applied by its own projection (or SELECT). The axes are first undone from
    the highest bit down (an exchange where the bit is 0, an inversion where it is 1), then Gray coded, then interleaved.
    """
    n = len(cells)
    x = [f"x{i}" for i in range(n)]
    steps = [(x[i], c) for i, c in enumerate(cells)]
    col = F.col
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            on = col(x[i]).bitwiseAND(F.lit(q)) != 0
            if i == 0:
                steps.append((x[0], F.when(on, col(x[0]).bitwiseXOR(F.lit(low))).otherwise(col(x[0]))))
            else:
                swap = col(x[0]).bitwiseXOR(col(x[i])).bitwiseAND(F.lit(low))
                steps += [("s", F.when(on, F.lit(0).cast("long")).otherwise(swap)), ("v", F.when(on, F.lit(low).cast("long")).otherwise(F.lit(0).cast("long")))]
                steps += [(x[0], col(x[0]).bitwiseXOR(col("s")).bitwiseXOR(col("v"))), (x[i], col(x[i]).bitwiseXOR(col("s")))]
    for i in range(1, n):
        steps.append((x[i], col(x[i]).bitwiseXOR(col(x[i - 1]))))
    steps.append(("t", F.lit(0).cast("long")))
    for b in range(bits - 1, 0, -1):
        q = 1 << b
        steps.append(("t", F.when(col(x[n - 1]).bitwiseAND(F.lit(q)) != 0, col("t").bitwiseXOR(F.lit(q - 1))).otherwise(col("t"))))
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            bit = F.shiftright(col(x[i]).bitwiseXOR(col("t")), b).bitwiseAND(F.lit(1))
            index = index.bitwiseOR(F.shiftleft(bit, b * n + n - 1 - i))
    return [*steps, ("h", index)]


def bucket_bits(rows: int) -> int:
    """Bits of a bucket's number for this many rows."""
    return min(31, (max(_LEAST, rows // PER_BUCKET) - 1).bit_length())


def curve_order(df: DataFrame, cells: list[Column], bits: int, key: str, rows: int | None = None) -> DataFrame:
    """``df`` with ``hilbert_index`` and ``position``, its place from 0 in curve order; ``rows`` is its count, if it is known."""
    keep = [c for c in df.columns if c.lower() not in ("hilbert_index", "position")]
    names = {c: f"_c{i}" for i, c in enumerate(keep)}
    spare = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if hashable(f.dataType)])
    work = df.select(F.struct(*[F.col(f"`{c}`").alias(a) for c, a in names.items()]).alias("row"), F.coalesce(F.col(f"`{key}`").try_cast("long"), spare).alias("k"), *[F.coalesce(c.try_cast("long"), F.lit(0)).alias(f"x{i}") for i, c in enumerate(cells)])
    mixed = (F.pmod(F.col("k"), F.lit(1 << 32)) * F.lit(_SPREAD)) % F.lit(1 << 32)
    x = [f"x{i}" for i in range(len(cells))]
    work = work.withColumn("m", mixed).withColumn("b", F.shiftright("m", 32 - bucket_bits(df.count() if rows is None else rows)))
    count = work.groupBy(*x, "b").agg(F.count(F.lit(1)).alias("n"))
    # the curve index belongs to a cell, so it is worked out once for each of the few distinct cells
    cell = count.groupBy(*x).agg(F.sum("n").alias("n"))
    curve = cell.select("n", *[F.col(c).alias(f"i{c}") for c in x], *x)
    for name, expr in hilbert_index([F.col(c) for c in x], bits):
        curve = curve.withColumn(name, expr)
    ahead = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)  # at most 2**(bits * dimensions) rows
    curve = curve.select(*[F.col(f"i{c}").alias(c) for c in x], "h", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("cell_at"))
    inside = Window.partitionBy(*x).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    count = count.select(*x, "b", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("bucket_at"))
    count = count.join(curve, x).select(*x, "b", "h", (F.col("cell_at") + F.col("bucket_at")).alias("at"))
    placed = work.withColumn("r", F.row_number().over(Window.partitionBy(*x, "b").orderBy("m", "k"))).join(count, [*x, "b"])
    return placed.select(*[F.col(f"row.{a}").alias(c) for c, a in names.items()], F.col("h").alias("hilbert_index"), (F.col("at") + F.col("r") - 1).alias("position"))


def cut(df: DataFrame, shards: int, rows: int) -> DataFrame:
    """``shard`` and ``slot`` from ``position``: ``shards`` runs of ``rows`` rows in all, sizes one apart at most."""
    shard = F.expr(f"position * {shards}L div {max(rows, 1)}L")
    start = F.expr(f"({max(rows, 1)}L * shard + {shards - 1}L) div {shards}L")
    return df.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("position") - start)


def write_shards(df: DataFrame, cells: list[Column], bits: int, key: str, shards: int, path: str, files: int = 1) -> None:
    """Writes one folder ``shard=N`` per run, rows in curve order, cut into about ``files`` files each by ranges of the order.

    The writer's statistics give each file the range of every dimension, so readers skip files on any of them.
    """
    rows = df.count()
    out = cut(curve_order(df, cells, bits, key, rows), shards, rows)
    dealt = out.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)
