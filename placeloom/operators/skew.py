"""Joins with one row per key that deal out no hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT = 1000  # keys at most that can have more than this share of the rows
LEAST = 1000  # rows that a key has at least, to be dealt


def with_values(rows: DataFrame, values: DataFrame, key: str, spread: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``values`` (``key``, no repeats; ``c``, its number of rows in ``rows``), null where it has none.

    Keys with more than ``total`` / ``HOT`` rows, so that many keys at most, are broadcast; their rows and rows without a key are dealt by
    their column ``spread`` and meet nobody. ``values`` is read twice, so it should be a written table.

    Both joins are by the hash of a key, and keys are compared after them: a broadcast of texts takes a whole page of memory (64 MB), however
    few they are, one of numbers what it holds.
    """
    names = [c for c in values.columns if c not in (key, "c")]
    often = F.col("c") > max(LEAST, total // HOT)
    listed = lambda which, name: values.where(which).groupBy(F.xxhash64(key).alias("_at")).agg(F.collect_list(F.struct(F.col(key).alias("k"), F.struct(*names).alias("v"))).alias(name))
    own = lambda name: F.try_element_at(F.filter(name, lambda x: x["k"] == F.col(key)), F.lit(1))["v"]
    met = rows.withColumn("_at", F.xxhash64(key)).join(F.broadcast(listed(often, "_hots")), "_at", "left").withColumn("_hot", own("_hots"))
    met = met.withColumn("_at", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.col("_at")))
    met = met.join(listed(~often, "_cools"), "_at", "left").withColumn("_cool", own("_cools"))
    return met.select(*rows.columns, *[F.coalesce(f"_hot.{c}", f"_cool.{c}").alias(c) for c in names])


def dealt(key: str, spread: str) -> Column:
    """Text ``key`` for a left join: rows without one, which meet nobody, are dealt by ``spread`` and not all to the task of the null."""
    return F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64(spread).cast("string")))


def bounded(table: DataFrame, most: int = 300_000) -> DataFrame:
    """``table`` marked for a broadcast if it has ``most`` rows at most (some ten MB of a few numbers each); else as it is, for a shuffled join."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table
