"""Gapless numbers along a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import Scratch

_BITS = 33  # of the place within a partition in what Spark numbers rows by


def numbered(rows: DataFrame, order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """``rows`` with ``name``, their place from 0 in ``order``, which should tell rows apart.

    Rows are range-sorted and written with their place inside their range; what each range starts with follows from a count per range.
    """
    sorted_ = scratch.put(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranges = sorted_.groupBy(F.shiftright("_at", _BITS).alias("_range")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range
    starts = ranges.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    met = sorted_.withColumn("_range", F.shiftright("_at", _BITS)).join(F.broadcast(starts), "_range")
    return met.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << _BITS) - 1)).drop("_at", "_range", "_start")
