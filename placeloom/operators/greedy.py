"""Greedy matching in parallel rounds: a row settles as soon as no open earlier row can change what it does.

Rows look under their keys in turn and join the first earlier row that stayed under one. A key is sure if any two rows that have it are the
same: then it has one holder at most, the first row that stayed, and that is known once every row before it has joined another. So a
round needs two numbers per key, the first row that stayed and the first that is open, and no pair of rows: of a million
branches that share a site the first stays in one round, and all others join it in the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch
from .skew import with_values

NONE, WAIT, JOIN = 0, 1, 2


def settle(keys: DataFrame, scratch: Scratch, rounds: int = 12, least: float = 0.05, few: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(seq, into) of rows that join, (seq) of rows that stay, (seq) of rows still open, of ``keys`` (seq, pos, k, sure).

    ``pos`` orders the keys of a row; positions do not repeat. Rounds end when ``few`` rows at most are open, after ``rounds``, or
    when two in turn settle less than ``least`` of what was open, as in a chain in which each row waits for the one before. One such
    round says nothing: the few rows that stay in it are those that most others join in the next.
    """
    left, total = keys, keys.count()
    none = scratch.spark.createDataFrame([], "seq long, into long")
    held = scratch.put(keys.where("false").select("k", F.col("seq").alias("held")))
    joined, stayed = none, none.select("seq")
    open_ = keys.select("seq").distinct().count()
    slow = 0
    for _ in range(rounds):
        if open_ <= few:
            break
        none_yet = F.lit(None).cast("long")
        both = left.select("k", "seq", none_yet.alias("held")).unionAll(held.select("k", none_yet.alias("seq"), "held"))
        first = both.groupBy("k").agg(F.min("seq").alias("first"), F.count("seq").alias("c"), F.min("held").alias("held"))
        values = scratch.put(first.where("c > 0"), total)
        told = with_values(left, values, "k", "seq", total)
        known = F.col("held") < F.least("seq", "first")
        what = F.when(F.coalesce(known & F.col("sure"), F.lit(False)), JOIN).when((F.col("first") < F.col("seq")) | F.coalesce(F.col("held") < F.col("seq"), F.lit(False)), WAIT).otherwise(NONE)
        told = told.select("seq", "pos", what.alias("what"), "held")
        act = told.groupBy("seq").agg(F.min_by(F.struct("what", "held"), F.when(F.col("what") != NONE, F.col("pos"))).alias("x"))
        act = scratch.put(act.select("seq", F.coalesce("x.what", F.lit(NONE)).alias("what"), F.col("x.held").alias("into")), total)
        joins = act.where(F.col("what") == JOIN).select("seq", "into")
        stays = act.where(F.col("what") == NONE).select("seq")
        joined, stayed = joined.unionAll(joins), stayed.unionAll(stays)
        more = left.join(stays, "seq").groupBy("k").agg(F.min("seq").alias("held"))
        held = scratch.put(held.unionAll(more).groupBy("k").agg(F.min("held").alias("held")), total)
        waits = act.where(F.col("what") == WAIT).select("seq")
        left = scratch.put(left.join(waits, "seq"), total)
        was, open_ = open_, waits.count()
        slow = slow + 1 if was - open_ < least * was else 0
        if slow == 2:
            break
    return joined, stayed, left.select("seq").distinct()
