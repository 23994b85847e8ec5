"""Keys of rows, for tables whose ids may be null or repeated, and broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeloom.plans.scratch import Scratch

ROW = "_row"
FEW = 300_000  # rows of a few numbers: about 30 MB as a hashed relation


def small(table: DataFrame, most: int = FEW) -> DataFrame:
    """``table`` marked for a broadcast if it has ``most`` rows at most; else as it is, for a shuffled join."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores before it while a column has that name (whatever the case)."""
    names = {c.lower() for c in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


def hashable(kind: T.DataType) -> bool:
    """Whether values of a type have a hash: those without a map at any depth."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def numbered(docs: DataFrame, scratch: Scratch, key: str) -> tuple[DataFrame, str]:
    """``docs``, written with a new column that numbers its rows in the order of ``key`` (nulls last, equal ids in any order), and that column's name."""
    row = free_name(ROW, docs.columns)
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name != key and hashable(f.dataType)]
    placed = docs.orderBy(F.asc_nulls_last(key), *([F.xxhash64(*others)] if others else []))
    return scratch.put(placed.withColumn(row, F.monotonically_increasing_id())), row


def keyed(docs: DataFrame, scratch: Scratch, key: str = "doc_id") -> tuple[DataFrame, str]:
    """The rows and the name of a long column that is never null and never repeated: ``key`` if it is so, else a new one in its order.

    The new one is written with the rows, so that every later read has the same.
    """
    ids = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # no row of a repeated id meets another before it is counted
    if docs.schema[key].dataType.typeName() in ("long", "integer", "short", "byte") and not ids.where((F.col("n") > 1) | F.col(key).isNull()).limit(1).count():
        return docs, key
    return numbered(docs, scratch, key)


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``gone``."""
    return docs.join(small(gone.select(key)), key, "left_anti")
