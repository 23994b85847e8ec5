"""Append-only logs as streams: records arrive in files, the last one of each key wins.

The batch counterpart is ``sources.readers.last_wins``; this keeps the same table current while records arrive, merged on read:

    target/v=N           what version N consists of: one row, with a base and the deltas since for each bucket of keys
    target/delta/n=N     the records of batch N, one for each key, a file a bucket
    target/base/n=N      buckets that batch N has compacted

A batch writes its own records and those buckets whose deltas have outgrown their base, so over time a record is written a bounded
number of times, however large the table is. Every version that has its ``_SUCCESS`` is whole.
"""

from __future__ import annotations

import json
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

BUCKETS = 64
_VERSION = "fields string, key string, pos string, buckets array<struct<bucket: int, base: bigint, since: bigint, base_rows: bigint, delta_rows: bigint>>"


@dataclass
class Bucket:
    """Its base is that of batch ``base`` (-1: none), followed by the deltas from batch ``since`` on."""

    bucket: int
    base: int = -1
    since: int = 0
    base_rows: int = 0
    delta_rows: int = 0


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _latest(spark: SparkSession, target: str) -> int:
    """The newest finished version."""
    fs, p = _path(spark, target)
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    whole = [int(x[2:]) for x in found if x.startswith("v=") and exists(spark, f"{target}/{x}/_SUCCESS")]
    if not whole:
        raise ValueError(f"no finished version in {target}")
    return max(whole)


def _version(spark: SparkSession, target: str, number: int) -> tuple[StructType, str, str, dict[int, Bucket]]:
    (row,) = spark.read.schema(_VERSION).parquet(f"{target}/v={number}").collect()  # one row, bounded by the number of buckets
    return StructType.fromJson(json.loads(row.fields)), row.key, row.pos, {b.bucket: Bucket(*b) for b in row.buckets}


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias("_bucket")


def _last(rows: DataFrame, key: str, pos: str, extra: list[str]) -> DataFrame:
    """One row for each key, by partial aggregation, so a key with a third of the records is one row a task."""
    names = rows.columns
    order = F.struct(F.col(pos), F.col("_n"), F.to_json(F.struct(*[c for c in names if c not in extra])))
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*names), order).alias("_row"))
    return best.select("_row.*")


def _put(rows: DataFrame, path: str, buckets: int) -> dict[int, int]:
    """Writes ``rows`` as a file a bucket; the number of rows of each."""
    rows.repartition(buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
    back = rows.sparkSession.read.schema("_n long, _bucket int").parquet(path)
    return {r[0]: r[1] for r in back.groupBy("_bucket").count().collect()}  # as many as buckets


def _rows(spark: SparkSession, target: str, fields: StructType, state: dict[int, Bucket], upto: int) -> DataFrame:
    """Base rows and later deltas of the buckets of ``state``; only their folders are read."""
    schema = StructType([*fields.fields, *StructType.fromDDL("_n long, _bucket int, n long").fields])
    parts = [spark.createDataFrame([], schema)]
    b, n = F.col("_bucket"), F.col("n")

    def of(column: str, some: list[Bucket]) -> Column:  # at most as many entries as buckets, a condition on folders alone
        return F.element_at(F.create_map(*[F.lit(x) for own in some for x in (own.bucket, getattr(own, column))]), b)

    if some := [x for x in state.values() if x.base >= 0]:
        parts.append(spark.read.schema(schema).parquet(f"{target}/base").where(n == of("base", some)))
    if some := [x for x in state.values() if x.delta_rows]:
        parts.append(spark.read.schema(schema).parquet(f"{target}/delta").where((n >= of("since", some)) & (n <= upto)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("n")


def current(spark: SparkSession, target: str) -> DataFrame:
    """The table that ``follow`` keeps, in its latest finished version: bases and deltas, the last record of each key."""
    number = _latest(spark, target)
    fields, key, pos, state = _version(spark, target, number)
    return _last(_rows(spark, target, fields, state, number), key, pos, ["_n", "_bucket"]).select(fields.names)


def merge(batch: DataFrame, number: int, target: str, key: str = "key", pos: str = "pos", buckets: int = BUCKETS, ratio: float = 0.5, floor: int = 100_000, work: float = 4.0) -> None:
    """Makes version ``number`` of ``target``: version ``number`` - 1 and the records of ``batch``.

    A bucket is compacted once its deltas have more than ``floor`` rows and ``ratio`` times those of its base; the most overdue ones
    first, as many as have ``work`` times the rows of this batch, one at least. Of records at one place those of the later batch win, then
    the greater as text; records without a key are left out. A repeated batch writes the same version again from the one before, which is
    kept, with all its folders, until the next one is finished; so a reader that has just begun can finish. ``buckets``, ``key`` and
    ``pos`` may not change.
    """
    spark = batch.sparkSession
    fields = batch.schema
    before: dict[int, Bucket] = _version(spark, target, number - 1)[3] if number > 0 else {}
    rows = batch.where(F.col(key).isNotNull()).withColumn("_n", F.lit(number).cast("long"))
    got = _put(_last(rows.select("*", _bucket(key, buckets)), key, pos, ["_n", "_bucket"]), f"{target}/delta/n={number}", buckets)
    state = {b: Bucket(*astuple(x)) for b, x in before.items()}
    for b, n in got.items():
        own = state.setdefault(b, Bucket(b, since=number))
        own.delta_rows += n
    due, spent = {}, 0
    for x in sorted(state.values(), key=lambda x: (x.base_rows - x.delta_rows / ratio, x.bucket)):
        if x.delta_rows > max(floor, ratio * x.base_rows) and (not due or spent + x.base_rows + x.delta_rows <= work * sum(got.values())):
            due[x.bucket] = x
            spent += x.base_rows + x.delta_rows
    if due:
        whole = _last(_rows(spark, target, fields, due, number), key, pos, ["_n", "_bucket"])
        for b, n in _put(whole, f"{target}/base/n={number}", buckets).items():
            state[b] = Bucket(b, number, number + 1, n, 0)
    row = (fields.json(), key, pos, [astuple(state[b]) for b in sorted(state)])
    spark.createDataFrame([row], _VERSION).coalesce(1).write.mode("overwrite").parquet(f"{target}/v={number}")
    if number > 1:
        _forget(spark, target, number - 2, before)


def _forget(spark: SparkSession, target: str, old: int, since: dict[int, Bucket]) -> None:
    """Removes version ``old`` and what it has that the next one, ``since``, has not."""
    if not exists(spark, f"{target}/v={old}/_SUCCESS"):
        return
    for b, x in _version(spark, target, old)[3].items():
        new = since[b]
        if new.base == x.base:
            continue
        _delete(spark, f"{target}/base/n={x.base}/_bucket={b}")
        for n in range(x.since, new.since):
            _delete(spark, f"{target}/delta/n={n}/_bucket={b}")
    _delete(spark, f"{target}/v={old}")


def follow(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str = "key", pos: str = "pos", files: int = 0, **options) -> StreamingQuery:
    """Keeps ``target`` at the last record of each key; ``current`` reads it, a batch has ``files`` files (0: all), ``options`` go to ``merge``.

    Each batch makes a version of its own. If the version before is gone the query fails: it never starts again from nothing.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        rows = batch.where("_corrupt_record is null").drop("_corrupt_record") if "_corrupt_record" in batch.columns else batch
        merge(rows, number, target, key, pos, **options)

    stream = spark.readStream.schema(schema)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    return stream.json(source).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
