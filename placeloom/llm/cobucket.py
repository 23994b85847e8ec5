"""A co-bucketed pair of tables: one sorted Parquet file per table and bucket, made by an RDD partitioner with a secondary sort.

Both tables are dealt by the same hash of the join key, so bucket i of one joins bucket i of the other and nothing else. A row travels as
one byte string, bucket first, that sorts as (bucket, row) does: ``repartitionAndSortWithinPartitions`` deals by the bucket and sorts by
the whole string while it shuffles, spilling as it must. A task then streams its sorted rows into one Parquet writer per bucket, a
few thousand rows at a time, so a bucket with a third of all rows takes time but no memory.

Rows of the second table whose key is not in the first form bucket ``buckets``, rows without a key bucket ``buckets`` + 1. A file of the starting
layout that holds just the rows of one bucket, all of them, stays as it is and is not read for the rewrite. Files
are written under another name and renamed when complete, so a task that is run again leaves the same file. The rewritten starting
files and all leftovers are removed at the end; at no time is a row only in memory.

Files are opened by workers through ``pyarrow.fs``, so the folder must be one that it can reach (a mounted folder, HDFS, S3, GCS).

Defined results: nulls sort first in any column, texts by their UTF-8 bytes, not-a-number last, zeros of either sign alike; repeated rows are kept;
empty tables have no files and an empty table beside a full one leaves bucket ``buckets`` only; extra columns are carried, whatever
their names; columns of lists, structs, maps or decimals have no order here and are an error. Keys are integers.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from placeloom.plans.scratch import Scratch, shared_dir, ship

from . import rowbytes
from .rows import free_name

_ROWS = 200_000  # rows of a shuffle partition, about
_HELD = 8192  # rows that a writer holds
_FREQUENT = 1000  # keys with more than this share of the rows do not go through the join


@dataclass(frozen=True)
class Side:
    """One table of the pair while it is rewritten: its folder, schema and encoded rows (s starting file, b bucket, r bytes)."""

    name: str
    path: str
    schema: pa.Schema
    rows: DataFrame
    n: int


def bucket_of(key: Column, buckets: int, salt: str = "s") -> Column:
    """The bucket of a key: unsigned CRC-32 of ``salt`` and the decimal key; null without a key."""
    return F.pmod(F.crc32(F.concat(F.lit(salt), key.cast("string")).cast("binary")), F.lit(buckets)).cast("int")


def _row_order(columns: list[str], key: str) -> list[str]:
    return [key, *[c for c in columns if c != key]]


def _quoted(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def write_numbered(df: DataFrame, path: str, number: Column, files: int, key: str) -> None:
    """Writes ``df`` as one sorted file for each value of ``number`` (0 to ``files`` - 1) that has rows, and nothing else."""
    order = [_quoted(c).asc_nulls_first() for c in _row_order(df.columns, key)]
    dealt = df.repartitionById(files, number.cast("int")).sortWithinPartitions(*order)
    dealt.write.option("maxRecordsPerFile", 0).parquet(path)


class _Folder:
    """Names and removal of files through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path, spark._jvm
        self.fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self) -> list[str]:
        return [f.getPath().getName() for f in self.fs.listStatus(self._at(self.path))] if self.fs.exists(self._at(self.path)) else []

    def remove(self, *names: str) -> None:
        for n in names:
            self.fs.delete(self._at(f"{self.path}/{n}" if n else self.path), True)


def _numbers(folder: _Folder) -> dict[int, str]:
    """Starting files of a folder by their number: one for each, so as many as there are buckets at most."""
    return {int(m[1]): n for n in folder.names() if (m := re.match(r"part-(\d+)-", n))}


def _encoded(rows: DataFrame, columns: list[str], key: str, number: str, bucket: str, schema: pa.Schema) -> DataFrame:
    """(s, b, r): starting file, bucket, and bucket and row as bytes that sort as they do."""
    order = _row_order(columns, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, b, *own = batch.columns
            place = b.to_numpy().astype(">u2").view(np.uint8).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([s, b, rowbytes.encode(own, place)], ["s", "b", "r"])

    rowbytes.check(schema)
    picked = rows.select(_quoted(number), _quoted(bucket), *[_quoted(c) for c in order])
    return picked.mapInArrow(run, "s int, b int, r binary")


def _with_file(spark: SparkSession, path: str, like: DataFrame, name: str) -> DataFrame:
    """The rows of a starting layout with the number of their file."""
    read = spark.read.schema(like.schema).parquet(path)
    return read.withColumn(name, F.regexp_extract(F.input_file_name(), r"/part-(\d+)-[^/]*$", 1).cast("int"))


def _known(lines: DataFrame, key: str, keys: DataFrame, n: int, found: str) -> DataFrame:
    """``lines`` with a column that tells whether their key is in ``keys`` (one column, no repeats).

    Keys with more than a share of 1 / ``_FREQUENT`` of the rows, so that many at most, are looked up apart; their rows and rows
    without a key are spread by their own values, so the join deals out no hot key.
    """
    count = lines.where(_quoted(key).isNotNull()).groupBy(_quoted(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    often = count.where(F.col("n") > max(1, n // _FREQUENT)).join(keys, "k", "left_outer")
    often = [(r["k"], r["in"]) for r in often.select("k", F.col("one").isNotNull().alias("in")).collect()]
    apart = _quoted(key).isNull() | _quoted(key).isin([k for k, _ in often])
    spread = free_name("_spread", lines.columns)
    taken = free_name("_one", lines.columns)
    values = F.xxhash64(*[_quoted(c) for c in lines.columns])
    own = lines.withColumn(spread, F.when(apart, 1 + F.pmod(values, F.lit(1 << 16)).cast("int")).otherwise(0))
    there = keys.select(F.col("k").alias(f"{taken}_k"), F.lit(0).alias(f"{taken}_s"), F.col("one").alias(taken))
    met = own.join(there, (_quoted(key) == F.col(f"{taken}_k")) & (_quoted(spread) == F.col(f"{taken}_s")), "left")
    sure = _quoted(key).isin([k for k, known in often if known])
    told = F.when(_quoted(key).isNull(), F.lit(False)).when(_quoted(spread) > 0, sure).otherwise(F.col(taken).isNotNull())
    return met.withColumn(found, told).drop(spread, taken, f"{taken}_k", f"{taken}_s")


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return pyarrow.fs.LocalFileSystem(), path


def rewrite(side: Side, key: str, stays: list[int], work: str) -> None:
    """Writes one file per bucket from the encoded rows, but for those of the starting files ``stays``."""
    order = _row_order(side.schema.names, key)
    sorted_schema = pa.schema([side.schema.field(c) for c in order])
    name, path, schema = side.name, side.path, side.schema

    def write(rows: Iterator[tuple[bytes, None]]) -> Iterator[int]:
        fs, to = _opened(path)
        _, aside = _opened(work)
        fs.create_dir(aside, recursive=True)
        now, held, out, at = -1, [], None, ""

        def flush() -> None:
            if held:
                got = rowbytes.decode(held, 2, sorted_schema)
                out.write_batch(got.select(schema.names))
                held.clear()

        def close() -> None:
            if out is not None:
                flush()
                out.close()
                final = f"{to}/bucket-{now:05d}.parquet"
                if fs.get_file_info(final).type != pyarrow.fs.FileType.NotFound:
                    fs.delete_file(final)
                fs.move(at, final)

        for r, _ in rows:
            b = r[0] << 8 | r[1]
            if b != now:
                close()
                if now >= 0:
                    yield now
                now, at = b, f"{aside}/{name}-{b:05d}-{uuid.uuid4().hex}"
                out = pq.ParquetWriter(fs.open_output_stream(at), schema, compression="snappy")
            held.append(r)
            if len(held) == _HELD:
                flush()
        close()
        if now >= 0:
            yield now

    moved = side.rows.where(~F.col("s").isin(stays)) if stays else side.rows
    pairs = moved.select("r").rdd.map(lambda x: (bytes(x[0]), None))
    cores = side.rows.sparkSession.sparkContext.defaultParallelism
    parts = max(2 * cores, side.n // _ROWS)
    dealt = pairs.repartitionAndSortWithinPartitions(parts, partitionFunc=lambda r: r[0] << 8 | r[1])
    dealt.mapPartitions(write).count()


def _runs(path: str, key: str, told: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of a sorted file and how often each occurs, in pieces that share no key; ``told`` gets the file's digest, rows and columns."""
    fs, at = _opened(path)
    digest, n, last = hashlib.sha256(), 0, None
    with fs.open_input_file(at) as source:
        file = pq.ParquetFile(source)
        told["columns"] = ",".join(file.schema_arrow.names)
        for batch in file.iter_batches(1 << 16, columns=[key]):
            ids = batch.column(0)
            if not len(ids):
                continue
            text = ",".join(pc.fill_null(ids.cast(pa.string()), "").to_pylist())
            digest.update(("," if n else "").encode() + text.encode())
            n += len(ids)
            value, count = np.unique(ids.drop_null().to_numpy(), return_counts=True)
            if last is not None and len(value):
                if value[0] == last[0][0]:
                    count[0] += last[1][0]
                else:
                    yield last
            if len(value):
                last = value[-1:], count[-1:]
                if len(value) > 1:
                    yield value[:-1], count[:-1]
    if last is not None:
        yield last
    told |= {"n": n, "sha": digest.hexdigest()}


def _meeting(left: Iterator[tuple[np.ndarray, np.ndarray]], right: Iterator[tuple[np.ndarray, np.ndarray]]) -> int:
    """Rows of the join of two sorted files by their runs."""
    total, x, y = 0, next(left, None), next(right, None)
    while x is not None and y is not None:
        upto = min(x[0][-1], y[0][-1])
        i, j = np.searchsorted(x[0], upto, "right"), np.searchsorted(y[0], upto, "right")
        _, p, q = np.intersect1d(x[0][:i], y[0][:j], assume_unique=True, return_indices=True)
        total += int((x[1][:i][p] * y[1][:j][q]).sum())
        x = (x[0][i:], x[1][i:]) if i < len(x[0]) else next(left, None)
        y = (y[0][j:], y[1][j:]) if j < len(y[0]) else next(right, None)
    for rest in (left, right):
        for _ in rest:
            pass
    return total


def _read_back(spark: SparkSession, files: dict[int, dict[str, str]], key: str) -> DataFrame:
    """(table_name, bucket, path, columns, n_rows, ids_sha256, n_joined) from the files: a bucket of both tables is one streamed merge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, names, paths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                told = [{} for _ in names]
                runs = [_runs(p, key, t) for p, t in zip(paths, told, strict=True)]
                met = _meeting(*runs, *[iter(()) for _ in range(2 - len(runs))])
                rows = [[x[c] for x in told] for c in ("columns", "n", "sha")]
                columns = [names, [b] * len(names), paths, *rows, [met] * len(names)]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _READ)

    listed = [(b, list(own), list(own.values())) for b, own in sorted(files.items())]
    cores = spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame(listed, "b long, names array<string>, paths array<string>").repartition(max(1, min(len(listed), 8 * cores)), "b")
    return rows.mapInArrow(run, "table_name string, bucket long, path string, columns string, n_rows long, ids_sha256 string, n_joined long")


_READ = ["table_name", "bucket", "path", "columns", "n_rows", "ids_sha256", "n_joined"]


def pair(
    first: DataFrame, second: DataFrame, key: str, names: tuple[str, str], starts: tuple[Column, Column], buckets: int = 600, base: str | None = None
) -> DataFrame:
    """Writes both tables in files numbered by ``starts`` into a new folder, then rewrites them there by bucket of ``key``.

    ``starts`` are integer columns of 0 to ``buckets`` + 1. Returns a row for each final file: table_name, path, columns,
    ids_sha256, lineage_sha256, bucket, n_rows, n_joined, rewritten.
    """
    spark = first.sparkSession
    ship(spark)
    base = base or f"{shared_dir(spark)}/cobucket-{uuid.uuid4().hex[:12]}"
    scratch, sides = Scratch(spark, "cobucket-work"), []
    for name, df, number in zip(names, (first, second), starts, strict=True):
        write_numbered(df, f"{base}/{name}", number, buckets + 2, key)
    keys = spark.read.schema(first.schema).parquet(f"{base}/{names[0]}").select(_quoted(key).alias("k"))
    keys = scratch.put(keys.where("k is not null").groupBy("k").agg(F.lit(1).alias("one")))
    for i, (name, df) in enumerate(zip(names, (first, second), strict=True)):
        path, number, place, found = f"{base}/{name}", *(free_name(c, df.columns) for c in ("_file", "_bucket", "_found"))
        rows = _with_file(spark, path, df, number)
        n = rows.count()
        own = F.coalesce(bucket_of(_quoted(key), buckets), F.lit(buckets + 1))
        if i:
            rows = _known(rows, key, keys, n, found)
            own = F.when(_quoted(key).isNull() | _quoted(found), own).otherwise(buckets)
        schema = to_arrow_schema(df.schema)
        rows = _encoded(rows.withColumn(place, own), df.columns, key, number, place, schema)
        sides.append(Side(name, path, schema, scratch.put(rows), n))

    files: dict[int, dict[str, str]] = {}
    lineage = []
    for side in sides:
        folder = _Folder(spark, side.path)
        origin = scratch.put(side.rows.groupBy("b", "s").agg(F.count(F.lit(1)).alias("n")), side.n)
        alone = origin.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("b").alias("b")).where("c = 1")
        whole = origin.groupBy("b").agg(F.count(F.lit(1)).alias("c"), F.min("s").alias("s")).where("c = 1")
        stays = {r.b: r.s for r in alone.join(whole, ["b", "s"]).select("b", "s").collect()}  # as many as buckets at most
        rewrite(side, key, sorted(stays.values()), f"{base}/_writing")
        start = _numbers(folder)
        for b, s in stays.items():
            files.setdefault(b, {})[side.name] = f"{side.path}/{start[s]}"
        folder.remove(*[n for n in folder.names() if not n.startswith("bucket-") and n not in {start[s] for s in stays.values()}])
        for n in folder.names():
            if m := re.match(r"bucket-(\d+)\.parquet$", n):
                files.setdefault(int(m[1]), {})[side.name] = f"{side.path}/{n}"
        each = F.array_sort(F.collect_list(F.struct("s", "n")))
        text = F.array_join(F.transform(each, lambda x: F.concat(x["s"].cast("string"), F.lit(":"), x["n"].cast("string"))), ",")
        told = origin.groupBy(F.col("b").cast("long").alias("bucket")).agg(F.sha2(text, 256).alias("lineage_sha256"))
        lineage.append(told.withColumn("table_name", F.lit(side.name)))
    _Folder(spark, f"{base}/_writing").remove("")
    read = _read_back(spark, files, key)
    out = read.join(lineage[0].unionByName(lineage[1]), ["table_name", "bucket"])
    out = out.withColumn("rewritten", F.regexp_extract("path", "([^/]*)$", 1).startswith("bucket-"))
    report = Scratch(spark, "cobucket-report").put(out.select("table_name", "path", "columns", "ids_sha256", "lineage_sha256", "bucket", "n_rows", "n_joined", "rewritten"), 2 * buckets + 4)
    scratch.clear()
    return report
