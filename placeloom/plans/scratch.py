"""Intermediate tables in the shared checkpoint folder, so that a lost executor costs a re-read, not a re-run."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_SIZES = {"spark.sql.sources.fileCompressionFactor": "100", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k", "spark.sql.codegen.hugeMethodLimit": "8000"}
_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process (``local[N]``, as in tests) gets a temporary folder where none
    is set; on a cluster a folder of this machine would lose tables, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="placeloom-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package when it is run from a source tree, has them give back large arrays at once, and keeps batches small."""
    env = spark.sparkContext.environment
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(8 << 20))
    env.setdefault("MALLOC_TRIM_THRESHOLD_", str(16 << 20))
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    if spark.conf.get(_BATCH, None) is None:  # texts may be long, so batches end by bytes, not by rows alone
        spark.conf.set(_BATCH, str(4 << 20))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def measured(spark: SparkSession) -> SparkSession:
    """Sets, unless it is set, how Spark takes the sizes of venue tables, whose files and shuffled rows need a hundred times as much in memory.

    A file is broadcast unasked only if it is tiny (a table is, once its rows have been measured), and small partitions are put together
    only as far as no core is left without work. Code that is too long for the JVM to compile is cut up: venue expressions are long.
    """
    for key, value in _SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


class Scratch:
    """Tables of one run: ``put`` writes and rereads one, ``drop`` removes those that no later step reads.

    ``part`` gives an inner step a folder of its own, which ``clear`` removes as a whole once its result is written elsewhere.
    """

    def __init__(self, spark: SparkSession, label: str, base: str | None = None):
        ship(spark)
        self.spark = spark
        self.base = f"{base or shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        self.paths: dict[int, tuple[str, DataFrame]] = {}  # a table that is held keeps its id

    def part(self, label: str) -> Scratch:
        return Scratch(self.spark, label, self.base)

    def put(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """``df``, written and read again; with ``rows``, its rows at most, as files of a million rows, or as two files a core.

        So a small table is not a file for each of many shuffle partitions, and no core is left without work.
        """
        self.n += 1
        if rows is not None:
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, rows // 1_000_000))
        path = f"{self.base}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def _remove(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if own := self.paths.pop(id(t), None):
                self._remove(own[0])

    def clear(self) -> None:
        """Removes every table of this run and of its parts."""
        self.paths.clear()
        self._remove(self.base)
