"""A training-corpus pipeline: quality, exact and near duplicates, benchmark leaks, token lengths.

Each stage takes all that the one before it kept and returns the columns of ``documents``; the last adds the encoded length.

Defined results: stages go by rows, so null and repeated ids are documents of their own. A null text counts as empty: the classifier
scores it as any other, empty texts are exact copies of one another, link with nothing and leak nothing, and have no tokens. Of
equal texts the longest original stays, of near copies the first by id; nulls rank last, and rows of one id in any order. Columns
beyond those of ``documents`` are carried by each stage but the last. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.llm import bpe, gam, jaccard, quotient, templates
from placeloom.llm.queries import QUALITY, VOCAB, quality_model
from placeloom.llm.rows import keyed, without
from placeloom.plans.scratch import Scratch, ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_open: list[Scratch] = []  # of stages whose results have not been written yet

#: No SQL expresses the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def _scratch(spark: SparkSession, label: str) -> Scratch:
    _open.append(Scratch(spark, label))
    return _open[-1]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    ship(spark)
    return gam.keep(docs, quality_model(spark, sf_dir), QUALITY)


def _kept(docs: DataFrame, scratch: Scratch, gone) -> DataFrame:
    """The rows of ``docs`` without those whose keys ``gone`` (rows, key, scratch) returns; of its tables only the keys stay."""
    rows, key = keyed(docs, scratch)
    inner = scratch.part("work")
    left = scratch.put(gone(rows, key, inner).select(key), rows.count())
    inner.clear()
    return without(rows, left, key).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, whatever the ids."""
    return _kept(docs, _scratch(spark, "exact_dedup"), lambda rows, key, work: quotient.dedupe(rows, key=key, scratch=work).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group linked by five-word shingles at 0.8, whatever the ids."""
    return _kept(docs, _scratch(spark, "near_dedup"), lambda rows, key, work: jaccard.link_components(rows, k=5, num=80, den=100, key=key, scratch=work).where(F.col(key) != F.col("component_id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no question of the benchmark, in these or other values."""
    return templates.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch=_scratch(spark, "decontaminate")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number and digest of their tokens."""
    return bpe.digests(docs, VOCAB).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next, and what it was made of is removed."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), None
    for _, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir))
        while _open:
            _open.pop().clear()
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
