"""Exact token-length histogram: totals, quantiles and truncated totals for every context limit from one small table.

Documents are counted by encoded length as they are scanned; only (length, count) pairs are shuffled. Suffix sums run over
ranges of lengths and then inside each range, so no task holds the whole histogram.

Defined results: a null or empty text has length 0; ids play no part; repeated rows count each; an empty table gives an empty histogram; other
columns are ignored unless they are named as groups, where null is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import lengths

RANGE = 1024


def histogram(docs: DataFrame, vocab_path: str, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """(*by, n_tokens, n_docs): documents of each encoded length."""
    keep = [*(by or []), text]
    return lengths(docs.select(*keep), vocab_path, text).groupBy(*(by or []), "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per length L: documents and tokens at least as long, share of documents below, and the total if all are cut to L.

    truncated_tokens = tokens of shorter documents + L * documents at least as long. ``quantile`` is the share of documents
    of at most L tokens, so the least L with quantile >= q is the q-quantile.
    """
    by = by or []
    h = hist.withColumn("range", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    ranges = h.groupBy(*by, "range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.partitionBy(*by).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    ranges = ranges.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("range").alias("_range"), *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in "dt"], *[F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"])
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("range") == F.col("_range")]
    inside = Window.partitionBy(*by, "range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(ranges, same).select(*by, "range", "n_tokens", "n_docs", "tokens", "d_after", "t_after", "d_all", "t_all")
    out = out.withColumn("docs_at_least", F.sum("n_docs").over(inside) + F.col("d_after")).withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("t_after"))
    cut = F.col("t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    return out.select(*by, "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_tokens"), ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("quantile"), F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit``; ``sums`` without groups."""
    row = sums.agg(F.max("total_tokens").alias("t"), F.sum(F.when(F.col("n_tokens") > limit, (F.col("n_tokens") - limit) * F.col("n_docs")).otherwise(0)).alias("over")).first()
    return int((row.t or 0) - (row.over or 0))
