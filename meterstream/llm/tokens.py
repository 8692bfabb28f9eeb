"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once; what is shuffled is one row for each length and
task.  Suffix sums over the distinct lengths then answer, for every context
limit, how many documents exceed it, how many tokens remain after truncation
and which quantile it is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .encode import encoder

#: Lengths for each block of the two-level suffix sums.
BLOCK = 1024


def encoded_length(text: Column, tokenizer: str) -> Column:
    """Number of ids of the whole text; 0 for null and empty texts."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        ids = encoder(tokenizer).ids
        return pa.array([len(ids(t)) if t else 0 for t in texts.to_pylist()], pa.int64())

    return count(text)


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``n_tokens, documents``: one row per distinct encoded length.

    Rows with a null text count as length 0, repeated rows count each time, an
    empty table gives no rows; columns other than the text aren't read.
    """
    return (docs.select(encoded_length(F.col(text), tokenizer).alias("n_tokens"))
            .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("documents")))


def context_totals(histogram: DataFrame) -> DataFrame:
    """Answers for the context limit at each distinct length.

    ``n_tokens`` (the limit), ``documents`` of that length, ``documents_over``
    (longer), ``documents_within``, ``tokens_within`` (tokens of the documents
    that fit), ``truncated_tokens`` (all documents cut at the limit),
    ``total_tokens``, ``quantile`` (share of documents that fit) and
    ``kept_share`` (of tokens; null if there are none).

    Between two neighbouring lengths no document ends, so ``totals_at`` fills
    in any other limit from the same histogram.
    """
    # Read twice below: written once, so that documents are encoded once.
    h = staged(histogram, "lengths").select(
        "n_tokens", "documents", F.floor(F.col("n_tokens") / BLOCK).alias("block"),
        (F.col("n_tokens") * F.col("documents")).alias("tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    blocks = (h.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
              .select("block", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "dt"],
                      *[F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"]))
    inside = (Window.partitionBy("block").orderBy(F.desc("n_tokens"))
              .rowsBetween(Window.unboundedPreceding, -1))
    s = (h.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_in")
                         for c in ("documents", "tokens")])
         .join(blocks, "block")
         .select("n_tokens", "documents", "d_all", "t_all",
                 (F.col("documents_in") + F.col("d_above")).alias("documents_over"),
                 (F.col("tokens_in") + F.col("t_above")).alias("tokens_over")))
    within = F.col("t_all") - F.col("tokens_over")
    cut = within + F.col("n_tokens") * F.col("documents_over")
    return s.select(
        "n_tokens", "documents", "documents_over",
        (F.col("d_all") - F.col("documents_over")).alias("documents_within"),
        within.alias("tokens_within"), cut.alias("truncated_tokens"),
        F.col("t_all").alias("total_tokens"),
        ((F.col("d_all") - F.col("documents_over")) / F.col("d_all")).alias("quantile"),
        F.when(F.col("t_all") > 0, cut / F.col("t_all")).alias("kept_share"))


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, documents_over, truncated_tokens, total_tokens`` for any limits asked for."""
    n, d = F.col("n_tokens"), F.col("documents")
    asked = [F.struct(F.lit(limit).cast("long").alias("context_limit"),
                      F.coalesce(F.sum(F.when(n > limit, d)), F.lit(0)).alias("documents_over"),
                      F.coalesce(F.sum(F.least(n, F.lit(limit)) * d), F.lit(0)).alias("truncated_tokens"),
                      F.coalesce(F.sum(n * d), F.lit(0)).alias("total_tokens")) for limit in limits]
    return histogram.agg(F.array(*asked).alias("a")).select(F.inline("a"))


def length_quantiles(totals: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the least length within which that share of the documents fits."""
    asked = [F.struct(F.lit(float(s)).alias("share"),
                      F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))).alias("n_tokens"))
             for s in shares]
    return totals.agg(F.array(*asked).alias("a")).select(F.inline("a"))
