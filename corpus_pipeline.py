"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstream.llm import decontamination, packing, pseudonyms, quality_model, simhash
from meterstream.llm.common import staged, table
from meterstream.llm.queries import DEMO_KEY, tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of label 1 stay."""
    labels = table(spark, sf_dir, "labels").filter(~quality_model.held_out(F.col("doc_id")))
    scored = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return (quality_model.with_scores(scored, quality_model.train(docs, labels))
            .filter("predicted = 1").select("row.*"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.deduplicate(docs, shingle=4, max_distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates, addresses and secrets get pseudonyms of the same length."""
    return pseudonyms.pseudonymise(docs, DEMO_KEY, found=None)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.pack(docs, tokenizer_file(), context=2048, end=0)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: No stage can be said in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
