"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows its predecessor kept and passes all their columns;
the last one returns digests of the ids.  What a stage does with nulls, empty texts, repeated rows and
empty tables is stated by the operator it calls.  No stage can be said in SQL (a trained
classifier, hashed signatures, alignments, BPE merges), so ORACLE_SQL is None and the stages are tested against
brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from peerlens.llm import bpe, decontam, minhash, toxicity
from peerlens.llm.common import free_name, written
from peerlens.llm.queries import RANKS, TOXIC, toxicity_model


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the toxic limit."""
    score = free_name(docs, "toxicity")
    scored = toxicity.with_scores(docs, toxicity_model(docs, spark, sf_dir), score_col=score)
    return scored.where(scored[score] < TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate class."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every whole text, decoded again: digests of both."""
    coded = bpe.bpe_encode(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, decoded_col="decoded")
    return bpe.with_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
