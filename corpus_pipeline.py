"""From raw documents to packed training sequences, and the registry of the package's queries.

Stages run in this order, each on all that the one before kept: toxic documents go; of near copies one stays;
documents with benchmark passages go; secrets are masked; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import decontaminate, ngram_join, packing, secrets, toxicity
from wattloom.llm.base import query, stored, table
from wattloom.llm.registry import ORACLE, QUERIES

# Models and tokens are no part of SQL; the pipeline is tested against a plain version instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


__all__ = ["ORACLE", "ORACLE_SQL", "QUERIES", "STAGES", "run"]
