"""Corpus cleaning pipeline: every stage applies one training-data operator.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` writes each stage's result as Parquet to the
shared folder and hands the re-read table to the next stage, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanegraph.scratch import Scratch
from lanegraph.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; the model learns from three quarters
    of the labelled documents (those whose crc32(id) mod 4 is not 2)."""
    from lanegraph.llm.langid import id_remainder, keep_identified, train
    return keep_identified(docs, train(docs.where(id_remainder(docs["doc_id"], 4) != 2)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts stays (A-Z lower-cased)."""
    from lanegraph.llm.exact_dedup import drop_exact_copies
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates stays."""
    from lanegraph.llm.minhash import drop_near_copies
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    from lanegraph.llm.secrets import redact
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece of a document."""
    from lanegraph.llm.packing import pack_documents
    from lanegraph.llm.registry import word_bpe
    return pack_documents(docs, word_bpe())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", packing),
]

#: Language identification, sketches and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; superseded tables are deleted."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        done = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = done
    return docs
