"""The corpus pipeline: language ID, quality rules, near-duplicates, secrets, packing.

``run`` applies the stages to ``documents``; each stage reads what the one before it has written. All stages but
the last return the columns of documents. ``ORACLE_SQL`` is None: estimated models, connected components and
packing have no SQL; the pipeline is tested against its stages' brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlens.llm import language, packing, quality, secret_scan, text_dedup
from reviewlens.llm.common import stored
from reviewlens.llm.queries import BPE_FILE


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that has most of the probability, go."""
    model = language.train(docs.where(~language.held_out()).select("text", "lang"))
    return language.drop_unknown(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that the label model thinks bad, go."""
    return quality.drop_low_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word Jaccard 0.8 or more stays: the one with the smallest doc_id."""
    return text_dedup.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to the name of their kind in brackets; no document goes."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.digests(packing.pack(docs, BPE_FILE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
