"""The corpus pipeline: documents to packed training sequences, one operator a stage.

Defined results: rows without a doc_id pass the near-duplicate and the mixing stage as they are and are not packed, as
no sequence could name them; of rows that are equal in doc_id and text one stays; null and empty texts are judged by
the classifier like any other and packed as their end token; extra columns pass all stages but the last; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoreg.llm import common, mixing, near, packing, quality, queries, secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably toxic or poor go."""
    model = quality.train(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return quality.keep_good(docs, model)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact_secrets(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest document stays."""
    return near.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept as often as the rate says that brings the domains to their target weights.

    The stages before have taken most toxic and poor documents out, so the domains are learnt from the whole table.
    """
    labels = common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    whole = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return mixing.mixed(docs, mixing.rates(docs, labels, train=whole))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, ids included, with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, *queries.tokenizer_paths(), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify_quality),
    ("near_dedup", drop_near_duplicates),
    ("secret_scans", scan_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL expresses the classifier, the sketches or the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
