"""The registered queries of the operators: thin applications to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoreg.llm import alignment, common, conversations, fingerprint, langid, mixing, near, packing, quality, repeats, secrets, suffix, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_paths() -> tuple[str, str]:
    """The vocabulary as tokenizer and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def alignment_paths() -> tuple[str, str, str]:
    """Both vocabularies, and the first one as ranks."""
    import public_tokenizers

    byte_tokenizer, ranks = tokenizer_paths()
    return byte_tokenizer, public_tokenizers.path("piece_bpe_32k.model"), ranks


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best partners of each vector whose id is divisible by 100, among all others."""
    vectors = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with expected grade and tail probabilities."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return quality.score(docs, model).where(F.col("p_good") >= quality.KEEP)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack_documents(common.table(spark, sf_dir, "documents", "doc_id", "text"), *tokenizer_paths())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text."""
    return fingerprint.fingerprints(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page."""
    model = langid.train(common.table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return langid.identify(common.table(spark, sf_dir, "pages", "page_id", "url", "html"), model)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.digest(secrets.find_secrets(common.table(spark, sf_dir, "documents", "doc_id", "text")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of every document that brings the domains to their target weights."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return mixing.rates(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that a smaller document holds."""
    return repeats.digest(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near.near_duplicates(common.table(spark, sf_dir, "documents", "doc_id", "text"), similarity=0.85)


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a smaller document holds."""
    return suffix.digest(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of every damaged conversation."""
    return conversations.digest(common.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt without a fifth of the labels."""
    return toxicity.digest(common.table(spark, sf_dir, "documents", "doc_id", "text"), common.table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of both tokenizers on every document."""
    return alignment.align(common.table(spark, sf_dir, "documents", "doc_id", "text"), *alignment_paths())


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_langid": op5_langid,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_repeats": op8_repeats,
    "op9_near": op9_near,
    "op10_suffix": op10_suffix,
    "op11_conversations": op11_conversations,
    "op12_toxicity": op12_toxicity,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {"op1_topk": topk.ORACLE}
