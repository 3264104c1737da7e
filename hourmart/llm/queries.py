"""The text operators as registered queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import (
    language,
    lexical,
    mixing,
    nearest,
    neardup,
    negatives,
    oracles,
    packing,
    quality,
    scoring,
    secretscan,
    spotsigs,
    substrings,
    toxicity,
)
from hourmart.llm.common import id_hash, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    """Where the vocabulary of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The order of the rules, and so the one that rejects first, comes from measured times.
    return quality.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op7_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"), id_hash(7) != 2, tokenizer())


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), id_hash(4) != 2)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare(table(spark, sf_dir, "documents"))


def fingerprint_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.links(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.score(docs, labels, id_hash(5) != 0)


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical.ranked_documents(docs, items)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("vec_id")
    return negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), vec_id % 50 == 0, vec_id % 7 == 0
    )


QUERIES: dict[str, Query] = {
    "op1_substrings": op1_substrings,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_secrets": op4_secrets,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_scoring": op7_scoring,
    "op8_language": op8_language,
    "op9_fingerprints": op9_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_nearest": op11_nearest,
    "op12_ranked_search": op12_ranked_search,
    "op13_hard_negatives": op13_hard_negatives,
    "fingerprint_links": fingerprint_links,
}
ORACLES: dict[str, str] = {
    "op1_substrings": oracles.SUBSTRINGS,
    "op3_mixing": oracles.MIXING,
    "op6_quality": oracles.QUALITY,
    "op11_nearest": oracles.NEAREST,
    "op12_ranked_search": oracles.RANKED_SEARCH,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
