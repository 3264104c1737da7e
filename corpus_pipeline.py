"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage works on all that the one before it kept, which is written and read again
in between, and all but the last return the columns of ``documents``. The near-duplicate and
packing stages are no SQL, so the whole has no oracle; it is tested against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourmart.llm import mixing, neardup, packing, quality, secretscan
from hourmart.llm.common import shared_folder
from hourmart.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies one document stays."""
    return neardup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secretscan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until sources have their target weights."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in training sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{number}.parquet"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
