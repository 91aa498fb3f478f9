"""From raw documents to packed training windows, in five stages.

Each stage takes what the one before kept. Between stages the documents are written as Parquet
to the shared folder and read again, so a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from panelkit.llm import cuckoo, dart_minhash, disclosure, packing, quality
from panelkit.llm.common import KNOWN_WORDS
from panelkit.operators.staging import settle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A document without an id is scored as well."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train_quality(docs, labels))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without blanks one stays."""
    return cuckoo.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return dart_minhash.drop_near_duplicates(docs)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are replaced in the texts."""
    out = disclosure.sanitise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns
    ) else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens. Workers that served other stages remember less."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), KNOWN_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("personal_data", personal_stage),
    ("packing", packing_stage),
]
# The classifier, the signatures and the windows cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
