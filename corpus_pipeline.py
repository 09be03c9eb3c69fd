"""Corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on what the stage before has
kept; all but the last return the columns of ``documents``.  Between stages
the rows go through Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import byte_bpe, decontaminate, jaccard, quality, secrets_scan
from ledgerlake.llm.registry import PATTERN, TOKENIZER, table
from ledgerlake.llm.store import land, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    ship(spark)
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark, and n_chars
    brought up to date."""
    return secrets_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (binary, and their digests)."""
    ship(spark)
    return byte_bpe.encode_documents(docs, TOKENIZER, PATTERN, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("byte_bpe", encode),
]

#: several stages can't be written in SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what the last one returns."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = land(docs, f"pipeline-{name}")
    return docs
