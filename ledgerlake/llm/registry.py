"""Registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import byte_bpe, collocations, decontaminate, html_text, jaccard, language_model, licenses, mixing, nearest, quality, secrets_scan, sharding, vector_codes
from ledgerlake.llm.oracles import ORACLES
from ledgerlake.llm.store import ship

__all__ = ["ORACLES", "PATTERN", "QUERIES", "TOKENIZER", "table"]

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name; it ships the package first."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark, sf_dir):
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op2_nearest(spark, sf_dir):
    """The 20 nearest rows found of every 20th embedding."""
    return nearest.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op3_language_model(spark, sf_dir):
    """Log-probability of every document; those of fold 2 of 7 are held out."""
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op4_jaccard(spark, sf_dir):
    """Near-copy component of every document."""
    return jaccard.groups(table(spark, sf_dir, "documents"))


@query
def op5_byte_bpe(spark, sf_dir):
    """Token ids of every document, and the round trip back to bytes."""
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER, PATTERN)


@query
def op6_licenses(spark, sf_dir):
    """License phrases and templates in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_quality(spark, sf_dir):
    """Both views' scores, the calibrated score and the verdict for every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_sharding(spark, sf_dir):
    """Slot and shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents"))


@query
def op9_secrets(spark, sf_dir):
    """Secrets in every document."""
    found = secrets_scan.scan(table(spark, sf_dir, "documents"))
    n = [secrets_scan.count_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(secrets_scan.KINDS[:3])]
    return found.select("doc_id", *n, F.sha2(secrets_scan.digest(F.col("base")).cast("binary"), 256).alias("base_sha256"), secrets_scan.digest(F.col("spans")).alias("spans"))


@query
def op10_decontaminate(spark, sf_dir):
    """Benchmark items that documents hold, with their places."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_vector_codes(spark, sf_dir):
    """Code of every embedding, its error and the codebooks' digest."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark, sf_dir):
    """The first 2000 phrases of every language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


@query
def op13_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.shares(table(spark, sf_dir, "documents"))
