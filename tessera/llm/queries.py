"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import UPPER, documents, labels
from tessera.llm.op01_minhash import document_fingerprints
from tessera.llm.op02_toxicity import toxicity
from tessera.llm.op03_simhash import simhash_components
from tessera.llm.op04_quality import quality
from tessera.llm.op05_exact_dedup import exact_dedup
from tessera.llm.op06_packing import pack_documents
from tessera.llm.op07_substring_dedup import substring_dedup
from tessera.llm.op08_token_counts import token_counts
from tessera.llm.op09_repeated_bytes import remove_repeats
from tessera.llm.op10_mixing import mix
from tessera.llm.op10_mixing import oracle_sql as mixing_sql
from tessera.llm.op11_resampling import oracle_sql as resampling_sql
from tessera.llm.op11_resampling import resample
from tessera.llm.op12_sharding import shard_documents
from tessera.llm.op13_search import oracle_sql as search_sql
from tessera.llm.op13_search import search

LOWER = UPPER.lower()


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return document_fingerprints(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    return simhash_components(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents, one row per document."""
    return exact_dedup(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token windows of all documents, one row per piece."""
    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ranges of every document that repeat earlier passages."""
    return substring_dedup(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings that occur elsewhere."""
    return remove_repeats(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling probability and decision of every document, scaled as in its SQL (largest 1)."""
    out = mix(documents(spark, sf_dir), share=None)
    return out.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
        F.round("_probability", 9).alias("probability"), F.col("_kept").alias("kept"),
    )


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole benchmark table."""
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, noisy score and rank of every document against the benchmark texts."""
    return resample(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, balanced in bytes, tokens and rows."""
    return shard_documents(documents(spark, sf_dir))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(documents(spark, sf_dir), benchmark(spark, sf_dir))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_fingerprints": op1_minhash_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_mixing": op10_mixing,
    "op11_resampling": op11_resampling,
    "op12_sharding": op12_sharding,
    "op13_search": op13_search,
}
ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": OP5_SQL.strip(),
    "op10_mixing": mixing_sql().strip(),
    "op11_resampling": resampling_sql().strip(),
    "op13_search": search_sql().strip(),
}
