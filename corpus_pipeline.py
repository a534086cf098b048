"""Corpus pipeline over ``documents``: each stage reads all that its predecessor kept.

Every function takes ``(spark, docs, sf_dir)``; all but the last return the columns of
documents, whatever further columns the table has.  Null texts count as empty.  Rows
without a doc_id are judged by every stage like any other row, whole texts are read
whatever their length, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import UPPER, content_key, documents, keep_rows, labels, text_of
from tessera.llm.op02_toxicity import train_toxicity
from tessera.llm.op03_simhash import component_keys
from tessera.llm.op05_exact_dedup import kept_keys
from tessera.llm.op06_packing import pack_documents
from tessera.llm.op10_mixing import mix
from tessera.llm.queries import vocabulary
from tessera.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5; a row is judged by its text alone, repeated rows alike."""
    model = train_toxicity(docs, labels(spark, sf_dir))
    return docs.where(model.column(text_of(docs)) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document, that with the largest doc_id (empty texts are equal; a repeated row counts once).

    Where no row of a text has an id, one of them stays.
    """
    return keep_rows(docs, kept_keys(docs), content_key(F.translate(text_of(docs), UPPER, UPPER.lower())))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one document, that with the smallest doc_id.

    Of one id's texts in a component the one with the least digest; rows without an
    id come after all others, and a component of such rows keeps one of them.
    """
    content = content_key(text_of(docs))
    return keep_rows(docs, component_keys(docs, content), content)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by probabilities raked to source, language and topic targets."""
    return mix(docs).where("_kept").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left, one row per piece."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned scores, XXH64 fingerprints and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are a Parquet table in the shared checkpoint folder."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
