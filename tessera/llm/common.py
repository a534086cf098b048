"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole labels table."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def token_estimate(text: Column) -> Column:
    """Tokens of a text, estimated: its words between blanks, or an eighth of its bytes where it has few blanks (empty: 0)."""
    gaps = F.length(text) - F.length(F.translate(text, " \n\t", ""))
    return F.when(text == "", F.lit(0).cast("long")).otherwise(F.greatest(gaps + 1, F.ceil(F.octet_length(text) / 8)).cast("long"))


def held_out(doc_id: Column) -> Column:
    """Fold rule of the contracts: crc32 of the id's decimal text, remainder 0 of 5 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, marks: DataFrame, label: str, bound: int) -> DataFrame:
    """Labelled rows of the training folds ``(text, y)``, at most about ``bound`` of them.

    A documented bound on classifier training data: rows are picked by a hash of
    the id against the fraction that meets the bound, so the pick is the same on
    every run and spread over the whole table.  One label per id (the largest if
    an id repeats); null labels and ids are left out.  The label side holds ids
    and one integer; the join needs no hint.
    """
    y = (
        marks.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    share = int((1 << 30) * min(1.0, bound / max(1, y.count())))
    y = y.where(F.pmod(F.xxhash64(F.lit(20), "doc_id"), F.lit(1 << 30)) < share)
    d = docs.select("doc_id", text_of(docs).alias("text"))
    return d.join(F.broadcast(y), "doc_id").select("text", "y")


def content_key(text: Column) -> Column:
    """SHA-256 of a text (lowercase hex): names a document's content where ids may be null or repeat."""
    return F.sha2(text, 256)


def keep_rows(docs: DataFrame, kept: DataFrame, content: Column) -> DataFrame:
    """Rows of ``docs`` that ``kept`` names, each document once, with the columns of ``docs``.

    ``kept`` has one row ``(doc_id, content)`` per document that stays; ``content`` is the
    same key over ``docs``.  A null id matches a null id, so rows without one are judged
    like any other.  Rows that repeat an id and its content count as one document.  The
    first of each key is picked in every task before the one shuffle of the rows, and the
    join reuses that partitioning: a text that holds a third of all rows sends a row a task.
    """
    names = ["_keep_id", "_keep_null", "_keep_content"]
    key = lambda df, c: df.withColumns({"_keep_id": F.coalesce(df["doc_id"].cast("long"), F.lit(0)), "_keep_null": df["doc_id"].isNull(), "_keep_content": c})
    w = Window.partitionBy(*names).orderBy(F.xxhash64(text_of(docs)))
    first = key(docs, content).withColumn("_keep_n", F.row_number().over(w)).where("_keep_n = 1")
    return first.join(key(kept, F.col("content")).select(*names), names, "left_semi").select(*docs.columns)
