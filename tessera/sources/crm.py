"""CRM change feed (S4) and dated CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import SF_CHANGES_LIMIT
from tessera.operators.normalize import check_crm_columns


def crm_changes(mapped: DataFrame, day: str, limit: int = SF_CHANGES_LIMIT) -> DataFrame:
    """S4 batch form: rows modified on ``day``, newest first, at most ``limit`` (the feature).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its own
    top ``limit`` and only those reach the final merge.
    """
    modified = F.try_to_timestamp(F.col("sf_modified_at"))
    return (
        mapped.filter(F.to_date(modified) == F.lit(day).cast("date"))
        .orderBy(modified.desc(), F.col("salesforce_id").asc())
        .limit(limit)
    )


def crm_changes_since(mapped: DataFrame, high_water_mark: str | None) -> DataFrame:
    """S4 incremental form: rows modified at or after the last high-water mark, once per (id, modified).

    Rows that share the mark's timestamp come again: the consumer's upsert by id makes
    that harmless, while skipping them would lose those that were not read before.
    """
    modified = F.try_to_timestamp(F.col("sf_modified_at"))
    rows = mapped if high_water_mark is None else mapped.filter(modified >= F.lit(high_water_mark).cast("timestamp"))
    return rows.dropDuplicates(["salesforce_id", "sf_modified_at"])


def read_crm_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """S3: header CSV in one pass; fails when the path is absent or ``Id``/``Email`` are missing.

    The header names the columns; ``types`` casts some of them (text otherwise, and null
    where a value doesn't fit) - no second read to infer types.
    """
    df = spark.read.option("header", True).csv(path)
    check_crm_columns(df)
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if types and c in types else F.col(c) for c in df.columns])


def load_files(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """Explicit schema, CSV header row skipped (Parquet carries its own)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_dated_export(spark: SparkSession, root: str, day: str) -> DataFrame:
    """``{root}/{yyyymmdd}/*.csv`` with the file each row came from (for A18)."""
    path = f"{root.rstrip('/')}/{day.replace('-', '')}/*.csv"
    df = spark.read.option("header", True).csv(path)
    return df.withColumn("_file", F.input_file_name())


def load_report(df: DataFrame) -> DataFrame:
    """Rows loaded and distinct files of a dated export."""
    return df.agg(F.count(F.lit(1)).alias("rows_loaded"), F.count_distinct("_file").alias("files"))
