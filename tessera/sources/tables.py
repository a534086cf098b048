"""Scans of the warehouse tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; later ``select``/``filter`` calls prune columns and push predicates."""
    df = spark.read.parquet(table_path(sf_dir, name))
    # Parquet written without zone info loads as TIMESTAMP_NTZ; the engine works in
    # UTC instants (watermarks need TIMESTAMP), so convert once at the scan.
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Temp views so that callers can use ``spark.sql`` (S10) over the same tables."""
    for name in names or TABLE_NAMES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
