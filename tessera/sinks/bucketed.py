"""K6 / K8 into bucketed tables: the target is written hash-bucketed by its keys once, and
every later merge joins it bucket by bucket - only the staging rows are shuffled.

A version is a catalog table; a merge writes the next one from the last (Spark's Parquet
tables have no ``MERGE``), bucketed and sorted like it, so the join after it needs no
exchange of the target either.  Each merge still reads and writes the whole target once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tessera.sinks.writers import merge_upsert, upsert_profiles


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> None:
    """Write ``df`` as table ``name`` at ``path``, one file per bucket: rows meet their bucket before the write."""
    _save(df.repartition(buckets, *keys), name, keys, buckets, path)


def _save(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> None:
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; raises where it is not bucketed."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in about:
        raise ValueError(f"table {name} is not bucketed")
    return int(about["Num Buckets"]), [c.strip().strip("`") for c in about["Bucket Columns"].strip("[]").split(",")]


def merged_bucketed(spark: SparkSession, name: str, staging: DataFrame, as_of: dt.datetime, mode: str = "overwrite") -> DataFrame:
    """K6 of ``staging`` into table ``name`` on its bucket columns: the rows of the next version (``merge_upsert``)."""
    buckets, keys = bucketing(spark, name)
    return merge_upsert(spark.table(name), staging.repartition(buckets, *keys), keys, as_of, mode)


def merge_bucketed(spark: SparkSession, name: str, staging: DataFrame, as_of: dt.datetime, new_name: str, path: str, mode: str = "overwrite") -> None:
    """K6: write the merge as table ``new_name`` at ``path``.  The rows already lie by bucket, so nothing is shuffled again."""
    buckets, keys = bucketing(spark, name)
    _save(merged_bucketed(spark, name, staging, as_of, mode), new_name, keys, buckets, path)


def upserted_bucketed(spark: SparkSession, name: str, incoming: DataFrame, as_of: dt.datetime) -> DataFrame:
    """K8 of ``incoming`` profiles into table ``name`` bucketed by ``profile_id``: the rows of the next version (``upsert_profiles``)."""
    buckets, keys = bucketing(spark, name)
    if keys != ["profile_id"]:
        raise ValueError(f"table {name} is bucketed by {keys}, not by profile_id")
    return upsert_profiles(spark.table(name), incoming.repartition(buckets, "profile_id"), as_of)
