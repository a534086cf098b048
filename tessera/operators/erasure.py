"""Right-to-erasure as set operations over every store.

A batch of requests is erased from each store in one pass: a join on the store's key
column flags the rows (the key differs per store, so the store list carries it),
flagged rows are counted and the others rewritten.  The request list is typically
small, and AQE turns these joins into broadcast joins from the measured size; a
large batch stays a shuffle join and still works.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.constants import ERASURE_SLA_HOURS, ERASURE_TOPICS
from tessera.session import cut_lineage, ensure_checkpoint_dir

#: Requests up to this number become an IN list, which Parquet checks against min/max and bloom filters; more are joined.
IN_LIST = 1000


def erase(stores: dict[str, tuple[DataFrame, str]], requests: DataFrame, skip: tuple[str, ...] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rewritten stores and a report ``(store, records_affected)``.

    One pass per store: the request ids are joined on as a flag, flagged rows are
    counted on the write itself and the others written as a new table in the shared
    folder (swap it in; the table read is never overwritten).  ``skip`` leaves stores
    as they are, as after a failed deletion.
    """
    ids = cut_lineage(requests.select(F.col("student_id").alias("_erase_id")).distinct())

    def one(name: str) -> tuple[DataFrame, int]:
        df, key = stores[name]
        if name in skip:
            return df, 0
        hits = Observation(f"erase_{name}")
        flagged = df.join(ids.withColumn("_hit", F.lit(1)), df[key].cast("string") == F.col("_erase_id"), "left")
        flagged = flagged.observe(hits, F.sum(F.coalesce("_hit", F.lit(0))).cast("bigint").alias("n"))
        left = cut_lineage(flagged.filter(F.col("_hit").isNull()).drop("_hit", "_erase_id"))
        return left, hits.get.get("n") or 0

    # The stores don't depend on each other: a few jobs at a time.
    with ThreadPoolExecutor(max_workers=4) as pool:
        done = dict(zip(stores, pool.map(one, stores)))
    report = [(name, n) for name, (_, n) in done.items()]
    return {name: left for name, (left, _) in done.items()}, requests.sparkSession.createDataFrame(report, "store string, records_affected long")


def write_store(df: DataFrame, path: str, key: str, partition_by: str | None = None, keys_per_file: int = 100_000) -> None:
    """A store as Parquet files with a bloom filter on ``key``: row groups without a given student are skipped unread."""
    w = df.write.mode("errorifexists").option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_per_file))
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


@dataclass
class FileStore:
    """A store as a list of files: those an erasure left alone, by reference, and the ones written in place of the others."""

    base: str
    kept: list[str]
    rewritten: str | None
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        parts = [spark.read.schema(self.schema).option("basePath", self.base).parquet(*self.kept)] if self.kept else []
        if self.rewritten:
            parts.append(spark.read.schema(self.schema).parquet(self.rewritten))
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else spark.createDataFrame([], self.schema)


def hit_files(store: DataFrame, key: str, requests: DataFrame) -> DataFrame:
    """``(file, records_affected)``: the files of a Parquet store that hold rows of the requests' students."""
    ids = requests.select(F.col("student_id").cast("string").alias("_erase_id")).where(F.col("_erase_id").isNotNull()).distinct()
    few = ids.limit(IN_LIST + 1).collect()
    rows = store.select(key, F.col("_metadata.file_path").alias("file"))
    if len(few) <= IN_LIST:  # literals of the column's own type reach the scan
        kind = store.schema[key].dataType
        rows = rows.where(F.col(key).isin([F.lit(r[0]).try_cast(kind) for r in few])) if few else rows.limit(0)
    else:
        rows = rows.join(ids, F.col(key).cast("string") == F.col("_erase_id"), "left_semi")
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("records_affected"))


def erase_in_files(spark: SparkSession, path: str, key: str, requests: DataFrame) -> tuple[FileStore, DataFrame]:
    """E1 / K7 / K9 on a Parquet store: only files that hold a requested student are read in full and written anew.

    Returns the store without the students' rows and the report ``(file,
    records_affected)`` of the files replaced.  Rewritten files go to a new folder in
    the shared folder; nothing of ``path`` is changed, so a failed run is run again and
    the new list of files is put in force (and the replaced files deleted) by whoever
    holds the store.  The driver holds file names only.
    """
    store = spark.read.parquet(path)
    report = cut_lineage(hit_files(store, key, requests))
    hit = sorted(r.file for r in report.select("file").collect())
    if not hit:
        return FileStore(path, sorted(store.inputFiles()), None, store.schema), report
    ids = requests.select(F.col("student_id").cast("string").alias("_erase_id")).distinct()
    left = spark.read.schema(store.schema).option("basePath", path).parquet(*hit).join(ids, F.col(key).cast("string") == F.col("_erase_id"), "left_anti")
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/erased_{uuid.uuid4().hex}"
    write_store(left, target, key)
    plain = lambda f: f.split(":", 1)[-1].lstrip("/")  # noqa: E731 - file:/x and file:///x are the same file
    gone = {plain(f) for f in hit}
    return FileStore(path, sorted(f for f in store.inputFiles() if plain(f) not in gone), target, store.schema), report


def erasure_audit(requests: DataFrame, report: DataFrame) -> DataFrame:
    """One ``delete`` row per request with the stores' results (``report`` has a row per store)."""
    results = F.to_json(F.array_sort(F.collect_list(F.struct("store", "records_affected"))))
    return requests.select(F.lit("delete").alias("action"), F.col("student_id").alias("subject"), report.agg(results).scalar().alias("detail"))


def verify_erasure(stores: dict[str, tuple[DataFrame, str]], requests: DataFrame) -> DataFrame:
    """Rows left per (student, store) and the all-clear flag per student,
    for every store that was erased (also the consent audit log)."""
    ids = requests.select(F.col("student_id").alias("_erase_id")).distinct()
    left = None
    for name, (df, key) in stores.items():
        c = df.select(F.col(key).cast("string").alias("_erase_id")).join(ids, "_erase_id", "left_semi")
        c = c.groupBy("_erase_id").agg(F.count(F.lit(1)).alias("remaining")).withColumn("store", F.lit(name))
        left = c if left is None else left.unionByName(c)
    per_student = left.groupBy("_erase_id").agg(F.sum("remaining").alias("remaining"))
    return ids.join(per_student, "_erase_id", "left").select(
        F.col("_erase_id").alias("student_id"),
        F.coalesce("remaining", F.lit(0)).cast("bigint").alias("remaining"),
        (F.coalesce("remaining", F.lit(0)) == 0).alias("all_clear"),
    )


def tombstones(requests: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """One ``(topic, key, value=null)`` record per student and topic (literal list, exploded)."""
    t = F.array(*[F.lit(x) for x in (topics or ERASURE_TOPICS)])
    return requests.select(F.explode(t).alias("topic"), F.col("student_id").alias("key"), F.lit(None).cast("string").alias("value"))


def crm_mappings_to_delete(requests: DataFrame, mappings: DataFrame) -> DataFrame:
    """CRM contacts to delete for the requests (left join on student)."""
    return requests.select("student_id").join(mappings, "student_id", "left")


def overdue(requests: DataFrame, as_of: dt.datetime, sla_hours: int = ERASURE_SLA_HOURS) -> DataFrame:
    """Open requests older than the SLA (72 h)."""
    age = (F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("requested_at")) / 3600.0
    return requests.withColumn("age_hours", age).filter(F.col("age_hours") > sla_hours)
