"""Structured Streaming jobs.

* ``write_stream_files`` lays a table down as an ordered sequence of files - the
  offline stand-in for a topic (Kafka works the same way when its jar exists).
* ``ProfileStreamJob`` is the event -> profile stream (D1-D4, D6, D7, D9): each
  micro-batch is validated, deduplicated, resolved to profiles and folded into
  bucketed tables; every output lies in a folder per batch and the commit comes
  last - at-least-once delivery, exactly-once effect.
* ``dedup_stream`` (D5) and ``windowed_counts`` / ``session_counts`` (D8)
  are plain streaming DataFrames with watermarks.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.segments import SegmentRules
from tessera.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}_{uuid.uuid4().hex}"


#: Rows of a stream file: a chunk of more is several files, so that it is written and read by several tasks.
FILE_ROWS = 100_000


def write_stream_files(
    df: DataFrame, path: str, order_col: str, chunks: int, sentinel: DataFrame | None = None, ordered: bool = True, file_rows: int = FILE_ROWS
) -> int:
    """Write ``df`` as ``chunks`` chunks in ``order_col`` order, one append per chunk so
    file modification times follow the order; an optional sentinel goes last.

    Every chunk has the same number of files, about ``file_rows`` rows each, and that
    number is given back: a stream that reads as many files per batch
    (``read_event_stream``) has one batch per chunk.

    ``ordered=False`` writes all chunks in one job (range-partitioned on
    ``order_col``) for consumers whose result does not depend on file order."""
    bounds = df.select(F.min(order_col).alias("lo"), F.max(order_col).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    files = max(1, -(-bounds["n"] // (chunks * file_rows)))
    if not ordered:
        df.repartitionByRange(chunks * files, order_col).write.mode("append").parquet(path)
        if sentinel is not None:
            sentinel.coalesce(1).write.mode("append").parquet(path)
        return files
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // chunks + 1
    held = 0
    for i in range(chunks):
        part = df.filter((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step))
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
        if files > 1:  # a chunk of few rows may leave partitions, and so files, out
            held, before = _parquet_files(df.sparkSession, path), held
            for _ in range(files - (held - before)):
                df.limit(0).coalesce(1).write.mode("append").parquet(path)
            held = before + files
    if sentinel is not None:
        sentinel.coalesce(1).write.mode("append").parquet(path)
    return files


def _parquet_files(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(st.getPath().getName().endswith(".parquet") for st in fs.listStatus(folder))


def read_event_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """The processed-event stream, bounded batches (``maxFilesPerTrigger``)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def dedup_stream(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeated ``event_id`` seen within the watermark (idempotent consumer)."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, key: str = "user_id", watermark: str = "40 days", size: str = "1 day") -> DataFrame:
    """Tumbling event-time window counts per key (append mode emits closed windows)."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(key, F.window("ts", size).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )


def session_counts(events: DataFrame, key: str = "user_id", watermark: str = "40 days", gap: str = "6 hours") -> DataFrame:
    """Session windows (gap 6 h) per key."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(key, F.session_window("ts", gap).alias("s"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
    )


def run_to_table(stream_df: DataFrame, output_mode: str = "append", state_partitions: int | None = None) -> DataFrame:
    """Drive a streaming query to completion (``availableNow``) into a Parquet table
    under the shared folder and return that table as a batch DataFrame.

    ``state_partitions`` fixes the number of state-store partitions of a stateful
    query for its whole life (recorded in its checkpoint); by default one per task
    slot of the cluster, so state work spreads over every core without a store
    per idle partition."""
    spark = stream_df.sparkSession
    out = scratch_dir(spark, "stream_out")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        q = (
            stream_df.writeStream.outputMode(output_mode)
            .format("parquet")
            .option("path", out)
            .option("checkpointLocation", out + "_ckpt")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream_df.schema).parquet(out)


class BucketedTable:
    """A table kept as hash buckets of its key: a batch writes new versions of the buckets
    it touches and leaves the others, so its cost follows the batch, not the table."""

    def __init__(self, spark: SparkSession, root: str, name: str, key: list[str], buckets: int) -> None:
        self.spark, self.path, self.name, self.key, self.buckets = spark, f"{root}/{name}", name, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self, versions: dict[int, int], schema, only: list[int] | None = None) -> DataFrame:
        """Rows of the current version of the buckets (``versions``: bucket -> batch)."""
        paths = [f"{self.path}/batch={v}/bucket={b}" for b, v in sorted(versions.items()) if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of ``keys``: at most ``buckets`` small numbers."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def write(self, df: DataFrame, batch_id: int) -> None:
        """New versions of the buckets that ``df`` holds (a retried batch overwrites its own)."""
        out = df.withColumn("bucket", self.bucket()).repartition("bucket")
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={batch_id}")


IDENTITY_SCHEMA = "id_type string, id_value string, profile_id string"
COUNTS_SCHEMA = "student_id string, category string, last_ts timestamp, chats long, started long, completed long, events long"


class ProfileStreamJob:
    """The event -> profile stream, one ``foreachBatch`` writer.

    Each micro-batch is validated (rejects to ``dlq``), deduplicated against every
    event id ever stored, resolved to profiles (J1 against the identity index; a new
    profile where nothing matches), folded into the profile table, staged with its
    profile snapshot, and turned into segment changes and feature counts.  Every
    output of a batch lies in a folder of its own (``.../batch={id}``) and the commit
    file, written last, names the bucket versions in force: a batch that fails
    half-way is simply run again over its own folders - exactly-once effect.  Batches
    run in order, so all folders of smaller batch ids are committed.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        as_of: dt.datetime,
        status: DataFrame | None = None,
        master: DataFrame | None = None,
        rules: SegmentRules | None = None,
        markers: Callable[[DataFrame], DataFrame] | None = None,
        buckets: int = 8,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.as_of = as_of
        self.status = status  # (student_id, enrollment_status) for the funnel-stage feature
        self.master = master  # known (profile_id, id_type, id_value)
        self.rules = rules or SegmentRules()
        self.markers = markers  # adds the marker columns W1 counts
        table = lambda name, *key: BucketedTable(spark, self.root, name, list(key), buckets)
        self.tables = {
            "ids": table("ids", "event_id"),
            "identity": table("identity", "id_type", "id_value"),
            "profiles": table("profiles", "profile_id"),
            "counts": table("counts", "student_id"),
        }

    # -- commits --------------------------------------------------------------
    def _committed(self) -> int:
        """The last committed batch (-1: none)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return -1
        names = [(st.getPath().getName(), st.getPath().toString()) for st in fs.listStatus(p)]
        done = [int(n) for n, path in names if n.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))]
        return max(done, default=-1)

    def _versions(self) -> dict[str, dict[int, int]]:
        """Bucket versions in force, by table (a few numbers per bucket)."""
        out: dict[str, dict[int, int]] = {name: {} for name in self.tables}
        last = self._committed()
        if last >= 0:
            for r in self.spark.read.parquet(f"{self.root}/_commits/{last}").collect():
                out[r["table"]][r["bucket"]] = r["batch"]
        return out

    def _commit(self, batch_id: int, versions: dict[str, dict[int, int]]) -> None:
        rows = [(name, b, v) for name, held in versions.items() for b, v in held.items()]
        df = self.spark.createDataFrame(rows, "table string, bucket int, batch long").coalesce(1)
        df.write.mode("overwrite").parquet(f"{self.root}/_commits/{batch_id}")

    # -- results --------------------------------------------------------------
    def profiles(self) -> DataFrame | None:
        held = self._versions()["profiles"]
        return self.tables["profiles"].read(held, self._profile_schema(held)) if held else None

    def _profile_schema(self, held: dict[int, int]):
        return self.spark.read.parquet(f"{self.root}/profiles/batch={max(held.values())}").drop("bucket").schema

    def features(self) -> DataFrame | None:
        from tessera.operators.features import features_from_counts

        held = self._versions()["counts"]
        return features_from_counts(self.tables["counts"].read(held, COUNTS_SCHEMA), self.as_of, status=self.status) if held else None

    def output(self, name: str) -> DataFrame:
        """``dlq``, ``silver``, ``staging`` or ``segment_changes``: the folders of committed batches."""
        return self.spark.read.parquet(f"{self.root}/{name}").filter(F.col("batch") <= self._committed()).drop("batch")

    # -- the batch function ---------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> None:
        from tessera.operators.features import add_counts, feature_counts
        from tessera.operators.identity import identifier_rows, resolve
        from tessera.operators.normalize import dedup_events, source_allow_list
        from tessera.operators.profile import build_profiles
        from tessera.operators.segments import segment_changes
        from tessera.sinks.writers import stage_for_warehouse

        if batch_id <= self._committed():
            return  # replay of a committed batch: already applied (D1)
        versions, t = self._versions(), self.tables
        folder = lambda name: f"{self.root}/{name}/batch={batch_id}"
        valid, dlq = source_allow_list(batch)
        dlq.write.mode("overwrite").parquet(folder("dlq"))  # D4 / D9: always dead-letter

        # D5 over the whole history: the first occurrence of an id in the batch, unknown to the id index.
        fresh = dedup_events(valid)
        known = t["ids"].read(versions["ids"], "event_id long", t["ids"].touched(fresh))
        fresh = fresh.join(known, "event_id", "left_anti")
        schema = fresh.schema
        fresh.write.mode("overwrite").parquet(folder("silver"))
        fresh = self.spark.read.schema(schema).parquet(folder("silver"))

        # D3: resolve against the identity index, then extend it (smallest profile per identifier).
        rows = identifier_rows(fresh, "event_id")
        index_buckets = t["identity"].touched(rows)
        index = t["identity"].read(versions["identity"], IDENTITY_SCHEMA, index_buckets)
        owners = index if self.master is None else index.unionByName(self.master.select("id_type", "id_value", "profile_id"))
        resolved = resolve(fresh.drop("personal_info"), owners.select("profile_id", "id_type", "id_value")).select("event_id", "profile_id")
        resolved.write.mode("overwrite").parquet(folder("resolved"))
        resolved = self.spark.read.schema(resolved.schema).parquet(folder("resolved"))
        seen = rows.join(resolved, "event_id").select("id_type", "id_value", "profile_id")
        index = index.unionByName(seen).groupBy("id_type", "id_value").agg(F.min("profile_id").alias("profile_id"))
        t["identity"].write(index, batch_id)

        # Fold into the touched buckets of the profile table.
        events = fresh.join(resolved, "event_id")
        touched = t["profiles"].touched(resolved)
        held = versions["profiles"]
        prev = t["profiles"].read(held, self._profile_schema(held), touched) if any(b in held for b in touched) else None
        folded = build_profiles(events, self.as_of, previous=prev)
        t["profiles"].write(folded, batch_id)
        now = self.spark.read.schema(folded.schema).parquet(f"{self.root}/profiles/batch={batch_id}")

        # Staging rows for the warehouse.
        ids = resolved.select("profile_id").distinct()
        mine = now.join(ids, "profile_id", "left_semi")
        stage_for_warehouse(events.select("profile_id", "event_id", "event_type", "source", "ts"), mine).write.mode("overwrite").parquet(folder("staging"))

        # Segment changes of the profiles this batch touched (a new profile counts against an empty membership).
        rules = self.rules.supported(folded.columns)
        after = rules.evaluate(mine)
        before = rules.evaluate(prev.join(ids, "profile_id", "left_semi")) if prev is not None else after.limit(0)
        segment_changes(after, before, as_of=self.as_of).write.mode("overwrite").parquet(folder("segment_changes"))

        # Feature counts add up; only touched students' buckets are rewritten.
        counted = (self.markers or (lambda e: e))(fresh)
        if {"category", "started", "completed"} <= set(counted.columns):
            new = feature_counts(counted, self.as_of)
            old = t["counts"].read(versions["counts"], COUNTS_SCHEMA, t["counts"].touched(fresh.select("student_id")))
            t["counts"].write(add_counts(old.unionByName(new)), batch_id)
        t["ids"].write(known.unionByName(fresh.select("event_id")), batch_id)

        for name, keys in (("ids", fresh), ("identity", rows), ("profiles", resolved), ("counts", fresh.select("student_id"))):
            if name != "counts" or {"category", "started", "completed"} <= set(counted.columns):
                versions[name] |= dict.fromkeys(t[name].touched(keys), batch_id)
        self._commit(batch_id, versions)

    def run(self, stream: DataFrame) -> None:
        q = (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.root}/_stream_ckpt")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def late_rows(spark: SparkSession, path: str, schema, delay: str, key: str = "event_id", max_files: int = 1) -> DataFrame:
    """Rows of the file stream at ``path`` that Spark's watermark dropped, with the reason.

    The stream runs once behind a watermark of ``delay`` and Spark drops what arrives at
    or behind it; the rows it let through are a table, and the input without them is the
    late-data dead-letter table.  ``key`` names a row; a repeat of a row that was let
    through is no late row.  The query has one stateful operator, so its watermark for
    late rows is that of the batch before (with several it would lag one batch more).
    """
    conf = "spark.sql.streaming.statefulOperator.allowMultiple"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        kept = run_to_table(dedup_stream(read_event_stream(spark, path, schema, max_files), delay))
    finally:
        spark.conf.set(conf, before)
    rows = spark.read.schema(schema).parquet(path)
    return rows.join(kept.select(key), key, "left_anti").withColumn("error", F.lit("behind watermark"))
