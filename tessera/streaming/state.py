"""Keyed state on streams (D2, D7, D8): running counts per key in Spark's RocksDB state store.

``running_counts`` folds every event into the state of its key and gives out the new
counts of the keys that a batch touched.  Spark keeps the state and its checkpoints; a
batch reads and writes the states of its own keys only, so its cost does not follow the
number of keys stored.  Counts only grow: the current row of a key is the largest in each
column (``current_counts``).

Counts alone are a streaming aggregate: a batch is added up per task before its one
shuffle, and state is read and written in the JVM, once for each (key, category) of the
batch.  A batch writes a folder of its own, which it overwrites when it is repeated, and
Spark's commit log tells which folders are in force.  Only idle timers, which an aggregate
has not, take a ``StatefulProcessor`` with Spark's exactly-once file sink: each of its
state requests is a round trip to a Python worker.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.identity import last_committed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = ("chats", "started", "completed", "events")
_STATE = "first_us long, last_us long, chats long, started long, completed long, events long"
OUTPUT = f"key string, kind string, category string, {_STATE}"
_ROW = Row(*(c.split()[0] for c in OUTPUT.split(", ")))
_CRASH = "\0planned crash"  # key of the group that fails; only in a batch that never commits


class RunningCounts(StatefulProcessor):
    """Per key: counts by category in a map state, and an event-time timer for idle keys.

    A row of kind ``counts`` is given out for every (key, category) that a batch touched,
    with all counts so far.  ``idle_days`` after the last event of a key, by the watermark,
    a row of kind ``idle`` is given out; a later event moves the timer.  Rows go through
    plain Python: a key has few in a batch, and a frame per key costs far more than they do.
    """

    def __init__(self, idle_days: int | None = None, fail_on: int | None = None) -> None:
        self.idle_days, self.fail_on = idle_days, fail_on

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "category string", _STATE)
        self.timer = handle.getValueState("timer", "at_ms long, last_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803 - names fixed by the interface
        found: dict[str, list] = {}
        for r in rows:
            if self.fail_on is not None and r["event_id"] == self.fail_on:
                raise RuntimeError("planned crash")
            n = found.setdefault(r["category"] or "", [None, None, 0, 0, 0, 0])
            if r["us"] is not None:
                n[0], n[1] = (r["us"], r["us"]) if n[0] is None else (min(n[0], r["us"]), max(n[1], r["us"]))
            for i, c in enumerate(("chat", "started", "completed"), 2):
                n[i] += r[c]
            n[5] += 1
        newest = max((n[1] for n in found.values() if n[1] is not None), default=None)
        for category in sorted(found):
            n, old = found[category], self.counts.getValue((category,))  # no value: None, one request less than asking first
            if old is not None:
                for i, least in ((0, min), (1, max)):
                    n[i] = least((x for x in (n[i], old[i]) if x is not None), default=None)
                n[2:] = [a + b for a, b in zip(n[2:], old[2:])]
            self.counts.updateValue((category,), tuple(n))
            yield _ROW(key[0], "counts", category or None, *n)
        if self.idle_days is not None and newest is not None:
            before = self.timer.get() if self.timer.exists() else None
            if before is None or newest > before[1]:
                if before is not None:
                    self.handle.deleteTimer(before[0])
                at = newest // 1000 + self.idle_days * 86_400_000
                self.handle.registerTimer(at)
                self.timer.update((at, newest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        last = self.timer.get()[1]
        self.timer.clear()
        yield _ROW(key[0], "idle", None, last, last, 0, 0, 0, 0)

    def close(self) -> None:
        pass


def count_input(events: DataFrame, key: F.Column, chat: F.Column, category: F.Column | None = None, started: F.Column | None = None, completed: F.Column | None = None) -> DataFrame:
    """The columns ``RunningCounts`` reads, from a stream of events with ``event_id`` and ``ts``."""
    flag = lambda c: (F.coalesce(c, F.lit(False)) if c is not None else F.lit(False)).cast("int")
    return events.select(
        key.cast("string").alias("key"), F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        (category if category is not None else F.lit(None)).cast("string").alias("category"), flag(chat).alias("chat"), flag(started).alias("started"), flag(completed).alias("completed"),
    )


def _counted(rows: DataFrame, fail_on: int | None) -> DataFrame:
    """``OUTPUT`` rows of kind ``counts``: every (key, category) that a batch touched with all counts so far.

    ``fail_on``: that event is a group of its own, whose row fails in a task that has
    put states of the batch, and so have the tasks beside it.
    """
    key = F.col("key")
    if fail_on is not None:
        rows = rows.withColumn("key", F.when(F.col("event_id") == fail_on, F.lit(_CRASH)).otherwise(key))
        key = F.when(key == _CRASH, F.raise_error(F.lit("planned crash"))).otherwise(key)
    sums = [F.sum(c).cast("long").alias(n) for c, n in zip(("chat", "started", "completed"), COUNTS)]
    g = rows.withColumn("category", F.nullif("category", F.lit(""))).groupBy("key", "category")
    g = g.agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"), *sums, F.count(F.lit(1)).alias("events"))
    return g.select(key.alias("key"), F.lit("counts").alias("kind"), "category", "first_us", "last_us", *COUNTS)


def _write_batch(root: str):
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{root}/counts/batch={batch_id}")


def running_counts(rows: DataFrame, root: str, watermark: str = "40 days", idle_days: int | None = None, fail_on: int | None = None, partitions: int | None = None):
    """Folds ``count_input`` rows into counts per (key, category) under ``root``; gives back the finished query.

    State and output live under ``root``: a run after a crash, or with more input, goes on
    where the last one committed.  ``partitions``: state partitions, fixed for the life
    of the checkpoint (default: one per task slot).  ``idle_days`` is fixed for it too: with
    it ``RunningCounts`` keeps timers by the ``watermark``, without it no row is late.
    """
    spark = rows.sparkSession
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    try:
        if idle_days is None:
            out = _counted(rows, fail_on).writeStream.outputMode("update").foreachBatch(_write_batch(root))
        else:
            keyed = rows.withWatermark("ts", watermark).groupBy("key")
            out = keyed.transformWithState(RunningCounts(idle_days, fail_on), OUTPUT, "Append", "EventTime")
            out = out.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
        q = out.option("checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return q


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """``(key, category, first_ts, last_ts, chats, started, completed, events)`` as of the last committed batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/counts")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        rows = spark.read.schema(f"{OUTPUT}, batch int").parquet(f"{root}/counts").where(F.col("batch") <= last_committed(spark, f"{root}/_stream"))
    else:  # kept with timers
        rows = spark.read.schema(OUTPUT).parquet(f"{root}/out").where("kind = 'counts'")
    most = [F.max(c).alias(c) for c in COUNTS]
    g = rows.groupBy("key", "category").agg(F.min("first_us").alias("f"), F.max("last_us").alias("l"), *most)
    return g.select("key", "category", F.timestamp_micros("f").alias("first_ts"), F.timestamp_micros("l").alias("last_ts"), *COUNTS)


def idle_keys(spark: SparkSession, root: str) -> DataFrame:
    """``(key, last_ts)``: keys reported idle, once for each time they fell idle."""
    rows = spark.read.schema(OUTPUT).parquet(f"{root}/out").where("kind = 'idle'")
    return rows.select("key", F.timestamp_micros("last_us").alias("last_ts"))


def unified_profiles(counts: DataFrame, components: DataFrame, as_of: dt.datetime) -> DataFrame:
    """J12 of the streamed profiles: counts kept per smallest identifier of the events, folded by component.

    ``counts``: ``current_counts`` with the source as category.  A merge of components
    changes no state: the fold at reading time sees the new component.
    """
    from tessera.operators.profile import engagement_score

    rows = counts.join(components, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "key"))
    per = [F.coalesce(F.sum(F.when(F.col("category") == s, F.col("events"))), F.lit(0)).cast("bigint").alias(f"{s}_events") for s in ("website", "app", "crm", "email", "whatsapp")]
    g = rows.groupBy("component").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("events").cast("bigint").alias("total_events"), *per)
    return g.withColumn("engagement_score", engagement_score(F.col("last_ts"), F.col("total_events"), as_of))
