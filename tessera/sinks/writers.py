"""Sink operators.  Without Delta/Iceberg jars there is no ``MERGE``; upserts are
rewrites: compute the new version with joins, write it to a NEW path, then
swap - never overwrite the path being read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish_frame(df: DataFrame, topic: str, key: str | None = None, value_cols: list[str] | None = None) -> DataFrame:
    """K1 / F16: ``(topic, key, value)`` rows - JSON value, empty key -> null."""
    cols = value_cols or [c for c in df.columns]
    k = F.nullif(F.col(key).cast("string"), F.lit("")) if key else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"), F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))


def write_topic(frame: DataFrame, path_or_servers: str, kafka: bool = False) -> None:
    """K1 delivery: Kafka when the connector is on the classpath, else JSON lines per topic."""
    if kafka:
        frame.write.format("kafka").option("kafka.bootstrap.servers", path_or_servers).save()
    else:
        frame.write.mode("append").partitionBy("topic").json(path_or_servers)


def stage_for_warehouse(events: DataFrame, profiles: DataFrame, key: str = "profile_id") -> DataFrame:
    """K2: ``{profile_id, event, profile_snapshot}`` staging rows."""
    ev = events.select(key, F.struct(*[F.col(c) for c in events.columns if c != key]).alias("event"))
    pr = profiles.select(key, F.struct(*[F.col(c) for c in profiles.columns if c != key]).alias("profile_snapshot"))
    return ev.join(pr, key, "left")


def append_rows(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """K4: rows with all required fields are appended; others are returned as rejects."""
    ok = None
    for c in required:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return rows.filter(ok), rows.filter(~ok)


def load_partitioned(df: DataFrame, path: str, mode: str = "append") -> None:
    """K5: partitioned by ``event_date``, files sorted by ``source, student_id`` so that
    readers can skip row groups.  ``REBALANCE`` sizes the writers from the measured
    data: a large day is split over many tasks, small days share one."""
    (
        df.hint("rebalance", "event_date")
        .sortWithinPartitions("source", "student_id")
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def merge_upsert(target: DataFrame, staging: DataFrame, keys: list[str], as_of: dt.datetime, mode: str = "overwrite") -> DataFrame:
    """K6: matched rows -> ``touch`` sets only ``updated_at`` (as the source system's
    MERGE does) or ``overwrite`` takes the staging values; unmatched staging rows are
    inserted; target rows without a match stay."""
    ts = F.lit(as_of).cast("timestamp")
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols]).withColumn("_in_t", F.lit(True))
    s = staging.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in staging.columns]).withColumn("_in_s", F.lit(True))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in cols:
        sc = F.col(f"_s_{c}") if c in staging.columns else F.lit(None)
        if c == "updated_at":
            v = F.when(F.col("_in_s").isNotNull(), ts).otherwise(F.col(f"_t_{c}"))
        elif mode == "touch":
            v = F.when(F.col("_in_t").isNotNull(), F.col(f"_t_{c}")).otherwise(sc)
        else:
            v = F.when(F.col("_in_s").isNotNull(), sc).otherwise(F.col(f"_t_{c}"))
        out.append(v.alias(c))
    return j.select(*keys, *out)


def upsert_profiles(stored: DataFrame, incoming: DataFrame, as_of: dt.datetime) -> DataFrame:
    """K8: replace the document, ``version = coalesce(version, 0) + 1``, ``created_at``
    only on insert, ``updated_at = as_of``."""
    ts = F.lit(as_of).cast("timestamp")
    old = stored.select("profile_id", F.col("version").alias("_ov"), F.col("created_at").alias("_oc"))
    body = [c for c in incoming.columns if c not in ("version", "created_at", "updated_at")]
    j = incoming.select(*body).join(old, "profile_id", "left")
    new = j.select(
        *body,
        (F.coalesce(F.col("_ov"), F.lit(0)) + 1).cast("bigint").alias("version"),
        F.coalesce(F.col("_oc"), ts).alias("created_at"),
        ts.alias("updated_at"),
    )
    untouched = stored.join(incoming.select("profile_id"), "profile_id", "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True)


def publish_features(features: DataFrame, stored: DataFrame | None = None, key: str = "entity_id", ts: str = "event_timestamp") -> DataFrame:
    """Append feature rows; the online view keeps the newest row per entity."""
    allrows = features if stored is None else stored.unionByName(features)
    row = F.struct(*[F.col(c) for c in allrows.columns if c != key])
    return allrows.groupBy(key).agg(F.max_by(row, F.col(ts)).alias("_r")).select(key, "_r.*")


def append_audit(*frames: DataFrame) -> DataFrame:
    """One append-only audit frame ``(action, subject, detail, timestamp)``."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
