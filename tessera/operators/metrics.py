"""Pipeline metrics as aggregates (A11-A14, A19): counters become ``groupBy``
counts, the latency histogram becomes conditional sums, gauges become single
aggregates.  On streams the same expressions run through ``df.observe``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import ACTIVE_PROFILE_DAYS, ALERT_DLQ_SHARE, ALERT_FRESHNESS_HOURS, LATENCY_BUCKETS


def counts_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """A labelled counter (e.g. ingested by source and type, DLQ by source and error)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def latency_histogram(df: DataFrame, seconds: Column, by: str | None = None, edges: list[float] | None = None) -> DataFrame:
    """Cumulative bucket counts (``le`` edges plus ``+Inf``), one pass."""
    edges = edges or LATENCY_BUCKETS
    aggs = [F.sum(F.when(seconds <= F.lit(e), 1).otherwise(0)).alias(f"_b{i}") for i, e in enumerate(edges)]
    aggs.append(F.count(F.lit(1)).alias("_inf"))
    g = (df.groupBy(by) if by else df.groupBy()).agg(*aggs)
    items = F.array(
        *[F.struct(F.lit(str(e)).alias("le"), F.col(f"_b{i}").cast("bigint").alias("count")) for i, e in enumerate(edges)],
        F.struct(F.lit("+Inf").alias("le"), F.col("_inf").cast("bigint").alias("count")),
    )
    return g.select(*([by] if by else []), F.inline(items))


def active_profiles(profiles: DataFrame, as_of: dt.datetime, days: int = ACTIVE_PROFILE_DAYS, ts: str = "last_interaction_at") -> DataFrame:
    """Profiles with an interaction in ``(as_of - days, as_of]``."""
    a = F.lit(as_of).cast("timestamp")
    active = (F.col(ts) > a - F.make_interval(days=F.lit(days))) & (F.col(ts) <= a)
    return profiles.agg(F.sum(F.when(active, 1).otherwise(0)).cast("bigint").alias("active_profiles"))


def match_rate(resolved: DataFrame) -> DataFrame:
    """Share of events matched to an existing profile, per match type and overall."""
    return resolved.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(F.col("match_type") == "deterministic", 1).otherwise(0)).alias("deterministic"),
        F.sum(F.when(F.col("match_type") == "probabilistic", 1).otherwise(0)).alias("probabilistic"),
        F.sum(F.when(F.col("match_type") == "created", 1).otherwise(0)).alias("created"),
        F.avg(F.when(F.col("match_type") != "created", 1.0).otherwise(0.0)).alias("match_rate"),
    )


def alerts(dlq_share: DataFrame, freshness: DataFrame) -> DataFrame:
    """Alert rows - DLQ share above 1 % per source, data older than 1 h per source.

    ``dlq_share (source, total, dead)`` and ``freshness (source, age_seconds)``.
    """
    d = dlq_share.withColumn("share", F.col("dead") / F.col("total")).filter(F.col("share") > ALERT_DLQ_SHARE).select(
        F.lit("dlq_share_high").alias("alert"), "source", F.col("share").alias("value")
    )
    f = freshness.filter(F.col("age_seconds") > ALERT_FRESHNESS_HOURS * 3600).select(
        F.lit("data_stale").alias("alert"), "source", F.col("age_seconds").cast("double").alias("value")
    )
    return d.unionByName(f)
