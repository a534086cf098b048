"""Feature computation and windows (W1-W4, W7) and the profile text summary.

Feature definitions the source system only names are fixed here (see
``README.md``): days since last interaction, chat messages in the last 30 days,
page views by category, funnel stage, completion rate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import API_RATE_LIMIT, API_RATE_WINDOW_SECONDS
from tessera.operators.profile import days_between, engagement_score

MICROS = 1_000_000


def student_features(events: DataFrame, as_of: dt.datetime, key: str = "student_id", status: DataFrame | None = None, chat_days: int = 30) -> DataFrame:
    """One feature row per student, ``event_timestamp = as_of``.

    ``events`` carry ``ts``, ``source``, a page ``category`` (null for other events)
    and the booleans ``started`` and ``completed``.

    * ``days_since_last_interaction``: whole days from the last event to ``as_of``;
    * ``whatsapp_messages_30d``: chat events with ``as_of - chat_days < ts <= as_of``;
    * ``page_views_by_category``: JSON object of view counts for whatever categories
      occur, keys sorted;
    * ``funnel_stage``: enrollment status (``status`` frame ``(key, enrollment_status)``);
    * ``course_completion_rate``: completed / started, null when none started.

    Counts are taken per (student, category) first - partial aggregates - and only
    those few rows per student meet in the second aggregate.
    """
    counts = feature_counts(events, as_of, key, chat_days)
    return features_from_counts(counts, as_of, key, status)


def feature_counts(events: DataFrame, as_of: dt.datetime, key: str = "student_id", chat_days: int = 30) -> DataFrame:
    """Counts per (``key``, category) that W1 is made of; rows of several batches add up (``add_counts``)."""
    a = F.lit(as_of).cast("timestamp")
    chat = (F.col("source") == "whatsapp") & (F.col("ts") > a - F.make_interval(days=F.lit(chat_days))) & (F.col("ts") <= a)
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return events.groupBy(key, "category").agg(
        F.max("ts").alias("last_ts"),
        one(chat).alias("chats"),
        one(F.col("started")).alias("started"),
        one(F.col("completed")).alias("completed"),
        F.count(F.lit(1)).alias("events"),
    )


def add_counts(counts: DataFrame, key: str = "student_id") -> DataFrame:
    """Fold count rows of several batches into one per (``key``, category)."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("chats", "started", "completed", "events")]
    return counts.groupBy(key, "category").agg(F.max("last_ts").alias("last_ts"), *sums)


def features_from_counts(counts: DataFrame, as_of: dt.datetime, key: str = "student_id", status: DataFrame | None = None) -> DataFrame:
    """W1 rows from ``feature_counts``: a few rows per student meet in this aggregate."""
    views = F.collect_list(F.when(F.col("category").isNotNull(), F.struct(F.col("category").alias("key"), F.col("events").alias("value"))))
    g = counts.groupBy(key).agg(
        F.max("last_ts").alias("_last"), F.sum("chats").alias("_chat"), F.sum("started").alias("_started"), F.sum("completed").alias("_completed"), views.alias("_views")
    )
    out = g.select(
        F.col(key).alias("entity_id"),
        F.lit(as_of).cast("timestamp").alias("event_timestamp"),
        F.floor(days_between(as_of, F.col("_last"))).cast("bigint").alias("days_since_last_interaction"),
        F.col("_chat").cast("bigint").alias("whatsapp_messages_30d"),
        F.to_json(F.map_from_entries(F.array_sort("_views"))).alias("page_views_by_category"),
        F.when(F.col("_started") > 0, F.col("_completed") / F.col("_started")).alias("course_completion_rate"),
    )
    if status is not None:
        return out.join(status.select(F.col(key).alias("entity_id"), F.col("enrollment_status").alias("funnel_stage")), "entity_id", "left")
    return out.withColumn("funnel_stage", F.lit(None).cast("string"))


def time_blocks(df: DataFrame, ts: str, lookback_us: int, block_us: int) -> DataFrame:
    """``df`` with ``_us`` (time), ``_block`` and ``_own``: every row in the block of its time, and
    again, not owned, in each later block that looks back on it.

    A trailing window partitioned by (key, block) then sees all it needs, and a key that
    holds a third of all rows is split over as many tasks as it has blocks.
    """
    us = F.unix_micros(F.col(ts))
    own = F.floor(us / F.lit(block_us)).cast("bigint")
    last = F.floor((us + F.lit(lookback_us)) / F.lit(block_us)).cast("bigint")
    x = df.withColumn("_us", us).withColumn("_home", own).withColumn("_block", F.explode(F.sequence(own, last)))
    return x.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")


def rolling_average(df: DataFrame, key: str, ts: str, value: Column, days: int = 30) -> DataFrame:
    """Trailing ``days`` average by event time, current row included.

    Returned as exact parts (``rolling_sum_cents``, ``rolling_n``) plus the
    average, so results do not depend on summation order for 2-decimal inputs.
    A key's rows are split into blocks of ``days`` with the tail before each block
    replicated (``time_blocks``).
    """
    span = days * 86_400 * MICROS
    w = Window.partitionBy(key, "_block").orderBy("_us").rangeBetween(-span, 0)
    x = time_blocks(df.withColumn("_cents", F.round(value * 100).cast("bigint")), ts, span, span)
    out = x.withColumn("rolling_sum_cents", F.sum("_cents").over(w)).withColumn("rolling_n", F.count(F.lit(1)).over(w)).filter("_own")
    out = out.withColumn("rolling_avg", F.col("rolling_sum_cents").cast("double") / F.col("rolling_n").cast("double") / F.lit(100.0))
    return out.drop("_us", "_block", "_own", "_cents")


def latest_features(features: DataFrame, entity_ids: DataFrame | None, feature_ids: list[str], key: str = "entity_id", ts: str = "event_timestamp") -> DataFrame:
    """Newest feature row per entity (``max_by`` aggregate - partial, skew-safe), projected."""
    f = features if entity_ids is None else features.join(entity_ids.select(key), key, "left_semi")
    row = F.struct(*[F.col(c) for c in feature_ids])
    return f.groupBy(key).agg(F.max_by(row, F.col(ts)).alias("_r"), F.max(ts).alias(ts)).select(key, ts, *[F.col(f"_r.{c}").alias(c) for c in feature_ids])


def rate_limit_window(calls: DataFrame, key: str, ts: str, limit: int = API_RATE_LIMIT, seconds: int = API_RATE_WINDOW_SECONDS) -> DataFrame:
    """W4 approximation: a call is accepted when at most ``limit`` calls (all calls,
    accepted or not) fall in the trailing ``seconds`` including itself.

    Exact where no key ever exceeds the limit; ``rate_limit_exact`` handles the rest.
    """
    span = seconds * MICROS - 1
    w = Window.partitionBy(key, "_block").orderBy("_us").rangeBetween(-span, 0)
    x = time_blocks(calls, ts, span, max(60 * seconds, 3600) * MICROS)
    out = x.withColumn("calls_in_window", F.count(F.lit(1)).over(w)).filter("_own").drop("_us", "_block", "_own")
    return out.withColumn("accepted", F.col("calls_in_window") <= limit)


def rate_limit_exact(calls: DataFrame, key: str, ts: str, call_id: str, limit: int = API_RATE_LIMIT, seconds: int = API_RATE_WINDOW_SECONDS) -> DataFrame:
    """W4 exact: rejected calls do not count against the window (sequential by nature).

    Calls are hash-partitioned by key and sorted by (key, time, id) inside each
    partition, then streamed through ``mapInPandas`` batch by batch.  The only state
    is, for the current key, the accepted call times still inside the window - at
    most ``limit`` values - so no key's calls are ever gathered in memory, however
    hot the key is.  Returns ``(key, call_id, ts, accepted)``.
    """
    from collections import deque

    import pandas as pd

    window_us = seconds * MICROS
    ordered = calls.select(key, call_id, ts).repartition(key).sortWithinPartitions(key, ts, call_id)

    def run(batches):
        cur_key = object()
        kept: deque = deque()
        for pdf in batches:
            t = pdf[ts].astype("datetime64[us]").astype("int64").to_numpy()
            keys = pdf[key].to_numpy()
            acc = []
            for k, x in zip(keys, t):
                if k != cur_key:
                    cur_key, kept = k, deque()
                while kept and kept[0] <= x - window_us:
                    kept.popleft()
                ok = len(kept) < limit
                if ok:
                    kept.append(x)
                acc.append(ok)
            yield pd.DataFrame({key: keys, call_id: pdf[call_id].to_numpy(), ts: pdf[ts].to_numpy(), "accepted": acc})

    dtypes = dict(calls.dtypes)
    return ordered.mapInPandas(run, f"{key} {dtypes[key]}, {call_id} {dtypes[call_id]}, {ts} timestamp, accepted boolean")


def declining_engagement(events: DataFrame, as_of: dt.datetime, before: dt.datetime, key: str = "student_id") -> DataFrame:
    """Students whose engagement score at ``as_of`` is below the score at ``before``
    (each computed only from events up to that time); one aggregate pass for both."""
    b = F.lit(before).cast("timestamp")
    g = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_now"),
        F.max("ts").alias("last_now"),
        F.sum(F.when(F.col("ts") < b, 1).otherwise(0)).alias("n_before"),
        F.max(F.when(F.col("ts") < b, F.col("ts"))).alias("last_before"),
    )
    out = g.select(
        F.col(key).alias("profile_id"),
        engagement_score(F.col("last_now"), F.col("n_now"), as_of).alias("score_now"),
        engagement_score(F.col("last_before"), F.col("n_before"), before).alias("score_before"),
    )
    return out.filter(F.col("score_now") < F.col("score_before"))


def profile_summary_text(courses: Column, engagement: Column, stage: Column, actions: Column) -> Column:
    """Text summary of a profile, ``unknown`` for missing score and stage."""
    return F.concat(
        F.lit("Student interested in "),
        F.array_join(F.coalesce(courses, F.array().cast("array<string>")), ", "),
        F.lit(". Engagement: "),
        F.coalesce(engagement.cast("string"), F.lit("unknown")),
        F.lit(". Stage: "),
        F.coalesce(stage, F.lit("unknown")),
        F.lit(". Recent activity: "),
        F.array_join(F.coalesce(actions, F.array().cast("array<string>")), ", "),
    )


def recent_actions(events: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Newest ``n`` event types per key, newest first.

    ``row_number() <= n`` is planned with a group limit applied before the shuffle
    (Spark's window group-limit), so a hot key ships at most ``n`` rows per task.
    """
    w = Window.partitionBy(key).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    top = events.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return top.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "event_type"))), lambda x: x["event_type"]).alias("actions"))
