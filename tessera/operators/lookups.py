"""Profile lookups as joins over request tables (J5, J6, T1) - the batch form of
the serving reads: many lookups answered by one join instead of one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def find_by_identifier(profiles: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests (request_id, id_type, id_value)`` -> matching profile ids
    (smallest when several hold the value; null when none)."""
    ids = profiles.select("profile_id", F.explode("identifiers").alias("i")).select(
        "profile_id", F.col("i.type").alias("id_type"), F.col("i.value").alias("id_value")
    )
    owner = ids.groupBy("id_type", "id_value").agg(F.min("profile_id").alias("profile_id"))
    return requests.join(owner, ["id_type", "id_value"], "left")


def get_profiles(profiles: DataFrame, ids: DataFrame) -> DataFrame:
    """Point lookup of many ids at once (``left_semi``; AQE broadcasts a small id list)."""
    return profiles.join(ids.select("profile_id").distinct(), "profile_id", "left_semi")


def history(events: DataFrame, key: str = "student_id", n: int = 50) -> DataFrame:
    """Newest ``n`` events per profile (window group-limit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return events.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
