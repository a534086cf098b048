"""Medallion jobs: bronze -> silver (M1), silver -> gold (M2), the gated run (M3)
and retention (M4).  One Spark application; layers are materialised only where
a later stage reads them more than once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.constants import RETENTION_DAYS
from tessera.operators.normalize import dedup_events, source_allow_list


def bronze_to_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M1: allow-list the source (P11, invalid rows -> dead letters) and dedup on event_id."""
    valid, dlq = source_allow_list(bronze)
    return dedup_events(valid), dlq


def retention_filter(df: DataFrame, layer: str, as_of: dt.datetime, date_col: str = "event_date") -> DataFrame:
    """M4: keep rows inside the layer's retention (bronze 90 d, silver 1 y, gold 2 y).

    On a table partitioned by ``event_date`` this is a partition filter: the
    scan skips expired partitions entirely.
    """
    days = dict(RETENTION_DAYS)[layer]
    cutoff = (as_of - dt.timedelta(days=days)).date()
    return df.filter(F.col(date_col) >= F.lit(cutoff))


def silver_to_gold(silver: DataFrame, profile_ids: DataFrame, profile_names: DataFrame, as_of: dt.datetime) -> DataFrame:
    """M2: resolve silver events to profiles (J3) and fold them into gold profiles (A5)."""
    from tessera.operators.identity import resolve
    from tessera.operators.profile import build_profiles

    resolved = resolve(silver, profile_ids, profile_names).select("event_id", "profile_id", "confidence")
    ev = silver.join(resolved, "event_id")
    gold = build_profiles(ev.drop("student_id"), as_of)
    # The least confidence of a profile's events (a created profile is sure of itself unless under review).
    sure = ev.groupBy("profile_id").agg(F.min(F.coalesce("confidence", F.lit(1.0))).alias("identity_confidence"))
    return gold.join(sure, "profile_id")


def run_pipeline(spark, sf_dir: str, as_of: dt.datetime) -> DataFrame:
    """M3: ingest -> silver -> gate 2 (stop on failure) -> gold -> gate 3 (warning) ->
    fan-out (profile store, features, embeddings, gate 4 and the consent-gated CRM
    sync) -> freshness, which runs even after a failed gate.  Returns one row per
    stage ``(stage, rows, passed)``.

    Silver and gold are each read by several later stages, so they are materialised
    once in the shared folder (the layer boundary).  The sync covers profiles with a
    CRM contact id; the student behind the contact decides on consent.
    """
    from tessera.operators import quality as Q
    from tessera.operators.activation import salesforce_sync
    from tessera.operators.features import student_features
    from tessera.operators.profile import first_identifier_of_type
    from tessera.operators.vectors import hashed_embeddings
    from tessera.plans.q_identity import crm_master, resolution_events
    from tessera.plans.q_privacy import CONSENT_START
    from tessera.session import cut_lineage
    from tessera.sinks.writers import upsert_profiles
    from tessera.sources.adapters import canonical_events, consent_records, email_of, page_markers

    report: list[tuple[str, int, bool]] = []
    bronze = resolution_events(canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True, with_contact=True))
    silver, dlq = bronze_to_silver(bronze)
    silver = cut_lineage(silver)
    report.append(("silver", silver.count(), True))
    report.append(("dead_letters", dlq.count(), True))
    g2 = cut_lineage(Q.gate2_silver(silver.select("event_id", "student_id", email_of(F.col("student_id").cast("bigint")).alias("email"))))
    ok2 = Q.gate_passed(g2)
    report.append(("gate2_bronze_to_silver", g2.count(), ok2))
    if ok2:
        ids, names = crm_master(spark, sf_dir)
        gold = cut_lineage(silver_to_gold(silver, ids, names, as_of))
        report.append(("gold_profiles", gold.count(), True))
        g3 = cut_lineage(
            Q.gate3_gold(gold.select(Q.completeness(gold).alias("profile_completeness_score"), "identity_confidence", F.col("profile_id").alias("primary_profile_id")))
        )
        report.append(("gate3_silver_to_gold", g3.count(), Q.gate_passed(g3)))
        stored = gold.withColumn("created_at", F.lit(as_of).cast("timestamp")).limit(0)
        report.append(("profile_store", cut_lineage(upsert_profiles(stored, gold, as_of)).count(), True))
        report.append(("features", cut_lineage(student_features(page_markers(silver), as_of)).count(), True))
        texts = gold.select("profile_id", F.concat_ws(". ", "personal_info.name", "enrollment_status", F.array_join("segments", ", ")).alias("text"))
        report.append(("embeddings", cut_lineage(hashed_embeddings(texts, "profile_id", "text")).count(), True))
        outbound = cut_lineage(
            gold.select(
                "profile_id",
                first_identifier_of_type(F.col("identifiers"), "salesforce_id").alias("salesforce_id"),
                F.col("engagement_score").alias("enrollment_score"),
                "segments",
                F.date_format("last_interaction_at", "yyyy-MM-dd HH:mm:ss").alias("last_interaction"),
            ).filter(F.col("salesforce_id").isNotNull())
        )
        # First run: the count is held against itself.
        g4 = cut_lineage(Q.gate4_outbound(outbound.select(F.col("salesforce_id").alias("salesforce_contact_id")), outbound.count()))
        ok4 = Q.gate_passed(g4)
        report.append(("gate4_reverse_etl", g4.count(), ok4))
        if ok4:
            student = outbound.select("profile_id", F.substring("salesforce_id", 4, 20).alias("student_id"))
            consent = consent_records(spark, sf_dir, CONSENT_START).join(student, "student_id").drop("student_id").withColumnRenamed("profile_id", "student_id")
            sync = cut_lineage(salesforce_sync(outbound, spark.createDataFrame([], "dedup_key string"), consent, F.lit(as_of).cast("timestamp")))
            by = {r["status"]: r["count"] for r in sync.groupBy("status").count().collect()}
            report.append(("crm_sent", by.get("sent", 0), True))
            report.append(("crm_consent_denied", by.get("consent_denied", 0), True))
    fresh = Q.freshness(silver, "ts", as_of)
    report.append(("freshness", 1, bool(fresh.first()["fresh"])))
    return spark.createDataFrame(report, "stage string, rows long, passed boolean")
