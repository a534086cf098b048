"""Consent: per-channel records, last-write-wins updates with audit (C1), reads
(C2), checks (J9, J10), merges (J11) and the outbound gate (J8).

Consent lives in a long table ``(student_id, channel, consented, legal_basis,
updated_at, terms_version)`` - one row per student and channel - so every
operation is a keyed join or aggregate on ``(student_id, channel)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import CONSENT_CHANNELS, MERGE_LEGAL_BASIS, TERMS_VERSION
from tessera.operators.skew import unbroadcast

KEY = ["student_id", "channel"]


def update_consent(current: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply ``changes (student_id, channel, consented, legal_basis, source, ts)``.

    Channels outside the allow-list of 6 are rejected.  Per (student, channel) the
    newest change wins (ties: the later row by legal basis, then source); the
    terms version becomes the current one.  Returns ``(new_state, audit, rejected)``
    where the audit has one row per accepted change with the value it replaced.
    """
    ok = changes.filter(F.col("channel").isin(CONSENT_CHANNELS))
    rejected = changes.filter(~F.col("channel").isin(CONSENT_CHANNELS) | F.col("channel").isNull())
    order = F.struct(F.col("ts"), F.col("legal_basis"), F.col("source"))
    latest = ok.groupBy(*KEY).agg(F.max_by(F.struct("consented", "legal_basis", "ts"), order).alias("x")).select(
        *KEY,
        F.col("x.consented").alias("consented"),
        F.col("x.legal_basis").alias("legal_basis"),
        F.col("x.ts").alias("updated_at"),
        F.lit(TERMS_VERSION).alias("terms_version"),
    )
    kept = current.join(latest.select(*KEY), KEY, "left_anti")
    state = kept.unionByName(latest)
    # Audit: the value each change replaced = previous change of the same key, or
    # the stored value for the first change.
    w = Window.partitionBy(*KEY).orderBy("ts", "legal_basis", "source")
    stored = current.select(*KEY, F.col("consented").alias("_stored"))
    audit = (
        ok.join(stored, KEY, "left")
        .withColumn("_prev", F.lag("consented").over(w))
        .withColumn("_rn", F.row_number().over(w))
        .select(
            *KEY,
            F.when(F.col("_rn") == 1, F.col("_stored")).otherwise(F.col("_prev")).alias("old_value"),
            F.col("consented").alias("new_value"),
            "legal_basis",
            F.lit(TERMS_VERSION).alias("terms_version"),
            "source",
            F.col("ts").alias("timestamp"),
        )
    )
    return state, audit, rejected


def get_consent(students: DataFrame, state: DataFrame) -> DataFrame:
    """``MAP<channel, consented>`` per requested student; no record -> empty map."""
    m = state.groupBy("student_id").agg(F.map_from_entries(F.collect_list(F.struct("channel", "consented"))).alias("channels"))
    return students.select("student_id").join(m, "student_id", "left").select(
        "student_id", F.coalesce("channels", F.create_map().cast("map<string,boolean>")).alias("channels")
    )


def bulk_check(requests: DataFrame, state: DataFrame, channel: str) -> DataFrame:
    """Every requested id answered; no record or revoked -> false."""
    c = state.filter(F.col("channel") == channel).select("student_id", F.col("consented").alias("_c"))
    return requests.select("student_id").join(c, "student_id", "left").select(
        "student_id", F.coalesce("_c", F.lit(False)).alias("allowed")
    )


def merge_consent(state: DataFrame, pairs: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """For each ``(primary_id, secondary_id)`` and each of the 6 channels,
    merged = primary AND secondary (missing = false).  The primary is rewritten only
    where it has no entry or a different value (legal basis ``legitimate_interest``);
    the secondary's records are deleted.  Returns ``(new_state, rewrites)``."""
    chans = F.array(*[F.lit(c) for c in CONSENT_CHANNELS])
    grid = pairs.select("primary_id", "secondary_id", F.explode(chans).alias("channel"))
    p = state.select(F.col("student_id").alias("primary_id"), "channel", F.col("consented").alias("p_c"))
    s = state.select(F.col("student_id").alias("secondary_id"), "channel", F.col("consented").alias("s_c"))
    g = grid.join(unbroadcast(p), ["primary_id", "channel"], "left").join(unbroadcast(s), ["secondary_id", "channel"], "left")
    merged = F.coalesce("p_c", F.lit(False)) & F.coalesce("s_c", F.lit(False))
    rewrites = g.filter(F.col("p_c").isNull() | (F.col("p_c") != merged)).select(
        F.col("primary_id").alias("student_id"),
        "channel",
        merged.alias("consented"),
        F.lit(MERGE_LEGAL_BASIS).alias("legal_basis"),
        F.lit(as_of).cast("timestamp").alias("updated_at"),
        F.lit(TERMS_VERSION).alias("terms_version"),
    )
    kept = state.join(unbroadcast(pairs.select(F.col("secondary_id").alias("student_id"))), "student_id", "left_anti")
    kept = kept.join(unbroadcast(rewrites.select(*KEY)), KEY, "left_anti")
    return kept.unionByName(rewrites), rewrites


def consent_gate(targets: DataFrame, profiles: DataFrame, state: DataFrame, channel: str, key: str = "profile_id") -> DataFrame:
    """Outbound rows pass only with a profile and a granted record for ``channel``.

    Adds ``allowed`` and ``reason`` (``no_profile``, ``no_record``, ``revoked``);
    denied rows are the consent audit of the send.
    """
    has_profile = profiles.select(F.col(key).alias("_pid")).withColumn("_has", F.lit(True))
    c = state.filter(F.col("channel") == channel).select(F.col("student_id").alias("_sid"), F.col("consented").alias("_c"))
    j = targets.join(has_profile, targets[key] == has_profile["_pid"], "left").join(c, targets[key] == c["_sid"], "left")
    reason = F.when(F.col("_has").isNull(), F.lit("no_profile")).when(F.col("_c").isNull(), F.lit("no_record")).when(~F.col("_c"), F.lit("revoked"))
    return j.select(*[targets[c] for c in targets.columns], reason.isNull().alias("allowed"), reason.alias("reason"))


def consent_audit_trail(audit: DataFrame, student_id: Column | str | None = None) -> DataFrame:
    """Audit rows in ascending time (optionally of one student)."""
    a = audit if student_id is None else audit.filter(F.col("student_id") == student_id)
    return a.orderBy("timestamp", "channel")
