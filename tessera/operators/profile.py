"""Profile assembly: interaction summary (A1), engagement score (A2), consent
rollup (A3), first identifier per type (A4), contact authority (P22), score bands
(P16) and the whole fold (A5).

The fold is order-free: every part is an aggregate that adds up (count, max,
``max_by``, ``min_by``, ``bool_and``), so all of it runs in ONE ``groupBy``
on the profile key with map-side partial aggregation - a hot profile never
gathers its raw events in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import (
    CONSENT_CHANNELS,
    CONTACT_INFO_AUTHORITY,
    EVENT_SOURCES,
    FREQUENCY_CAP,
    FREQUENCY_PER_EVENT,
    FREQUENCY_WEIGHT,
    IDENTIFIER_TYPES,
    RECENCY_DECAY,
    RECENCY_HALF_LIFE_DAYS,
    RECENCY_WEIGHT,
    SCORE_BANDS,
)

MICROS_PER_DAY = 86_400_000_000.0


def round2(x: Column) -> Column:
    """Round half-up to 2 decimals with plain double arithmetic (same bits in any engine)."""
    return F.floor(x * 100.0 + 0.5) / 100.0


def days_between(as_of: Column | dt.datetime, ts: Column) -> Column:
    a = F.lit(as_of).cast("timestamp") if isinstance(as_of, dt.datetime) else as_of
    return (F.unix_micros(a) - F.unix_micros(ts)) / F.lit(MICROS_PER_DAY)


def engagement_score(last_ts: Column, total: Column, as_of: dt.datetime | Column) -> Column:
    """A2: ``0.55*recency + 0.45*frequency`` rounded to 2; no last interaction -> recency 0.

    recency = 100*exp(-0.693*days/14) with days >= 0; frequency = min(100, 2.5*n).
    """
    days = F.greatest(days_between(as_of, last_ts), F.lit(0.0))
    recency = F.when(last_ts.isNull(), F.lit(0.0)).otherwise(
        F.lit(100.0) * F.exp(F.lit(-RECENCY_DECAY) * days / F.lit(RECENCY_HALF_LIFE_DAYS))
    )
    frequency = F.least(F.lit(FREQUENCY_CAP), total.cast("double") * F.lit(FREQUENCY_PER_EVENT))
    return round2(F.lit(RECENCY_WEIGHT) * recency + F.lit(FREQUENCY_WEIGHT) * frequency)


def score_segment(score: Column) -> Column:
    """Half-open bands [70,100) [40,70) [15,40) [0,15).

    As coded in the source system, a score of exactly 100.0 is in no band (null).
    """
    out = None
    for name, low, high in SCORE_BANDS:
        cond = (score >= F.lit(low)) & (score < F.lit(high))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def interaction_summary(events: DataFrame, key: str = "profile_id") -> DataFrame:
    """A1: total events, per-source counts (MAP) and last interaction (max time)."""
    return events.groupBy(key).agg(*_summary_aggs())


def _summary_aggs() -> list[Column]:
    # Sources are a fixed list of 5, so per-source counts are conditional sums in the
    # same aggregate (no second shuffle on (profile, source)).
    per_src = [F.sum(F.when(F.col("source") == s, 1).otherwise(0)).alias(f"_n_{s}") for s in EVENT_SOURCES]
    return [F.count(F.lit(1)).alias("total_events"), F.max("ts").alias("last_interaction_at"), *per_src]


def _per_source_map() -> Column:
    entries = F.array(*[F.struct(F.lit(s).alias("key"), F.col(f"_n_{s}").cast("bigint").alias("value")) for s in EVENT_SOURCES])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


def first_identifier_of_type(identifiers: Column, id_type: str) -> Column:
    """Value of the first non-empty identifier of ``id_type`` in list order (null if none)."""
    return F.get(F.filter(identifiers, lambda x: (x["type"] == F.lit(id_type)) & (F.length(x["value"]) > 0)), 0)["value"]


def first_identifier_sql(identifiers: str, id_type: str) -> Column:
    """``first_identifier_of_type`` as one SQL expression over a column name."""
    return F.expr(f"get(filter({identifiers}, x -> x.type = '{id_type}' AND length(x.value) > 0), 0).value")


def build_profiles(
    events: DataFrame,
    as_of: dt.datetime,
    key: str = "profile_id",
    previous: DataFrame | None = None,
) -> DataFrame:
    """A5: fold resolved events into one profile row per ``key``.

    ``events`` needs ``key, event_id, source, ts, identifiers`` and optionally
    ``personal_info`` (STRUCT name,email,phone), ``lead_status`` and ``consent``
    (MAP<STRING,BOOLEAN>).  With ``previous`` profiles, counts add up, contact info
    and first identifiers keep the old value unless absent, consent ANDs with the
    old map (missing old = true, A3) and ``version`` goes up by one; new profiles
    start at version 0 + 1.
    """
    cols = set(events.columns)
    # Per-row picks are projected once before the aggregate (each higher-order
    # function runs once per row, not once per aggregate input).
    pre = {f"_i_{t}": first_identifier_sql("identifiers", t) for t in IDENTIFIER_TYPES}
    if "personal_info" in cols:
        is_auth = (F.col("source") == CONTACT_INFO_AUTHORITY) & F.col("personal_info").isNotNull()
        pre["_pi"] = F.when(is_auth, F.col("personal_info"))
    events = events.withColumns(pre)
    order = F.struct(F.col("ts"), F.col("event_id"))
    aggs = _summary_aggs()
    if "personal_info" in cols:
        # Only the authority source overwrites contact info; newest authority event wins.
        aggs.append(F.max_by(F.col("_pi"), F.when(F.col("_pi").isNotNull(), order)).alias("personal_info"))
    if "lead_status" in cols:
        aggs.append(F.max_by(F.col("lead_status"), F.when(F.col("lead_status").isNotNull(), order)).alias("lead_status"))
    if "consent" in cols:
        # A3: most restrictive wins; channels never mentioned stay absent.
        aggs += [F.bool_and(F.col("consent")[ch]).alias(f"_c_{ch}") for ch in CONSENT_CHANNELS]
    # A4: first value per identifier type, by (time, event id); 5 fixed types -> bounded.
    for t in IDENTIFIER_TYPES:
        v = F.col(f"_i_{t}")
        aggs.append(F.min_by(v, F.when(v.isNotNull(), order)).alias(f"_i_{t}"))
    g = events.groupBy(key).agg(*aggs)

    ident_arr = F.array(*[F.struct(F.lit(t).alias("type"), F.col(f"_i_{t}").alias("value")) for t in IDENTIFIER_TYPES])
    out_cols = [
        F.col(key).alias("profile_id"),
        F.filter(ident_arr, lambda x: x["value"].isNotNull()).alias("identifiers"),
        (F.col("personal_info") if "personal_info" in cols else F.lit(None).cast("struct<name:string,email:string,phone:string>")).alias(
            "personal_info"
        ),
        F.coalesce(F.col("lead_status") if "lead_status" in cols else F.lit(None).cast("string"), F.lit("anonymous")).alias(
            "enrollment_status"
        ),
    ]
    if "consent" in cols:
        entries = F.array(*[F.struct(F.lit(ch).alias("key"), F.col(f"_c_{ch}").alias("value")) for ch in CONSENT_CHANNELS])
        consent = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    else:
        consent = F.create_map().cast("map<string,boolean>")
    out_cols += [
        consent.alias("consent"),
        F.col("total_events").cast("bigint").alias("total_events"),
        _per_source_map().alias("per_source_count"),
        F.col("last_interaction_at"),
    ]
    prof = g.select(*out_cols)
    if previous is not None:
        prof = _merge_previous(prof, previous)
    else:
        prof = prof.withColumn("version", F.lit(1).cast("bigint"))
    score = engagement_score(F.col("last_interaction_at"), F.col("total_events"), as_of)
    return (
        prof.withColumn("engagement_score", score)
        .withColumn("segments", F.filter(F.array(score_segment(F.col("engagement_score"))), lambda s: s.isNotNull()))
        .withColumn("updated_at", F.lit(as_of).cast("timestamp"))
    )


def _merge_previous(new: DataFrame, old: DataFrame) -> DataFrame:
    """Fold a batch delta into stored profiles (full outer join on profile_id)."""
    o = old.select(
        F.col("profile_id"),
        F.col("identifiers").alias("o_ids"),
        F.col("personal_info").alias("o_info"),
        F.col("enrollment_status").alias("o_status"),
        F.col("consent").alias("o_consent"),
        F.col("total_events").alias("o_total"),
        F.col("per_source_count").alias("o_src"),
        F.col("last_interaction_at").alias("o_last"),
        F.col("version").alias("o_version"),
    )
    j = new.join(o, "profile_id", "full_outer")
    old_types = F.transform(F.coalesce(F.col("o_ids"), F.array()), lambda x: x["type"])
    kept_new = F.filter(F.coalesce(F.col("identifiers"), F.array()), lambda x: ~F.array_contains(old_types, x["type"]))
    return j.select(
        "profile_id",
        F.concat(F.coalesce(F.col("o_ids"), F.array()), kept_new).alias("identifiers"),
        F.coalesce(F.col("personal_info"), F.col("o_info")).alias("personal_info"),
        F.when(F.col("enrollment_status") != "anonymous", F.col("enrollment_status"))
        .otherwise(F.coalesce(F.col("o_status"), F.col("enrollment_status")))
        .alias("enrollment_status"),
        F.map_zip_with(
            F.coalesce(F.col("o_consent"), F.create_map().cast("map<string,boolean>")),
            F.coalesce(F.col("consent"), F.create_map().cast("map<string,boolean>")),
            lambda k, a, b: F.when(b.isNull(), a).otherwise(F.coalesce(a, F.lit(True)) & b),
        ).alias("consent"),
        (F.coalesce(F.col("total_events"), F.lit(0)) + F.coalesce(F.col("o_total"), F.lit(0))).cast("bigint").alias("total_events"),
        F.map_zip_with(
            F.coalesce(F.col("o_src"), F.create_map().cast("map<string,bigint>")),
            F.coalesce(F.col("per_source_count"), F.create_map().cast("map<string,bigint>")),
            lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        ).alias("per_source_count"),
        F.greatest(F.col("last_interaction_at"), F.col("o_last")).alias("last_interaction_at"),
        (F.coalesce(F.col("o_version"), F.lit(0)) + F.when(F.col("total_events").isNotNull(), 1).otherwise(0)).cast("bigint").alias("version"),
    )


def flatten_profile(prof: DataFrame) -> DataFrame:
    """Scalar view of a profile (sorted ``k=v`` strings for maps and arrays)."""
    return prof.select(
        "profile_id",
        F.col("personal_info.name").alias("name"),
        F.col("personal_info.email").alias("email"),
        F.col("personal_info.phone").alias("phone"),
        "enrollment_status",
        "total_events",
        F.array_join(
            F.array_sort(F.transform(F.map_entries("per_source_count"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))),
            ";",
        ).alias("per_source"),
        F.date_format("last_interaction_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_interaction_at"),
        "engagement_score",
        F.try_element_at("segments", F.lit(1)).alias("score_segment"),
        F.array_join(F.array_sort(F.map_keys(F.map_filter("consent", lambda k, v: v))), ",").alias("consented_channels"),
        F.array_join(
            F.array_sort(F.transform("identifiers", lambda x: F.concat(x["type"], F.lit("="), x["value"]))), ";"
        ).alias("first_identifiers"),
        "version",
    )


def rule_inputs(events: DataFrame, as_of: dt.datetime, key: str = "profile_id") -> DataFrame:
    """Profile fields the segment rules read (one aggregate pass, one shuffle).

    ``total_events``, ``enrollment_status`` (newest CRM lead status, else
    ``anonymous``), ``days_since_last_login`` (whole days since the last app
    event; null without one), ``viewed_mba_page`` / ``downloaded_brochure``
    (any event with the boolean column of that name), and ``purchase_value`` (sum
    of CRM event values).
    """
    order = F.struct(F.col("ts"), F.col("event_id"))
    last_app = F.max(F.when(F.col("source") == "app", F.col("ts")))
    aggs = [
        F.count(F.lit(1)).alias("total_events"),
        F.max("ts").alias("last_interaction_at"),
        last_app.alias("_last_app"),
        F.bool_or(F.coalesce("viewed_mba_page", F.lit(False))).alias("viewed_mba_page"),
        F.bool_or(F.coalesce("downloaded_brochure", F.lit(False))).alias("downloaded_brochure"),
        F.sum(F.when(F.col("source") == "crm", F.col("value"))).alias("purchase_value"),
    ]
    if "lead_status" in events.columns:
        aggs.append(F.max_by(F.col("lead_status"), F.when(F.col("lead_status").isNotNull(), order)).alias("_lead"))
    g = events.groupBy(key).agg(*aggs)
    status = F.coalesce(F.col("_lead"), F.lit("anonymous")) if "lead_status" in events.columns else F.lit("anonymous")
    return g.select(
        F.col(key).alias("profile_id"),
        "total_events",
        "last_interaction_at",
        status.alias("enrollment_status"),
        F.floor(days_between(as_of, F.col("_last_app"))).alias("days_since_last_login"),
        "viewed_mba_page",
        "downloaded_brochure",
        "purchase_value",
    )
