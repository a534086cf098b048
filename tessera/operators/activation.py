"""Outbound activation as outbox tables.

Nothing is sent from Spark: every step produces rows - a status per request and
an outbox of payloads a connector delivers.  Steps follow the source system's
order: pre-push check (P17) -> daily quota (W5) -> idempotency (F11) -> payload
(P18-P20) -> status, with the consent gate (J8) always on.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.constants import PUSH_AT_EXEMPT, PUSH_PII_FIELDS, SF_DAILY_API_LIMIT, WHATSAPP_PREFIX
from tessera.functions.crypto import dedup_key
from tessera.session import cut_lineage


def push_check(df: DataFrame) -> Column:
    """A row passes when it has a profile id and no checked string column holds ``@``.

    Checked: string columns other than the PII fields and the exempt ids.
    """
    checked = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in PUSH_PII_FIELDS and f.name not in PUSH_AT_EXEMPT
    ]
    leak = F.lit(False)
    for c in checked:
        leak = leak | F.coalesce(F.lower(F.col(c)).contains("@"), F.lit(False))
    has_id = F.coalesce(F.length(F.col("profile_id").cast("string")) > 0, F.lit(False))
    return has_id & ~leak


def daily_quota_rank(df: DataFrame, day: Column, order: list[Column], buckets: int = 64, limit: int = SF_DAILY_API_LIMIT) -> DataFrame:
    """W5 helper: exact rank within ``day`` for the first ``limit`` rows, without one task per day.

    Rows are first ranked inside ``(day, hash bucket)`` - many tasks per day -
    and only each bucket's first ``limit`` survive; the final per-day rank then
    sees at most ``buckets * limit`` rows, a bound set by the quota, not the data.
    Rows past the limit get rank null.
    """
    b = F.pmod(F.xxhash64(*order), F.lit(buckets))
    x = df.withColumn("_day", day).withColumn("_b", b)
    w1 = Window.partitionBy("_day", "_b").orderBy(*order)
    cand = x.withColumn("_r1", F.row_number().over(w1))
    top = cand.filter(F.col("_r1") <= limit)
    w2 = Window.partitionBy("_day").orderBy(*order)
    r2 = F.row_number().over(w2)
    ranked = top.withColumn("quota_rank", F.when(r2 <= limit, r2)).select(*df.columns, "_day", "quota_rank")
    rest = cand.filter(F.col("_r1") > limit).select(*df.columns, "_day", F.lit(None).cast("int").alias("quota_rank"))
    return ranked.unionByName(rest).drop("_day")


def crm_payload(profiles: DataFrame) -> DataFrame:
    """P18 + F10: the CRM payload map (score default 0, segments joined by ``,``, last
    interaction) and the idempotency key over the whole profile row (every column not
    starting with ``_``), as two projected columns."""
    whole = [c for c in sorted(profiles.columns) if not c.startswith("_")]
    atomic = {f.name for f in profiles.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    row = F.create_map(*[x for c in whole for x in (F.lit(c), F.col(c).cast("string") if c in atomic else F.to_json(c))])
    payload = F.create_map(
        F.lit("Enrollment_Score__c"), F.coalesce(F.col("enrollment_score"), F.lit(0.0)).cast("string"),
        F.lit("CDP_Segment__c"), F.array_join(F.coalesce(F.col("segments"), F.array().cast("array<string>")), ","),
        F.lit("Last_Interaction__c"), F.col("last_interaction").cast("string"),
    )
    return profiles.withColumn("_payload", payload).withColumn("dedup_key", dedup_key("sf", F.col("profile_id"), row))


def salesforce_sync(
    profiles: DataFrame,
    sent_keys: DataFrame,
    consent: DataFrame | None,
    request_ts: Column,
    used_today: int = 0,
    limit: int = SF_DAILY_API_LIMIT,
    consent_channel: str = "profiling",
) -> DataFrame:
    """Per profile row a status ``validation_failed`` / ``consent_denied`` /
    ``deduplicated`` / ``quota_exceeded`` / ``sent`` and the CRM payload (P18).

    ``profiles`` needs ``profile_id, salesforce_id, enrollment_score, segments,
    last_interaction``; ``sent_keys (dedup_key)`` holds keys already pushed.  Requests
    run in order of request time, then id: of equal requests in this run the first is
    sent and the others are deduplicated (F11); the quota counts sends only.
    """
    p = crm_payload(profiles.withColumn("_valid", push_check(profiles)).withColumn("_req_ts", request_ts))
    if consent is not None:
        c = consent.filter(F.col("channel") == consent_channel).select(F.col("student_id").alias("_cid"), F.col("consented").alias("_ok"))
        p = p.join(c, p.profile_id == c._cid, "left").drop("_cid")
    else:
        p = p.withColumn("_ok", F.lit(True))
    seen = sent_keys.select(F.col("dedup_key").alias("_k")).distinct().withColumn("_seen", F.lit(True))
    p = p.join(seen, p.dedup_key == seen._k, "left").drop("_k")
    # The row number tells equal requests apart; materialised, it is the same for every reader.
    p = p.withColumn("_day", F.to_date("_req_ts")).withColumn("_row", F.monotonically_increasing_id())
    p = cut_lineage(p.withColumn("_ord", F.struct("_req_ts", "profile_id", "_row")))
    passes = F.col("_valid") & F.coalesce(F.col("_ok"), F.lit(False))
    fresh = passes & F.col("_seen").isNull()
    first = p.filter(fresh).groupBy("dedup_key").agg(F.min("_ord").alias("_first"))
    p = p.join(first, "dedup_key", "left")
    sends = fresh & (F.col("_ord") == F.col("_first"))
    remaining = max(limit - used_today, 0)
    # W5 as the source system runs it, in request order: the quota is checked for every
    # row that passed the checks, before dedup; once `remaining` sends are done, the
    # next such row stops the run and every row from there on fails.  The cut is found
    # with per-day aggregates: the order key of the last allowed send, then the first
    # passing row after it - no window over a whole day.
    ranked = daily_quota_rank(
        p.filter(sends).select("_ord", "_req_ts", "profile_id", "_row"), F.to_date("_req_ts"), [F.col("_req_ts"), F.col("profile_id"), F.col("_row")], limit=remaining
    )
    last = ranked.filter(F.col("quota_rank") == remaining).select(F.to_date("_req_ts").alias("_day"), F.col("_ord").alias("_last_ord"))
    if remaining == 0:
        cut = p.filter(passes).groupBy("_day").agg(F.min("_ord").alias("_cut"))
    else:
        # One row per day on the small side: the planner broadcasts it by its size.
        after = p.filter(passes).join(last, "_day").filter(F.col("_ord") > F.col("_last_ord"))
        cut = after.groupBy("_day").agg(F.min("_ord").alias("_cut"))
    p = p.join(cut_lineage(cut), "_day", "left")
    stopped = F.col("_cut").isNotNull() & (F.col("_ord") >= F.col("_cut"))
    status = (
        F.when(stopped, F.lit("quota_exceeded"))
        .when(~F.col("_valid"), F.lit("validation_failed"))
        .when(~F.coalesce(F.col("_ok"), F.lit(False)), F.lit("consent_denied"))
        .when(F.col("_seen").isNotNull() | (F.col("_ord") > F.col("_first")), F.lit("deduplicated"))
        .otherwise(F.lit("sent"))
    )
    return p.select(
        "profile_id",
        "salesforce_id",
        F.col("_day").alias("day"),
        status.alias("status"),
        F.col("_payload")["Enrollment_Score__c"].alias("Enrollment_Score__c"),
        F.col("_payload")["CDP_Segment__c"].alias("CDP_Segment__c"),
        F.col("_payload")["Last_Interaction__c"].alias("Last_Interaction__c"),
        "dedup_key",
    )


def sync_result(statuses: DataFrame) -> DataFrame:
    """Total / succeeded / failed and error count of a sync (deduplicated = succeeded)."""
    ok = F.col("status").isin("sent", "deduplicated")
    return statuses.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(ok, 1).otherwise(0)).alias("succeeded"),
        F.sum(F.when(~ok, 1).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("status").isin("validation_failed", "consent_denied"), 1).otherwise(0)).alias("errors"),
    )


def format_template(template: str, params: dict[str, Column]) -> Column:
    """``template.format(**params)`` for ``{name}`` fields: the template is split once
    and its pieces concatenated, so braces inside a value stay text.  A field without a
    parameter raises ``KeyError`` when the plan is built, as ``str.format`` does."""
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field is not None:
            pieces.append(F.coalesce(params[field].cast("string"), F.lit("None")))
    return F.concat(*pieces) if pieces else F.lit("")


def _first_of_equal(requests: DataFrame, status: Column, wanted: str) -> DataFrame:
    """F11 within a run: of the rows with one key and status ``wanted`` all but the first become ``deduplicated``."""
    r = cut_lineage(requests.withColumn("status", status).withColumn("_row", F.monotonically_increasing_id()))
    first = r.filter(F.col("status") == wanted).groupBy("dedup_key").agg(F.min("_row").alias("_first"))
    again = (F.col("status") == wanted) & (F.col("_row") > F.col("_first"))
    return r.join(first, "dedup_key", "left").withColumn("status", F.when(again, F.lit("deduplicated")).otherwise(F.col("status"))).drop("_row", "_first")


def whatsapp_outbox(
    requests: DataFrame, profiles: DataFrame, gate: DataFrame, sent_keys: DataFrame, template: str, params: dict[str, Column]
) -> DataFrame:
    """R2 (chat): consent -> idempotency -> profile with a phone -> message row.

    ``requests (profile_id + param columns)``, ``profiles (profile_id, phone)``,
    ``gate (profile_id, allowed)`` from J8.  Status ``consent_denied`` /
    ``deduplicated`` / ``no_phone`` / ``queued``.
    """
    key_payload = F.create_map(F.lit("template"), F.lit(template), *[x for k, v in params.items() for x in (F.lit(k), v.cast("string"))])
    r = requests.withColumn("dedup_key", dedup_key("wa", F.col("profile_id"), key_payload))
    r = r.join(gate.select("profile_id", "allowed"), "profile_id", "left")
    r = r.join(sent_keys.select("dedup_key").distinct().withColumn("_seen", F.lit(True)), "dedup_key", "left")
    r = r.join(profiles.select("profile_id", F.col("phone").alias("_phone")), "profile_id", "left")
    status = (
        F.when(~F.coalesce(F.col("allowed"), F.lit(False)), F.lit("consent_denied"))
        .when(F.col("_seen").isNotNull(), F.lit("deduplicated"))
        .when(F.col("_phone").isNull(), F.lit("no_phone"))
        .otherwise(F.lit("queued"))
    )
    queued = F.col("status") == "queued"
    r = _first_of_equal(r.withColumn("_body", format_template(template, params)), status, "queued")
    return r.select(
        "profile_id",
        "status",
        F.when(queued, F.concat(F.lit(WHATSAPP_PREFIX), F.col("_phone"))).alias("to"),
        F.when(queued, F.col("_body")).alias("body"),
        "dedup_key",
    )


def email_outbox(requests: DataFrame, gate: DataFrame, sent_keys: DataFrame, campaign_id: str) -> DataFrame:
    """R2 (e-mail): consent -> idempotency -> ``{profile_id, campaign_id}`` (P20)."""
    r = requests.withColumn("dedup_key", dedup_key("email", F.col("profile_id"), F.create_map(F.lit("campaign"), F.lit(campaign_id))))
    r = r.join(gate.select("profile_id", "allowed"), "profile_id", "left")
    r = r.join(sent_keys.select("dedup_key").distinct().withColumn("_seen", F.lit(True)), "dedup_key", "left")
    status = (
        F.when(~F.coalesce(F.col("allowed"), F.lit(False)), F.lit("consent_denied"))
        .when(F.col("_seen").isNotNull(), F.lit("deduplicated"))
        .otherwise(F.lit("queued"))
    )
    r = _first_of_equal(r, status, "queued")
    return r.select("profile_id", F.lit(campaign_id).alias("campaign_id"), "status", "dedup_key")


def segment_change_actions(changes: DataFrame) -> DataFrame:
    """K10 change rows exploded to one ``(profile_id, segment, action)`` row each."""
    add = changes.select("profile_id", F.explode("segments_added").alias("segment")).withColumn("action", F.lit("add"))
    rem = changes.select("profile_id", F.explode("segments_removed").alias("segment")).withColumn("action", F.lit("remove"))
    return add.unionByName(rem)


def audience_outbox(actions: DataFrame, gate: DataFrame, sent_keys: DataFrame, channel: str) -> DataFrame:
    """Audience changes of one channel - consent (``gate (profile_id, allowed, reason)``),
    then idempotency against earlier runs and within this one (F11)."""
    payload = F.create_map(F.lit("segment"), F.col("segment"), F.lit("action"), F.col("action"))
    r = actions.withColumn("dedup_key", dedup_key(channel, F.col("profile_id"), payload))
    r = r.join(gate.select("profile_id", "allowed", "reason").dropDuplicates(["profile_id"]), "profile_id", "left")
    r = r.join(sent_keys.select("dedup_key").distinct().withColumn("_seen", F.lit(True)), "dedup_key", "left")
    status = F.when(~F.coalesce("allowed", F.lit(False)), F.lit("consent_denied")).when(F.col("_seen").isNotNull(), F.lit("deduplicated")).otherwise(F.lit("queued"))
    r = _first_of_equal(r, status, "queued")
    return r.select(F.lit(channel).alias("channel"), "profile_id", "segment", "action", "status", "reason", "dedup_key")
