"""Normalisation of the five sources into ``customer_event`` (P1-P12, S1-S6, U6),
with validation, dead-letter split (K3, D9) and bronze dedup (W6).

Every parser is a projection (``from_json`` + column expressions): no shuffle,
so it runs at scan speed and pipelines into whatever follows.  Invalid rows are
never dropped silently (apart from the mobile allow-list, P6, which the source
system drops by design): they go to a dead-letter frame with the error text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.constants import (
    CONSENT_CHANNELS,
    DLQ_REASON_MAX,
    EMAIL_EVENT_TYPES,
    ENROLLMENT_STATES,
    EVENT_SOURCES,
    IDENTIFIER_TYPES,
    MACHINE_OPEN_MARKERS,
    MOBILE_EVENT_TYPES,
    SF_FIELD_MAP,
    SF_REQUIRED_COLUMNS,
)
from tessera.functions.text import detect_intent, extract_entities, first_non_empty
from tessera.functions.timestamps import coerce_types, parse_iso, parse_timestamp, parse_timestamp_or

STR_MAP = T.MapType(T.StringType(), T.StringType())
#: Malformed text lands in the ``_corrupt_record`` field instead of a row of nulls.
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

CLICKSTREAM_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("utm_params", STR_MAP),
        T.StructField("referrer", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("student_id", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
MOBILE_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("advertising_id", T.StringType()),
        T.StructField("firebase_token", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("app_version", T.StringType()),
        T.StructField("os_name", T.StringType()),
        T.StructField("os_version", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("properties", STR_MAP),
        T.StructField("event_id", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

CANONICAL_COLUMNS = ["event_id", "event_type", "source", "ts", "student_id", "identifiers", "raw_data", "normalized_data", "event_date"]


def with_errors(df: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    """Add ``errors`` ARRAY<STRING> - one message per failed check."""
    msgs = [F.when(F.coalesce(bad, F.lit(True)), F.lit(msg)) for bad, msg in checks]
    return df.withColumn("errors", F.array_compact(F.array(*msgs)))


def field_checks(json: str, required: list[str]) -> list[tuple[Column, str]]:
    """P12 for a parsed payload: malformed text, else each missing required field."""
    broken = F.col(json).isNull() | F.col(f"{json}._corrupt_record").isNotNull()
    return [(broken, "malformed json"), *[(~broken & F.col(f"{json}.{c}").isNull(), f"{c}: field required") for c in required]]


def profile_checks(df: DataFrame) -> list[tuple[Column, str]]:
    """P12 of the profile model, for the columns present: identifier type and length (1 to 512),
    enrollment state, consent channels, scores within 0 and 1."""
    checks: list[tuple[Column, str]] = []
    if "identifiers" in df.columns:
        ids = F.coalesce("identifiers", F.array())
        size = lambda x: F.length(F.coalesce(x["value"], F.lit("")))
        checks.append((F.exists(ids, lambda x: ~F.coalesce(x["type"].isin(IDENTIFIER_TYPES), F.lit(False))), "identifiers.type: not a valid enumeration member"))
        checks.append((F.exists(ids, lambda x: size(x) < 1), "identifiers.value: at least 1 character"))
        checks.append((F.exists(ids, lambda x: size(x) > 512), "identifiers.value: at most 512 characters"))
    if "enrollment_status" in df.columns:
        s = F.col("enrollment_status")
        checks.append((s.isNotNull() & ~s.isin(ENROLLMENT_STATES), "enrollment_status: not a valid enumeration member"))
    if "consent" in df.columns:
        channels = F.map_keys(F.coalesce("consent", F.create_map().cast("map<string,boolean>")))
        checks.append((F.exists(channels, lambda c: ~c.isin(CONSENT_CHANNELS)), "consent: not a valid enumeration member"))
    for c in ("engagement", "churn_risk", "enrollment_probability"):
        if c in df.columns:
            v = F.col(c)
            checks.append((v.isNotNull() & (F.isnan(v) | (v < 0) | (v > 1)), f"{c}: between 0 and 1"))
    return checks


def validate_profiles(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles that satisfy the model, and dead letters."""
    return split_valid(with_errors(df, profile_checks(df)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split on ``errors``: valid rows, and dead letters ``{original, error, error_type}`` (K3)."""
    valid = df.filter(F.size("errors") == 0).drop("errors")
    bad = df.filter(F.size("errors") > 0)
    original = F.col("raw_value") if "raw_value" in df.columns else F.to_json(F.struct(*[F.col(c) for c in df.columns if c != "errors"]))
    dlq = bad.select(
        original.alias("original"),
        F.array_join("errors", "; ").alias("error"),
        F.substring(F.array_join("errors", "; "), 1, DLQ_REASON_MAX).alias("error_type"),
        *([F.col("source")] if "source" in df.columns else []),
    )
    return valid, dlq


def _event_id(explicit: Column, raw: Column) -> Column:
    """Payload ``event_id`` if given, else a content hash (stable replacement of a random id)."""
    return F.coalesce(explicit, F.sha2(raw, 256))


def _truthy(v: Column, key: str) -> Column:
    """Text of a top-level field of a VARIANT, or null where it is empty: missing, null, "", 0, false, [] or {}."""
    kind = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
    text = F.try_variant_get(v, f"$.{key}", "string")
    hollow = kind.isin("VOID", "ARRAY<VOID>", "OBJECT<>") | (text == "") | ((kind == "BOOLEAN") & (text == "false"))
    number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(text.isNotNull() & ~hollow & ~(number & (F.try_variant_get(v, f"$.{key}", "double") == 0)), text)


def normalize_json(raw: DataFrame, source: str, as_of: dt.datetime) -> DataFrame:
    """JSON payloads of any source (column ``value``) as canonical events, parsed once into a VARIANT.

    The first non-empty of ``timestamp`` and ``event_time`` is the time (a number is an
    epoch, text an ISO time; none or unreadable: ``as_of``), of ``event_type`` and
    ``event`` the type (none: ``unknown``), of ``user_id``, ``student_id`` and ``Id``
    the student.  Empty is what is missing, null, "", 0, false, [] or {}.  Without an
    ``event_id`` the event is named by a hash of the payload.  ``normalized_data``
    holds every field after type coercion (P4).  Text that is no JSON object gives a
    row of type ``unknown`` with all fields null.
    """
    p = raw.select(F.col("value").alias("raw_value"), F.try_parse_json(F.col("value")).alias("v"))
    p = p.withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))
    ts_text = F.coalesce(_truthy(F.col("v"), "timestamp"), _truthy(F.col("v"), "event_time"))
    key = F.when(_truthy(F.col("v"), "timestamp").isNotNull(), "timestamp").otherwise("event_time")
    kind = F.when(key == "timestamp", F.schema_of_variant(F.try_variant_get("v", "$.timestamp", "variant"))).otherwise(F.schema_of_variant(F.try_variant_get("v", "$.event_time", "variant")))
    epoch = F.when(kind == "BOOLEAN", F.timestamp_seconds(F.lit(1))).when(kind != "STRING", parse_timestamp(ts_text))
    ts = F.coalesce(epoch, F.when(kind == "STRING", parse_iso(ts_text)))
    out = p.select(
        _event_id(F.try_variant_get("v", "$.event_id", "string"), F.col("raw_value")).alias("event_id"),
        F.coalesce(_truthy(F.col("v"), "event_type"), _truthy(F.col("v"), "event"), F.lit("unknown")).alias("event_type"),
        F.lit(source).alias("source"),
        F.coalesce(ts, F.lit(as_of).cast("timestamp")).alias("ts"),
        F.coalesce(*[_truthy(F.col("v"), k) for k in ("user_id", "student_id", "Id")]).alias("student_id"),
        F.col("raw_value").alias("raw_data"),
        coerce_types(F.try_variant_get("v", "$", "map<string,string>")).alias("normalized_data"),
        ts.isNull().alias("ts_defaulted"),
    )
    return out.withColumn("event_date", F.to_date("ts"))


def parse_clickstream(raw: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """S1 + P12 + P1 + P4: clickstream JSON (column ``value``) -> (events, dead letters).

    Required: ``session_id``, ``page_url``.  Student id is ``user_id`` only.
    """
    p = raw.select(F.col("value").alias("raw_value"), F.from_json("value", CLICKSTREAM_SCHEMA, PERMISSIVE).alias("j"))
    p = with_errors(p, field_checks("j", ["session_id", "page_url"]))
    valid, dlq = split_valid(p.withColumn("source", F.lit("website")))
    ts, failed = parse_timestamp_or(first_non_empty(F.col("j.timestamp"), F.col("j.event_time")), as_of)
    norm_map = F.map_concat(
        coerce_types(F.from_json("raw_value", STR_MAP)),
        F.create_map(
            F.lit("session_id"), F.col("j.session_id"),
            F.lit("page_url"), F.col("j.page_url"),
            F.lit("event_type"), F.coalesce(F.col("j.event_type"), F.lit("page_view")),
            F.lit("utm_params"), F.to_json(F.coalesce(F.col("j.utm_params"), F.create_map().cast(STR_MAP))),
            F.lit("referrer"), F.col("j.referrer"),
        ),
    )
    ids = F.filter(
        F.array(F.struct(F.lit("session_id").alias("type"), F.col("j.session_id").alias("value"))), lambda x: F.length(x["value"]) > 0
    )
    ev = valid.select(
        _event_id(F.col("j.event_id"), F.col("raw_value")).alias("event_id"),
        F.coalesce(first_non_empty(F.col("j.event_type"), F.col("j.event")), F.lit("unknown")).alias("event_type"),
        F.lit("website").alias("source"),
        ts.alias("ts"),
        F.col("j.user_id").alias("student_id"),
        ids.alias("identifiers"),
        F.col("raw_value").alias("raw_data"),
        norm_map.alias("normalized_data"),
        failed.alias("ts_defaulted"),
    )
    return ev.withColumn("event_date", F.to_date("ts")), dlq


def parse_mobile(raw: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """S2 + P12 + P6 + P5 + P7: mobile JSON -> (events, dead letters).

    Types outside the allow-list of 8 are dropped without a dead letter (P6).
    """
    p = raw.select(F.col("value").alias("raw_value"), F.from_json("value", MOBILE_SCHEMA, PERMISSIVE).alias("j"))
    p = with_errors(p, field_checks("j", ["event_type", "device_id"]))
    valid, dlq = split_valid(p.withColumn("source", F.lit("app")))
    valid = valid.filter(F.col("j.event_type").isin(MOBILE_EVENT_TYPES))
    ts, failed = parse_timestamp_or(first_non_empty(F.col("j.timestamp")), as_of)
    ident = lambda v: F.struct(F.lit("device_id").alias("type"), v.alias("value"))
    ids = F.filter(F.array(ident(F.col("j.device_id")), ident(F.col("j.advertising_id"))), lambda x: F.length(x["value"]) > 0)
    os_text = F.trim(F.concat_ws(" ", F.coalesce(F.col("j.os_name"), F.lit("")), F.coalesce(F.col("j.os_version"), F.lit(""))))
    enrich = F.create_map(
        F.lit("device_id"), F.col("j.device_id"),
        F.lit("advertising_id"), F.col("j.advertising_id"),
        F.lit("firebase_token"), F.col("j.firebase_token"),
        F.lit("app_version"), F.col("j.app_version"),
        F.lit("os"), os_text,
        F.lit("identifiers"), F.to_json(ids),
    )
    # Properties overlay last and so overwrite (map key dedup policy LAST_WIN).
    norm_map = F.map_concat(coerce_types(F.from_json("raw_value", STR_MAP)), enrich, F.coalesce(F.col("j.properties"), F.create_map().cast(STR_MAP)))
    ev = valid.select(
        _event_id(F.col("j.event_id"), F.col("raw_value")).alias("event_id"),
        F.concat(F.lit("mobile."), F.col("j.event_type")).alias("event_type"),
        F.lit("app").alias("source"),
        ts.alias("ts"),
        F.col("j.user_id").alias("student_id"),
        ids.alias("identifiers"),
        F.col("raw_value").alias("raw_data"),
        norm_map.alias("normalized_data"),
        failed.alias("ts_defaulted"),
    )
    return ev.withColumn("event_date", F.to_date("ts")), dlq


def is_machine_open(event_type: Column, user_agent: Column) -> Column:
    """P10: an open whose user agent names an Apple proxy (case-insensitive)."""
    ua = F.lower(F.coalesce(user_agent, F.lit("")))
    hit = None
    for m in MACHINE_OPEN_MARKERS:
        hit = ua.contains(m) if hit is None else hit | ua.contains(m)
    return (event_type == "email_opened") & hit


def parse_email(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S5 + P9 + P10: e-mail webhook JSON (``value``, receive time ``ts``) -> (email events, rejects)."""
    m = F.from_json("value", STR_MAP)
    p = raw.select(F.col("value").alias("raw_value"), F.col("ts").alias("received_at"), m.alias("m"))
    etype = F.coalesce(F.col("m")["event_type"], F.col("m")["event"], F.lit(""))
    p = p.withColumn("etype", etype)
    p = with_errors(p, [(~F.col("etype").isin(EMAIL_EVENT_TYPES), "unsupported event_type")])
    valid, dlq = split_valid(p.withColumn("source", F.lit("email")))
    ua = first_non_empty(F.col("m")["user_agent"], F.col("m")["useragent"])
    out = valid.select(
        F.col("etype").alias("event_type"),
        F.coalesce(F.col("m")["recipient_email"], F.col("m")["email"], F.lit("")).alias("recipient_email"),
        F.col("m")["campaign_id"].alias("campaign_id"),
        F.col("m")["url"].alias("link_url"),
        F.col("m")["bounce_type"].alias("bounce_type"),
        ua.alias("user_agent"),
        F.col("m")["ip"].alias("ip_address"),
        F.coalesce(is_machine_open(F.col("etype"), ua), F.lit(False)).alias("is_machine_open"),
        F.col("received_at").alias("timestamp"),
        F.col("raw_value").alias("raw_payload"),
    )
    return out, dlq


def parse_whatsapp(forms: DataFrame) -> DataFrame:
    """Chat webhook form fields (``form`` MAP, receive time ``ts``) -> chat events."""
    f = F.col("form")
    n = F.coalesce(f["NumMedia"].try_cast("int"), F.lit(0))
    media = F.when(
        n > 0, F.filter(F.transform(F.sequence(F.lit(0), n - 1), lambda i: f[F.concat(F.lit("MediaUrl"), i.cast("string"))]), lambda x: x.isNotNull())
    ).otherwise(F.array().cast("array<string>"))
    status = f["MessageStatus"]
    return forms.select(
        F.coalesce(f["From"], F.lit("")).alias("from_number"),
        F.nullif(f["Body"], F.lit("")).alias("body"),
        media.alias("media_urls"),
        n.alias("num_media"),
        f["MessageSid"].alias("message_sid"),
        status.alias("message_status"),
        F.col("ts").alias("timestamp"),
        F.when(F.length(F.coalesce(status, F.lit(""))) > 0, F.lit("status")).otherwise(F.lit("message")).alias("event_kind"),
    )


def normalize_whatsapp_text(chat: DataFrame, body: str = "body", sender: str = "from_number") -> DataFrame:
    """Intent (F4), entities (F5) and body length for chat messages."""
    intent = detect_intent(F.col(body))
    return chat.withColumns(
        {
            "intent": intent,
            "event_type": F.concat(F.lit("whatsapp."), intent),
            "entities": extract_entities(F.col(body)),
            "body_length": F.length(F.col(body)),
        }
    )


def email_events(email: DataFrame) -> DataFrame:
    """E-mail events as canonical events; the recipient is the identifier."""
    to = F.nullif(F.lower(F.trim("recipient_email")), F.lit(""))
    text = F.create_map(*[x for c in ("campaign_id", "link_url", "bounce_type", "user_agent", "ip_address") for x in (F.lit(c), F.col(c))], F.lit("is_machine_open"), F.col("is_machine_open").cast("string"))
    return email.select(
        F.sha2(F.concat_ws("\u0001", "raw_payload", F.unix_micros("timestamp").cast("string")), 256).alias("event_id"),
        "event_type",
        F.lit("email").alias("source"),
        F.col("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("student_id"),
        _identifiers(("email", to)).alias("identifiers"),
        F.col("raw_payload").alias("raw_data"),
        text.alias("normalized_data"),
        F.to_date("timestamp").alias("event_date"),
    )


def chat_events(chat: DataFrame) -> DataFrame:
    """Chat events (``parse_whatsapp``) as canonical events; the sender's number is the identifier.

    A message carries intent and entities and is named by its sid.  A delivery status
    is an event of its own: typed ``whatsapp.status.{status}``, without an intent, and
    named by sid and status, so the callbacks of one message neither replace it nor
    each other while a callback that is sent again counts once.
    """
    c = normalize_whatsapp_text(chat.withColumn("body", F.coalesce("body", F.lit(""))))
    status = F.col("event_kind") == "status"
    sid = F.nullif("message_sid", F.lit(""))
    c = c.withColumns(
        {
            "event_type": F.when(status, F.concat(F.lit("whatsapp.status."), "message_status")).otherwise(F.col("event_type")),
            "intent": F.when(~status, F.col("intent")),
            "entities": F.when(~status, F.col("entities")),
        }
    )
    phone = F.nullif(F.regexp_replace("from_number", "^whatsapp:", ""), F.lit(""))
    norm = F.create_map(
        F.lit("intent"), F.col("intent"),
        F.lit("entities"), F.to_json("entities"),
        F.lit("from_number"), F.col("from_number"),
        F.lit("message_sid"), F.col("message_sid"),
        F.lit("event_kind"), F.col("event_kind"),
        F.lit("message_status"), F.when(status, F.col("message_status")),
        F.lit("body_length"), F.col("body_length").cast("string"),
    )
    raw = F.to_json(F.struct("body", "from_number", "message_sid", "message_status", "num_media", "media_urls"))
    return c.select(
        F.coalesce(F.when(status, F.concat(sid, F.lit(":"), "message_status")).otherwise(sid), F.sha2(F.concat_ws("\u0001", raw, F.unix_micros("timestamp").cast("string")), 256)).alias("event_id"),
        "event_type",
        F.lit("whatsapp").alias("source"),
        F.col("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("student_id"),
        _identifiers(("phone", phone)).alias("identifiers"),
        raw.alias("raw_data"),
        norm.alias("normalized_data"),
        F.to_date("timestamp").alias("event_date"),
    )


def _identifiers(*pairs: tuple[str, Column]) -> Column:
    """Identifier array of the pairs whose value is neither null nor empty."""
    rows = F.array(*[F.struct(F.lit(t).alias("type"), v.cast("string").alias("value")) for t, v in pairs])
    return F.filter(rows, lambda x: F.length(x["value"]) > 0)


def map_crm_fields(df: DataFrame) -> DataFrame:
    """9 renames; other columns kept as ``sf_<name>``; ``attributes`` dropped."""
    mapped = dict(SF_FIELD_MAP)
    cols = [F.col(c).alias(mapped[c]) for c in df.columns if c in mapped]
    cols += [F.col(c).alias(f"sf_{c}") for c in df.columns if c not in mapped and c != "attributes"]
    return df.select(*cols)


def check_crm_columns(df: DataFrame) -> None:
    """Fail when required CSV columns are missing (schema only, no data read)."""
    missing = sorted(set(SF_REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"CSV missing required columns: {missing}")


def normalize_csv_rows(df: DataFrame, schema_map: dict[str, str], as_of: dt.datetime) -> DataFrame:
    """Keep mapped columns present; type default ``csv_import``; id = student_id else salesforce_id."""
    present = [(src, dst) for src, dst in schema_map.items() if src in df.columns]
    mapped = {dst: F.col(src).cast("string") for src, dst in present}
    get = lambda k: mapped.get(k, F.lit(None).cast("string"))
    ts, failed = parse_timestamp_or(first_non_empty(get("timestamp"), get("event_time")), as_of)
    norm = F.create_map(*[x for dst, c in mapped.items() for x in (F.lit(dst), c)]) if mapped else F.create_map().cast(STR_MAP)
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(
        F.sha2(raw, 256).alias("event_id"),
        F.coalesce(get("event_type"), F.lit("csv_import")).alias("event_type"),
        F.lit("crm").alias("source"),
        ts.alias("ts"),
        first_non_empty(get("student_id"), get("salesforce_id")).alias("student_id"),
        _identifiers(("email", get("email")), ("phone", get("phone")), ("salesforce_id", get("salesforce_id"))).alias("identifiers"),
        raw.alias("raw_data"),
        norm.alias("normalized_data"),
        failed.alias("ts_defaulted"),
        F.to_date(ts).alias("event_date"),
    )


def source_allow_list(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Only the 5 known sources pass; others are dead-lettered."""
    checked = with_errors(df, [(~F.col("source").isin(EVENT_SOURCES), "unknown source")])
    return split_valid(checked)


def dedup_events(df: DataFrame, key: str = "event_id", order: str = "ts") -> DataFrame:
    """One row per ``event_id``, the earliest by ``ts`` (ties: the least hash of the row).

    An aggregate (``min_by`` over a struct of the row) rather than a window: the
    partial aggregation runs map-side, so even an id repeated millions of times
    reaches the shuffle as one row per map task.  The tie-break is a number, not a
    rendering of the row.
    """
    others = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in others])
    flat = [F.map_entries(c) if kind.startswith("map<") else F.col(c) for c, kind in df.dtypes if c != key]
    tie = F.struct(F.col(order), F.xxhash64(*flat))
    return df.groupBy(key).agg(F.min_by(row, tie).alias("_r")).select(key, "_r.*")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by name into the canonical event table; missing columns are null."""
    out = None
    for f in frames:
        f = f.select(*[c for c in f.columns if c in CANONICAL_COLUMNS])
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
