"""Registered queries: sources, parsing, normalisation, dead letters, dedup
(S1-S6, P1-P12, F1-F5, F8, K3, W6, U6, M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import normalize as N
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources import payloads as PL
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events
from tessera.sources.tables import read_table

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _ts(c):
    return F.date_format(c, TS)


S1_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_id % 2 = 0 THEN 'page_view' ELSE 'unknown' END AS event_type,
       {O.ts_str("date_trunc('second', ts)")} AS ts,
       CAST(user_id AS VARCHAR) AS student_id,
       's_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 5 AS VARCHAR) AS session_id,
       'https://example.com/p/' || CAST(event_id % 50 AS VARCHAR) || '?utm_source=src' || CAST(user_id % 3 AS VARCHAR) AS page_url,
       'src' || CAST(user_id % 3 AS VARCHAR) AS utm_source,
       false AS ts_defaulted
FROM events WHERE event_type = 'view' AND event_id % 53 <> 0
"""


@register("s1_clickstream_normalize", S1_SQL, "S1 P1 P4 P12 F1 F2 F3 F18: clickstream JSON -> canonical events")
def s1_clickstream_normalize(spark, sf_dir):
    ev, _ = N.parse_clickstream(PL.clickstream_json(spark, sf_dir), AS_OF_EVENTS)
    nd = F.col("normalized_data")
    return ev.select(
        "event_id",
        "event_type",
        _ts(F.col("ts")).alias("ts"),
        "student_id",
        nd["session_id"].alias("session_id"),
        nd["page_url"].alias("page_url"),
        F.parse_url(nd["page_url"], F.lit("QUERY"), F.lit("utm_source")).alias("utm_source"),
        "ts_defaulted",
    )


S2_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       'mobile.' || ['app_opened','lesson_completed','quiz_taken','push_clicked','course_downloaded',
                     'study_session_started','study_session_ended','notification_received'][event_id % 9 + 1] AS event_type,
       {O.ts_str("date_trunc('second', ts)")} AS ts,
       CAST(user_id AS VARCHAR) AS student_id,
       'd_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 2 AS VARCHAR) AS device_id,
       CASE WHEN event_id % 4 = 0 THEN 'ad_' || CAST(user_id AS VARCHAR) END AS advertising_id,
       CASE WHEN user_id % 2 = 0 THEN 'iOS' ELSE 'Android' END || CASE WHEN user_id % 5 = 0 THEN '' ELSE ' 17' END AS os,
       'p' || CAST(event_id % 3 AS VARCHAR) AS plan,
       CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS n_identifiers
FROM events WHERE event_type = 'click' AND event_id % 9 <> 8
"""


@register("s2_mobile_normalize", S2_SQL, "S2 P5 P6 P7 P12 F1: mobile JSON -> canonical events (allow-list)")
def s2_mobile_normalize(spark, sf_dir):
    ev, _ = N.parse_mobile(PL.mobile_json(spark, sf_dir), AS_OF_EVENTS)
    nd = F.col("normalized_data")
    return ev.select(
        "event_id",
        "event_type",
        _ts(F.col("ts")).alias("ts"),
        "student_id",
        nd["device_id"].alias("device_id"),
        nd["advertising_id"].alias("advertising_id"),
        nd["os"].alias("os"),
        nd["plan"].alias("plan"),
        F.size("identifiers").alias("n_identifiers"),
    )


S5_SQL = f"""
WITH e AS (
  SELECT event_id, ts, user_id,
         ['email_opened','email_clicked','email_bounced','email_unsubscribed','email_spam'][event_id % 5 + 1] AS etype,
         CASE WHEN event_id % 3 = 0 THEN 'Mail/3.0 CFNetwork/1' ELSE 'Mozilla/5.0' END AS ua
  FROM events WHERE event_type = 'signup')
SELECT etype AS event_type, {O.email()} AS recipient_email, 'c' || CAST(event_id % 4 AS VARCHAR) AS campaign_id,
       CASE WHEN etype = 'email_clicked' THEN 'https://example.com/mba' END AS link_url,
       ua AS user_agent, '10.0.0.1' AS ip_address,
       (etype = 'email_opened' AND (lower(ua) LIKE '%apple%' OR lower(ua) LIKE '%cfnetwork%')) AS is_machine_open,
       {O.ts_str('ts')} AS ts
FROM e WHERE etype <> 'email_spam'
"""


@register("s5_email_webhook", S5_SQL, "S5 P9 P10: e-mail webhook payloads -> e-mail events")
def s5_email_webhook(spark, sf_dir):
    ev, _ = N.parse_email(PL.email_json(spark, sf_dir))
    return ev.select(
        "event_type", "recipient_email", "campaign_id", "link_url", "user_agent", "ip_address", "is_machine_open", _ts(F.col("timestamp")).alias("ts")
    )


S6_SQL = f"""
SELECT 'whatsapp:' || {O.phone()} AS from_number,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'when does the course start? ref ' || CAST(event_id AS VARCHAR) END AS body,
       CAST(event_id % 3 AS INTEGER) AS num_media,
       CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://media.example.com/0'
            ELSE CASE WHEN event_id % 5 <> 0 THEN 'https://media.example.com/0,https://media.example.com/1' ELSE 'https://media.example.com/0' END
       END AS media_urls,
       'SM' || CAST(event_id AS VARCHAR) AS message_sid,
       CASE WHEN event_id % 4 = 0 THEN 'delivered' ELSE '' END AS message_status,
       CASE WHEN event_id % 4 = 0 THEN 'status' ELSE 'message' END AS event_kind,
       {O.ts_str('ts')} AS ts
FROM events WHERE event_type = 'error'
"""


@register("s6_whatsapp_webhook", S6_SQL, "S6: chat webhook form fields -> chat events")
def s6_whatsapp_webhook(spark, sf_dir):
    ev = N.parse_whatsapp(PL.whatsapp_forms(spark, sf_dir))
    return ev.select(
        "from_number",
        "body",
        "num_media",
        F.array_join("media_urls", ",").alias("media_urls"),
        "message_sid",
        "message_status",
        "event_kind",
        _ts(F.col("timestamp")).alias("ts"),
    )


INTENT_CASE = """CASE
  WHEN regexp_matches(text, '(?i)\\b(enroll|admission|apply|register)\\b') THEN 'enrollment_inquiry'
  WHEN regexp_matches(text, '(?i)\\b(program|course|degree|master|bachelor)\\b') THEN 'program_inquiry'
  WHEN regexp_matches(text, '(?i)\\b(fee|cost|price|tuition|payment)\\b') THEN 'fee_inquiry'
  WHEN regexp_matches(text, '(?i)\\b(help|support|problem|issue|error)\\b') THEN 'support_request'
  WHEN regexp_matches(text, '(?i)\\b(schedule|deadline|start date|when)\\b') THEN 'schedule_inquiry'
  ELSE 'general_message' END"""

P3_SQL = f"""
SELECT conv_id, turn, 'whatsapp.' || {INTENT_CASE} AS event_type, length(text) AS body_length,
       len(regexp_extract_all(text, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+')) AS n_emails
FROM conversations WHERE role = 'user'
"""


@register("p3_chat_intent", P3_SQL, "P3 F4 F5: intent, e-mail entities and length of user chat turns")
def p3_chat_intent(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    out = N.normalize_whatsapp_text(conv, body="text")
    return out.select(
        "conv_id",
        "turn",
        "event_type",
        F.col("body_length").cast("bigint").alias("body_length"),
        F.coalesce(F.size(F.col("entities")["email"]), F.lit(0)).cast("bigint").alias("n_emails"),
    )


P3D_SQL = f"""
SELECT doc_id, {INTENT_CASE} AS intent,
       len(regexp_extract_all(text, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+')) AS n_emails,
       len(regexp_extract_all(text, '\\+?\\d[\\d\\s\\-()]{{7,15}}')) AS n_phones,
       len(regexp_extract_all(text, '(?i)\\b(?:B\\.?Sc|M\\.?Sc|MBA|B\\.?A|M\\.?A)\\b\\.?\\s*\\w*')) AS n_programs
FROM documents
"""


@register("f4_document_intent", P3D_SQL, "F4 F5: intent and e-mail entities over whole documents")
def f4_document_intent(spark, sf_dir):
    from tessera.functions.text import detect_intent, extract_entities

    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ents = extract_entities(F.col("text"))
    return d.select("doc_id", detect_intent(F.col("text")).alias("intent"), *[F.coalesce(F.size(ents[k]), F.lit(0)).cast("bigint").alias(n) for k, n in (("email", "n_emails"), ("phone", "n_phones"), ("program_name", "n_programs"))])


F8_SQL = """
SELECT doc_id,
       md5(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[REDACTED]', 'g'),
                          '\\+?\\d[\\d\\-\\s()]{7,}\\d', '[REDACTED]', 'g')) AS redacted_md5
FROM documents
"""


@register("f8_redact_documents", F8_SQL, "F8: e-mail and phone redaction over whole document texts")
def f8_redact_documents(spark, sf_dir):
    from tessera.functions.text import redact_text

    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", F.md5(redact_text(F.col("text"))).alias("redacted_md5"))


F8K_SQL = "SELECT event_id, '[REDACTED]' AS email, '[REDACTED]' AS guardian_name, CASE WHEN event_id % 2 = 0 THEN 'mail [REDACTED] now' ELSE 'order ' || CAST(event_id AS VARCHAR) END AS note, CASE WHEN event_id % 3 <> 0 THEN '[REDACTED]' END AS mobile FROM events"


@register("f8_redact_fields", F8K_SQL, "F8: log fields - PII key names replaced outright, other text by pattern, null kept")
def f8_redact_fields(spark, sf_dir):
    from tessera.functions.text import redact_field

    e = read_table(spark, sf_dir, "events").select("event_id")
    n = F.col("event_id").cast("string")
    fields = {
        "email": n,
        "guardian_name": F.concat(F.lit("G"), n),
        "note": F.when(F.col("event_id") % 2 == 0, F.lit("mail a.b@c.example now")).otherwise(F.concat(F.lit("order "), n)),
        "mobile": F.when(F.col("event_id") % 3 != 0, n),
    }
    return e.select("event_id", *[redact_field(k, v).alias(k) for k, v in fields.items()])


P8_SQL = f"""
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS salesforce_id, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name, {O.email('c_custkey')} AS email, {O.phone('c_custkey')} AS phone,
       c_mktsegment AS enrollment_status, 'prog_' || CAST(c_custkey % 4 AS VARCHAR) AS program_interest,
       '2024-01-01T00:00:00' AS sf_created_at,
       strftime(TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS sf_modified_at,
       CAST(c_acctbal AS VARCHAR) AS sf_AccountBalance
FROM customer
"""


@register("p8_crm_map_fields", P8_SQL, "S3 P8 U5: CRM rows -> mapped fields, sf_ prefix, attributes dropped")
def p8_crm_map_fields(spark, sf_dir):
    rows = PL.crm_rows(spark, sf_dir)
    N.check_crm_columns(rows)
    return N.map_crm_fields(rows)


S4_SQL = """
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS salesforce_id,
       strftime(TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS sf_modified_at
FROM customer
ORDER BY sf_modified_at DESC, salesforce_id ASC
LIMIT 200
"""


@register("s4_crm_changes", S4_SQL, "S4 T2: CRM rows modified on the as-of day, newest 200")
def s4_crm_changes(spark, sf_dir):
    from tessera.sources.crm import crm_changes

    m = N.map_crm_fields(PL.crm_rows(spark, sf_dir))
    return crm_changes(m, "2024-01-30").select("salesforce_id", "sf_modified_at")


P2_SQL = f"""
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS student_id, c_mktsegment AS event_type,
       {O.ts_str("TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT))")} AS ts, false AS ts_defaulted
FROM customer
"""


@register("p2_csv_rows", P2_SQL, "P2 F3: CSV rows through a caller schema map -> canonical events")
def p2_csv_rows(spark, sf_dir):
    rows = PL.crm_rows(spark, sf_dir)
    ev = N.normalize_csv_rows(
        rows, {"Id": "salesforce_id", "Email": "email", "LeadStatus": "event_type", "LastModifiedDate": "timestamp"}, AS_OF_EVENTS
    )
    return ev.select("student_id", "event_type", _ts(F.col("ts")).alias("ts"), "ts_defaulted")


M1_SQL = f"""
WITH {O.BRONZE},
valid AS (SELECT * FROM bronze WHERE source IN ('website','app','crm','email','whatsapp'))
SELECT event_id, arg_min(source, ts) AS source, {O.ts_str('min(ts)')} AS ts, arg_min(student_id, ts) AS student_id
FROM valid GROUP BY event_id
"""


@register("m1_bronze_to_silver", M1_SQL, "M1 P11 W6: bronze -> silver (allow-list, dedup on event_id)")
def m1_bronze_to_silver(spark, sf_dir):
    from tessera.plans.medallion import bronze_to_silver

    bronze = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True)
    silver, _ = bronze_to_silver(bronze)
    return silver.select("event_id", "source", _ts(F.col("ts")).alias("ts"), "student_id")


K3_SQL = f"""
WITH {O.BRONZE}
SELECT 'unknown source' AS error, 'unknown source' AS error_type, count(*) AS n
FROM bronze WHERE source NOT IN ('website','app','crm','email','whatsapp')
"""


@register("k3_dead_letters", K3_SQL, "K3 D9 P11: dead-letter rows by error")
def k3_dead_letters(spark, sf_dir):
    from tessera.plans.medallion import bronze_to_silver

    bronze = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True)
    _, dlq = bronze_to_silver(bronze)
    return dlq.groupBy("error", "error_type").agg(F.count(F.lit(1)).alias("n"))


def _five_sources(spark, sf_dir):
    """All five sources parsed from raw payloads to canonical events, and their rejects."""
    web, r1 = N.parse_clickstream(PL.clickstream_json(spark, sf_dir), AS_OF_EVENTS)
    app, r2 = N.parse_mobile(PL.mobile_json(spark, sf_dir), AS_OF_EVENTS)
    mail, r3 = N.parse_email(PL.email_json(spark, sf_dir))
    fields = {"Id": "salesforce_id", "Email": "email", "Phone": "phone", "LastModifiedDate": "timestamp"}
    crm = N.normalize_csv_rows(PL.crm_rows(spark, sf_dir), fields, AS_OF_EVENTS)
    chat = N.chat_events(N.parse_whatsapp(PL.whatsapp_forms(spark, sf_dir).unionByName(PL.whatsapp_status_forms(spark, sf_dir))))
    return N.union_sources(web, app, crm, N.email_events(mail), chat), (r1, r2, r3)


FIVE_SQL = f"""five AS (
  SELECT 'website' AS source, CASE WHEN event_id % 2 = 0 THEN 'page_view' ELSE 'unknown' END AS event_type, date_trunc('second', ts) AS ts,
         ['session_id:s_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 5 AS VARCHAR)] AS ids FROM events WHERE event_type = 'view' AND event_id % 53 <> 0
  UNION ALL
  SELECT 'app', 'mobile.' || ['app_opened','lesson_completed','quiz_taken','push_clicked','course_downloaded',
                     'study_session_started','study_session_ended','notification_received'][event_id % 9 + 1], date_trunc('second', ts),
         list_concat(['device_id:d_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 2 AS VARCHAR)],
                     CASE WHEN event_id % 4 = 0 THEN ['device_id:ad_' || CAST(user_id AS VARCHAR)] ELSE [] END)
  FROM events WHERE event_type = 'click' AND event_id % 9 <> 8
  UNION ALL
  SELECT 'crm', 'csv_import', TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)),
         ['email:' || {O.email('c_custkey')}, 'phone:' || {O.phone('c_custkey')}, 'salesforce_id:sf_' || CAST(c_custkey AS VARCHAR)] FROM customer
  UNION ALL
  SELECT 'email', ['email_opened','email_clicked','email_bounced','email_unsubscribed','email_spam'][event_id % 5 + 1], ts, ['email:' || {O.email()}]
  FROM events WHERE event_type = 'signup' AND event_id % 5 <> 4
  UNION ALL
  SELECT 'whatsapp', CASE WHEN event_id % 4 = 0 THEN 'whatsapp.status.delivered' WHEN event_id % 7 = 0 THEN 'whatsapp.general_message' ELSE 'whatsapp.program_inquiry' END,
         ts, ['phone:' || {O.phone()}]
  FROM events WHERE event_type = 'error'
  UNION ALL
  SELECT 'whatsapp', 'whatsapp.status.' || st, ts + to_seconds(secs), ['phone:' || {O.phone()}]
  FROM events, (VALUES ('sent', 1, 1), ('read', 5, 3)) AS k(st, secs, every) WHERE event_type = 'error' AND event_id % 4 <> 0 AND event_id % every = 0)"""

U6_SQL = f"""
WITH {FIVE_SQL}
SELECT source, event_type, count(*) AS n_events, CAST(sum(len(ids)) AS BIGINT) AS n_identifiers, min(ids[1]) AS first_identifier, {O.ts_str('max(ts)')} AS last_ts
FROM five GROUP BY 1, 2
"""


@register("u6_union_sources", U6_SQL, "U6 S5 S6 P2 P3: five sources parsed from payloads into one event table with identifiers")
def u6_union_sources(spark, sf_dir):
    return _source_totals(_five_sources(spark, sf_dir)[0])


def _source_totals(events):
    keys = F.transform("identifiers", lambda x: F.concat(x["type"], F.lit(":"), x["value"]))
    return events.groupBy("source", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.size("identifiers")).cast("bigint").alias("n_identifiers"),
        F.min(keys[0]).alias("first_identifier"),
        _ts(F.max("ts")).alias("last_ts"),
    )


@register("m1_payloads_to_silver", U6_SQL, "M1 U6 P11 W6: raw payloads of five sources, every event delivered twice, to silver")
def m1_payloads_to_silver(spark, sf_dir):
    from tessera.plans.medallion import bronze_to_silver

    bronze = _five_sources(spark, sf_dir)[0]
    again = bronze.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    silver, _ = bronze_to_silver(bronze.unionByName(again))
    return _source_totals(silver)


M2P_SQL = f"""
WITH RECURSIVE {FIVE_SQL},
n AS (SELECT row_number() OVER () AS eid, * FROM five),
own AS (SELECT DISTINCT ids[1] AS hub, unnest(ids) AS node FROM n),
edges AS (SELECT hub AS a, node AS b FROM own UNION SELECT node, hub FROM own),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY 1),
g AS (SELECT comp.component, count(*) AS total_events, count(DISTINCT n.source) AS sources, max(n.ts) AS last_ts FROM n JOIN comp ON comp.node = n.ids[1] GROUP BY 1)
SELECT sha256(component) AS profile_id, total_events, sources, {O.score('last_ts', 'total_events')} AS engagement_score FROM g
"""


@register("m2_payloads_to_gold", M2P_SQL, "M2 J4 A5: raw payloads of five sources to gold profiles, joined by the identity graph")
def m2_payloads_to_gold(spark, sf_dir):
    from tessera.operators import identity as I
    from tessera.operators.profile import build_profiles
    from tessera.session import cut_lineage

    silver = cut_lineage(_five_sources(spark, sf_dir)[0])
    nodes, edges = I.graph_edges(silver)
    comp = I.connected_components(nodes, edges)
    ev = I.smallest_identifier(silver).join(comp, F.col("_min_id") == F.col("node")).withColumn("profile_id", I.new_profile_id(F.col("component")))
    gold = build_profiles(ev.drop("student_id"), AS_OF_EVENTS)
    return gold.select("profile_id", "total_events", F.size("per_source_count").cast("bigint").alias("sources"), "engagement_score")


D9P_SQL = """
WITH w AS (SELECT event_id, event_type FROM events),
r AS (
  SELECT 'website' AS source, CASE WHEN event_id % 59 = 0 THEN 'malformed json' ELSE 'session_id: field required' END AS error
  FROM w WHERE event_type = 'view' AND (event_id % 59 = 0 OR event_id % 53 = 0)
  UNION ALL SELECT 'app', 'malformed json' FROM w WHERE event_type = 'click' AND event_id % 59 = 0
  UNION ALL SELECT 'app', 'device_id: field required' FROM w WHERE event_type = 'click' AND event_id % 59 <> 0 AND event_id % 61 = 0
  UNION ALL SELECT 'email', 'unsupported event_type' FROM w WHERE event_type = 'signup' AND event_id % 5 = 4)
SELECT source, error, count(*) AS n FROM r GROUP BY 1, 2
"""


@register("d9_parser_rejects", D9P_SQL, "D9 K3 P12 S1 S2 S5: dead letters of the parsers - malformed text, missing fields, unsupported types")
def d9_parser_rejects(spark, sf_dir):
    broken = F.when(F.col("offset") % 59 == 0, F.concat(F.lit("{not json "), F.col("offset").cast("string")))
    web = PL.clickstream_json(spark, sf_dir).withColumn("value", F.coalesce(broken, "value"))
    gone = F.when(F.col("offset") % 61 == 0, F.regexp_replace("value", '"device_id":"[^"]*",', "")).otherwise(F.col("value"))
    app = PL.mobile_json(spark, sf_dir).withColumn("value", F.coalesce(broken, gone))
    _, r1 = N.parse_clickstream(web, AS_OF_EVENTS)
    _, r2 = N.parse_mobile(app, AS_OF_EVENTS)
    _, r3 = N.parse_email(PL.email_json(spark, sf_dir))
    return r1.unionByName(r2).unionByName(r3).groupBy("source", "error").agg(F.count(F.lit(1)).alias("n"))


P12_SQL = """
WITH c AS (SELECT c_custkey AS k FROM customer),
e AS (
  SELECT k, 'identifiers.type: not a valid enumeration member' AS error, 1 AS o FROM c WHERE k % 5 = 0
  UNION ALL SELECT k, 'identifiers.value: at least 1 character', 2 FROM c WHERE k % 7 = 0
  UNION ALL SELECT k, 'identifiers.value: at most 512 characters', 3 FROM c WHERE k % 11 = 0
  UNION ALL SELECT k, 'enrollment_status: not a valid enumeration member', 4 FROM c WHERE k % 13 = 0
  UNION ALL SELECT k, 'engagement: between 0 and 1', 5 FROM c WHERE k % 17 = 0
  UNION ALL SELECT k, 'churn_risk: between 0 and 1', 6 FROM c WHERE k % 19 = 0)
SELECT string_agg(error, '; ' ORDER BY o) AS error, k AS profile_id FROM e GROUP BY k
"""


@register("p12_profile_model", P12_SQL, "P12: identifier type and length, enrollment state, score ranges; every failed check named")
def p12_profile_model(spark, sf_dir):
    k = F.col("c_custkey")
    bad = lambda n, wrong, right: F.when(k % n == 0, wrong).otherwise(right)
    ident = lambda t, v: F.struct(t.alias("type"), v.alias("value"))
    prof = read_table(spark, sf_dir, "customer").select(
        k.alias("profile_id"),
        F.array(
            ident(bad(5, F.lit("fax"), F.lit("email")), F.lit("x@y.z")),
            ident(F.lit("phone"), bad(7, F.lit(""), F.lit("+49"))),
            ident(F.lit("device_id"), bad(11, F.repeat(F.lit("d"), 513), F.repeat(F.lit("d"), 512))),
        ).alias("identifiers"),
        bad(13, F.lit("graduated"), F.lit("inquiry")).alias("enrollment_status"),
        bad(17, F.lit(1.01), F.lit(1.0)).alias("engagement"),
        bad(19, F.lit(-0.01), F.lit(0.0)).alias("churn_risk"),
    )
    _, dlq = N.validate_profiles(prof)
    return dlq.select("error", F.get_json_object("original", "$.profile_id").cast("bigint").alias("profile_id"))


F2_SQL = f"""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || '+00:00' AS updated_at, CAST(event_id AS VARCHAR) AS code, 'x0' || CAST(event_id AS VARCHAR) AS note
FROM events
"""


@register("f2_coerced_values", F2_SQL, "F2: payload values coerced - times to UTC text, digit strings without leading zeros, text kept")
def f2_coerced_values(spark, sf_dir):
    from tessera.functions.timestamps import coerce_types

    e = read_table(spark, sf_dir, "events")
    cet = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("CET"))
    n = F.col("event_id").cast("string")
    m = coerce_types(F.create_map(F.lit("updated_at"), cet, F.lit("code"), F.concat(F.lit("000"), n), F.lit("note"), F.concat(F.lit("x0"), n)))
    return e.select("event_id", m["updated_at"].alias("updated_at"), m["code"].alias("code"), m["note"].alias("note"))


@register("s3_crm_csv", P8_SQL, "S3 U5 P8: header CSV read in one pass, required columns checked, fields mapped")
def s3_crm_csv(spark, sf_dir):
    from tessera.sources.crm import read_crm_csv
    from tessera.streaming.pipeline import scratch_dir

    path = scratch_dir(spark, "crm_csv")
    PL.crm_rows(spark, sf_dir).write.option("header", True).csv(path)
    return N.map_crm_fields(read_crm_csv(spark, path))


S8_SQL = f"""
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS Id, {O.email('c_custkey')} AS Email, c_mktsegment AS LeadStatus FROM customer
"""


@register("s8_load_files", S8_SQL, "S8: CSV files loaded with an explicit schema, header row skipped")
def s8_load_files(spark, sf_dir):
    from tessera.sources.crm import load_files
    from tessera.streaming.pipeline import scratch_dir

    path = scratch_dir(spark, "crm_export")
    PL.crm_rows(spark, sf_dir).select("Id", "Email", "LeadStatus").write.option("header", True).csv(path)
    return load_files(spark, path, "Id string, Email string, LeadStatus string", "csv")


S9_SQL = "SELECT count(*) AS rows_loaded, 3 AS files FROM customer"


@register("s9_dated_export", S9_SQL, "S9 A18: dated CSV export read by glob, rows and files reported")
def s9_dated_export(spark, sf_dir):
    from tessera.sources.crm import load_report, read_dated_export
    from tessera.streaming.pipeline import scratch_dir

    root = scratch_dir(spark, "exports")
    PL.crm_rows(spark, sf_dir).repartition(3).write.option("header", True).csv(f"{root}/20240130")
    return load_report(read_dated_export(spark, root, "2024-01-30")).select("rows_loaded", F.col("files").cast("int").alias("files"))


K4_SQL = """
SELECT CASE WHEN ['email_opened','email_clicked','email_bounced','email_unsubscribed','email_spam'][event_id % 5 + 1] = 'email_clicked'
            THEN 'appended' ELSE 'rejected' END AS status, count(*) AS n
FROM events WHERE event_type = 'signup' AND event_id % 5 <> 4 GROUP BY 1
"""


@register("k4_append_rows", K4_SQL, "K4: append with required fields, rejected rows reported")
def k4_append_rows(spark, sf_dir):
    from tessera.sinks.writers import append_rows

    ev, _ = N.parse_email(PL.email_json(spark, sf_dir))
    ok, bad = append_rows(ev, ["recipient_email", "link_url"])
    return ok.select(F.lit("appended").alias("status")).unionByName(bad.select(F.lit("rejected").alias("status"))).groupBy("status").agg(
        F.count(F.lit(1)).alias("n")
    )


S4I_SQL = """
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS salesforce_id,
       strftime(TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS sf_modified_at
FROM customer
WHERE TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)) >= TIMESTAMP '2024-01-30 00:50:00'
"""


@register("s4_crm_changes_incremental", S4I_SQL, "S4: CRM changes after the last high-water mark, once per (id, modified)")
def s4_crm_changes_incremental(spark, sf_dir):
    from tessera.sources.crm import crm_changes_since

    m = N.map_crm_fields(PL.crm_rows(spark, sf_dir))
    return crm_changes_since(m, "2024-01-30 00:50:00").select("salesforce_id", "sf_modified_at")


S4S_SQL = """
SELECT 'sf_' || CAST(c_custkey AS VARCHAR) AS salesforce_id,
       strftime(TIMESTAMP '2024-01-30 00:00:00' + to_minutes(CAST(c_custkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS sf_modified_at,
       c_mktsegment AS segment, CAST(1 AS BIGINT) AS deliveries
FROM customer
"""


@register("s4_stream_changes", S4S_SQL, "S4: polled change feed as a stream source, late rows and repeats across restarts, each (id, modified) once")
def s4_stream_changes(spark, sf_dir):
    from tessera.sources.changes import changes_stream, deliver_changes
    from tessera.streaming.pipeline import scratch_dir

    m = N.map_crm_fields(PL.crm_rows(spark, sf_dir))
    key = F.substring("salesforce_id", 4, 18).cast("long")
    page = m.select(F.col("salesforce_id").alias("id"), F.col("sf_modified_at").alias("modified"), F.to_json(F.struct(*m.columns)).alias("payload"), key.alias("k"))
    # Three pages of eight hours; one row in eleven comes a poll late, one in seven is sent again by the next poll.
    hours = F.hour(F.to_timestamp("modified"))
    due = F.least(F.lit(2), F.floor(hours / 8).cast("int") + F.when(F.col("k") % 11 == 0, 1).otherwise(0))
    feed, out, checkpoint = (scratch_dir(spark, n) for n in ("feed", "changes", "changes_ckpt"))
    for poll in range(3):
        again = (due == poll - 1) & (F.col("k") % 7 == 0)
        page.where((due == poll) | again).drop("k").write.mode("append").parquet(feed)
        deliver_changes(changes_stream(spark, feed, 20 * 3600), out, checkpoint)  # each poll a query of its own, as after a restart
    got = spark.read.parquet(out).select("id", "modified", F.get_json_object("payload", "$.enrollment_status").alias("segment"))
    return got.groupBy(F.col("id").alias("salesforce_id"), F.col("modified").alias("sf_modified_at"), "segment").agg(F.count(F.lit(1)).alias("deliveries"))


P1_SQL = f"""
WITH e AS (SELECT event_id, user_id, ts, event_id % 8 AS k FROM events)
SELECT CASE WHEN k = 7 THEN sha256('["' || event_id || '"]') ELSE CAST(event_id AS VARCHAR) END AS event_id,
       ['a', 'b', 'unknown', 'unknown', 'c', 'd', 'e', 'unknown'][k + 1] AS event_type,
       CASE k WHEN 0 THEN {O.ts_str("date_trunc('second', ts) + INTERVAL 123457 MICROSECONDS")} WHEN 1 THEN '2023-11-14 22:13:20.000000'
              WHEN 2 THEN {O.ts_str("date_trunc('second', ts)")} WHEN 4 THEN '1969-12-31 23:59:58.500000' ELSE {O.ts_str(O.AS_OF)} END AS ts,
       CASE WHEN k IN (0, 1, 2, 5) OR (k = 3 AND user_id <> 0) THEN CAST(user_id AS VARCHAR) END AS student_id,
       k IN (3, 5, 6, 7) AS ts_defaulted,
       CASE WHEN k = 4 THEN '2024-01-05 10:00:00+00:00' END AS opened_at, CASE WHEN k = 4 THEN '7' END AS code,
       CASE WHEN k = 5 THEN '{{"a":[1,2]}}' END AS nested
FROM e
"""


@register("p1_normalize_json", P1_SQL, "P1 P4 F1 F2: any JSON payload to canonical events, parsed once, with the fallback chains of time, type and student")
def p1_normalize_json(spark, sf_dir):
    ev = N.normalize_json(PL.odd_json(spark, sf_dir), "website", AS_OF_EVENTS)
    nd = F.col("normalized_data")
    return ev.select("event_id", "event_type", _ts(F.col("ts")).alias("ts"), "student_id", "ts_defaulted", *[nd[c].alias(c) for c in ("opened_at", "code", "nested")])


F1_TEXTS = [
    ("1700000000", 1_700_000_000_000_000), ("1700000000.1", 1_700_000_000_100_000), ("1700000000.123456", 1_700_000_000_123_456),
    ("1700000000.1234567", 1_700_000_000_123_457), ("1700000000.123456789", 1_700_000_000_123_457), ("1.7e9", 1_700_000_000_000_000),
    ("17E8", 1_700_000_000_000_000), ("-1.5", -1_500_000), (" 42 ", 42_000_000), (".5", 500_000), ("1e30", None), ("1.2.3", None), ("e9", None),
]
F1_SQL = (
    "WITH t(i, raw, us) AS (VALUES " + ", ".join(f"({i}, '{raw}', {'NULL' if us is None else us})" for i, (raw, us) in enumerate(F1_TEXTS)) + f") SELECT e.event_id, t.raw, "
    f"CASE WHEN t.raw = '1700000000' THEN epoch_us(date_trunc('second', e.ts)) ELSE t.us END AS micros FROM events e JOIN t ON t.i = e.event_id % {len(F1_TEXTS)}"
)


@register("f1_epoch_texts", F1_SQL, "F1: epoch text with 0 to 9 decimals, exponents and signs; what is no number stays null")
def f1_epoch_texts(spark, sf_dir):
    from tessera.functions.timestamps import parse_timestamp

    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    raw = F.element_at(F.array(*[F.lit(x) for x, _ in F1_TEXTS]), (F.col("event_id") % len(F1_TEXTS) + 1).cast("int"))
    own = F.when(raw == F1_TEXTS[0][0], F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).otherwise(raw)
    return e.select("event_id", raw.alias("raw"), F.unix_micros(parse_timestamp(own)).alias("micros"))
