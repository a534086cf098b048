"""Registered queries: outbound activation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.constants import SF_DAILY_API_LIMIT
from tessera.operators import activation as A
from tessera.operators import consent as C
from tessera.operators import profile as P
from tessera.plans import oracle_fragments as O
from tessera.plans.q_privacy import CONSENT_START, CUR_SQL
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, consent_records, page_markers, phone_of
from tessera.session import cut_lineage
from tessera.sources.tables import read_table

QUOTA_LEFT = 20  # the day's quota is used up to 20 calls when this sync runs


def _sync_input(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    g = ev.groupBy("student_id").agg(
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("n"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_ts"),
        F.bool_or(F.col("source") == "crm").alias("is_crm"),
    )
    score = P.engagement_score(F.col("last_ts"), F.col("n"), AS_OF_EVENTS)
    return g.select(
        F.col("student_id").alias("profile_id"),
        F.when(F.col("is_crm"), F.concat(F.lit("sf_"), F.col("student_id"))).alias("salesforce_id"),
        score.alias("enrollment_score"),
        F.filter(F.array(P.score_segment(score)), lambda s: s.isNotNull()).alias("segments"),
        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_interaction"),
        F.when(F.col("student_id").cast("bigint") % 13 == 0, F.concat(F.lit("contact u"), F.col("student_id"), F.lit("@example.com"))).alias("notes"),
    )


def _sync(spark, sf_dir):
    prof = _sync_input(spark, sf_dir)
    cons = consent_records(spark, sf_dir, CONSENT_START)
    # Requests of three days; every seventh student's request comes twice in the run.
    req_ts = F.lit(AS_OF_EVENTS).cast("timestamp") - F.make_interval(days=(F.col("profile_id").cast("bigint") % 3).cast("int"))
    # Keys pushed by an earlier run: the same payload for every fifth student.
    sent = A.crm_payload(prof).filter(F.col("profile_id").cast("bigint") % 5 == 0).select("dedup_key")
    prof = prof.unionByName(prof.filter(F.col("profile_id").cast("bigint") % 7 == 0))
    return A.salesforce_sync(prof, sent, cons, req_ts, used_today=SF_DAILY_API_LIMIT - QUOTA_LEFT)


SYNC_SQL = f"""
WITH {O.EV}, {CUR_SQL},
g AS (SELECT student_id, count(*) FILTER (WHERE event_type = 'purchase') AS n, max(ts) FILTER (WHERE event_type = 'purchase') AS last_ts,
             bool_or(source = 'crm') AS is_crm FROM ev GROUP BY 1),
p AS (SELECT g.student_id AS profile_id, {O.score('last_ts', 'n')} AS score, copy.copy,
             CAST({O.AS_OF} AS DATE) - CAST(CAST(g.student_id AS BIGINT) % 3 AS INTEGER) AS day,
             CAST(g.student_id AS BIGINT) % 13 <> 0 AS valid,
             coalesce(c.consented, false) AS ok, CAST(g.student_id AS BIGINT) % 5 = 0 AS seen
      FROM g JOIN (VALUES (0), (1)) copy(copy) ON copy.copy = 0 OR CAST(g.student_id AS BIGINT) % 7 = 0
             LEFT JOIN cur c ON c.student_id = g.student_id AND c.channel = 'profiling'),
r AS (SELECT *, coalesce(sum(CASE WHEN valid AND ok AND NOT seen AND copy = 0 THEN 1 ELSE 0 END)
                          OVER (PARTITION BY day ORDER BY profile_id, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sends_before FROM p),
cut AS (SELECT day, min((profile_id, copy)) AS c FROM r WHERE valid AND ok AND sends_before >= {QUOTA_LEFT} GROUP BY 1),
s AS (SELECT profile_id, r.day, score,
             CASE WHEN (profile_id, copy) >= cut.c THEN 'quota_exceeded'
                  WHEN NOT valid THEN 'validation_failed' WHEN NOT ok THEN 'consent_denied' WHEN seen OR copy = 1 THEN 'deduplicated'
                  ELSE 'sent' END AS status
      FROM r LEFT JOIN cut ON cut.day = r.day)"""

R1_SQL = f"""
{SYNC_SQL}
SELECT profile_id, CAST(day AS VARCHAR) AS day, status, CAST(score AS VARCHAR) AS Enrollment_Score__c, coalesce({O.band('score')}, '') AS CDP_Segment__c FROM s
"""


@register("r1_salesforce_sync", R1_SQL, "R1 W5 F10 F11 P17 P18: CRM sync statuses (check, consent, dedup, daily quota)")
def r1_salesforce_sync(spark, sf_dir):
    return _sync(spark, sf_dir).select("profile_id", F.col("day").cast("string").alias("day"), "status", "Enrollment_Score__c", "CDP_Segment__c")


A16_SQL = f"""
{SYNC_SQL}
SELECT count(*) AS total, CAST(sum(CASE WHEN status IN ('sent', 'deduplicated') THEN 1 ELSE 0 END) AS BIGINT) AS succeeded,
       CAST(sum(CASE WHEN status NOT IN ('sent', 'deduplicated') THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(sum(CASE WHEN status IN ('validation_failed', 'consent_denied') THEN 1 ELSE 0 END) AS BIGINT) AS errors
FROM s
"""


@register("a16_sync_result", A16_SQL, "A16: sync result totals")
def a16_sync_result(spark, sf_dir):
    return A.sync_result(_sync(spark, sf_dir))


TEMPLATE = "Hi {name}, applications for {program} close soon"


def _gate(spark, sf_dir, channel):
    students = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("profile_id")).distinct()
    return students, C.consent_gate(students, students, consent_records(spark, sf_dir, CONSENT_START), channel)


def _wa(spark, sf_dir):
    students, gate = _gate(spark, sf_dir, "whatsapp")
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("profile_id"), "c_name")
    req = students.join(cust, "profile_id", "left")
    ev = canonical_events(spark, sf_dir)
    phones = ev.filter(F.col("source") == "crm").select(F.col("student_id").alias("profile_id"), phone_of(F.col("user_id")).alias("phone")).distinct()
    # Every eighth request is made twice; some names hold braces, which stay text.
    req = req.unionByName(req.filter(F.col("profile_id").cast("bigint") % 8 == 0))
    braces = F.when(F.col("profile_id").cast("bigint") % 3 == 0, F.concat(F.col("c_name"), F.lit(" {program}"))).otherwise(F.col("c_name"))
    params = {"name": braces, "program": F.lit("MBA")}
    first = A.whatsapp_outbox(req, phones, gate, spark.createDataFrame([], "dedup_key string"), TEMPLATE, params)
    sent = first.filter(F.col("profile_id").cast("bigint") % 6 == 0).select("dedup_key")
    return A.whatsapp_outbox(req, phones, gate, sent, TEMPLATE, params)


R2W_SQL = f"""
WITH {O.EV}, {CUR_SQL},
st AS (SELECT DISTINCT student_id AS profile_id FROM ev),
ph AS (SELECT DISTINCT student_id AS profile_id, {O.phone()} AS phone FROM ev WHERE source = 'crm'),
x AS (SELECT st.profile_id, coalesce(c.consented, false) AS allowed,
             CAST(st.profile_id AS BIGINT) % 6 = 0 AS seen, ph.phone, copy.copy,
             cu.c_name || CASE WHEN CAST(st.profile_id AS BIGINT) % 3 = 0 THEN ' {{program}}' ELSE '' END AS c_name
      FROM st JOIN (VALUES (0), (1)) copy(copy) ON copy.copy = 0 OR CAST(st.profile_id AS BIGINT) % 8 = 0
              LEFT JOIN cur c ON c.student_id = st.profile_id AND c.channel = 'whatsapp'
              LEFT JOIN ph USING (profile_id)
              LEFT JOIN customer cu ON CAST(cu.c_custkey AS VARCHAR) = st.profile_id)
SELECT profile_id,
       CASE WHEN NOT allowed THEN 'consent_denied' WHEN seen THEN 'deduplicated' WHEN phone IS NULL THEN 'no_phone' WHEN copy = 1 THEN 'deduplicated' ELSE 'queued' END AS status,
       CASE WHEN allowed AND NOT seen AND copy = 0 AND phone IS NOT NULL THEN 'whatsapp:' || phone END AS "to",
       CASE WHEN allowed AND NOT seen AND copy = 0 AND phone IS NOT NULL THEN 'Hi ' || coalesce(c_name, 'None') || ', applications for MBA close soon' END AS body
FROM x
"""


@register("r2_whatsapp_outbox", R2W_SQL, "R2 J8 P19 F10 F11: consent-gated, idempotent WhatsApp outbox")
def r2_whatsapp_outbox(spark, sf_dir):
    return _wa(spark, sf_dir).select("profile_id", "status", "to", "body")


R2E_SQL = f"""
WITH {CUR_SQL},
st AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS profile_id FROM events)
SELECT st.profile_id, 'spring_mba' AS campaign_id,
       CASE WHEN NOT coalesce(c.consented, false) THEN 'consent_denied' WHEN CAST(st.profile_id AS BIGINT) % 4 = 0 OR copy = 1 THEN 'deduplicated' ELSE 'queued' END AS status
FROM st JOIN (VALUES (0), (1)) copy(copy) ON copy = 0 OR CAST(st.profile_id AS BIGINT) % 5 = 0
     LEFT JOIN cur c ON c.student_id = st.profile_id AND c.channel = 'email'
"""


@register("r2_email_outbox", R2E_SQL, "R2 J8 P20 F11: consent-gated, idempotent e-mail outbox")
def r2_email_outbox(spark, sf_dir):
    students, gate = _gate(spark, sf_dir, "email")
    first = A.email_outbox(students, gate, spark.createDataFrame([], "dedup_key string"), "spring_mba")
    sent = first.filter(F.col("profile_id").cast("bigint") % 4 == 0).select("dedup_key")
    # Every fifth request is made twice in the run.
    students = students.unionByName(students.filter(F.col("profile_id").cast("bigint") % 5 == 0))
    return A.email_outbox(students, gate, sent, "spring_mba").select("profile_id", "campaign_id", "status")


R3_SQL = f"""
WITH {O.EV}, {CUR_SQL},
crm AS (SELECT c_custkey, {O.LEAD_CASE} AS lead_status FROM customer),
f AS (SELECT ev.student_id AS profile_id,
             count(*) FILTER (WHERE ev.source = 'website' AND CAST(json_extract_string(ev.props, '$.k') AS INTEGER) % 10 = 0) AS mba_page_count,
             coalesce(arg_max(c.lead_status, (ev.ts, ev.event_id)) FILTER (WHERE ev.source = 'crm' AND c.lead_status IS NOT NULL), 'anonymous') AS status
      FROM ev LEFT JOIN crm c ON ev.user_id = c.c_custkey GROUP BY 1)
SELECT f.profile_id FROM f JOIN cur c ON c.student_id = f.profile_id AND c.channel = 'email'
WHERE f.mba_page_count >= 3 AND f.status = 'inquiry' AND c.consented
"""


@register("r3_campaign_trigger", R3_SQL, "R3 P13 J8: MBA pages >= 3 and inquiry and e-mail consent")
def r3_campaign_trigger(spark, sf_dir):
    from tessera.operators.segments import compile_rule

    ev = page_markers(canonical_events(spark, sf_dir, with_contact=True))
    f = ev.groupBy(F.col("student_id").alias("profile_id")).agg(
        F.sum(F.col("viewed_mba_page").cast("int")).alias("mba_page_count"),
        F.max_by(F.col("lead_status"), F.when(F.col("lead_status").isNotNull(), F.struct("ts", "event_id"))).alias("_lead"),
    ).withColumn("enrollment_status", F.coalesce("_lead", F.lit("anonymous")))
    rule = {"field": "mba_page_count", "operator": ">=", "value": 3, "and": {"field": "enrollment_status", "operator": "==", "value": "inquiry"}}
    hits = f.filter(compile_rule(rule)).select("profile_id")
    gate = C.consent_gate(hits, hits, consent_records(spark, sf_dir, CONSENT_START), "email")
    return gate.filter("allowed").select("profile_id")


R4_SQL = f"""
WITH {O.EV},
f AS (SELECT student_id AS profile_id, max(user_id) AS u,
             sum(CASE WHEN source = 'app' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 THEN 1 ELSE 0 END) AS started,
             sum(CASE WHEN source = 'app' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0 THEN 1 ELSE 0 END) AS completed
      FROM ev GROUP BY 1),
g AS (SELECT profile_id, CASE WHEN started > 0 THEN completed / started END AS completion, CAST((u * 37) % 100 AS DOUBLE) / 100.0 AS churn_risk FROM f)
SELECT profile_id, concat_ws(',', CASE WHEN completion >= 0.8 THEN 'course_completion_nudge' END, CASE WHEN churn_risk > 0.75 THEN 'churn_save' END) AS triggers
FROM g WHERE completion >= 0.8 OR churn_risk > 0.75
"""


@register("r4_course_triggers", R4_SQL, "R4 P13: completion >= 80% and churn risk > 0.75 triggers")
def r4_course_triggers(spark, sf_dir):
    from tessera.operators.features import student_features
    from tessera.operators.segments import SegmentRules

    feats = student_features(page_markers(canonical_events(spark, sf_dir)), AS_OF_EVENTS)
    feats = feats.withColumn("churn_risk", (F.col("entity_id").cast("bigint") * 37 % 100).cast("double") / 100.0)
    rules = SegmentRules(builtins=False)
    rules.add_rule("course_completion_nudge", {"field": "course_completion_rate", "operator": ">=", "value": 0.8})
    rules.add_rule("churn_save", {"field": "churn_risk", "operator": ">", "value": 0.75})
    out = rules.evaluate(feats, "triggers").filter(F.size("triggers") > 0)
    return out.select(F.col("entity_id").alias("profile_id"), F.array_join("triggers", ",").alias("triggers"))


def _r5_sql():
    from tessera.plans.q_segments import K10_SQL

    body = K10_SQL.strip()
    head, tail = body.split("SELECT profile_id, segments_added, segments_removed", 1)
    return f"""
{head.rstrip()},
{CUR_SQL},
act AS (
  SELECT profile_id, unnest(string_split(segments_added, ',')) AS segment, 'add' AS action FROM d WHERE segments_added <> ''
  UNION ALL SELECT profile_id, unnest(string_split(segments_removed, ',')), 'remove' FROM d WHERE segments_removed <> '')
SELECT ch.channel, act.profile_id, act.segment, act.action,
       CASE WHEN NOT coalesce(c.consented, false) THEN 'consent_denied' WHEN CAST(act.profile_id AS BIGINT) % 4 = 0 OR copy = 1 THEN 'deduplicated' ELSE 'queued' END AS status,
       CASE WHEN c.consented IS NULL THEN 'no_record' WHEN NOT c.consented THEN 'revoked' END AS reason
FROM act JOIN (VALUES (0), (1)) k(copy) ON copy = 0 OR CAST(act.profile_id AS BIGINT) % 3 = 0
     CROSS JOIN (VALUES ('push'), ('email')) ch(channel) LEFT JOIN cur c ON c.student_id = act.profile_id AND c.channel = ch.channel
"""


@register("r5_push_audience_changes", _r5_sql(), "R5 K10 J8 F11: segment changes as push/e-mail audience add/remove rows")
def r5_push_audience_changes(spark, sf_dir):
    import datetime as dt

    from tessera.operators import segments as S
    from tessera.plans.q_segments import _profiles_with_segments

    now = _profiles_with_segments(spark, sf_dir, AS_OF_EVENTS)
    before = _profiles_with_segments(spark, sf_dir, AS_OF_EVENTS - dt.timedelta(days=7))
    actions = A.segment_change_actions(S.segment_changes(now, before, as_of=AS_OF_EVENTS))
    # Every third profile's changes come twice in the run; every fourth profile's went out before.
    actions = cut_lineage(actions.unionByName(actions.filter(F.col("profile_id").cast("bigint") % 3 == 0)))
    students = actions.select("profile_id").distinct()
    none = spark.createDataFrame([], "dedup_key string")
    out = []
    for channel in ("push", "email"):
        gate = C.consent_gate(students, students, consent_records(spark, sf_dir, CONSENT_START), channel)
        first = A.audience_outbox(actions, gate, none, channel)
        sent = first.filter(F.col("profile_id").cast("bigint") % 4 == 0).select("dedup_key")
        out.append(A.audience_outbox(actions, gate, sent, channel).drop("dedup_key"))
    return out[0].unionByName(out[1])
