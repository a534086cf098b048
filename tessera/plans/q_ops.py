"""Registered queries: metrics (A11-A14, A19), lookups (J5, J6, T1), sinks (K1,
K2, K5, K6, K8, K14), scalar functions (F9, F17, F18, P23), caller SQL (S10),
medallion (M2, M3, M4)."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import profile as P
from tessera.plans import oracle_fragments as O
from tessera.plans.q_identity import J3_SQL, crm_master, resolution_events, resolved_events
from tessera.plans.registry import register
from tessera.session import cut_lineage, ensure_checkpoint_dir
from tessera.sources.adapters import AS_OF_EVENTS, SOURCE_BY_EVENT_TYPE, _case, canonical_events
from tessera.sources.tables import read_table

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
PREV = dt.datetime(2024, 1, 24)
PREV_SQL = "TIMESTAMP '2024-01-24 00:00:00'"

A11_SQL = f"""
WITH {O.BRONZE}
SELECT source, event_type, count(*) AS n FROM bronze GROUP BY 1, 2
"""


@register("a11_ingested_counts", A11_SQL, "A11: events ingested by (source, type) incl. duplicates and invalid rows")
def a11_ingested_counts(spark, sf_dir):
    b = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True)
    return M.counts_by(b, "source", "event_type")


def _hist_sql() -> str:
    from tessera.constants import LATENCY_BUCKETS

    parts = [
        f"SELECT source, '{e}' AS le, CAST(sum(CASE WHEN value / 10.0 <= {e} THEN 1 ELSE 0 END) AS BIGINT) AS count FROM ev GROUP BY 1"
        for e in LATENCY_BUCKETS
    ]
    parts.append("SELECT source, '+Inf', CAST(count(*) AS BIGINT) FROM ev GROUP BY 1")
    return f"WITH {O.EV}\n" + "\nUNION ALL ".join(parts)


@register("a12_latency_histogram", _hist_sql(), "A12: cumulative latency histogram per source (10 edges + Inf)")
def a12_latency_histogram(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    return M.latency_histogram(ev, F.col("value") / 10.0, by="source")


ACTIVE_DAYS = 2  # the test events span 30 days: a window that cuts (the default is 90)
A13_SQL = f"""
WITH {O.EV}, g AS (SELECT student_id, max(ts) AS last_ts FROM ev GROUP BY 1)
SELECT CAST(sum(CASE WHEN last_ts > {O.AS_OF} - INTERVAL {ACTIVE_DAYS} DAYS AND last_ts <= {O.AS_OF} THEN 1 ELSE 0 END) AS BIGINT) AS active_profiles FROM g
"""


@register("a13_active_profiles", A13_SQL, "A13: profiles with an interaction in the last days")
def a13_active_profiles(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    prof = P.interaction_summary(ev, "student_id")
    return M.active_profiles(prof, AS_OF_EVENTS, ACTIVE_DAYS)


A11C_SQL = f"""
WITH j3 AS ({J3_SQL.strip()})
SELECT 'matches' AS counter, match_type AS label, count(*) AS n FROM j3 GROUP BY 2
UNION ALL SELECT 'dead_letters', 'website: session_id: field required', count(*) FROM events WHERE event_type = 'view' AND event_id % 53 = 0
UNION ALL SELECT 'dead_letters', 'email: unsupported event_type', count(*) FROM events WHERE event_type = 'signup' AND event_id % 5 = 4
UNION ALL SELECT 'processed', 'website', count(*) FROM events WHERE event_type = 'view' AND event_id % 53 <> 0
UNION ALL SELECT 'processed', 'app', count(*) FROM events WHERE event_type = 'click' AND event_id % 9 <> 8
UNION ALL SELECT 'processed', 'crm', count(*) FROM customer
UNION ALL SELECT 'processed', 'email', count(*) FROM events WHERE event_type = 'signup' AND event_id % 5 <> 4
UNION ALL SELECT 'processed', 'whatsapp', count(*) FROM events WHERE event_type = 'error'
"""


@register("a11_pipeline_counters", A11C_SQL, "A11: processed events by source, dead letters by source and error, matches by type")
def a11_pipeline_counters(spark, sf_dir):
    from tessera.plans.q_ingest import _five_sources

    events, rejects = _five_sources(spark, sf_dir)
    dead = reduce(lambda a, b: a.unionByName(b), rejects)
    counter = lambda df, name, label: M.counts_by(df.select(F.lit(name).alias("counter"), label.alias("label")), "counter", "label")
    return (
        counter(events, "processed", F.col("source"))
        .unionByName(counter(dead, "dead_letters", F.concat_ws(": ", "source", "error")))
        .unionByName(counter(resolved_events(spark, sf_dir), "matches", F.col("match_type")))
    )


A14_SQL = f"""
WITH j3 AS ({J3_SQL.strip()})
SELECT count(*) AS events, CAST(sum(CASE WHEN match_type = 'deterministic' THEN 1 ELSE 0 END) AS BIGINT) AS deterministic,
       CAST(sum(CASE WHEN match_type = 'probabilistic' THEN 1 ELSE 0 END) AS BIGINT) AS probabilistic,
       CAST(sum(CASE WHEN match_type = 'created' THEN 1 ELSE 0 END) AS BIGINT) AS created,
       avg(CASE WHEN match_type <> 'created' THEN 1.0 ELSE 0.0 END) AS match_rate
FROM j3
"""


@register("a14_match_rate", A14_SQL, "A14: identity match rate by match type")
def a14_match_rate(spark, sf_dir):
    return M.match_rate(resolved_events(spark, sf_dir))


A19_SQL = f"""
WITH b AS (SELECT event_id, ts, {O.SOURCE_CASE} AS source FROM events
           UNION ALL SELECT event_id, ts + INTERVAL 1 SECOND, {O.SOURCE_CASE} FROM events WHERE event_id % 20 = 0),
d AS (SELECT source, count(*) AS total, sum(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS dead FROM b GROUP BY 1),
f AS (SELECT source, (epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) AS age_seconds
      FROM events e JOIN (SELECT DISTINCT event_type, {O.SOURCE_CASE} AS source FROM events) m USING (event_type)
      WHERE e.event_id % 97 <> 0 GROUP BY 1)
SELECT 'dlq_share_high' AS alert, source, dead / total AS value FROM d WHERE dead / total > 0.01
UNION ALL SELECT 'data_stale', source, CAST(age_seconds AS DOUBLE) FROM f WHERE age_seconds > 3600
"""


@register("a19_alerts", A19_SQL, "A19: alert rows - DLQ share > 1 % and freshness > 1 h per source")
def a19_alerts(spark, sf_dir):
    from tessera.operators.quality import freshness

    b = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True).withColumn("true_source", _case(F.col("event_type"), SOURCE_BY_EVENT_TYPE))
    d = b.groupBy(F.col("true_source").alias("source")).agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.when(F.col("source") == "unknown", 1).otherwise(0)).alias("dead")
    )
    silver = canonical_events(spark, sf_dir, with_invalid=True).filter(F.col("source") != "unknown")
    f = freshness(silver, "ts", AS_OF_EVENTS, max_age_hours=1, by="source")
    return M.alerts(d, f)


def _profiles(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, with_contact=True).withColumnRenamed("student_id", "profile_id")
    return P.build_profiles(ev, AS_OF_EVENTS)


J5_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS request_id, {O.email('c_custkey')} AS id_value,
       CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type IN ('purchase', 'signup')
                               OR (event_type = 'view' AND event_id % 4 = 0) OR (event_type = 'click' AND event_id % 3 = 0))
            THEN CAST(c_custkey AS VARCHAR) END AS profile_id
FROM customer
"""


@register("j5_find_by_identifier", J5_SQL, "J5: profile lookup by (type, value) for a batch of requests")
def j5_find_by_identifier(spark, sf_dir):
    from tessera.operators.lookups import find_by_identifier
    from tessera.sources.adapters import email_of

    req = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("request_id"), F.lit("email").alias("id_type"), email_of(F.col("c_custkey")).alias("id_value")
    )
    return find_by_identifier(_profiles(spark, sf_dir), req).select("request_id", "id_value", "profile_id")


J6_SQL = f"""
WITH {O.EV}
SELECT student_id AS profile_id, count(*) AS total_events FROM ev
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY 1
"""


@register("j6_get_profiles", J6_SQL, "J6: many-id point lookup (semi join)")
def j6_get_profiles(spark, sf_dir):
    from tessera.operators.lookups import get_profiles

    ids = read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").cast("string").alias("profile_id"))
    return get_profiles(_profiles(spark, sf_dir), ids).select("profile_id", "total_events")


T1_SQL = """
SELECT student_id, event_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT CAST(user_id AS VARCHAR) AS student_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events)
WHERE rank <= 50
"""


@register("t1_history", T1_SQL, "T1: newest 50 events per profile")
def t1_history(spark, sf_dir):
    from tessera.operators.lookups import history

    return history(canonical_events(spark, sf_dir), "student_id", 50).select("student_id", "event_id", "rank")


def _k1_sql():
    from tessera.plans.q_segments import K10_SQL

    head = K10_SQL.strip().split("SELECT profile_id, segments_added, segments_removed", 1)[0]
    return f"""
{head.rstrip()}
SELECT 'cdp.segment.changes' AS topic, profile_id AS key,
       '{{"profile_id":"' || profile_id || '","segments_added":' ||
       CAST(to_json(CASE WHEN segments_added = '' THEN [] ELSE string_split(segments_added, ',') END) AS VARCHAR) ||
       ',"segments_removed":' || CAST(to_json(CASE WHEN segments_removed = '' THEN [] ELSE string_split(segments_removed, ',') END) AS VARCHAR) || '}}' AS value
FROM d WHERE segments_added <> '' OR segments_removed <> ''
"""


@register("k1_publish_segment_changes", _k1_sql(), "K1 F16 K10: segment changes as keyed JSON messages")
def k1_publish_segment_changes(spark, sf_dir):
    from tessera.operators.segments import segment_changes
    from tessera.plans.q_segments import AS_OF_PREV, _profiles_with_segments
    from tessera.sinks.writers import publish_frame

    ch = segment_changes(_profiles_with_segments(spark, sf_dir), _profiles_with_segments(spark, sf_dir, AS_OF_PREV), as_of=AS_OF_EVENTS)
    return publish_frame(ch, "cdp.segment.changes", key="profile_id", value_cols=["profile_id", "segments_added", "segments_removed"])


@register("k1_topic_delivery", _k1_sql(), "K1: messages delivered as JSON lines per topic, read back")
def k1_topic_delivery(spark, sf_dir):
    from tessera.sinks.writers import write_topic
    from tessera.streaming.pipeline import scratch_dir

    path = scratch_dir(spark, "topics")
    write_topic(k1_publish_segment_changes(spark, sf_dir), path)
    return spark.read.schema("topic string, key string, value string").json(path).select("topic", "key", "value")


K2_SQL = f"""
WITH {O.EV}
SELECT student_id AS profile_id, event_id, student_id IN (SELECT student_id FROM ev WHERE source = 'crm') AS has_snapshot FROM ev
"""


@register("k2_stage_for_warehouse", K2_SQL, "K2: {profile_id, event, profile_snapshot} staging rows")
def k2_stage_for_warehouse(spark, sf_dir):
    from tessera.sinks.writers import stage_for_warehouse

    ev = canonical_events(spark, sf_dir).withColumnRenamed("student_id", "profile_id").select("profile_id", "event_id", "source", "ts")
    prof = ev.filter(F.col("source") == "crm").groupBy("profile_id").agg(F.count(F.lit(1)).alias("crm_events"))
    st = stage_for_warehouse(ev, prof)
    return st.select("profile_id", F.col("event.event_id").alias("event_id"), F.col("profile_snapshot").isNotNull().alias("has_snapshot"))


K5_SQL = f"""
WITH {O.BRONZE},
valid AS (SELECT * FROM bronze WHERE source IN ('website','app','crm','email','whatsapp')),
silver AS (SELECT event_id, arg_min(source, ts) AS source, min(ts) AS ts FROM valid GROUP BY event_id)
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS event_date, source, count(*) AS n FROM silver
WHERE CAST(ts AS DATE) >= DATE '2024-01-25' GROUP BY 1, 2
"""


@register("k5_partitioned_load", K5_SQL, "K5 M1: silver written partitioned by event_date, read back with partition pruning")
def k5_partitioned_load(spark, sf_dir):
    from tessera.plans.medallion import bronze_to_silver
    from tessera.sinks.writers import load_partitioned

    silver, _ = bronze_to_silver(canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/silver_events_{uuid.uuid4().hex}"
    load_partitioned(silver.select("event_id", "source", "student_id", "ts", "event_date"), path)
    back = spark.read.parquet(path).filter(F.col("event_date") >= F.lit("2024-01-25").cast("date"))
    return back.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "source").agg(F.count(F.lit(1)).alias("n"))


def _score_at(spark, sf_dir, as_of):
    ev = canonical_events(spark, sf_dir).filter((F.col("event_type") == "purchase") & (F.col("ts") < F.lit(as_of)))
    g = ev.groupBy(F.col("student_id").alias("profile_id")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    return g.select("profile_id", P.engagement_score(F.col("last_ts"), F.col("n"), as_of).alias("score"))


def _k6_sql(mode: str) -> str:
    score_prev = O.score("last_ts", "n", PREV_SQL)
    score_now = O.score("last_ts", "n")
    if mode == "touch":
        val = "CASE WHEN t.profile_id IS NOT NULL THEN t.score ELSE s.score END"
    else:
        val = "CASE WHEN s.profile_id IS NOT NULL THEN s.score ELSE t.score END"
    return f"""
WITH {O.EV},
t AS (SELECT student_id AS profile_id, {score_prev} AS score FROM (
        SELECT student_id, count(*) AS n, max(ts) AS last_ts FROM ev WHERE event_type = 'purchase' AND ts < {PREV_SQL} GROUP BY 1)),
s AS (SELECT student_id AS profile_id, {score_now} AS score FROM (
        SELECT student_id, count(*) AS n, max(ts) AS last_ts FROM ev WHERE event_type = 'purchase' AND ts < {O.AS_OF} GROUP BY 1))
SELECT coalesce(t.profile_id, s.profile_id) AS profile_id, {val} AS score,
       CASE WHEN s.profile_id IS NOT NULL THEN {O.ts_str(O.AS_OF)} ELSE {O.ts_str(PREV_SQL)} END AS updated_at
FROM t FULL OUTER JOIN s ON t.profile_id = s.profile_id
"""


def _k6(spark, sf_dir, mode):
    from tessera.sinks.writers import merge_upsert

    t = _score_at(spark, sf_dir, PREV).withColumn("updated_at", F.lit(PREV).cast("timestamp"))
    s = _score_at(spark, sf_dir, AS_OF_EVENTS).withColumn("updated_at", F.lit(None).cast("timestamp"))
    m = merge_upsert(t, s, ["profile_id"], AS_OF_EVENTS, mode=mode)
    return m.select("profile_id", "score", F.date_format("updated_at", TS).alias("updated_at"))


@register("k6_merge_touch", _k6_sql("touch"), "K6: MERGE as coded - matched rows only get updated_at, new rows inserted")
def k6_merge_touch(spark, sf_dir):
    return _k6(spark, sf_dir, "touch")


@register("k6_merge_overwrite", _k6_sql("overwrite"), "K6: MERGE by intent - matched rows take staging values")
def k6_merge_overwrite(spark, sf_dir):
    return _k6(spark, sf_dir, "overwrite")


#: Buckets of the test tables; a production table takes its size divided by about 256 MB.
TEST_BUCKETS = 8


@register("k6_merge_bucketed", _k6_sql("overwrite"), "K6: MERGE into a bucketed target, whose rows are never shuffled")
def k6_merge_bucketed(spark, sf_dir):
    from tessera.sinks.bucketed import merge_bucketed, write_bucketed
    from tessera.streaming.pipeline import scratch_dir

    old, new = f"profiles_{uuid.uuid4().hex}", f"profiles_{uuid.uuid4().hex}"
    t = _score_at(spark, sf_dir, PREV).withColumn("updated_at", F.lit(PREV).cast("timestamp"))
    write_bucketed(t, old, ["profile_id"], TEST_BUCKETS, scratch_dir(spark, "bucketed"))
    s = _score_at(spark, sf_dir, AS_OF_EVENTS).withColumn("updated_at", F.lit(None).cast("timestamp"))
    merge_bucketed(spark, old, s, AS_OF_EVENTS, new, scratch_dir(spark, "bucketed"))
    return spark.table(new).select("profile_id", "score", F.date_format("updated_at", TS).alias("updated_at"))


K8_SQL = f"""
WITH {O.EV},
old AS (SELECT DISTINCT student_id FROM ev WHERE ts < {PREV_SQL}),
cur AS (SELECT student_id, count(*) AS total_events FROM ev GROUP BY 1)
SELECT cur.student_id AS profile_id, cur.total_events,
       CAST(CASE WHEN old.student_id IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS version,
       CASE WHEN old.student_id IS NOT NULL THEN {O.ts_str(PREV_SQL)} ELSE {O.ts_str(O.AS_OF)} END AS created_at,
       {O.ts_str(O.AS_OF)} AS updated_at
FROM cur LEFT JOIN old USING (student_id)
"""


@register("k8_upsert_profiles", K8_SQL, "K8: profile upsert - version + 1, created_at only on insert")
def k8_upsert_profiles(spark, sf_dir):
    from tessera.sinks.writers import upsert_profiles

    out = upsert_profiles(*_k8_inputs(spark, sf_dir), AS_OF_EVENTS)
    return _k8_rows(out)


@register("k8_upsert_bucketed", K8_SQL, "K8: profile upsert into a bucketed table, whose rows are never shuffled")
def k8_upsert_bucketed(spark, sf_dir):
    from tessera.sinks.bucketed import upserted_bucketed, write_bucketed
    from tessera.streaming.pipeline import scratch_dir

    stored, incoming = _k8_inputs(spark, sf_dir)
    name = f"profiles_{uuid.uuid4().hex}"
    write_bucketed(stored, name, ["profile_id"], TEST_BUCKETS, scratch_dir(spark, "bucketed"))
    return _k8_rows(upserted_bucketed(spark, name, incoming, AS_OF_EVENTS))


def _k8_rows(out):
    return out.select("profile_id", "total_events", "version", F.date_format("created_at", TS).alias("created_at"), F.date_format("updated_at", TS).alias("updated_at"))


def _k8_inputs(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    stored = (
        ev.filter(F.col("ts") < F.lit(PREV))
        .groupBy(F.col("student_id").alias("profile_id"))
        .agg(F.count(F.lit(1)).alias("total_events"))
        .withColumn("version", F.lit(1).cast("bigint"))
        .withColumn("created_at", F.lit(PREV).cast("timestamp"))
        .withColumn("updated_at", F.lit(PREV).cast("timestamp"))
    )
    incoming = ev.groupBy(F.col("student_id").alias("profile_id")).agg(F.count(F.lit(1)).alias("total_events"))
    return stored, incoming


F9_SQL = f"""
WITH {O.EV}
SELECT student_id AS profile_id,
       CASE WHEN bool_or(source = 'crm') THEN '***REDACTED***' END AS name,
       CASE WHEN bool_or(source = 'crm') THEN '***REDACTED***' END AS email,
       CASE WHEN bool_or(source = 'crm') THEN '***REDACTED***' END AS phone
FROM ev GROUP BY 1
"""


@register("f9_redact_profile", F9_SQL, "F9: profile contact fields redacted when present")
def f9_redact_profile(spark, sf_dir):
    from tessera.functions.text import redact_profile

    p = _profiles(spark, sf_dir)
    r = p.select("profile_id", F.when(F.col("personal_info").isNotNull(), redact_profile(F.col("personal_info"))).alias("pi"))
    return r.select("profile_id", F.col("pi.name").alias("name"), F.col("pi.email").alias("email"), F.col("pi.phone").alias("phone"))


F17_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS student_id, sha256('tessera-salt' || CAST(c_custkey AS VARCHAR)) AS pseudonym, true AS roundtrip_ok,
       {O.email('c_custkey')} AS email_plain
FROM customer
"""


@register("f17_pseudonymise_encrypt", F17_SQL, "F17: keyed pseudonym and AES round trip of the e-mail field")
def f17_pseudonymise_encrypt(spark, sf_dir):
    from tessera.functions.crypto import decrypt_pii, encrypt_pii, pseudonymise
    from tessera.sources.adapters import email_of

    key = "0123456789abcdef"
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    em = email_of(F.col("c_custkey"))
    enc = c.select(F.col("c_custkey").cast("string").alias("student_id"), em.alias("email_plain"), encrypt_pii(em, key).alias("email_enc"))
    return enc.select(
        "student_id",
        pseudonymise(F.col("student_id"), "tessera-salt").alias("pseudonym"),
        (decrypt_pii(F.col("email_enc"), key) == F.col("email_plain")).alias("roundtrip_ok"),
        "email_plain",
    )


F18_SQL = """
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref_param
FROM pages
"""


@register("f18_url_params", F18_SQL, "F18: query parameters parsed from page URLs")
def f18_url_params(spark, sf_dir):
    from tessera.functions.text import query_param

    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id", query_param(F.col("url"), "page").alias("page_param"), query_param(F.col("url"), "ref").alias("ref_param"))


P23_SQL = "SELECT event_id AS offset, event_id % 3 <> 0 AS form_valid, event_id % 4 <> 0 AS body_valid FROM events WHERE event_type = 'error'"


@register("p23_verify_signatures", P23_SQL, "P23: HMAC-SHA1 form and HMAC-SHA256 body signatures verified in the JVM, some forged")
def p23_verify_signatures(spark, sf_dir):
    from tessera.functions.crypto import form_signature_message, hmac_hex, verify_body_signature, verify_form_signature
    from tessera.sources.payloads import whatsapp_forms

    forms = whatsapp_forms(spark, sf_dir)
    url = F.lit("https://hooks.example.com/whatsapp")
    token, body = "test-token", F.to_json("form")
    form_sig = F.when(F.col("offset") % 3 == 0, F.lit("0" * 40)).otherwise(hmac_hex(token, form_signature_message(url, F.col("form")), 1))
    # A forged body signature is the right one of another body.
    body_sig = hmac_hex(token, F.when(F.col("offset") % 4 == 0, F.concat(body, F.lit(" "))).otherwise(body), 256)
    return forms.select(
        "offset",
        verify_form_signature(token, url, F.col("form"), form_sig).alias("form_valid"),
        verify_body_signature(token, body, F.upper(body_sig)).alias("body_valid"),
    )


S10_TEXT = """
SELECT n.n_name AS nation, count(DISTINCT c.c_custkey) AS customers, count(*) AS orders,
       CAST(round(sum(o.o_totalprice)) AS BIGINT) AS revenue
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name
"""


@register("s10_run_query", S10_TEXT, "S10: caller SQL over registered views (spark.sql)")
def s10_run_query(spark, sf_dir):
    from tessera.sources.tables import register_views

    register_views(spark, sf_dir, ["orders", "customer", "nation"])
    return spark.sql(S10_TEXT)


M2_SQL = f"""
WITH j3 AS ({J3_SQL.strip()}),
{O.EV},
r AS (SELECT ev.*, j3.profile_id FROM ev JOIN j3 USING (event_id)),
g AS (SELECT profile_id, count(*) AS total_events, max(ts) AS last_ts FROM r GROUP BY 1)
SELECT profile_id, total_events, {O.score('last_ts', 'total_events')} AS engagement_score,
       {O.band(O.score('last_ts', 'total_events'))} AS score_segment
FROM g
"""


@register("m2_silver_to_gold", M2_SQL, "M2 J3 A5: silver events resolved to profiles and folded into gold profiles")
def m2_silver_to_gold(spark, sf_dir):
    from tessera.plans.medallion import silver_to_gold

    ev = cut_lineage(resolution_events(canonical_events(spark, sf_dir, with_contact=True)))  # the silver layer boundary
    ids, names = crm_master(spark, sf_dir)
    gold = silver_to_gold(ev, ids, names, AS_OF_EVENTS)
    return gold.select("profile_id", "total_events", "engagement_score", F.try_element_at("segments", F.lit(1)).alias("score_segment"))


M4_SQL = """
SELECT 'bronze' AS layer, count(*) AS rows_kept FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-16'
UNION ALL SELECT 'silver', count(*) FROM events WHERE CAST(ts AS DATE) >= DATE '2023-04-16'
UNION ALL SELECT 'gold', count(*) FROM events WHERE CAST(ts AS DATE) >= DATE '2022-04-16'
"""


@register("m4_retention", M4_SQL, "M4: retention by layer (bronze 90 d, silver 1 y, gold 2 y) as partition filters")
def m4_retention(spark, sf_dir):
    from tessera.plans.medallion import retention_filter

    ev = canonical_events(spark, sf_dir)
    as_of = dt.datetime(2024, 4, 15)
    out = None
    for layer in ("bronze", "silver", "gold"):
        c = retention_filter(ev, layer, as_of).agg(F.count(F.lit(1)).alias("rows_kept")).select(F.lit(layer).alias("layer"), "rows_kept")
        out = c if out is None else out.unionByName(c)
    return out


M3_SQL = f"""
WITH j3 AS ({J3_SQL.strip()}),
{O.BRONZE}, {O.EV}, {O.IDS},
{O.CHANNELS},
live AS (SELECT ev.*, j3.profile_id, coalesce(j3.confidence, 1.0) AS confidence, c.c_custkey, {O.LEAD_CASE} AS lead_status
         FROM ev JOIN j3 USING (event_id) LEFT JOIN customer c ON c.c_custkey = ev.user_id WHERE event_id % 97 <> 0),
gold AS (SELECT profile_id, min(confidence) AS confidence, max(ts) AS last_ts,
                coalesce(bool_or(source = 'crm' AND c_custkey IS NOT NULL), false) AS info, coalesce(bool_or(source = 'crm' AND lead_status IS NOT NULL), false) AS status
         FROM live GROUP BY 1),
g3 AS (SELECT min(CASE WHEN info THEN 0.6 ELSE 0.0 END + CASE WHEN status THEN 0.2 ELSE 0.0 END + 0.2) >= 0.6 AND min(confidence) >= 0.85 AS ok FROM gold),
sf AS (SELECT live.profile_id, arg_min(ids.id_value, (live.ts, live.event_id)) AS sf FROM live JOIN ids USING (event_id)
       WHERE ids.id_type = 'salesforce_id' AND NOT (live.source = 'crm' AND event_id % 3 < 2) GROUP BY 1),
sync AS (SELECT sf.profile_id, CAST(substr(sf, 4) AS BIGINT) % 7 <> 0 AND (CAST(substr(sf, 4) AS BIGINT) * 31 + 5) % 3 <> 0
                AND substr(sf, 4) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) AS ok FROM sf),
fresh AS (SELECT coalesce((epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) <= 86400, false) AS ok FROM live)
SELECT 'silver' AS stage, count(*) AS rows, true AS passed FROM live
UNION ALL SELECT 'dead_letters', count(*), true FROM bronze WHERE source = 'unknown'
UNION ALL SELECT 'gate2_bronze_to_silver', 4, true
UNION ALL SELECT 'gold_profiles', count(*), true FROM gold
UNION ALL SELECT 'gate3_silver_to_gold', 3, ok FROM g3
UNION ALL SELECT 'profile_store', count(*), true FROM gold
UNION ALL SELECT 'features', count(DISTINCT student_id), true FROM live
UNION ALL SELECT 'embeddings', count(*), true FROM gold
UNION ALL SELECT 'gate4_reverse_etl', 3, true
UNION ALL SELECT 'crm_sent', count(*), true FROM sync WHERE ok
UNION ALL SELECT 'crm_consent_denied', count(*), true FROM sync WHERE NOT ok
UNION ALL SELECT 'freshness', 1, ok FROM fresh
"""


@register("m3_pipeline_run", M3_SQL, "M3: gated medallion run (silver, gate 2, gold, gate 3, store, features, embeddings, gate 4, consent-gated sync, freshness)")
def m3_pipeline_run(spark, sf_dir):
    from tessera.plans.medallion import run_pipeline

    return run_pipeline(spark, sf_dir, AS_OF_EVENTS)


K14_SQL = f"""
WITH j3 AS ({J3_SQL.strip()})
SELECT 'create' AS action, count(DISTINCT profile_id) AS n FROM j3 WHERE match_type = 'created'
UNION ALL SELECT 'merge', count(DISTINCT profile_id) FROM j3 WHERE match_type = 'probabilistic'
UNION ALL SELECT 'review', count(DISTINCT (profile_id, review_candidate)) FROM j3 WHERE review_candidate IS NOT NULL
UNION ALL SELECT 'consent', count(*) FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'delete', count(*) FROM customer WHERE c_custkey % 50 = 0
UNION ALL SELECT 'verify', count(*) FROM customer WHERE c_custkey % 50 = 0
"""


@register("k14_audit_log", K14_SQL, "K14: append-only audit (create, merge, review, consent, delete, verify) by action")
def k14_audit_log(spark, sf_dir):
    from tessera.operators import consent as C
    from tessera.plans.q_privacy import CONSENT_START, consent_changes, erasure_run
    from tessera.sinks.writers import append_audit
    from tessera.sources.adapters import consent_records

    r = cut_lineage(resolved_events(spark, sf_dir))
    row = lambda df, action, subject: df.select(F.lit(action).alias("action"), F.col(subject).alias("subject"))
    created = row(r.filter(F.col("match_type") == "created"), "create", "profile_id").distinct()
    merged = row(r.filter(F.col("match_type") == "probabilistic"), "merge", "profile_id").distinct()
    pair = r.filter(F.col("review_candidate").isNotNull()).select(F.concat_ws("|", "profile_id", "review_candidate").alias("pair")).distinct()
    _, audit, _ = C.update_consent(consent_records(spark, sf_dir, CONSENT_START), consent_changes(spark, sf_dir))
    _, _, deleted, verified = erasure_run(spark, sf_dir)
    frames = [created, merged, row(pair, "review", "pair"), row(audit, "consent", "student_id"), deleted.select("action", "subject"), row(verified, "verify", "student_id")]
    return append_audit(*frames).groupBy("action").agg(F.count(F.lit(1)).alias("n"))
