"""Registered queries: consent and erasure."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.constants import CONSENT_CHANNELS, ERASURE_DOCUMENT_COLLECTIONS, ERASURE_WAREHOUSE_TABLES
from tessera.operators import consent as C
from tessera.operators import erasure as X
from tessera.operators.features import student_features
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, consent_records, erasure_requests, page_markers
from tessera.sources.tables import read_table

CONSENT_START = dt.datetime(2024, 1, 1)
CH_LIST = "[" + ", ".join(f"'{c}'" for c in CONSENT_CHANNELS) + "]"
TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"

CUR_SQL = f"""{O.CHANNELS},
cur AS (
  SELECT CAST(c_custkey AS VARCHAR) AS student_id, channel, ((c_custkey * 31 + ch_idx) % 3 <> 0) AS consented,
         'consent' AS legal_basis, TIMESTAMP '2024-01-01 00:00:00' AS updated_at, 'v1.0' AS terms_version
  FROM customer CROSS JOIN channels WHERE c_custkey % 7 <> 0),
ch AS (
  SELECT CAST(user_id AS VARCHAR) AS student_id, {CH_LIST}[event_id % 6 + 1] AS channel, event_id % 4 <> 0 AS consented,
         'consent' AS legal_basis, 'api' AS source, ts
  FROM events WHERE event_type = 'signup')"""


def consent_changes(spark, sf_dir):
    """Consent changes from sign-up events: channel ``event_id % 6``, revoked when ``event_id % 4 = 0``."""
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    chans = F.array(*[F.lit(c) for c in CONSENT_CHANNELS])
    return e.select(
        F.col("user_id").cast("string").alias("student_id"),
        F.element_at(chans, (F.col("event_id") % 6 + 1).cast("int")).alias("channel"),
        (F.col("event_id") % 4 != 0).alias("consented"),
        F.lit("consent").alias("legal_basis"),
        F.lit("api").alias("source"),
        "ts",
    )


C1_SQL = f"""
WITH {CUR_SQL},
latest AS (SELECT student_id, channel, arg_max(consented, (ts, legal_basis, source)) AS consented, max(ts) AS updated_at FROM ch GROUP BY 1, 2)
SELECT student_id, channel, consented, terms_version, {O.ts_str('updated_at')} AS updated_at FROM cur
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.student_id = cur.student_id AND l.channel = cur.channel)
UNION ALL
SELECT student_id, channel, consented, 'v2.1', {O.ts_str('updated_at')} FROM latest
"""


@register("c1_update_consent", C1_SQL, "C1: consent changes applied, last write wins, terms v2.1")
def c1_update_consent(spark, sf_dir):
    state, _, _ = C.update_consent(consent_records(spark, sf_dir, CONSENT_START), consent_changes(spark, sf_dir))
    return state.select("student_id", "channel", "consented", "terms_version", F.date_format("updated_at", TS).alias("updated_at"))


C1A_SQL = f"""
WITH {CUR_SQL}
SELECT ch.student_id, ch.channel,
       CASE WHEN row_number() OVER w = 1 THEN cur.consented ELSE lag(ch.consented) OVER w END AS old_value,
       ch.consented AS new_value, {O.ts_str('ch.ts')} AS timestamp
FROM ch LEFT JOIN cur USING (student_id, channel)
WINDOW w AS (PARTITION BY ch.student_id, ch.channel ORDER BY ch.ts, ch.legal_basis, ch.source)
"""


@register("c1_consent_audit", C1A_SQL, "C1 K14 T3: consent audit rows with the value each change replaced")
def c1_consent_audit(spark, sf_dir):
    _, audit, _ = C.update_consent(consent_records(spark, sf_dir, CONSENT_START), consent_changes(spark, sf_dir))
    return audit.select("student_id", "channel", "old_value", "new_value", F.date_format("timestamp", TS).alias("timestamp"))


T3_SQL = f"""
SELECT row_number() OVER (ORDER BY timestamp, channel) AS position, channel, new_value, timestamp
FROM ({C1A_SQL}) WHERE student_id = '7'
"""


@register("t3_consent_trail", T3_SQL, "T3: audit trail of one student in ascending time")
def t3_consent_trail(spark, sf_dir):
    _, audit, _ = C.update_consent(consent_records(spark, sf_dir, CONSENT_START), consent_changes(spark, sf_dir))
    trail = C.consent_audit_trail(audit, "7").withColumn("position", F.monotonically_increasing_id())
    # One student's rows: numbered in the order the trail gives.
    order = Window.partitionBy("student_id").orderBy("position")
    return trail.select(
        F.row_number().over(order).cast("long").alias("position"), "channel", "new_value", F.date_format("timestamp", TS).alias("timestamp")
    )


C2_SQL = f"""
WITH {CUR_SQL}
SELECT CAST(c.c_custkey AS VARCHAR) AS student_id,
       coalesce((SELECT string_agg(channel, ',' ORDER BY channel) FROM cur WHERE cur.student_id = CAST(c.c_custkey AS VARCHAR) AND consented), '') AS granted,
       (SELECT count(*) FROM cur WHERE cur.student_id = CAST(c.c_custkey AS VARCHAR)) AS n_channels
FROM customer c
"""


@register("c2_get_consent", C2_SQL, "C2: consent map per student; no record -> empty")
def c2_get_consent(spark, sf_dir):
    students = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("student_id"))
    m = C.get_consent(students, consent_records(spark, sf_dir, CONSENT_START))
    return m.select(
        "student_id",
        F.array_join(F.array_sort(F.map_keys(F.map_filter("channels", lambda k, v: v))), ",").alias("granted"),
        F.size("channels").cast("bigint").alias("n_channels"),
    )


J9_SQL = f"""
WITH {CUR_SQL}
SELECT r.student_id, coalesce(cur.consented, false) AS allowed
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS student_id FROM events) r
LEFT JOIN cur ON cur.student_id = r.student_id AND cur.channel = 'email'
"""


@register("j9_bulk_check", J9_SQL, "J9 J10: bulk consent check for e-mail, every id answered")
def j9_bulk_check(spark, sf_dir):
    req = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("student_id")).distinct()
    return C.bulk_check(req, consent_records(spark, sf_dir, CONSENT_START), "email")


J11_SQL = f"""
WITH {CUR_SQL},
pairs AS (SELECT CAST(a.c_custkey AS VARCHAR) AS primary_id, CAST(b.c_custkey AS VARCHAR) AS secondary_id
          FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 WHERE a.c_custkey % 10 = 0),
g AS (SELECT p.primary_id, p.secondary_id, c.channel FROM pairs p CROSS JOIN channels c),
m AS (SELECT g.primary_id, g.channel, pc.consented AS p_c,
             coalesce(pc.consented, false) AND coalesce(sc.consented, false) AS merged
      FROM g LEFT JOIN cur pc ON pc.student_id = g.primary_id AND pc.channel = g.channel
             LEFT JOIN cur sc ON sc.student_id = g.secondary_id AND sc.channel = g.channel)
SELECT primary_id AS student_id, channel, merged AS consented, 'legitimate_interest' AS legal_basis
FROM m WHERE p_c IS NULL OR p_c <> merged
"""


@register("j11_merge_consent", J11_SQL, "J11: consent merge of duplicate pairs (AND, missing = false), rewrites")
def j11_merge_consent(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    a, b = c.alias("a"), c.alias("b")
    pairs = a.join(b, F.col("b.c_custkey") == F.col("a.c_custkey") + 1).filter(F.col("a.c_custkey") % 10 == 0).select(
        F.col("a.c_custkey").cast("string").alias("primary_id"), F.col("b.c_custkey").cast("string").alias("secondary_id")
    )
    _, rewrites = C.merge_consent(consent_records(spark, sf_dir, CONSENT_START), pairs, AS_OF_EVENTS)
    return rewrites.select("student_id", "channel", "consented", "legal_basis")


J8_SQL = f"""
WITH {CUR_SQL},
prof AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS profile_id FROM events)
SELECT CAST(c.c_custkey AS VARCHAR) AS profile_id,
       (p.profile_id IS NOT NULL AND cur.consented IS NOT NULL AND cur.consented) AS allowed,
       CASE WHEN p.profile_id IS NULL THEN 'no_profile' WHEN cur.consented IS NULL THEN 'no_record' WHEN NOT cur.consented THEN 'revoked' END AS reason
FROM customer c LEFT JOIN prof p ON p.profile_id = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN cur ON cur.student_id = CAST(c.c_custkey AS VARCHAR) AND cur.channel = 'whatsapp'
"""


@register("j8_consent_gate", J8_SQL, "J8: outbound consent gate for WhatsApp (no profile / no record / revoked)")
def j8_consent_gate(spark, sf_dir):
    targets = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("profile_id"))
    prof = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("profile_id")).distinct()
    return C.consent_gate(targets, prof, consent_records(spark, sf_dir, CONSENT_START), "whatsapp")


def _stores(spark, sf_dir):
    """The 14 stores that hold a student's data: warehouse tables, document collections, CRM
    mapping, vectors and features."""
    ev = canonical_events(spark, sf_dir)
    marked = page_markers(ev)
    graph = ev.select("student_id", "event_id", F.explode("identifiers").alias("identifier"))
    students = ev.groupBy("student_id").agg(F.count(F.lit(1)).alias("total_events"))
    member = students.filter(F.col("total_events") >= 5).select("student_id", F.lit("engaged_learner").alias("segment"))
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("student_id"), F.concat(F.lit("sf_"), F.col("c_custkey").cast("string")).alias("salesforce_id")
    )
    vec = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("student_id"), "label")
    frames = [ev, students, graph, students.withColumnRenamed("student_id", "profile_id"), member, cust.withColumn("status", F.lit("sent"))]
    keys = ["student_id", "student_id", "student_id", "profile_id", "student_id", "student_id"]
    stores = {name: (df, key) for name, df, key in zip(ERASURE_WAREHOUSE_TABLES, frames, keys)}
    documents = [students.withColumnRenamed("student_id", "profile_id"), ev, consent_records(spark, sf_dir, CONSENT_START), consent_changes(spark, sf_dir), member]
    keys = ["profile_id", "student_id", "student_id", "student_id", "student_id"]
    stores |= {name: (df, key) for name, df, key in zip(ERASURE_DOCUMENT_COLLECTIONS, documents, keys)}
    stores["salesforce_mappings"] = (cust, "student_id")
    stores["vectors"] = (vec, "student_id")
    stores["features"] = (student_features(marked, AS_OF_EVENTS), "entity_id")
    return stores


def erasure_run(spark, sf_dir, skip=()):
    """(rewritten stores, report, audit rows, verification) of the erasure requests."""
    req, stores = erasure_requests(spark, sf_dir), _stores(spark, sf_dir)
    remaining, report = X.erase(stores, req, skip)
    verified = X.verify_erasure({n: (df, stores[n][1]) for n, df in remaining.items()}, req)
    return remaining, report, X.erasure_audit(req, report), verified


REQ_SQL = "req AS (SELECT CAST(c_custkey AS VARCHAR) AS student_id FROM customer WHERE c_custkey % 50 = 0)"


def _per_store_sql() -> str:
    """(store, student_id, n) rows of every store for the requested students."""
    students = "SELECT student_id, 1 AS n FROM (SELECT DISTINCT student_id FROM ev)"
    member = "SELECT student_id, 1 AS n FROM (SELECT student_id FROM ev GROUP BY 1 HAVING count(*) >= 5)"
    events, cust = "SELECT student_id, 1 AS n FROM ev", "SELECT CAST(c_custkey AS VARCHAR) AS student_id, 1 AS n FROM customer"
    graph = "SELECT ev.student_id, 1 AS n FROM ids JOIN ev USING (event_id)"
    parts = dict(zip(ERASURE_WAREHOUSE_TABLES, [events, students, graph, students, member, cust]))
    parts |= dict(zip(ERASURE_DOCUMENT_COLLECTIONS, [students, events, "SELECT student_id, 1 AS n FROM cur", "SELECT student_id, 1 AS n FROM ch", member]))
    parts |= {"salesforce_mappings": cust, "vectors": "SELECT CAST(vec_id AS VARCHAR) AS student_id, 1 AS n FROM embeddings", "features": students}
    return " UNION ALL ".join(f"SELECT '{name}' AS store, student_id, n FROM ({sql})" for name, sql in parts.items())


E1_SQL = f"""
WITH {O.EV}, {O.IDS}, {CUR_SQL}, {REQ_SQL}, held AS ({_per_store_sql()})
SELECT store, CAST(coalesce(sum(n) FILTER (WHERE student_id IN (SELECT student_id FROM req)), 0) AS BIGINT) AS records_affected FROM held GROUP BY store
"""


@register("e1_erasure_report", E1_SQL, "E1 E4 K7 K9: erasure across 14 stores (features and vectors included), rows affected per store")
def e1_erasure_report(spark, sf_dir):
    return erasure_run(spark, sf_dir)[1]


K7_SQL = f"""
WITH {O.EV}, {O.IDS}, {CUR_SQL}, {REQ_SQL}, held AS ({_per_store_sql()})
SELECT store, CAST(coalesce(sum(n) FILTER (WHERE student_id NOT IN (SELECT student_id FROM req)), 0) AS BIGINT) AS rows_left FROM held GROUP BY store
"""


@register("k7_erased_tables", K7_SQL, "K7 K9: the rewritten stores, read back and counted")
def k7_erased_tables(spark, sf_dir):
    remaining, _, _, _ = erasure_run(spark, sf_dir)
    counts = [df.agg(F.count(F.lit(1)).alias("rows_left")).select(F.lit(n).alias("store"), "rows_left") for n, df in remaining.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


# Two stores were skipped: what they hold is left over, and only there.
SKIPPED = ("consent_audit_log", "cdp_silver.identity_graph")
E2_SQL = f"""
WITH {O.EV}, {O.IDS}, {CUR_SQL}, {REQ_SQL}, held AS ({_per_store_sql()}),
left_over AS (SELECT student_id, sum(n) AS n FROM held WHERE store IN {SKIPPED} GROUP BY 1)
SELECT req.student_id, CAST(coalesce(n, 0) AS BIGINT) AS remaining, coalesce(n, 0) = 0 AS all_clear FROM req LEFT JOIN left_over USING (student_id)
"""


@register("e2_verify_erasure", E2_SQL, "E2 A15: verification of the written stores after an erasure that skipped two of them")
def e2_verify_erasure(spark, sf_dir):
    return erasure_run(spark, sf_dir, SKIPPED)[3]


K11_SQL = f"""
WITH {REQ_SQL}, t AS (SELECT unnest(['cdp.events.raw', 'cdp.profiles.unified', 'cdp.segments.updates', 'cdp.reverse-etl.commands']) AS topic)
SELECT t.topic, req.student_id AS key, CAST(NULL AS VARCHAR) AS value FROM req CROSS JOIN t
"""


@register("k11_tombstones", K11_SQL, "K11: tombstone records per erased student and topic")
def k11_tombstones(spark, sf_dir):
    return X.tombstones(erasure_requests(spark, sf_dir))


E3_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS student_id, CAST((c_custkey % 7) * 24 AS DOUBLE) AS age_hours
FROM customer WHERE c_custkey % 50 = 0 AND (c_custkey % 7) * 24 > 72
"""


@register("e3_erasure_sla", E3_SQL, "E3: erasure requests open beyond the 72 h SLA")
def e3_erasure_sla(spark, sf_dir):
    return X.overdue(erasure_requests(spark, sf_dir), AS_OF_EVENTS).select("student_id", "age_hours")


J15_SQL = f"""
WITH {REQ_SQL}
SELECT req.student_id, 'sf_' || req.student_id AS salesforce_id FROM req
"""


@register("j15_crm_mapping_erase", J15_SQL, "J15: CRM contacts to delete for erasure requests")
def j15_crm_mapping_erase(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("student_id"), F.concat(F.lit("sf_"), F.col("c_custkey").cast("string")).alias("salesforce_id")
    )
    return X.crm_mappings_to_delete(erasure_requests(spark, sf_dir), cust)


E1F_SQL = """
WITH e AS (SELECT user_id, user_id % 16 AS bucket, user_id % 50 = 0 AND user_id IN (SELECT c_custkey FROM customer) AS gone FROM events)
SELECT bucket, count(*) FILTER (WHERE gone) AS records_affected, bool_or(gone) AS rewritten, count(*) FILTER (WHERE NOT gone) AS records_left FROM e GROUP BY 1
"""


@register("e1_erase_in_files", E1F_SQL, "E1 K7 K9: erasure that reads and rewrites only the files holding a requested student")
def e1_erase_in_files(spark, sf_dir):
    from tessera.operators import erasure as E
    from tessera.streaming.pipeline import scratch_dir

    events = read_table(spark, sf_dir, "events").withColumn("bucket", (F.col("user_id") % 16).cast("int"))
    path = scratch_dir(spark, "event_store")
    E.write_store(events.repartition("bucket").sortWithinPartitions("bucket", "user_id"), path, "user_id", partition_by="bucket")
    requests = read_table(spark, sf_dir, "customer").where(F.col("c_custkey") % 50 == 0).select(F.col("c_custkey").cast("string").alias("student_id"))
    store, report = E.erase_in_files(spark, path, "user_id", requests)
    hit = report.groupBy(F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("int").alias("bucket")).agg(F.sum("records_affected").alias("records_affected"))
    left = store.read(spark).groupBy("bucket").agg(F.count(F.lit(1)).alias("records_left"))
    out = left.join(hit, "bucket", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(F.col("bucket").cast("bigint").alias("bucket"), zero("records_affected"), F.col("records_affected").isNotNull().alias("rewritten"), zero("records_left"))
