"""Registered queries: quality gates and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators import quality as Q
from tessera.plans import oracle_fragments as O
from tessera.plans.q_identity import J3_SQL, resolved_events
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, email_of
from tessera.sources.tables import read_table

SOURCES_IN = "('website','app','crm','email','whatsapp')"


def _gate_sql(gate: str, severity: str, n: str, items: list[tuple[str, str]], src: str) -> str:
    parts = [
        f"SELECT '{gate}' AS gate, '{name}' AS expectation, CAST({expr} AS BIGINT) AS failed_rows, CAST({expr} AS BIGINT) = 0 AS passed, "
        f"CASE WHEN CAST({expr} AS BIGINT) = 0 THEN 'info' ELSE '{severity}' END AS severity, CAST({n} AS BIGINT) AS record_count FROM {src}"
        for name, expr in items
    ]
    return "\nUNION ALL ".join(parts)


G1_SQL = f"""
WITH {O.BRONZE},
a AS (SELECT count(*) AS n, coalesce(sum(CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END), 0) AS ts_bad,
             coalesce(sum(CASE WHEN source NOT IN {SOURCES_IN} THEN 1 ELSE 0 END), 0) AS src_bad FROM bronze)
{_gate_sql("gate1_ingestion", "critical", "n", [("event_id column exists", "0"), ("event_id not null", "0"), ("timestamp is ISO8601", "ts_bad"), ("source in allowed set", "src_bad")], "a")}
"""


@register("g1_gate_ingestion", G1_SQL, "G1 A8: ingestion gate over bronze (id, ISO timestamp, source set)")
def g1_gate_ingestion(spark, sf_dir):
    b = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True)
    fmt = F.when(F.col("event_id") % 13 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return Q.gate1_ingestion(b.select("event_id", fmt.alias("timestamp"), "source"))


G2_SQL = f"""
WITH {O.BRONZE},
s AS (SELECT event_id, CASE WHEN event_id % 101 = 0 THEN NULL ELSE student_id END AS student_id,
             CASE WHEN event_id % 89 = 0 THEN 'bad-email' ELSE {O.email()} END AS email
      FROM bronze WHERE source IN {SOURCES_IN}),
a AS (SELECT count(*) AS n, coalesce(sum(CASE WHEN student_id IS NULL THEN 1 ELSE 0 END), 0) AS sid_null,
             coalesce(sum(CASE WHEN NOT regexp_full_match(email, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+') THEN 1 ELSE 0 END), 0) AS bad_email,
             (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM s GROUP BY event_id HAVING count(*) > 1)) AS dups
      FROM s)
{_gate_sql("gate2_bronze_to_silver", "critical", "n", [("student_id not null", "sid_null"), ("email format valid", "bad_email"), ("student_id is string", "0"), ("event_id unique", "dups")], "a")}
"""


@register("g2_gate_silver", G2_SQL, "G2 A8 F14: silver gate (student not null, unique event, e-mail format, type)")
def g2_gate_silver(spark, sf_dir):
    b = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True).filter(F.col("source").isin("website", "app", "crm", "email", "whatsapp"))
    s = b.select(
        "event_id",
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("student_id")).alias("student_id"),
        F.when(F.col("event_id") % 89 == 0, F.lit("bad-email")).otherwise(email_of(F.col("user_id"))).alias("email"),
    )
    return Q.gate2_silver(s)


COMPLETENESS_SQL = f"""{O.EV},
crm AS (SELECT c_custkey, {O.LEAD_CASE} AS lead_status FROM customer),
pc AS (
  SELECT ev.student_id AS profile_id,
         bool_or(ev.source = 'crm' AND c.c_custkey IS NOT NULL) AS has_info,
         bool_or(ev.source = 'crm' AND c.lead_status IS NOT NULL) AS has_status,
         max(ev.ts) AS last_ts
  FROM ev LEFT JOIN crm c ON ev.user_id = c.c_custkey GROUP BY 1),
comp AS (
  SELECT profile_id,
         0 + (CASE WHEN has_info THEN 0.2 ELSE 0.0 END) + (CASE WHEN has_info THEN 0.2 ELSE 0.0 END)
           + (CASE WHEN has_info THEN 0.2 ELSE 0.0 END) + (CASE WHEN has_status THEN 0.2 ELSE 0.0 END)
           + (CASE WHEN last_ts IS NOT NULL THEN 0.2 ELSE 0.0 END) AS completeness
  FROM pc)"""


def _gold(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, with_contact=True).withColumnRenamed("student_id", "profile_id")
    prof = P.build_profiles(ev, AS_OF_EVENTS)
    return prof.select("profile_id", Q.completeness(prof).alias("completeness"))


G5_SQL = f"""
WITH {COMPLETENESS_SQL}
SELECT profile_id, CAST(completeness AS DOUBLE) AS completeness FROM comp
"""


@register("g5_completeness", G5_SQL, "G5: profile completeness score (5 fields, 0.2 each)")
def g5_completeness(spark, sf_dir):
    return _gold(spark, sf_dir)


G3_SQL = f"""
WITH {COMPLETENESS_SQL},
j3 AS ({J3_SQL.strip()}),
conf AS (SELECT ev.student_id AS profile_id, min(coalesce(j3.confidence, 1.0)) AS confidence FROM ev JOIN j3 USING (event_id) GROUP BY 1),
a AS (SELECT count(*) AS n, CASE WHEN min(completeness) < 0.6 THEN 1 ELSE 0 END AS c_bad,
             CASE WHEN min(confidence) < 0.85 THEN 1 ELSE 0 END AS i_bad, sum(CASE WHEN CAST(profile_id AS BIGINT) % 9 = 0 THEN 1 ELSE 0 END) AS p_null
      FROM comp JOIN conf USING (profile_id))
{_gate_sql("gate3_silver_to_gold", "warning", "n", [("profile_completeness_score min >= 0.6", "c_bad"), ("identity_confidence min >= 0.85", "i_bad"), ("primary_profile_id not null", "p_null")], "a")}
"""


@register("g3_gate_gold", G3_SQL, "G3 A8: gold gate (completeness, identity confidence, orphans)")
def g3_gate_gold(spark, sf_dir):
    # Real confidences of the resolver; every ninth gold row has lost its primary profile id.
    conf = canonical_events(spark, sf_dir).select("event_id", "student_id").join(resolved_events(spark, sf_dir), "event_id")
    conf = conf.groupBy(F.col("student_id").alias("profile_id")).agg(F.min(F.coalesce("confidence", F.lit(1.0))).alias("identity_confidence"))
    g = _gold(spark, sf_dir).join(conf, "profile_id")
    primary = F.when(F.col("profile_id").cast("bigint") % 9 != 0, F.col("profile_id"))
    return Q.gate3_gold(g.select(F.col("completeness").alias("profile_completeness_score"), "identity_confidence", primary.alias("primary_profile_id")))


G4_SQL = f"""
WITH {O.EV},
o AS (SELECT student_id, CASE WHEN bool_or(source = 'crm') THEN 'sf_' || student_id END AS salesforce_contact_id FROM ev GROUP BY 1),
prev AS (SELECT count(DISTINCT user_id) AS p FROM events WHERE ts < TIMESTAMP '2024-01-24 00:00:00'),
a AS (SELECT count(*) AS n, coalesce(sum(CASE WHEN salesforce_contact_id IS NULL THEN 1 ELSE 0 END), 0) AS sf_null,
             CASE WHEN count(*) < (SELECT p FROM prev) * 0.8 OR count(*) > (SELECT p FROM prev) * 1.2 THEN 1 ELSE 0 END AS cnt_bad
      FROM o)
{_gate_sql("gate4_reverse_etl", "critical", "n", [("row count within 20% of previous", "cnt_bad"), ("salesforce_contact_id not null", "sf_null"), ("no PII in marketing fields", "1")], "a")}
"""


@register("g4_gate_outbound", G4_SQL, "G4 F15: outbound gate (count vs previous run, contact id, PII columns)")
def g4_gate_outbound(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    out = ev.groupBy("student_id").agg(
        F.when(F.bool_or(F.col("source") == "crm"), F.concat(F.lit("sf_"), F.col("student_id"))).alias("salesforce_contact_id"),
        F.max("ts").alias("marketing_last_seen"),
        F.lit(None).cast("string").alias("marketing_email"),  # one PII column, which the gate must name
    )
    prev = ev.filter(F.col("ts") < F.lit("2024-01-24 00:00:00").cast("timestamp")).agg(F.count_distinct("student_id").alias("p"))
    return Q.gate4_outbound(out, prev.scalar())


G6_SQL = f"""
WITH {O.EV}
SELECT count(*) AS orphan_rows FROM ev WHERE student_id NOT IN (SELECT DISTINCT student_id FROM ev WHERE source = 'crm')
"""


@register("g6_orphans", G6_SQL, "G6: silver rows whose student has no CRM-backed profile (anti join)")
def g6_orphans(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    prof = ev.filter(F.col("source") == "crm").select(F.col("student_id").alias("profile_id")).distinct()
    return Q.orphans(ev, prof)


A9_SQL = f"""
SELECT {O.ts_str('max(ts)')} AS latest,
       (epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) AS age_seconds,
       coalesce((epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) <= 86400, false) AS fresh
FROM events
"""


@register("a9_freshness", A9_SQL, "A9: newest row of the event table against 24 h")
def a9_freshness(spark, sf_dir):
    f = Q.freshness(read_table(spark, sf_dir, "events"), "ts", AS_OF_EVENTS)
    return f.select(F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"), "age_seconds", "fresh")


A10_SQL = f"""
WITH {O.EV}
SELECT source, {O.ts_str('max(ts)')} AS latest,
       (epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) AS age_seconds,
       (epoch_us({O.AS_OF}) // 1000000) - (epoch_us(max(ts)) // 1000000) <= 3600 AS fresh
FROM ev GROUP BY source
"""


@register("a10_freshness_by_source", A10_SQL, "A10 A19: freshness per source against 1 h")
def a10_freshness_by_source(spark, sf_dir):
    f = Q.freshness(canonical_events(spark, sf_dir), "ts", AS_OF_EVENTS, max_age_hours=1, by="source")
    return f.select("source", F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"), "age_seconds", "fresh")


J13_SQL = f"""
WITH {O.EV}, {O.IDS},
attrs AS (
  SELECT ev.student_id AS profile_id, ev.source,
         max(CASE WHEN ids.id_type = 'email' THEN ids.id_value END) AS email_seen,
         max(CASE WHEN ids.id_type = 'phone' THEN ids.id_value END) AS phone_seen
  FROM ev LEFT JOIN ids USING (event_id) GROUP BY 1, 2),
n AS (SELECT profile_id, count(*) AS n FROM attrs GROUP BY 1),
lng AS (SELECT profile_id, 'email_seen' AS field, email_seen AS v FROM attrs UNION ALL SELECT profile_id, 'phone_seen', phone_seen FROM attrs),
agree AS (SELECT profile_id, sum(c * (c - 1) / 2) AS agreements FROM (SELECT profile_id, field, v, count(*) AS c FROM lng GROUP BY 1, 2, 3) GROUP BY 1)
SELECT n.profile_id, n.n,
       CASE WHEN n.n * (n.n - 1) / 2 * 2 > 0 THEN agreements / (n.n * (n.n - 1) / 2 * 2) ELSE 1.0 END AS agreement,
       (n.n < 2 OR CASE WHEN n.n * (n.n - 1) / 2 * 2 > 0 THEN agreements / (n.n * (n.n - 1) / 2 * 2) ELSE 1.0 END >= 0.9) AS passed
FROM n JOIN agree USING (profile_id)
"""


@register("j13_cross_source_agreement", J13_SQL, "J13: field agreement across source rows per profile (no self-join)")
def j13_cross_source_agreement(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    seen = lambda t: F.max(F.array_max(F.transform(F.filter("identifiers", lambda x: x["type"] == t), lambda x: x["value"])))
    attrs = ev.groupBy(F.col("student_id").alias("profile_id"), "source").agg(seen("email").alias("email_seen"), seen("phone").alias("phone_seen"))
    return Q.cross_source_agreement(attrs, ["email_seen", "phone_seen"])


J14_SQL = f"""
WITH {O.EV}, g AS (SELECT student_id, count(*) AS n, max(ts) AS last_ts FROM ev WHERE event_type = 'purchase' GROUP BY 1),
a AS (SELECT student_id AS profile_id, {O.score('last_ts', 'n')} AS score FROM g)
SELECT profile_id, CASE WHEN CAST(profile_id AS BIGINT) % 40 = 0 THEN 'missing_b' ELSE 'differs' END AS status
FROM a WHERE CAST(profile_id AS BIGINT) % 40 = 0 OR CAST(profile_id AS BIGINT) % 30 = 0
"""


@register("j14_reconcile", J14_SQL, "J14: nightly diff of two profile stores (full outer join, null-safe)")
def j14_reconcile(spark, sf_dir):
    ev = canonical_events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    g = ev.groupBy(F.col("student_id").alias("profile_id")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    a = g.select("profile_id", P.engagement_score(F.col("last_ts"), F.col("n"), AS_OF_EVENTS).alias("score"))
    pid = F.col("profile_id").cast("bigint")
    b = a.filter(pid % 40 != 0).withColumn("score", F.when(pid % 30 == 0, F.col("score") + 1).otherwise(F.col("score")))
    return Q.reconcile(a, b, "profile_id", ["score"])


# Two copies of the profile table that drifted apart: rows missing on either side, older rows on
# either side, a score lost (null) under an equal time.
_A_KEEPS, _B_KEEPS = "pid % 41 <> 0", "pid % 40 <> 0"
_HEAL_STORES = f"""
WITH {O.EV}, g AS (SELECT student_id AS profile_id, CAST(student_id AS BIGINT) AS pid, count(*) AS n, max(epoch_us(ts)) AS last_us FROM ev GROUP BY 1, 2),
a AS (SELECT profile_id, CASE WHEN pid % 31 = 0 THEN n + 1 ELSE n END AS n, CASE WHEN pid % 31 = 0 THEN last_us + 1 ELSE last_us END AS last_us FROM g WHERE {_A_KEEPS}),
b AS (SELECT profile_id, CASE WHEN pid % 37 = 0 THEN NULL WHEN pid % 30 = 0 THEN n + 2 ELSE n END AS n,
             CASE WHEN pid % 37 <> 0 AND pid % 30 = 0 THEN last_us + 2 ELSE last_us END AS last_us FROM g WHERE {_B_KEEPS}),
j AS (SELECT coalesce(a.profile_id, b.profile_id) AS profile_id, a.profile_id IS NULL AS no_a, b.profile_id IS NULL AS no_b,
             a.n AS an, a.last_us AS aat, b.n AS bn, b.last_us AS bat FROM a FULL JOIN b ON a.profile_id = b.profile_id),
d AS (SELECT *, no_a OR (NOT no_b AND bat > aat) AS from_b FROM j WHERE no_a OR no_b OR an IS DISTINCT FROM bn OR aat IS DISTINCT FROM bat)"""

J14_HEAL_SQL = f"""{_HEAL_STORES}
SELECT profile_id, CASE WHEN from_b THEN 'a' ELSE 'b' END AS store,
       CASE WHEN no_a THEN 'missing_a' WHEN no_b THEN 'missing_b' ELSE 'differs' END AS status,
       CASE WHEN from_b THEN bn ELSE an END AS n, CASE WHEN from_b THEN bat ELSE aat END AS last_us FROM d
"""
J14_WORK_SQL = f"""{_HEAL_STORES},
r AS (SELECT DISTINCT substr(md5(profile_id), 1, 4) AS leaf FROM d),
s AS (SELECT substr(md5(profile_id), 1, 4) AS leaf, 1 AS na, 0 AS nb FROM a UNION ALL SELECT substr(md5(profile_id), 1, 4), 0, 1 FROM b)
SELECT CAST(sum(na) AS BIGINT) AS rows_a, CAST(sum(nb) AS BIGINT) AS rows_b, count(DISTINCT s.leaf) AS ranges, (SELECT count(*) FROM r) AS ranges_differing,
       CAST(count_if(na = 1 AND r.leaf IS NOT NULL) AS BIGINT) AS joined_a, CAST(count_if(nb = 1 AND r.leaf IS NOT NULL) AS BIGINT) AS joined_b,
       CAST(0 AS BIGINT) AS differences_left
FROM s LEFT JOIN r ON s.leaf = r.leaf
"""


def _drifted_stores(spark, sf_dir):
    """Both copies written as reconcilable stores: their paths."""
    import uuid

    from tessera.operators.healing import write_store
    from tessera.session import ensure_checkpoint_dir

    g = canonical_events(spark, sf_dir).groupBy(F.col("student_id").alias("profile_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last_us")
    ).withColumn("pid", F.col("profile_id").cast("bigint"))
    bump = lambda when, c, by: F.when(when, F.col(c) + by).otherwise(F.col(c)).alias(c)
    up_a, up_b, lost = F.expr("pid % 31 = 0"), F.expr("pid % 37 <> 0 AND pid % 30 = 0"), F.expr("pid % 37 = 0")
    a = g.where(_A_KEEPS).select("profile_id", bump(up_a, "n", 1), bump(up_a, "last_us", 1))
    b = g.where(_B_KEEPS).select("profile_id", F.when(~lost, bump(up_b, "n", 2)).alias("n"), bump(up_b, "last_us", 2))
    paths = [f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/store_{uuid.uuid4().hex}" for _ in "ab"]
    for store, path in zip((a, b), paths):
        write_store(store, "profile_id", ["n", "last_us"], path)
    return paths


_STORE_SCHEMA = "profile_id string, n long, last_us long"


@register("j14_heal", J14_HEAL_SQL, "J14: repair rows of two drifted stores, only ranges with differing digests joined")
def j14_heal(spark, sf_dir):
    from tessera.operators.healing import compare_stores

    return compare_stores(spark, *_drifted_stores(spark, sf_dir), "profile_id", _STORE_SCHEMA, ["n", "last_us"], "last_us")[0]


@register("j14_heal_work", J14_WORK_SQL, "J14: rows and ranges read by the digest tree, and the differences left once the repair rows are applied")
def j14_heal_work(spark, sf_dir):
    from tessera.operators.healing import apply_repairs, compare_stores, read_store
    from tessera.session import cut_lineage

    paths = _drifted_stores(spark, sf_dir)
    repairs, work = compare_stores(spark, *paths, "profile_id", _STORE_SCHEMA, ["n", "last_us"], "last_us")
    repairs = cut_lineage(repairs)
    healed = [apply_repairs(read_store(spark, p, _STORE_SCHEMA), repairs, s, "profile_id") for p, s in zip(paths, "ab")]
    left = Q.reconcile(*healed, "profile_id", ["n", "last_us"]).agg(F.count(F.lit(1)).alias("differences_left"))
    return work.join(left, F.lit(True))  # one row with one row


A8_SQL = """
WITH a AS (
  SELECT count(*) AS n,
         coalesce(sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END), 0) AS cust_null,
         coalesce(sum(CASE WHEN o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P') THEN 1 ELSE 0 END), 0) AS status_bad,
         coalesce(sum(CASE WHEN o_orderpriority IS NOT NULL AND NOT regexp_matches(o_orderpriority, '^[1-5]-') THEN 1 ELSE 0 END), 0) AS prio_bad,
         CASE WHEN min(o_totalprice) < 0 THEN 1 ELSE 0 END AS price_bad,
         (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)) AS dups
  FROM orders)
""" + _gate_sql(
    "orders_expectations",
    "critical",
    "n",
    [
        ("o_custkey not null", "cust_null"),
        ("o_orderstatus in set", "status_bad"),
        ("o_orderpriority matches regex", "prio_bad"),
        ("o_totalprice min >= 0", "price_bad"),
        ("o_orderkey unique", "dups"),
    ],
    "a",
)


@register("a8_expectations", A8_SQL, "A8: generic expectations (not-null, in-set, regex, min, unique) in one pass")
def a8_expectations(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return Q.run_expectations(
        o,
        "orders_expectations",
        [
            Q.expect("not_null", "o_custkey"),
            Q.expect("in_set", "o_orderstatus", ["F", "O", "P"]),
            Q.expect("regex", "o_orderpriority", "^[1-5]-"),
            Q.expect("min_at_least", "o_totalprice", 0),
            Q.expect("unique", "o_orderkey"),
        ],
    )
