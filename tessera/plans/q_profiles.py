"""Registered queries: profile assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events

FLAGSHIP_SQL = f"""
WITH {O.EV},
crm AS (SELECT c_custkey, c_name, {O.LEAD_CASE} AS lead_status FROM customer),
{O.IDS},
e2 AS (
  SELECT ev.*, c.c_custkey IS NOT NULL AND ev.source = 'crm' AS has_info,
         CASE WHEN ev.source = 'crm' THEN c.c_name END AS name,
         CASE WHEN ev.source = 'crm' THEN c.lead_status END AS lead_status,
         CASE WHEN ev.source = 'crm' THEN c.c_custkey END AS ck
  FROM ev LEFT JOIN crm c ON ev.user_id = c.c_custkey),
g AS (
  SELECT student_id AS profile_id, count(*) AS total_events, max(ts) AS last_ts,
         arg_max(name, (ts, event_id)) FILTER (WHERE has_info) AS name,
         arg_max({O.email()}, (ts, event_id)) FILTER (WHERE has_info) AS email,
         arg_max({O.phone()}, (ts, event_id)) FILTER (WHERE has_info) AS phone,
         arg_max(lead_status, (ts, event_id)) FILTER (WHERE lead_status IS NOT NULL) AS lead_status,
         max(ck) AS ck
  FROM e2 GROUP BY student_id),
src AS (
  SELECT profile_id, string_agg(source || '=' || CAST(n AS VARCHAR), ';' ORDER BY source) AS per_source
  FROM (SELECT student_id AS profile_id, source, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1),
{O.CHANNELS},
cons AS (
  SELECT CAST(c_custkey AS VARCHAR) AS profile_id,
         string_agg(channel, ',' ORDER BY channel) FILTER (WHERE (c_custkey * 31 + ch_idx) % 3 <> 0) AS ch
  FROM customer CROSS JOIN channels
  WHERE c_custkey % 7 <> 0 AND c_custkey IN (SELECT user_id FROM ev WHERE source = 'crm')
  GROUP BY 1),
fi AS (
  SELECT profile_id, string_agg(id_type || '=' || v, ';' ORDER BY id_type || '=' || v) AS first_identifiers
  FROM (SELECT ev.student_id AS profile_id, ids.id_type, arg_min(ids.id_value, (ev.ts, ev.event_id)) AS v
        FROM ids JOIN ev USING (event_id) GROUP BY 1, 2) GROUP BY 1)
SELECT g.profile_id, g.name, g.email, g.phone, coalesce(g.lead_status, 'anonymous') AS enrollment_status,
       g.total_events, src.per_source, {O.ts_str('g.last_ts')} AS last_interaction_at,
       {O.score('g.last_ts', 'g.total_events')} AS engagement_score,
       {O.band(O.score('g.last_ts', 'g.total_events'))} AS score_segment,
       coalesce(cons.ch, '') AS consented_channels, fi.first_identifiers, CAST(1 AS BIGINT) AS version
FROM g JOIN src USING (profile_id) LEFT JOIN cons USING (profile_id) LEFT JOIN fi USING (profile_id)
"""


@register("a5_build_profile", FLAGSHIP_SQL, "A5 P22 A1 A2 A3 A4 P16: unified profile per student (flagship)")
def a5_build_profile(spark, sf_dir):
    # Folded on user_id, the key of the CRM join: at scale that join is a sort-merge
    # join hash-partitioned on user_id, and the fold reuses that partitioning instead
    # of shuffling the events a second time.  The string profile id is derived after.
    ev = canonical_events(spark, sf_dir, with_contact=True).drop("student_id")
    prof = P.build_profiles(ev, AS_OF_EVENTS, key="user_id").withColumn("profile_id", F.col("profile_id").cast("string"))
    return P.flatten_profile(prof)


A1_SQL = f"""
WITH {O.EV}
SELECT student_id AS profile_id, source, count(*) AS n_events, {O.ts_str('max(ts)')} AS last_interaction_at
FROM ev GROUP BY student_id, source
"""


@register("a1_interaction_summary", A1_SQL, "A1: events and last interaction per (profile, source)")
def a1_interaction_summary(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    return ev.groupBy(F.col("student_id").alias("profile_id"), "source").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_interaction_at"),
    )


A2_SQL = f"""
WITH {O.EV}, g AS (SELECT student_id, count(*) AS n, max(ts) AS last_ts FROM ev WHERE event_type = 'purchase' GROUP BY 1)
SELECT student_id AS profile_id, n AS total_events, {O.score('last_ts', 'n')} AS engagement_score,
       {O.band(O.score('last_ts', 'n'))} AS score_segment
FROM g
"""


@register("a2_purchase_engagement", A2_SQL, "A2 P16: engagement score and band over purchase events")
def a2_purchase_engagement(spark, sf_dir):
    ev = canonical_events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    g = ev.groupBy("student_id").agg(F.count(F.lit(1)).alias("total_events"), F.max("ts").alias("last_ts"))
    s = P.engagement_score(F.col("last_ts"), F.col("total_events"), AS_OF_EVENTS)
    return g.select(
        F.col("student_id").alias("profile_id"),
        "total_events",
        s.alias("engagement_score"),
        P.score_segment(s).alias("score_segment"),
    )


ORDERS_SQL = f"""
WITH g AS (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_ts FROM orders GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS profile_id, n AS total_events,
       {O.score('last_ts', 'n', "TIMESTAMP '2001-08-01 00:00:00'")} AS engagement_score,
       {O.band(O.score('last_ts', 'n', "TIMESTAMP '2001-08-01 00:00:00'"))} AS score_segment
FROM g
"""


@register("a2_order_engagement", ORDERS_SQL, "A2 P16: engagement score over orders as interactions")
def a2_order_engagement(spark, sf_dir):
    from tessera.sources.adapters import AS_OF_ORDERS
    from tessera.sources.tables import read_table

    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_events"), F.max("o_orderdate").alias("last_ts"))
    s = P.engagement_score(F.col("last_ts"), F.col("total_events"), AS_OF_ORDERS)
    return g.select(
        F.col("o_custkey").cast("string").alias("profile_id"),
        "total_events",
        s.alias("engagement_score"),
        P.score_segment(s).alias("score_segment"),
    )
