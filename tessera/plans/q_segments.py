"""Registered queries: segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators import segments as S
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, page_markers

AS_OF_PREV = AS_OF_EVENTS - dt.timedelta(days=7)
AS_OF_PREV_SQL = "TIMESTAMP '2024-01-24 00:00:00'"


def rule_inputs_sql(as_of: str, name: str = "ri") -> str:
    return f"""{name} AS (
  SELECT student_id AS profile_id, count(*) AS total_events,
         coalesce(arg_max(lead_status, (ts, event_id)) FILTER (WHERE lead_status IS NOT NULL), 'anonymous') AS enrollment_status,
         floor((epoch_us({as_of}) - epoch_us(max(ts) FILTER (WHERE source = 'app'))) / {O.MICROS_PER_DAY}) AS days_since_last_login,
         bool_or(source = 'website' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0) AS viewed_mba_page,
         bool_or(source = 'app' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 1) AS downloaded_brochure,
         sum(value) FILTER (WHERE source = 'crm') AS purchase_value
  FROM e2 WHERE ts < {as_of} GROUP BY 1)"""


E2_SQL = f"""{O.EV},
crm AS (SELECT c_custkey, {O.LEAD_CASE} AS lead_status FROM customer),
e2 AS (SELECT ev.*, CASE WHEN ev.source = 'crm' THEN c.lead_status END AS lead_status
       FROM ev LEFT JOIN crm c ON ev.user_id = c.c_custkey)"""


def segs_sql(r: str) -> str:
    return f"""concat_ws(',',
    CASE WHEN {r}.total_events >= 3 AND {r}.enrollment_status = 'inquiry' THEN 'high_intent_prospect' END,
    CASE WHEN {r}.days_since_last_login >= 14 AND {r}.enrollment_status = 'active' THEN 'at_risk_student' END,
    CASE WHEN {r}.total_events >= 5 THEN 'engaged_learner' END,
    CASE WHEN {r}.viewed_mba_page = true AND {r}.downloaded_brochure = true THEN 'mba_interested' END)"""


def _profiles_with_segments(spark, sf_dir, as_of=AS_OF_EVENTS, rules=None):
    ev = canonical_events(spark, sf_dir, with_contact=True).filter(F.col("ts") < F.lit(as_of)).withColumnRenamed("student_id", "profile_id")
    ri = P.rule_inputs(page_markers(ev), as_of)
    return (rules or S.SegmentRules()).evaluate(ri)


A6_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF)}
SELECT profile_id, {segs_sql('ri')} AS segments FROM ri
"""


@register("a6_segment_membership", A6_SQL, "A6 P13 P15 F13: built-in rules evaluated on every profile")
def a6_segment_membership(spark, sf_dir):
    prof = _profiles_with_segments(spark, sf_dir)
    return prof.select("profile_id", F.array_join("segments", ",").alias("segments"))


K10_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF, 'rn')}, {rule_inputs_sql(AS_OF_PREV_SQL, 'rb')},
segs AS (
  SELECT coalesce(rn.profile_id, rb.profile_id) AS profile_id,
         CASE WHEN rn.profile_id IS NULL THEN [] ELSE list_filter(string_split({segs_sql('rn')}, ','), lambda x: x <> '') END AS now_s,
         CASE WHEN rb.profile_id IS NULL THEN [] ELSE list_filter(string_split({segs_sql('rb')}, ','), lambda x: x <> '') END AS before_s
  FROM rn FULL OUTER JOIN rb USING (profile_id)),
d AS (
  SELECT profile_id,
         array_to_string(list_sort(list_filter(now_s, lambda x: NOT list_contains(before_s, x))), ',') AS segments_added,
         array_to_string(list_sort(list_filter(before_s, lambda x: NOT list_contains(now_s, x))), ',') AS segments_removed
  FROM segs)
SELECT profile_id, segments_added, segments_removed, {O.ts_str(O.AS_OF)} AS timestamp
FROM d WHERE segments_added <> '' OR segments_removed <> ''
"""


@register("k10_segment_changes", K10_SQL, "K10 A6 U1: segment changes against the run 7 days earlier")
def k10_segment_changes(spark, sf_dir):
    now = _profiles_with_segments(spark, sf_dir, AS_OF_EVENTS)
    before = _profiles_with_segments(spark, sf_dir, AS_OF_PREV)
    ch = S.segment_changes(now, before, as_of=AS_OF_EVENTS)
    return ch.select(
        "profile_id",
        F.array_join("segments_added", ",").alias("segments_added"),
        F.array_join("segments_removed", ",").alias("segments_removed"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
    )


U2_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF)},
s AS (SELECT profile_id, total_events, list_filter(string_split({segs_sql('ri')}, ','), lambda x: x <> '') AS cur FROM ri),
e AS (SELECT profile_id,
             list_distinct(list_concat(cur, CASE WHEN total_events >= 70 THEN ['vip'] ELSE [] END)) AS u,
             CASE WHEN CAST(profile_id AS BIGINT) % 3 = 0 THEN ['engaged_learner'] ELSE [] END AS r
      FROM s)
SELECT profile_id, array_to_string(list_sort(list_filter(u, lambda x: NOT list_contains(r, x))), ',') AS segments FROM e
"""


@register("u2_segment_edit", U2_SQL, "U2: manual segment edit (current + add - remove, sorted)")
def u2_segment_edit(spark, sf_dir):
    prof = _profiles_with_segments(spark, sf_dir)
    add = F.when(F.col("total_events") >= 70, F.array(F.lit("vip"))).otherwise(F.array().cast("array<string>"))
    remove = F.when(F.col("profile_id").cast("bigint") % 3 == 0, F.array(F.lit("engaged_learner"))).otherwise(F.array().cast("array<string>"))
    return prof.select("profile_id", F.array_join(S.edit_segments(F.col("segments"), add, remove), ",").alias("segments"))


A7_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF)},
x AS (SELECT unnest(list_filter(string_split({segs_sql('ri')}, ','), lambda x: x <> '')) AS segment FROM ri)
SELECT segment, count(*) AS profiles FROM x GROUP BY 1
"""


@register("a7_segment_sizes", A7_SQL, "A7: profiles per segment")
def a7_segment_sizes(spark, sf_dir):
    return S.segment_sizes(_profiles_with_segments(spark, sf_dir))


P14_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF)}
SELECT profile_id FROM ri WHERE purchase_value >= 500 AND enrollment_status <> 'churned' AND enrollment_status IS NOT NULL
"""


@register("p14_custom_rule", P14_SQL, "P14 P13: rule added at run time (purchase value >= 500 and not churned)")
def p14_custom_rule(spark, sf_dir):
    rules = S.SegmentRules(builtins=False).add_rule(
        "big_spender",
        {"field": "purchase_value", "operator": ">=", "value": 500, "and": {"field": "enrollment_status", "operator": "!=", "value": "churned"}},
    )
    prof = _profiles_with_segments(spark, sf_dir, rules=rules)
    return prof.filter(F.array_contains("segments", "big_spender")).select("profile_id")


J7_SQL = f"""
WITH {E2_SQL}, {rule_inputs_sql(O.AS_OF)}
SELECT profile_id FROM ri WHERE total_events >= 5 ORDER BY profile_id LIMIT 100
"""


@register("j7_find_by_segment", J7_SQL, "J7: first 100 profiles (by id) of a segment")
def j7_find_by_segment(spark, sf_dir):
    return S.find_by_segment(_profiles_with_segments(spark, sf_dir), "engaged_learner", 100).select("profile_id")


J16_AS_OF = dt.datetime(2024, 1, 15)
J16_AS_OF_SQL = "TIMESTAMP '2024-01-15 00:00:00'"
J16_SQL = f"""
WITH {E2_SQL},
recent AS (SELECT DISTINCT student_id FROM ev WHERE source = 'website' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0
           AND ts > {J16_AS_OF_SQL} - INTERVAL 10 DAYS AND ts <= {J16_AS_OF_SQL}),
applied AS (SELECT DISTINCT student_id FROM e2 WHERE lead_status IN ('application', 'enrollment', 'active', 'alumni') AND ts <= {J16_AS_OF_SQL})
SELECT student_id AS profile_id FROM recent WHERE student_id NOT IN (SELECT student_id FROM applied)
"""


@register("j16_viewed_not_applied", J16_SQL, "J16: MBA page viewed in the window and no application (one aggregate pass)")
def j16_viewed_not_applied(spark, sf_dir):
    ev = page_markers(canonical_events(spark, sf_dir, with_contact=True))
    return S.viewed_not_applied(ev, J16_AS_OF, days=10).select(F.col("student_id").alias("profile_id"))


# P13 across types: (column, operator, literal) and whether a non-null value can satisfy it as Python compares.
TYPE_CASES = [
    ("text_no", ">=", 2, "false"), ("text_no", "==", 3, "false"), ("text_no", "!=", 3, "true"), ("text_no", "==", "3", "text_no = '3'"),
    ("total", "==", "3", "false"), ("total", "!=", "3", "true"), ("total", ">=", 60, "total >= 60"), ("total", "==", True, "total = 1"),
    ("flag", "==", True, "flag"), ("flag", "==", 1, "flag"), ("flag", ">=", 1, "flag"), ("flag", "==", "true", "false"), ("flag", "!=", 5, "true"),
    ("amount", "<", 250.5, "amount < 250.5"), ("amount", ">", "1", "false"), ("text_no", "~", "3", "false"),
]
P13_SQL = f"""
WITH {O.EV},
t AS (SELECT student_id AS profile_id, count(*) AS total, CAST(count(*) % 5 AS VARCHAR) AS text_no,
             CASE WHEN count(*) % 4 > 0 THEN count(*) % 4 = 1 END AS flag, max(value) FILTER (WHERE source = 'crm') AS amount FROM ev GROUP BY 1)
SELECT profile_id, {', '.join(f"coalesce({c} IS NOT NULL AND ({sql}), false) AS c{i}" for i, (c, _, _, sql) in enumerate(TYPE_CASES))} FROM t
"""


@register("p13_rule_types", P13_SQL, "P13: rules over text, number and boolean fields against literals of every type")
def p13_rule_types(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    n = F.count(F.lit(1))
    t = ev.groupBy(F.col("student_id").alias("profile_id")).agg(
        n.alias("total"),
        (n % 5).cast("string").alias("text_no"),
        F.when(n % 4 > 0, n % 4 == 1).alias("flag"),
        F.max(F.when(F.col("source") == "crm", F.col("value"))).alias("amount"),
    )
    return t.select("profile_id", *[S.compile_condition(c, op, v).alias(f"c{i}") for i, (c, op, v, _) in enumerate(TYPE_CASES)])
