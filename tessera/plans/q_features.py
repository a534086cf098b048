"""Registered queries: features, windows, vectors and the profile text (W1-W4,
W7, P21, T4, T5, V1, A17, K12, K13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import features as W
from tessera.operators import vectors as V
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, crm_contacts, page_markers
from tessera.sources.tables import read_table

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# The test events span 30 days: windows shorter than that, so that they cut.
CHAT_DAYS, ROLL_DAYS, RATE_LIMIT, RATE_SECONDS = 12, 7, 3, 3600
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _features(spark, sf_dir, as_of=AS_OF_EVENTS):
    ev = page_markers(canonical_events(spark, sf_dir)).filter(F.col("ts") <= F.lit(as_of))
    status = crm_contacts(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("student_id"), F.col("lead_status").alias("enrollment_status"))
    return W.student_features(ev, as_of, status=status, chat_days=CHAT_DAYS)


def _features_sql(as_of: str) -> str:
    return f"""f AS (
  SELECT student_id AS entity_id,
         CAST(floor((epoch_us({as_of}) - epoch_us(max(ts))) / {O.MICROS_PER_DAY}) AS BIGINT) AS days_since_last_interaction,
         CAST(sum(CASE WHEN source = 'whatsapp' AND ts > {as_of} - INTERVAL {CHAT_DAYS} DAYS AND ts <= {as_of} THEN 1 ELSE 0 END) AS BIGINT) AS whatsapp_messages_30d,
         sum(CASE WHEN source = 'app' AND {K} % 2 = 0 THEN 1 ELSE 0 END) AS started,
         sum(CASE WHEN source = 'app' AND {K} % 4 = 0 THEN 1 ELSE 0 END) AS completed
  FROM ev WHERE ts <= {as_of} GROUP BY 1),
v AS (
  SELECT entity_id, '{{' || string_agg('"' || cat || '":' || CAST(n AS VARCHAR), ',' ORDER BY cat) || '}}' AS views
  FROM (SELECT student_id AS entity_id, 'c' || CAST({K} % 4 AS VARCHAR) AS cat, count(*) AS n FROM ev
        WHERE source = 'website' AND ts <= {as_of} GROUP BY 1, 2) GROUP BY 1),
st AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, {O.LEAD_CASE} AS funnel_stage FROM customer)"""


W1_SQL = f"""
WITH {O.EV}, {_features_sql(O.AS_OF)}
SELECT f.entity_id, f.days_since_last_interaction, f.whatsapp_messages_30d, coalesce(v.views, '{{}}') AS page_views_by_category,
       st.funnel_stage, CASE WHEN started > 0 THEN completed / started END AS course_completion_rate
FROM f LEFT JOIN v USING (entity_id) LEFT JOIN st USING (entity_id)
"""


@register("w1_student_features", W1_SQL, "W1: student feature rows (recency, chat 30 d, views by category, stage, completion)")
def w1_student_features(spark, sf_dir):
    return _features(spark, sf_dir).select(
        "entity_id", "days_since_last_interaction", "whatsapp_messages_30d", "page_views_by_category", "funnel_stage", "course_completion_rate"
    )


W2_SQL = f"""
SELECT event_id,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS rolling_sum_cents,
       count(*) OVER w AS rolling_n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / CAST(count(*) OVER w AS DOUBLE) / 100.0 AS rolling_avg
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {ROLL_DAYS} DAYS PRECEDING AND CURRENT ROW)
"""


@register("w2_rolling_average", W2_SQL, "W2: trailing average (7 days here) of an event score per student")
def w2_rolling_average(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return W.rolling_average(ev, "user_id", "ts", F.col("value"), days=ROLL_DAYS).select("event_id", "rolling_sum_cents", "rolling_n", "rolling_avg")


W3_SQL = f"""
WITH {O.EV}, {_features_sql(O.AS_OF)}
SELECT entity_id, {O.ts_str(O.AS_OF)} AS event_timestamp, days_since_last_interaction FROM f
"""


@register("w3_latest_features", W3_SQL, "W3 K13: newest feature row per entity from an appended feature table")
def w3_latest_features(spark, sf_dir):
    from tessera.sinks.writers import publish_features

    older = _features(spark, sf_dir, AS_OF_EVENTS - dt.timedelta(days=7))
    newer = _features(spark, sf_dir, AS_OF_EVENTS)
    online = publish_features(newer, older)
    latest = W.latest_features(online, None, ["days_since_last_interaction"])
    return latest.select("entity_id", F.date_format("event_timestamp", TS).alias("event_timestamp"), "days_since_last_interaction")


W4_SQL = f"""
SELECT event_id, count(*) OVER w AS calls_in_window, count(*) OVER w <= {RATE_LIMIT} AS accepted
FROM (SELECT *, 'key' || CAST(user_id % 3 AS VARCHAR) AS api_key FROM events)
WINDOW w AS (PARTITION BY api_key ORDER BY ts RANGE BETWEEN INTERVAL {RATE_SECONDS * 1_000_000 - 1} MICROSECONDS PRECEDING AND CURRENT ROW)
"""


@register("w4_rate_limit", W4_SQL, "W4: limit per window and API key (3 an hour here; the default is 1000 in 60 s)")
def w4_rate_limit(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", F.concat(F.lit("key"), (F.col("user_id") % 3).cast("string")).alias("api_key"))
    return W.rate_limit_window(ev, "api_key", "ts", RATE_LIMIT, RATE_SECONDS).select("event_id", "calls_in_window", "accepted")


W7_SQL = f"""
WITH {O.EV},
g AS (SELECT student_id, count(*) AS n_now, max(ts) AS last_now,
             count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-24 00:00:00') AS n_before,
             max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-24 00:00:00') AS last_before FROM ev GROUP BY 1),
s AS (SELECT student_id AS profile_id, {O.score('last_now', 'n_now')} AS score_now,
             {O.score('last_before', 'n_before', "TIMESTAMP '2024-01-24 00:00:00'")} AS score_before FROM g)
SELECT * FROM s WHERE score_now < score_before
"""


@register("w7_declining_engagement", W7_SQL, "W7: students whose score fell against the run 7 days earlier")
def w7_declining_engagement(spark, sf_dir):
    return W.declining_engagement(canonical_events(spark, sf_dir), AS_OF_EVENTS, AS_OF_EVENTS - dt.timedelta(days=7))


P21_SQL = f"""
WITH {O.EV},
crm AS (SELECT c_custkey, {O.LEAD_CASE} AS lead_status FROM customer),
courses AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS profile_id, string_agg(DISTINCT p.p_brand, ', ' ORDER BY p.p_brand) AS courses
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1),
g AS (SELECT student_id AS profile_id, count(*) FILTER (WHERE event_type = 'purchase') AS n,
             max(ts) FILTER (WHERE event_type = 'purchase') AS last_ts, max(user_id) AS u FROM ev GROUP BY 1),
acts AS (SELECT profile_id, string_agg(event_type, ', ' ORDER BY rn) AS actions FROM (
           SELECT student_id AS profile_id, event_type, row_number() OVER (PARTITION BY student_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev)
         WHERE rn <= 3 GROUP BY 1)
SELECT g.profile_id,
       'Student interested in ' || coalesce(courses.courses, '') || '. Engagement: ' ||
       coalesce(CAST(CASE WHEN n > 0 THEN {O.score('last_ts', 'n')} END AS VARCHAR), 'unknown') ||
       '. Stage: ' || coalesce(crm.lead_status, 'unknown') || '. Recent activity: ' || coalesce(acts.actions, '') AS summary
FROM g LEFT JOIN courses USING (profile_id) LEFT JOIN acts USING (profile_id) LEFT JOIN crm ON crm.c_custkey = g.u
"""


@register("p21_profile_text", P21_SQL, "P21: profile text summary (courses, engagement, stage, recent actions)")
def p21_profile_text(spark, sf_dir):
    from tessera.operators.profile import engagement_score

    ev = canonical_events(spark, sf_dir)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    courses = (
        o.join(li, li.l_orderkey == o.o_orderkey)
        .join(pa, pa.p_partkey == li.l_partkey)
        .select(F.col("o_custkey").cast("string").alias("profile_id"), "p_brand")
        .distinct()
        .groupBy("profile_id")
        .agg(F.array_sort(F.collect_list("p_brand")).alias("courses"))
    )
    g = ev.groupBy(F.col("student_id").alias("profile_id")).agg(
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("n"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_ts"),
    )
    acts = W.recent_actions(ev.withColumnRenamed("student_id", "profile_id"), "profile_id", 3)
    stage = crm_contacts(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("profile_id"), "lead_status")
    j = g.join(courses, "profile_id", "left").join(acts, "profile_id", "left").join(stage, "profile_id", "left")
    score = F.when(F.col("n") > 0, engagement_score(F.col("last_ts"), F.col("n"), AS_OF_EVENTS))
    return j.select("profile_id", W.profile_summary_text(F.col("courses"), score, F.col("lead_status"), F.col("actions")).alias("summary"))


def _knn_sql(filter_label: bool, exclude_self: bool) -> str:
    cond = ["true"]
    if filter_label:
        cond.append("q.label = x.label")
    if exclude_self:
        cond.append("q.vec_id <> x.vec_id")
    return f"""
WITH s AS (
  SELECT q.vec_id AS qid, x.vec_id AS vid,
         list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(x.embedding AS DOUBLE[]))
           / (sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])))
              * sqrt(list_dot_product(CAST(x.embedding AS DOUBLE[]), CAST(x.embedding AS DOUBLE[])))) AS score
  FROM embeddings q JOIN embeddings x ON {' AND '.join(cond)}),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vid) AS rank FROM s)
SELECT qid, vid, CAST(rank AS INTEGER) AS rank, floor(score * 1000000.0 + 0.5) / 1000000.0 AS score FROM r WHERE rank <= 5
"""


def _knn(spark, sf_dir, by, exclude_self):
    e = read_table(spark, sf_dir, "embeddings")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"), "label")
    x = e.select(F.col("vec_id").alias("vid"), F.col("embedding").alias("vec"), "label")
    r = V.knn_exact(q, x, 5, by=by, exclude_self=exclude_self)
    return r.select("qid", "vid", "rank", (F.floor(F.col("score") * 1e6 + 0.5) / 1e6).alias("score"))


@register("t4_search_similar", _knn_sql(True, False), "T4: exact cosine top-5 per vector within its label (filter before ranking)")
def t4_search_similar(spark, sf_dir):
    return _knn(spark, sf_dir, "label", False)


@register("t5_similar_profiles", _knn_sql(False, True), "T5: exact cosine top-5 neighbours of every vector, self excluded")
def t5_similar_profiles(spark, sf_dir):
    return _knn(spark, sf_dir, None, True)


def _pruned(spark, sf_dir, by, exclude_self):
    e = read_table(spark, sf_dir, "embeddings")
    q = e.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"), "label")
    x = e.select(F.col("vec_id").alias("vid"), F.col("embedding").alias("vec"), "label")
    r, _ = V.knn_pruned(q, x, 5, by=by, exclude_self=exclude_self)
    return r.select("qid", "vid", "rank", (F.floor(F.col("score") * 1e6 + 0.5) / 1e6).alias("score"))


@register("t4_pruned_search", _knn_sql(True, False), "T4: exact cosine top-5 within a label, clusters skipped by an angle bound")
def t4_pruned_search(spark, sf_dir):
    return _pruned(spark, sf_dir, "label", False)


@register("t5_pruned_search", _knn_sql(False, True), "T5: exact cosine top-5 neighbours, clusters skipped by an angle bound")
def t5_pruned_search(spark, sf_dir):
    return _pruned(spark, sf_dir, None, True)


def _asked(spark, sf_dir):
    """Every vector whose id is divisible by 100 as a query, and the whole table as the index."""
    e = read_table(spark, sf_dir, "embeddings")
    q = e.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    return q, e.select(F.col("vec_id").alias("vid"), F.col("embedding").alias("vec"))


@register("t4_lsh_search", None, "T4: approximate cosine top-5 by multi-probe hyperplane hashing")
def t4_lsh_search(spark, sf_dir):
    return V.knn_lsh(*_asked(spark, sf_dir), 5, exclude_self=True)


T4_RECALL_SQL = """
WITH n AS (SELECT count(*) AS total, count(*) FILTER (vec_id % 100 = 0) AS queries FROM embeddings)
SELECT queries, queries * least(5, total - 1) AS neighbours, TRUE AS nine_tenths_found FROM n
"""


@register("t4_lsh_recall", T4_RECALL_SQL, "T4: recall of the hashed search against brute force, at least 0.9")
def t4_lsh_recall(spark, sf_dir):
    q, x = _asked(spark, sf_dir)
    r = V.recall(V.knn_lsh(q, x, 5, exclude_self=True), V.knn_exact(q, x, 5, exclude_self=True))
    return r.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("nine_tenths_found"))


V1_SQL = r"""
WITH w AS (SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS w FROM conversations),
h AS (SELECT conv_id, turn, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS bucket, CASE WHEN substr(md5(w), 9, 1) < '8' THEN 1.0 ELSE -1.0 END AS s FROM w WHERE length(w) > 0),
v AS (SELECT conv_id, turn, bucket, sum(s)::DOUBLE AS v FROM h GROUP BY ALL),
n AS (SELECT conv_id, turn, sqrt(sum(v * v)) AS n FROM v GROUP BY ALL)
SELECT conv_id, turn, bucket::BIGINT AS bucket, round(v / n, 9) AS value FROM v JOIN n USING (conv_id, turn) WHERE v <> 0
"""


@register("v1_embed_texts", V1_SQL, "V1: feature-hashing embeddings of all conversation turns (distinct texts embedded once)")
def v1_embed_texts(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn").alias("id"), "text")
    e = V.hashed_embeddings(c, "id", "text", dim=64)
    return e.select("id.conv_id", "id.turn", F.posexplode("embedding").alias("b", "v")).filter(F.col("v") != 0).select(
        "conv_id", "turn", F.col("b").cast("long").alias("bucket"), F.round("v", 9).alias("value")
    )


A17_SQL = "SELECT label, count(*) AS vector_count, max(len(embedding)) AS dimension FROM embeddings GROUP BY label"


@register("a17_vector_index_stats", A17_SQL, "A17: vector count per namespace and dimension")
def a17_vector_index_stats(spark, sf_dir):
    return V.index_stats(read_table(spark, sf_dir, "embeddings"))


K12_SQL = """
SELECT vec_id, label, CASE WHEN label = 0 THEN -CAST(embedding[1] AS DOUBLE) ELSE CAST(embedding[1] AS DOUBLE) END AS first_value FROM embeddings
"""


@register("k12_upsert_vectors", K12_SQL, "K12: keyed vector upsert (updates replace rows with the same id)")
def k12_upsert_vectors(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    upd = e.filter(F.col("label") == 0).withColumn("embedding", F.transform("embedding", lambda v: -v))
    out = V.upsert_by_id(e, upd, "vec_id")
    return out.select("vec_id", "label", F.col("embedding")[0].cast("double").alias("first_value"))


@register("w4_rate_limit_exact", None, "W4: exact limiter (rejected calls do not count), streamed per key with bounded state")
def w4_rate_limit_exact(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", F.concat(F.lit("key"), (F.col("user_id") % 3).cast("string")).alias("api_key"))
    return W.rate_limit_exact(ev, "api_key", "ts", "event_id").select("event_id", "accepted")
