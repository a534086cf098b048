"""Registered queries: identity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import identity as I
from tessera.operators import profile as P
from tessera.plans import oracle_fragments as O
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, email_of, phone_of
from tessera.sources.tables import read_table


def crm_master(spark, sf_dir):
    """Known profiles: one per CRM contact, id ``p{custkey}``, with e-mail, phone and CRM id."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    pid = F.concat(F.lit("p"), F.col("c_custkey").cast("string"))
    k = F.col("c_custkey")
    ids = c.select(
        pid.alias("profile_id"),
        F.explode(
            F.array(
                F.struct(F.lit("email").alias("id_type"), email_of(k).alias("id_value")),
                F.struct(F.lit("phone").alias("id_type"), phone_of(k).alias("id_value")),
                F.struct(F.lit("salesforce_id").alias("id_type"), F.concat(F.lit("sf_"), k.cast("string")).alias("id_value")),
            )
        ).alias("i"),
    ).select("profile_id", "i.id_type", "i.id_value")
    names = c.select(pid.alias("profile_id"), F.col("c_name").alias("name"))
    return ids, names


PROF_SQL = f"""prof AS (
  SELECT 'p' || CAST(c_custkey AS VARCHAR) AS profile_id, 'email' AS id_type, {O.email('c_custkey')} AS id_value FROM customer
  UNION ALL SELECT 'p' || CAST(c_custkey AS VARCHAR), 'phone', {O.phone('c_custkey')} FROM customer
  UNION ALL SELECT 'p' || CAST(c_custkey AS VARCHAR), 'salesforce_id', 'sf_' || CAST(c_custkey AS VARCHAR) FROM customer)"""

MASTER_SQL = PROF_SQL + """,
owner AS (SELECT id_type, id_value, min(profile_id) AS profile_id FROM prof GROUP BY 1, 2),
best AS (
  SELECT ids.event_id, arg_min(owner.profile_id, ids.pos) AS profile_id, min(ids.pos) AS match_pos
  FROM ids JOIN owner USING (id_type, id_value) GROUP BY 1)"""

J1_SQL = f"""
WITH {O.EV}, {O.IDS}, {MASTER_SQL}
SELECT ev.event_id, best.profile_id, coalesce(best.match_pos, -1) AS match_pos FROM ev LEFT JOIN best USING (event_id)
"""


@register("j1_deterministic_match", J1_SQL, "J1: first identifier (list order) that hits a known profile")
def j1_deterministic_match(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    ids, _ = crm_master(spark, sf_dir)
    hits = I.deterministic_match(I.identifier_rows(ev, "event_id"), ids)
    out = ev.select("event_id").join(hits, "event_id", "left")
    return out.select("event_id", "profile_id", F.coalesce("match_pos", F.lit(-1)).alias("match_pos"))


NAME_SCORE = "(CASE WHEN greatest(length(lower(a.c_name)), length(lower(b.c_name))) = 0 THEN 1.0 ELSE 1.0 - CAST(levenshtein(lower(a.c_name), lower(b.c_name)) AS DOUBLE) / CAST(greatest(length(lower(a.c_name)), length(lower(b.c_name))) AS DOUBLE) END)"

J2_SQL = f"""
WITH {PROF_SQL},
pairs AS (
  SELECT q.profile_id AS qid, p.profile_id, count(*) AS shared
  FROM (SELECT DISTINCT profile_id, id_value FROM prof) q JOIN (SELECT DISTINCT profile_id, id_value FROM prof) p
    ON q.id_value = p.id_value AND q.profile_id <> p.profile_id
  GROUP BY 1, 2),
sizes AS (SELECT profile_id, count(DISTINCT id_value) AS n FROM prof GROUP BY 1),
names AS (SELECT 'p' || CAST(c_custkey AS VARCHAR) AS profile_id, c_name FROM customer),
scored AS (
  SELECT pairs.qid, pairs.profile_id,
         {NAME_SCORE.replace('a.c_name', 'qa.c_name').replace('b.c_name', 'pb.c_name')} AS name_score,
         CAST(shared AS DOUBLE) / CAST(greatest(qs.n + ps.n - shared, 1) AS DOUBLE) AS overlap
  FROM pairs JOIN names qa ON qa.profile_id = pairs.qid JOIN names pb ON pb.profile_id = pairs.profile_id
       JOIN sizes qs ON qs.profile_id = pairs.qid JOIN sizes ps ON ps.profile_id = pairs.profile_id
  WHERE length(qa.c_name) > 0),
conf AS (SELECT *, 0.6 * name_score + 0.4 * overlap AS confidence FROM scored)
SELECT qid, arg_min(profile_id, (-confidence, profile_id)) AS profile_id, max(confidence) AS confidence,
       CASE WHEN max(confidence) >= 0.85 THEN 'auto_merge' ELSE 'review' END AS decision
FROM conf GROUP BY qid
"""


@register("j2_probabilistic_duplicates", J2_SQL, "J2 F6 F7 U4 T6: fuzzy duplicate candidates among CRM contacts")
def j2_probabilistic_duplicates(spark, sf_dir):
    ids, names = crm_master(spark, sf_dir)
    best = I.probabilistic_match(
        ids.select(F.col("profile_id").alias("qid"), "id_value"),
        names.select(F.col("profile_id").alias("qid"), "name"),
        ids,
        names,
        exclude_self=True,
    )
    return best.select(
        "qid",
        "profile_id",
        "confidence",
        F.when(F.col("confidence") >= 0.85, F.lit("auto_merge")).otherwise(F.lit("review")).alias("decision"),
    )


# Every third CRM event carries its identifiers under another type (J1 misses, J2 finds the
# person by value and name), every other third only the first of them (J2 stays below 0.85).
J3_SQL = f"""
WITH {O.EV}, {O.IDS.replace('ids AS', 'ids0 AS')},
ids AS (
  SELECT ids0.event_id, pos, CASE WHEN source = 'crm' AND ev.event_id % 3 < 2 THEN 'device_id' ELSE id_type END AS id_type, id_value
  FROM ids0 JOIN ev USING (event_id) WHERE NOT (source = 'crm' AND ev.event_id % 3 = 1 AND pos > 0)),
{MASTER_SQL},
mins AS (SELECT event_id, min(id_type || ':' || id_value) AS min_id FROM ids GROUP BY 1),
q AS (SELECT ev.event_id, c.c_name FROM ev JOIN customer c ON c.c_custkey = ev.user_id
      WHERE source = 'crm' AND length(c.c_name) > 0 AND event_id NOT IN (SELECT event_id FROM best)),
pairs AS (
  SELECT i.event_id, p.profile_id, count(*) AS shared
  FROM (SELECT DISTINCT event_id, id_value FROM ids JOIN q USING (event_id)) i JOIN (SELECT DISTINCT profile_id, id_value FROM prof) p USING (id_value)
  GROUP BY 1, 2),
qn AS (SELECT event_id, count(DISTINCT id_value) AS n FROM ids GROUP BY 1),
pn AS (SELECT profile_id, count(DISTINCT id_value) AS n FROM prof GROUP BY 1),
names AS (SELECT 'p' || CAST(c_custkey AS VARCHAR) AS profile_id, c_name FROM customer),
scored AS (
  SELECT pairs.event_id, pairs.profile_id,
         0.6 * {NAME_SCORE.replace('a.c_name', 'q.c_name').replace('b.c_name', 'names.c_name')}
         + 0.4 * (CAST(shared AS DOUBLE) / CAST(greatest(qn.n + pn.n - shared, 1) AS DOUBLE)) AS confidence
  FROM pairs JOIN q USING (event_id) JOIN qn USING (event_id) JOIN pn USING (profile_id) JOIN names USING (profile_id)),
j2 AS (SELECT event_id, arg_min(profile_id, (-confidence, profile_id)) AS cand, max(confidence) AS conf FROM scored GROUP BY 1)
SELECT ev.event_id,
       CASE WHEN best.profile_id IS NOT NULL THEN best.profile_id WHEN conf >= 0.85 THEN cand
            ELSE sha256(coalesce(mins.min_id, 'event:' || CAST(ev.event_id AS VARCHAR))) END AS profile_id,
       CASE WHEN best.profile_id IS NOT NULL THEN 'deterministic' WHEN conf >= 0.85 THEN 'probabilistic' ELSE 'created' END AS match_type,
       CASE WHEN best.profile_id IS NOT NULL THEN 1.0::DOUBLE ELSE conf END AS confidence,
       CASE WHEN best.profile_id IS NULL AND NOT coalesce(conf >= 0.85, false) THEN cand END AS review_candidate
FROM ev LEFT JOIN best USING (event_id) LEFT JOIN mins USING (event_id) LEFT JOIN j2 USING (event_id)
"""


def resolution_events(events):
    """Events of which two thirds of the CRM ones need the fuzzy match (see ``J3_SQL``)."""
    other = F.transform("identifiers", lambda x: F.struct(F.lit("device_id").alias("type"), x["value"].alias("value")))
    crm, third = F.col("source") == "crm", F.col("event_id") % 3
    return events.withColumn("identifiers", F.when(crm & (third == 0), other).when(crm & (third == 1), F.slice(other, 1, 1)).otherwise(F.col("identifiers")))


def resolved_events(spark, sf_dir):
    ids, names = crm_master(spark, sf_dir)
    return I.resolve(resolution_events(canonical_events(spark, sf_dir, with_contact=True)), ids, names)


@register("j3_resolve", J3_SQL, "J3: deterministic, else probabilistic >= 0.85, else created profile (all three, and review candidates)")
def j3_resolve(spark, sf_dir):
    return resolved_events(spark, sf_dir)


COMPONENTS_SQL = """nodes AS (SELECT DISTINCT event_id, id_type || ':' || id_value AS node FROM ids),
edges AS (SELECT DISTINCT a.node AS src, b.node AS dst FROM nodes a JOIN nodes b USING (event_id)),
reach(src, dst) AS (SELECT src, dst FROM edges UNION SELECT r.src, e.dst FROM reach r JOIN edges e ON r.dst = e.src),
comp AS (SELECT src AS node, min(dst) AS component FROM reach GROUP BY src)"""

J4_SQL = f"""
WITH RECURSIVE {O.EV}, {O.IDS}, {COMPONENTS_SQL}
SELECT component, count(*) AS n_identifiers, sha256(component) AS profile_id FROM comp GROUP BY component
"""


def identity_components(spark, sf_dir):
    ev = canonical_events(spark, sf_dir)
    nodes, edges = I.graph_edges(ev)
    return I.connected_components(nodes, edges)


@register("j4_identity_graph", J4_SQL, "J4: connected components of co-occurring identifiers")
def j4_identity_graph(spark, sf_dir):
    comp = identity_components(spark, sf_dir)
    return comp.groupBy("component").agg(F.count(F.lit(1)).alias("n_identifiers")).withColumn(
        "profile_id", I.new_profile_id(F.col("component"))
    )


J12_SQL = f"""
WITH RECURSIVE {O.EV}, {O.IDS}, {COMPONENTS_SQL},
canon AS (
  SELECT ev.student_id, coalesce(min(comp.component), ev.student_id) AS component
  FROM ev LEFT JOIN nodes ON nodes.event_id = ev.event_id AND ev.student_id NOT LIKE '%7' LEFT JOIN comp USING (node) GROUP BY ev.student_id),
firsts AS (
  SELECT ev.student_id, ids.id_type, arg_min(ids.id_value, (ev.ts, ev.event_id)) AS id_value
  FROM ids JOIN ev USING (event_id) GROUP BY 1, 2),
{O.CHANNELS},
crm_students AS (SELECT DISTINCT student_id FROM ev WHERE source = 'crm'),
cons AS (
  SELECT CAST(c_custkey AS VARCHAR) AS student_id, channel, ((c_custkey * 31 + ch_idx) % 3 <> 0) AS ok
  FROM customer CROSS JOIN channels
  WHERE c_custkey % 7 <> 0 AND CAST(c_custkey AS VARCHAR) IN (SELECT student_id FROM crm_students)),
members AS (SELECT component, count(*) AS members FROM canon GROUP BY 1),
nids AS (SELECT component, count(*) AS n_identifiers FROM (SELECT DISTINCT component, id_type, id_value FROM firsts JOIN canon USING (student_id)) GROUP BY 1),
chans AS (SELECT DISTINCT canon.component, cons.channel FROM cons JOIN canon USING (student_id)),
allowed AS (
  SELECT ch.component, ch.channel,
         bool_and(coalesce(c.ok, false)) AS ok
  FROM chans ch JOIN canon m ON m.component = ch.component
       LEFT JOIN cons c ON c.student_id = m.student_id AND c.channel = ch.channel
  GROUP BY 1, 2)
SELECT members.component AS canonical_id, members.members, coalesce(nids.n_identifiers, 0) AS n_identifiers,
       coalesce((SELECT string_agg(channel, ',' ORDER BY channel) FROM allowed a WHERE a.component = members.component AND a.ok), '') AS consented_channels,
       coalesce((SELECT count(*) FROM allowed a WHERE a.component = members.component), 0) AS n_channels
FROM members LEFT JOIN nids USING (component)
"""


@register("j12_merge_profiles", J12_SQL, "J12 U3 F12: profiles of one identity component merged (ids union, consent AND)")
def j12_merge_profiles(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, with_contact=True).withColumnRenamed("student_id", "profile_id")
    prof = P.build_profiles(ev, AS_OF_EVENTS)
    comp = identity_components(spark, sf_dir)
    # Students whose id ends in 7 have no mapping: they stay profiles of their own.
    first = I.smallest_identifier(ev).filter(~F.col("profile_id").endswith("7")).select("profile_id", F.col("_min_id").alias("node"))
    mapping = first.distinct().join(comp, "node").groupBy("profile_id").agg(F.min("component").alias("canonical_id"))
    merged, _ = I.merge_profiles(prof, mapping)
    return merged.select(
        "canonical_id",
        "members",
        "n_identifiers",
        F.array_join(F.array_sort(F.map_keys(F.map_filter("consent", lambda k, v: v))), ",").alias("consented_channels"),
        F.size("consent").cast("bigint").alias("n_channels"),
    )


@register("j2_probabilistic_difflib", None, "J2 F6 F7 T6: fuzzy duplicate candidates scored with the exact difflib ratio (Arrow UDF)")
def j2_probabilistic_difflib(spark, sf_dir):
    ids, names = crm_master(spark, sf_dir)
    best = I.probabilistic_match(
        ids.select(F.col("profile_id").alias("qid"), "id_value"),
        names.select(F.col("profile_id").alias("qid"), "name"),
        ids,
        names,
        exclude_self=True,
        name_mode="difflib",
    )
    return best.select("qid", "profile_id", "confidence")


# Another export of the contacts: every third with a further value, every third with one of its own only, every
# fifth name misspelt.  All share one switchboard value.
J2B_SQL = f"""
WITH p AS (
  SELECT 'p' || c_custkey AS profile_id, unnest([{O.email('c_custkey')}, {O.phone('c_custkey')}, 'sf_' || c_custkey, 'switchboard']) AS id_value FROM customer),
q AS (
  SELECT 'q' || c_custkey AS qid, unnest(CASE c_custkey % 3 WHEN 1 THEN [{O.email('c_custkey')}, 'switchboard']
    WHEN 0 THEN [{O.email('c_custkey')}, {O.phone('c_custkey')}, 'sf_' || c_custkey, 'switchboard', 'dev' || c_custkey]
    ELSE [{O.email('c_custkey')}, {O.phone('c_custkey')}, 'sf_' || c_custkey, 'switchboard'] END) AS id_value FROM customer),
names AS (SELECT 'p' || c_custkey AS profile_id, 'q' || c_custkey AS qid, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'X' || c_name ELSE c_name END AS other FROM customer),
sh AS (SELECT qid, profile_id, count(*) AS shared FROM (SELECT DISTINCT * FROM q) JOIN (SELECT DISTINCT * FROM p) USING (id_value) GROUP BY 1, 2),
qs AS (SELECT qid, count(DISTINCT id_value) AS n FROM q GROUP BY 1), ps AS (SELECT profile_id, count(DISTINCT id_value) AS n FROM p GROUP BY 1),
c AS (
  SELECT sh.qid, sh.profile_id, 0.6 * (1.0 - CAST(levenshtein(lower(a.other), lower(b.name)) AS DOUBLE) / greatest(length(a.other), length(b.name)))
         + 0.4 * (CAST(shared AS DOUBLE) / (qs.n + ps.n - shared)) AS confidence
  FROM sh JOIN qs USING (qid) JOIN ps USING (profile_id) JOIN names a ON a.qid = sh.qid JOIN names b ON b.profile_id = sh.profile_id)
SELECT qid, arg_min(profile_id, (-confidence, profile_id)) AS profile_id, max(confidence) AS confidence FROM c WHERE confidence >= 0.85 GROUP BY qid
"""


def _second_export(spark, sf_dir):
    """``(query ids, query names, profile ids, profile names)`` of two exports of the contacts."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    key = F.col("k").cast("string")
    mail, tel, sf, hub = email_of(F.col("k")), phone_of(F.col("k")), F.concat(F.lit("sf_"), key), F.lit("switchboard")
    values = F.when(F.col("k") % 3 == 1, F.array(mail, hub)).when(F.col("k") % 3 == 0, F.array(mail, tel, sf, hub, F.concat(F.lit("dev"), key))).otherwise(F.array(mail, tel, sf, hub))
    qid, pid = F.concat(F.lit("q"), key).alias("qid"), F.concat(F.lit("p"), key).alias("profile_id")
    return (
        c.select(qid, F.explode(values).alias("id_value")), c.select(qid, F.when(F.col("k") % 5 == 0, F.concat(F.lit("X"), "name")).otherwise(F.col("name")).alias("name")),
        c.select(pid, F.explode(F.array(mail, tel, sf, hub)).alias("id_value")), c.select(pid, "name"),
    )


@register("j2_bounded_match", J2B_SQL, "J2 T6: fuzzy matches of at least 0.85 from prefix, size and name-length bounds; a value shared by all makes no pairs")
def j2_bounded_match(spark, sf_dir):
    return I.bounded_match(*_second_export(spark, sf_dir)).select("qid", "profile_id", "confidence")
