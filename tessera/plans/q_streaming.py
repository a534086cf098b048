"""Registered queries: streaming (D1-D9, S7), each driven to completion with
``availableNow`` over a file stream laid down from the tables, and checked
against the equivalent batch SQL (stream = batch)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.profile import flatten_profile
from tessera.plans import oracle_fragments as O
from tessera.plans.q_profiles import FLAGSHIP_SQL
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events
from tessera.sources.tables import read_table
from tessera.streaming import pipeline as S

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CHUNKS = 4
FAR_FUTURE = dt.datetime(2030, 1, 1)

# The stream in SQL: events in CHUNKS batches; each resolves against the identifiers of the CRM
# contacts with an even key and of all batches before it.
VALID_EV = O.EV.replace("  FROM events)", "  FROM events WHERE event_id % 97 <> 0)")


def _resolved_sql() -> str:
    from tessera.plans.q_identity import PROF_SQL

    steps = [
        VALID_EV.replace("ev AS (", "ev0 AS (", 1),
        O.IDS.replace("ids AS (", "ids0 AS (", 1).replace("FROM ev ", "FROM ev0 "),
        PROF_SQL,
        "span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)",
        f"chunked AS (SELECT ev0.event_id, (ev0.event_id - span.lo) // ((span.hi - span.lo) // {CHUNKS} + 1) AS chunk FROM ev0, span)",
        "mins AS (SELECT event_id, min(id_type || ':' || id_value) AS min_id FROM ids0 GROUP BY 1)",
        "idx0 AS (SELECT id_type, id_value, profile_id FROM prof WHERE CAST(substr(profile_id, 2) AS BIGINT) % 2 = 0)",
    ]
    for i in range(CHUNKS):
        steps += [
            f"own{i} AS (SELECT id_type, id_value, min(profile_id) AS profile_id FROM idx{i} GROUP BY 1, 2)",
            f"hit{i} AS (SELECT event_id, arg_min(profile_id, pos) AS profile_id FROM ids0 JOIN own{i} USING (id_type, id_value) GROUP BY 1)",
            f"res{i} AS (SELECT c.event_id, c.chunk, coalesce(h.profile_id, sha256(coalesce(m.min_id, 'event:' || CAST(c.event_id AS VARCHAR)))) AS profile_id "
            f"FROM chunked c LEFT JOIN hit{i} h USING (event_id) LEFT JOIN mins m USING (event_id) WHERE c.chunk = {i})",
            f"idx{i + 1} AS (SELECT * FROM idx{i} UNION ALL SELECT id_type, id_value, profile_id FROM ids0 JOIN res{i} USING (event_id))",
        ]
    steps.append("res AS (" + " UNION ALL ".join(f"SELECT * FROM res{i}" for i in range(CHUNKS)) + ")")
    return ",\n".join(steps)


def _d1_sql() -> str:
    body = FLAGSHIP_SQL.split(O.EV + ",", 1)[1].replace(", CAST(1 AS BIGINT) AS version", "")
    a, b = body.index("cons AS ("), body.index("fi AS (")
    cons = """cons AS (
  SELECT profile_id, string_agg(channel, ',' ORDER BY channel) FILTER (WHERE ok) AS ch
  FROM (SELECT e2.student_id AS profile_id, channel, bool_and((ck * 31 + ch_idx) % 3 <> 0) AS ok
        FROM e2 CROSS JOIN channels WHERE ck % 7 <> 0 GROUP BY 1, 2) GROUP BY 1),
"""
    return f"""
WITH {_resolved_sql()},
ev AS (SELECT ev0.* REPLACE (res.profile_id AS student_id) FROM ev0 JOIN res USING (event_id)),
{body[:a]}{cons}{body[b:]}"""


def _bronze(spark, sf_dir):
    """Bronze rows with unknown sources, repeats, and a replay of old ids under dates 400 days later."""
    bronze = canonical_events(spark, sf_dir, with_invalid=True, with_duplicates=True, with_contact=True)
    last = bronze.agg(F.max("event_id")).first()[0]
    # The replay comes with the last chunk; file order goes by the _pos column.
    replay = bronze.filter((F.col("event_id") % 211 == 0) & (F.col("event_id") % 97 != 0)).withColumns(
        {"_pos": F.lit(last).cast("long"), "ts": F.col("ts") + F.make_interval(days=F.lit(400)), "event_date": F.date_add("event_date", 400)}
    )
    return bronze.withColumn("_pos", F.col("event_id")).unionByName(replay.dropDuplicates(["event_id"]))


class _CrashOnce:
    """Fails the first run of one batch after all its writes, just before the commit."""

    def __init__(self, job, batch_id: int) -> None:
        self.job, self.batch_id, self.commit, self.failed = job, batch_id, job._commit, False
        job._commit = self

    def __call__(self, batch_id, versions):
        if batch_id == self.batch_id and not self.failed:
            self.failed = True
            raise RuntimeError("crash before commit")
        self.commit(batch_id, versions)


def _stream_job(spark, sf_dir, crash_at: int = 1):
    """The profile stream over CHUNKS files, with a crash before one commit and a retry."""
    from tessera.operators.segments import SegmentRules
    from tessera.plans.q_identity import crm_master
    from tessera.sources.adapters import crm_contacts, page_markers

    bronze = _bronze(spark, sf_dir)
    src = S.scratch_dir(spark, "bronze_stream")
    files = S.write_stream_files(bronze, src, "_pos", CHUNKS)
    status = crm_contacts(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("student_id"), F.col("lead_status").alias("enrollment_status"))
    master, _ = crm_master(spark, sf_dir)
    master = master.filter(F.substring("profile_id", 2, 20).cast("bigint") % 2 == 0)
    rules = SegmentRules(builtins=False).add_rule("engaged_learner", {"field": "total_events", "operator": ">=", "value": 5})
    job = S.ProfileStreamJob(spark, S.scratch_dir(spark, "profile_job"), AS_OF_EVENTS, status=status, master=master, rules=rules, markers=page_markers, buckets=4)
    crash = _CrashOnce(job, crash_at)
    stream = lambda: S.read_event_stream(spark, src, bronze.schema, max_files=files).drop("_pos")
    try:
        job.run(stream())
    except Exception:  # noqa: BLE001 - the planned crash; anything else fails again below
        if not crash.failed:
            raise
    job.run(stream())
    return job


@register("d1_stream_profiles", _d1_sql(), "D1 D2 D3 D4 S7 A5: profile stream with identity resolution, a crash before commit and its retry")
def d1_stream_profiles(spark, sf_dir):
    return flatten_profile(_stream_job(spark, sf_dir).profiles()).drop("version")


D9_SQL = f"""
WITH {O.BRONZE}
SELECT event_id, source, count(*) AS copies FROM bronze WHERE source = 'unknown' GROUP BY 1, 2
"""


@register("d9_stream_dead_letters", D9_SQL, "D9 D4 K3: dead letters of the profile stream, each once after a crash and retry")
def d9_stream_dead_letters(spark, sf_dir):
    dlq = _stream_job(spark, sf_dir).output("dlq")
    event_id = F.get_json_object("original", "$.event_id").cast("bigint")
    return dlq.select(event_id.alias("event_id"), F.get_json_object("original", "$.source").alias("source")).groupBy("event_id", "source").agg(
        F.count(F.lit(1)).alias("copies")
    )


D4_SQL = f"""
WITH {_resolved_sql()}
SELECT res.profile_id, res.event_id, CAST(sum(count(*)) OVER (PARTITION BY res.profile_id ORDER BY res.chunk) AS BIGINT) AS snapshot_events
FROM res GROUP BY res.profile_id, res.chunk, res.event_id
"""


@register("d4_stream_staging", D4_SQL, "D4 D3 K2: staging rows of the stream: event, resolved profile and its snapshot after the batch")
def d4_stream_staging(spark, sf_dir):
    st = _stream_job(spark, sf_dir).output("staging")
    return st.select("profile_id", F.col("event.event_id").alias("event_id"), F.col("profile_snapshot.total_events").alias("snapshot_events"))


def _d7_sql():
    from tessera.plans.q_features import CHAT_DAYS, W1_SQL

    return W1_SQL.replace(f"INTERVAL {CHAT_DAYS} DAYS", "INTERVAL 30 DAYS").replace("  FROM events)", "  FROM events WHERE event_id % 97 <> 0)", 1)


@register("d7_stream_features", _d7_sql(), "D7 K13 W1: feature counts added up per micro-batch equal the batch features")
def d7_stream_features(spark, sf_dir):
    f = _stream_job(spark, sf_dir).features()
    return f.select("entity_id", "days_since_last_interaction", "whatsapp_messages_30d", "page_views_by_category", "funnel_stage", "course_completion_rate")


def _d6_sql() -> str:
    return f"""
WITH {_resolved_sql()},
per AS (SELECT profile_id, chunk, count(*) AS n FROM res GROUP BY 1, 2),
cum AS (SELECT profile_id, chunk, n, sum(n) OVER (PARTITION BY profile_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM per)
SELECT profile_id, 'engaged_learner' AS segments_added, '' AS segments_removed
FROM cum WHERE total >= 5 AND total - n < 5
"""


@register("d6_stream_segment_changes", _d6_sql(), "D6 K10 A6: segment changes emitted once by each micro-batch, across a crash and retry")
def d6_stream_segment_changes(spark, sf_dir):
    ch = _stream_job(spark, sf_dir).output("segment_changes")
    return ch.select("profile_id", F.array_join("segments_added", ",").alias("segments_added"), F.array_join("segments_removed", ",").alias("segments_removed"))


D5_SQL = "SELECT DISTINCT event_id FROM events"


@register("d5_stream_dedup", D5_SQL, "D5: dropDuplicatesWithinWatermark on event_id over a replaying stream")
def d5_stream_dedup(spark, sf_dir):
    bronze = canonical_events(spark, sf_dir, with_duplicates=True).select("event_id", "ts", "student_id", "source")
    src = S.scratch_dir(spark, "dup_stream")
    files = S.write_stream_files(bronze, src, "event_id", CHUNKS)
    out = S.run_to_table(S.dedup_stream(S.read_event_stream(spark, src, bronze.schema, files), "1 hour"))
    return out.select("event_id")


def _late_events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    # Late data: every 31st event carries a time 2 days earlier than its position in the stream.
    return e.withColumn("ts", F.when(F.col("event_id") % 31 == 0, F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts")))


def _sentinel(spark):
    """One far-future row in a last file, so that append-mode windows close (left out of results)."""
    return spark.createDataFrame([(-1, -1, FAR_FUTURE)], "event_id long, user_id long, ts timestamp")


LATE_SQL = "e AS (SELECT user_id, event_id, CASE WHEN event_id % 31 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END AS ts FROM events)"

# Spark filters late rows of a batch by the watermark that the batch before it started with.
D8W_SQL = f"""
WITH {LATE_SQL},
b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
c AS (SELECT e.*, (e.event_id - b.lo) // ((b.hi - b.lo) // {CHUNKS} + 1) AS chunk FROM e, b),
m AS (SELECT chunk, max(ts) AS mx FROM c GROUP BY chunk),
w AS (SELECT m1.chunk, (SELECT max(m2.mx) FROM m m2 WHERE m2.chunk < m1.chunk - 1) AS seen FROM m m1)
SELECT user_id, {O.ts_str("date_trunc('day', ts)")} AS window_start, count(*) AS n
FROM c JOIN w USING (chunk) WHERE seen IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > seen - INTERVAL 1 DAY GROUP BY 1, 2
"""


@register("d8_stream_daily_windows", D8W_SQL, "D8: 1-day tumbling event-time windows; rows behind a 1-day watermark are dropped")
def d8_stream_daily_windows(spark, sf_dir):
    ev = _late_events(spark, sf_dir)
    src = S.scratch_dir(spark, "late_stream")
    # One chunk per batch in event order: rows of a window that closed before their batch are dropped.
    files = S.write_stream_files(ev, src, "event_id", CHUNKS, sentinel=_sentinel(spark))
    out = S.run_to_table(S.windowed_counts(S.read_event_stream(spark, src, ev.schema, files), "user_id", "1 day", "1 day"))
    return out.filter(F.col("user_id") != -1).select("user_id", F.date_format("window_start", TS).alias("window_start"), "n")


D8S_SQL = f"""
WITH {LATE_SQL},
s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new_s
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s)
SELECT user_id, {O.ts_str('min(ts)')} AS session_start, {O.ts_str('max(ts) + INTERVAL 6 HOUR')} AS session_end, count(*) AS n
FROM g GROUP BY user_id, sid
"""


@register("d8_stream_sessions", D8S_SQL, "D8: 6-hour session windows per student over a stream with late rows")
def d8_stream_sessions(spark, sf_dir):
    ev = _late_events(spark, sf_dir)
    src = S.scratch_dir(spark, "session_stream")
    files = S.write_stream_files(ev, src, "event_id", CHUNKS, sentinel=_sentinel(spark), ordered=False)
    out = S.run_to_table(S.session_counts(S.read_event_stream(spark, src, ev.schema, files), "user_id", "40 days", "6 hours"))
    return out.filter(F.col("user_id") != -1).select(
        "user_id", F.date_format("session_start", TS).alias("session_start"), F.date_format("session_end", TS).alias("session_end"), "n"
    )


def _late_sql() -> str:
    return f"""
WITH {LATE_SQL},
b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
c AS (SELECT e.*, (e.event_id - b.lo) // ((b.hi - b.lo) // {CHUNKS} + 1) AS chunk FROM e, b),
m AS (SELECT chunk, max(ts) AS mx FROM c GROUP BY chunk),
w AS (SELECT m1.chunk, (SELECT max(m2.mx) FROM m m2 WHERE m2.chunk < m1.chunk) AS seen FROM m m1)
SELECT c.event_id, c.user_id, 'behind watermark' AS error
FROM c JOIN w USING (chunk) WHERE w.seen IS NOT NULL AND c.ts < w.seen - INTERVAL 1 DAY
"""


@register("d8_stream_late_rows", _late_sql(), "D8 D9: rows behind the watermark routed to a late-data dead-letter table")
def d8_stream_late_rows(spark, sf_dir):
    ev = _late_events(spark, sf_dir)
    src = S.scratch_dir(spark, "late_rows_stream")
    files = S.write_stream_files(ev, src, "event_id", CHUNKS)
    return S.late_rows(spark, src, ev.schema, "1 day", max_files=files).select("event_id", "user_id", "error")
