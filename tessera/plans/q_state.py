"""Registered queries: identity and keyed state on streams (D2, D3, D7, D8, J4, J12), each across a crash and a restart."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import identity as I
from tessera.operators.features import features_from_counts
from tessera.plans import oracle_fragments as O
from tessera.plans.q_features import CHAT_DAYS, W1_SQL
from tessera.plans.q_identity import COMPONENTS_SQL, J4_SQL
from tessera.plans.q_streaming import CHUNKS, FAR_FUTURE
from tessera.plans.registry import register
from tessera.sources.adapters import AS_OF_EVENTS, canonical_events, crm_contacts, page_markers
from tessera.streaming import pipeline as S
from tessera.streaming import state as K
from tessera.streaming.identity import IdentityStream

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _source(spark, sf_dir, sentinel: bool = False):
    """The canonical events as ``CHUNKS`` chunks in event order: ``(path, schema, files of a chunk)``; an optional far-future row goes last."""
    events = canonical_events(spark, sf_dir, with_contact=True)
    path = S.scratch_dir(spark, "state_stream")
    last = None
    if sentinel:
        far = {"event_id": F.lit(-1).cast("long"), "ts": F.lit(FAR_FUTURE).cast(events.schema["ts"].dataType), "student_id": F.lit("-1")}
        last = events.limit(1).withColumns(far).select(*[F.col(f.name).cast(f.dataType) for f in events.schema])
    files = S.write_stream_files(events, path, "event_id", CHUNKS, sentinel=last)
    return path, events.schema, files


def _identity(spark, source, crash_at: int = 2) -> IdentityStream:
    """The identity stream, with a crash after all writes of one batch but before its commit, and the run after it."""
    path, schema, files = source
    job = IdentityStream(spark, S.scratch_dir(spark, "identity"))
    process = job.process

    def crash(batch, batch_id):
        process(batch, batch_id)
        if batch_id == crash_at:
            raise RuntimeError("planned crash")

    job.process = crash
    try:
        job.run(S.read_event_stream(spark, path, schema, files))
    except Exception as e:  # noqa: BLE001 - the planned crash only
        if "planned crash" not in str(e):
            raise
    job.process = process
    job.run(S.read_event_stream(spark, path, schema, files))
    return job


@register("d3_stream_identity", J4_SQL, "D3 J4: connected components kept up batch by batch, across a crash, equal the batch components")
def d3_stream_identity(spark, sf_dir):
    comp = _identity(spark, _source(spark, sf_dir)).components()
    return comp.groupBy("component").agg(F.count(F.lit(1)).alias("n_identifiers")).withColumn("profile_id", I.new_profile_id(F.col("component")))


def _merges_sql() -> str:
    steps = [
        "chunked AS (SELECT event_id, (event_id - lo) // ((hi - lo) // %d + 1) AS chunk FROM ev, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM ev))" % CHUNKS,
        "nodes AS (SELECT DISTINCT event_id, chunk, id_type || ':' || id_value AS node FROM ids JOIN chunked USING (event_id))",
    ]
    for k in range(CHUNKS):
        steps += [
            f"e{k} AS (SELECT DISTINCT a.node AS src, b.node AS dst FROM nodes a JOIN nodes b USING (event_id) WHERE a.chunk <= {k})",
            f"r{k}(src, dst) AS (SELECT src, dst FROM e{k} UNION SELECT r.src, e.dst FROM r{k} r JOIN e{k} e ON r.dst = e.src)",
            f"c{k} AS (SELECT src AS node, min(dst) AS component FROM r{k} GROUP BY src)",
        ]
    parts = " UNION ALL ".join(f"SELECT {k} AS batch, n.component, o.component AS old_component, count(*) AS old_size FROM c{k - 1} o JOIN c{k} n USING (node) GROUP BY ALL" for k in range(1, CHUNKS))
    return f"""
WITH RECURSIVE {O.EV}, {O.IDS}, {", ".join(steps)},
met AS ({parts})
SELECT batch, component, old_component, old_size FROM met QUALIFY count(*) OVER (PARTITION BY batch, component) > 1
"""


@register("d3_stream_merges", _merges_sql(), "D3 J12: audit of the components that each batch of the stream merged")
def d3_stream_merges(spark, sf_dir):
    return _identity(spark, _source(spark, sf_dir)).merges().drop("kept")


def _counts(spark, source, make, crash_event: int, **options):
    """``RunningCounts`` over a source, failing in a task at one event, then run to the end."""
    path, schema, files = source
    root = S.scratch_dir(spark, "counts")
    rows = lambda: make(S.read_event_stream(spark, path, schema, files))
    try:
        K.running_counts(rows(), root, fail_on=crash_event, **options)
    except Exception as e:  # noqa: BLE001 - the planned crash only
        if "planned crash" not in str(e):
            raise
    K.running_counts(rows(), root, **options)
    return root


def _middle(spark, source) -> int:
    return spark.read.schema(source[1]).parquet(source[0]).agg(F.expr("percentile_approx(event_id, 0.6)")).first()[0]


def _unified_sql() -> str:
    per = ", ".join(f"count(*) FILTER (WHERE ev.source = '{s}') AS {s}_events" for s in ("website", "app", "crm", "email", "whatsapp"))
    return f"""
WITH RECURSIVE {O.EV}, {O.IDS}, {COMPONENTS_SQL},
hubs AS (SELECT event_id, min(node) AS node FROM nodes GROUP BY 1),
p AS (SELECT coalesce(component, 'event:' || CAST(ev.event_id AS VARCHAR)) AS component, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS total_events, {per}
      FROM ev LEFT JOIN hubs USING (event_id) LEFT JOIN comp USING (node) GROUP BY 1)
SELECT * REPLACE ({O.ts_str('first_ts')} AS first_ts, {O.ts_str('last_ts')} AS last_ts), {O.score('last_ts', 'total_events')} AS engagement_score FROM p
"""


@register("d2_stream_unified_profiles", _unified_sql(), "D2 D3 J12 A2: profiles from keyed state, folded by the streamed components, across crashes of both streams")
def d2_stream_unified_profiles(spark, sf_dir):
    source = _source(spark, sf_dir)
    hub = lambda e: F.coalesce(F.array_min(I.valid_identifier_keys(F.col("identifiers"))), F.concat(F.lit("event:"), F.col("event_id").cast("string")))
    root = _counts(spark, source, lambda e: K.count_input(e, hub(e), F.col("source") == "whatsapp", category=F.col("source")), _middle(spark, source))
    out = K.unified_profiles(K.current_counts(spark, root), _identity(spark, source).components(), AS_OF_EVENTS)
    return out.withColumns({c: F.date_format(c, TS) for c in ("first_ts", "last_ts")})


@register("d7_state_features", W1_SQL, "D7 W1: feature counts in a RocksDB state store, across a crash, equal the batch features")
def d7_state_features(spark, sf_dir):
    source = _source(spark, sf_dir)
    a = F.lit(AS_OF_EVENTS).cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    chat = (F.col("source") == "whatsapp") & (ts > a - F.make_interval(days=F.lit(CHAT_DAYS))) & (ts <= a)
    make = lambda e: K.count_input(page_markers(e), F.col("student_id"), chat, F.col("category"), F.col("started"), F.col("completed"))
    root = _counts(spark, source, make, _middle(spark, source))
    counts = K.current_counts(spark, root).withColumnRenamed("key", "student_id")
    status = crm_contacts(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("student_id"), F.col("lead_status").alias("enrollment_status"))
    return features_from_counts(counts, AS_OF_EVENTS, status=status).select(
        "entity_id", "days_since_last_interaction", "whatsapp_messages_30d", "page_views_by_category", "funnel_stage", "course_completion_rate"
    )


IDLE_SQL = f"SELECT CAST(user_id AS VARCHAR) AS student_id, {O.ts_str('max(ts)')} AS last_ts FROM events GROUP BY 1"


@register("d8_state_idle", IDLE_SQL, "D8: event-time timers report each student idle once, 30 days after the last event by the watermark")
def d8_state_idle(spark, sf_dir):
    source = _source(spark, sf_dir, sentinel=True)
    make = lambda e: K.count_input(e, F.col("student_id"), F.col("source") == "whatsapp")
    root = _counts(spark, source, make, _middle(spark, source), idle_days=30)
    return K.idle_keys(spark, root).where("key != '-1'").select(F.col("key").alias("student_id"), F.date_format("last_ts", TS).alias("last_ts"))


A11S_SQL = f"""
WITH {O.EV}, b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM ev),
c AS (SELECT source, (event_id - lo) // ((hi - lo) // {CHUNKS} + 1) AS batch FROM ev, b)
SELECT batch, source AS counter, count(*) AS n FROM c GROUP BY ALL
"""


@register("a11_stream_counters", A11S_SQL, "A11 S7: events by source of every micro-batch, observed in the running stream and gathered by a listener")
def a11_stream_counters(spark, sf_dir):
    from tessera.streaming.metrics import CounterListener, with_counters

    path, schema, files = _source(spark, sf_dir)
    listener = CounterListener("ingested")
    spark.streams.addListener(listener)
    try:
        sources = {s: F.col("source") == s for s in ("website", "app", "crm", "email", "whatsapp")}
        S.run_to_table(with_counters(S.read_event_stream(spark, path, schema, files), "ingested", sources))
        return listener.table(spark).where("n > 0").drop("run_id")
    finally:
        spark.streams.removeListener(listener)
