"""Streamed identity equals batch identity for any split; keyed state is exactly-once and costs what the batch holds."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import identity as I
from tessera.streaming import pipeline as S
from tessera.streaming import state as K
from tessera.streaming.identity import IdentityStream, last_committed

EVENTS = "event_id long, identifiers array<struct<type: string, value: string>>"


def _events(seed, n=120, people=25):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ids = [("email", f"u{rng.randrange(people)}") for _ in range(rng.choice([0, 1, 1, 2]))] + [("device_id", f"d{rng.randrange(people * 2)}") for _ in range(rng.randint(0, 2))]
        rows.append((i, ids + [("unknown", "x"), ("phone", "")][: rng.randint(0, 2)]))
    return rows


def _feed(spark, rows, cuts, root=None, job=None):
    path = S.scratch_dir(spark, "feed")
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], EVENTS).coalesce(1).write.mode("append").parquet(path)
    job = job or IdentityStream(spark, S.scratch_dir(spark, "ids"))
    job.run(S.read_event_stream(spark, path, spark.createDataFrame([], EVENTS).schema))
    return job


def _batch(spark, rows):
    nodes, edges = I.graph_edges(spark.createDataFrame(rows, EVENTS))
    out = {r.node: r.component for r in I.connected_components(nodes, edges).collect()}
    return out | {f"event:{i}": f"event:{i}" for i, ids in rows if not any(t in ("email", "device_id") for t, _ in ids)}


@pytest.mark.parametrize("cuts", [[60], [1, 2, 90]])
def test_any_split_gives_the_batch_components(spark, cuts):
    rows = _events(len(cuts))
    job = _feed(spark, rows, cuts)
    got = job.components().collect()
    assert {r.node: r.component for r in got} == _batch(spark, rows) and len(got) == len(_batch(spark, rows))
    # The record of merges: exactly the components of one batch that share a component in the next.
    want = set()
    for k in range(1, len(cuts) + 1):
        old, new = _batch(spark, rows[: cuts[k - 1]]), _batch(spark, rows[: cuts[k] if k < len(cuts) else len(rows)])
        met = {}
        for node, c in old.items():
            met.setdefault(new[node], {}).setdefault(c, set()).add(node)
        want |= {(k, n, c, len(nodes)) for n, olds in met.items() if len(olds) > 1 for c, nodes in olds.items()}
    merges = job.merges().collect()
    assert {(r.batch, r.component, r.old_component, r.old_size) for r in merges} == want and len(merges) == len(want)
    kept = [(r.batch, r.component) for r in merges if r.kept]
    assert sorted(kept) == sorted({(b, n) for b, n, *_ in want})


def test_a_merge_rewrites_the_smaller_side(spark):
    big, small = [(i, [("email", "a"), ("device_id", f"b{i}")]) for i in range(30)], [(100, [("email", "z"), ("device_id", "y")])]
    job = _feed(spark, big + small + [(200, [("email", "a"), ("email", "z")])], [30, 31])
    assert sorted(r.node for r in job.table("nodes").where("batch = 2").collect()) == ["device_id:y", "email:z"]


def test_a_batch_makes_its_graph_from_distinct_lists(spark, monkeypatch):
    from tessera.streaming import identity as ID

    seen = []
    graph = ID.graph_edges
    monkeypatch.setattr(ID, "graph_edges", lambda events: (seen.append(events.count()), graph(events))[1])
    rows = [(i, [("email", f"u{i % 3}"), ("device_id", f"d{i % 3}")] if i % 10 else [("phone", "")]) for i in range(40)] + [(40, None), (None, [])]
    job = _feed(spark, rows, [20])
    assert seen == [4, 6]  # three lists with valid identifiers, and the others: an empty value, null, no element
    got = {r.node: r.component for r in job.components().collect()}
    assert got == {f"{t}{k}": f"device_id:d{k}" for t in ("email:u", "device_id:d") for k in range(3)} | {f"event:{i}": f"event:{i}" for i in (0, 10, 20, 30, 40)}


def test_a_repeated_batch_changes_nothing(spark):
    rows = _events(9)
    job = IdentityStream(spark, S.scratch_dir(spark, "ids"))
    process, done = job.process, []

    def twice(batch, batch_id):
        process(batch, batch_id)
        done.append(batch_id)
        if done.count(batch_id) == 1 and batch_id == 1:
            process(batch, batch_id)

    job.process = twice
    _feed(spark, rows, [40, 80], job=job)
    assert {r.node: r.component for r in job.components().collect()} == _batch(spark, rows)
    assert last_committed(spark, job.checkpoint) == 2 and last_committed(spark, job.root + "/nowhere") == -1


ROWS = "event_id long, ts timestamp, student string, source string"


def _counted(spark, path, root, **options):
    stream = S.read_event_stream(spark, path, spark.createDataFrame([], ROWS).schema)
    return K.running_counts(K.count_input(stream, F.col("student"), F.col("source") == "whatsapp", F.col("source")), root, partitions=2, **options)


def test_state_goes_on_and_costs_what_the_batch_holds(spark):
    path, root = S.scratch_dir(spark, "rows"), S.scratch_dir(spark, "state")
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    some = lambda ids: ids.select(F.col("id").alias("event_id"), ts.alias("ts"), F.concat(F.lit("s"), (F.col("id") % 400).cast("string")).alias("student"), F.when(F.col("id") % 3 == 0, "whatsapp").when(F.col("id") % 3 == 1, "app").alias("source"))
    some(spark.range(2000)).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="planned crash"):
        _counted(spark, path, root, fail_on=1234)
    _counted(spark, path, root)
    some(spark.range(2000, 2003)).coalesce(1).write.mode("append").parquet(path)  # three students, known ones
    last = _counted(spark, path, root)
    moved = [p["stateOperators"][0]["numRowsUpdated"] for p in (x if isinstance(x, dict) else __import__("json").loads(x.json) for x in last.recentProgress) if p["numInputRows"]]
    assert moved == [3]  # of 1200 (student, category) states
    got = {(r.key, r.category): (r.events, r.chats, r.first_ts, r.last_ts) for r in K.current_counts(spark, root).collect()}
    want = some(spark.range(2003)).groupBy("student", "source").agg(F.count("*"), F.sum((F.col("source") == "whatsapp").cast("int")), F.min("ts"), F.max("ts")).collect()
    assert got == {(r[0], r[1]): (r[2], r[3] or 0, r[4], r[5]) for r in want}


def _odd(spark, path, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


def _current(spark, root):
    rows = K.current_counts(spark, root).select("key", "category", F.unix_seconds("first_ts"), F.unix_seconds("last_ts"), "chats", "events").collect()
    got = {tuple(r)[:2]: tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def _at(s):
    return None if s is None else datetime.datetime.fromtimestamp(s, datetime.timezone.utc)


def test_counts_without_timers_are_kept_by_the_jvm_and_no_row_is_late(spark):
    path, root = S.scratch_dir(spark, "rows"), S.scratch_dir(spark, "state")
    day, now = 86_400, 1_700_000_000
    _odd(spark, path, [(1, _at(now), "a", "app"), (2, _at(now - 5), "a", ""), (3, None, "a", None), (4, None, None, "app"), (5, _at(now), "b", "whatsapp")])
    _odd(spark, path, [(6, _at(now + 1), "c", "app")])
    _odd(spark, path, [(7, _at(now - 90 * day), "a", "app"), (7, _at(now - 90 * day), "a", "app"), (8, _at(now), None, "app"), (9, None, "b", "whatsapp")])
    last = _counted(spark, path, root)
    progress = [x if isinstance(x, dict) else json.loads(x.json) for x in last.recentProgress]
    assert {p["stateOperators"][0]["operatorName"] for p in progress} == {"stateStoreSave"}  # no state request leaves the JVM
    assert _current(spark, root) == {
        ("a", "app"): (now - 90 * day, now, 0, 3), ("a", None): (now - 5, now - 5, 0, 2), (None, "app"): (now, now, 0, 2),
        ("b", "whatsapp"): (now, now, 2, 2), ("c", "app"): (now + 1, now + 1, 0, 1),
    }


@pytest.mark.parametrize("fails", ["a state task", "after the writes"])
def test_a_batch_that_did_not_commit_counts_once(spark, monkeypatch, fails):
    path, root = S.scratch_dir(spark, "rows"), S.scratch_dir(spark, "state")
    row = lambda i: (i, _at(1_700_000_000 + i), f"s{i % 7}", "whatsapp")
    for a in (0, 40):
        _odd(spark, path, [row(i) for i in range(a, a + 40)])
    fold = lambda rows: {(f"s{k}", "whatsapp"): (1_700_000_000 + min(m), 1_700_000_000 + max(m), len(m), len(m)) for k in range(7) if (m := [i for i in rows if i % 7 == k])}
    with monkeypatch.context() as m, pytest.raises(Exception, match="planned crash"):
        if fails == "after the writes":
            write = K._write_batch(root)

            def crash(batch, batch_id):
                write(batch, batch_id)
                if batch_id == 1:
                    raise RuntimeError("planned crash")

            m.setattr(K, "_write_batch", lambda _: crash)
        _counted(spark, path, root, fail_on=55 if fails == "a state task" else None)
    assert _current(spark, root) == fold(range(40))  # what the failed batch wrote is not read
    _counted(spark, path, root)
    assert _current(spark, root) == fold(range(80))


def test_counts_kept_with_timers_equal_those_without(spark):
    path = S.scratch_dir(spark, "rows")
    for a in (0, 40):
        _odd(spark, path, [(i, _at(1_700_000_000 + i), f"s{i % 7}", ("whatsapp", "app", None)[i % 3]) for i in range(a, a + 40)])
    plain, timed = S.scratch_dir(spark, "state"), S.scratch_dir(spark, "state")
    _counted(spark, path, plain)
    _counted(spark, path, timed, idle_days=30)
    assert _current(spark, plain) == _current(spark, timed) and len(_current(spark, plain)) == 21
