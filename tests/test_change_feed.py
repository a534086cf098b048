"""S4 stream: late rows, equal times and repeats reach the sink once per (id, modified), across restarts."""

import datetime as dt
import random

from tessera.sources.changes import FEED_SCHEMA, changes_stream, deliver_changes
from tessera.streaming.pipeline import scratch_dir

T0 = dt.datetime(2024, 1, 30)


def _iso(minute):
    return (T0 + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S")


def _page(spark, path, rows):
    spark.createDataFrame([(i, m, f"{i}@{m}") for i, m in rows], FEED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _got(spark, out):
    return sorted(((r.id, r.modified) for r in spark.read.parquet(out).collect()), key=str)


def test_late_and_equal_times_once_across_restarts(spark):
    feed, out, ckpt = (scratch_dir(spark, n) for n in ("feed", "out", "ckpt"))
    polls = [
        [("a", _iso(0)), ("b", _iso(60)), ("c", _iso(60))],
        [("c", _iso(60)), ("d", _iso(60)), ("a", _iso(60))],  # the mark's own time again, one row a repeat
        [("e", _iso(20)), ("b", _iso(60))],  # only late rows and repeats: still a batch
        [("f", _iso(90)), ("e", _iso(20)), ("g", _iso(31)), (None, _iso(80))],
    ]
    seen = set()
    for rows in polls:
        _page(spark, feed, rows)
        deliver_changes(changes_stream(spark, feed), out, ckpt)  # a new query each time: a restart
        seen |= set(rows)
        assert _got(spark, out) == sorted(seen, key=str)
    deliver_changes(changes_stream(spark, feed), out, ckpt)  # nothing new
    assert _got(spark, out) == sorted(seen, key=str)


def test_random_polls(spark):
    rng = random.Random(3)
    feed, out, ckpt = (scratch_dir(spark, n) for n in ("feed", "out", "ckpt"))
    seen, now = set(), 0
    for _ in range(4):
        rows = [(f"i{rng.randrange(40)}", _iso(now + rng.randrange(-55, 30) if now else 0)) for _ in range(60)]
        now += 30
        _page(spark, feed, rows)
        deliver_changes(changes_stream(spark, feed, 2 * 3600), out, ckpt)
        seen |= set(rows)
        assert _got(spark, out) == sorted(seen, key=str)


def test_only_the_last_stretch_is_read_again(spark):
    from tessera.sources.changes import _FeedReader

    feed = scratch_dir(spark, "feed")
    reader = _FeedReader(feed, 3600)
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.initialOffset()) == []
    for k in range(5):
        _page(spark, feed, [(f"x{k}", _iso(k * 600)), ("n", None)])
    first = reader.latestOffset()
    assert first["modified"] == _iso(2400) and len(reader.partitions(reader.initialOffset(), first)) == 5
    _page(spark, feed, [("late", _iso(2390))])
    second = reader.latestOffset()
    assert second["recent"] == first["recent"] + 1 and second["id"] == first["id"]
    pages = reader.partitions(first, second)
    assert len(pages) == 2 and sorted(b["id"][0].as_py() for p in pages for b in reader.read(p)) == ["late", "x4"]
