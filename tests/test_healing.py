"""Digests find every difference, only differing ranges are joined, repairs leave none."""

import random

import pytest

from tessera.operators import healing as H
from tessera.operators import quality as Q
from tessera.streaming.pipeline import scratch_dir

SCHEMA = "k string, v long, w string, at long"
COLUMNS = ["v", "w", "at"]


def _stores(spark, a, b):
    paths = [scratch_dir(spark, "store_a"), scratch_dir(spark, "store_b")]
    for rows, path in zip((a, b), paths):
        H.write_store(spark.createDataFrame(rows, SCHEMA), "k", COLUMNS, path)
    return paths


def _compare(spark, paths):
    return H.compare_stores(spark, *paths, "k", SCHEMA, COLUMNS, "at")


def test_repairs_by_hand(spark):
    # Null and value swapped between columns must differ; equal times: the row of a; a null key is no profile.
    a = [("same", 1, None, 5), ("swap", 7, None, 1), ("old", 1, "x", 1), ("only_a", 2, "", None), ("no_time", 1, "p", None), (None, 9, "n", 9)]
    b = [("same", 1, None, 5), ("swap", None, "7", 1), ("old", 2, "x", 3), ("only_b", 3, None, 4), ("no_time", 2, "q", 0)]
    got = {tuple(r) for r in _compare(spark, _stores(spark, a, b))[0].collect()}
    assert got == {
        ("swap", "b", "differs", 7, None, 1), ("old", "a", "differs", 2, "x", 3), ("only_a", "b", "missing_b", 2, "", None),
        ("only_b", "a", "missing_a", 3, None, 4), ("no_time", "a", "differs", 2, "q", 0),
    }


def test_random_stores_heal_and_little_is_joined(spark):
    rng = random.Random(5)
    a = [(f"k{i}", rng.randrange(9), rng.choice([None, "u", ""]), rng.randrange(50)) for i in range(20_000)]
    b = [r for r in a if rng.random() > 0.001]
    b = [(k, v + 1, w, at + rng.choice([-1, 0, 1])) if rng.random() < 0.001 else (k, v, w, at) for k, v, w, at in b] + [(f"x{i}", 0, None, 1) for i in range(5)]
    paths = _stores(spark, a, b)
    repairs, work = _compare(spark, paths)
    repairs.cache()
    da, db = {r[0]: r for r in a}, {r[0]: r for r in b}
    assert {r.k for r in repairs.collect()} == {k for k in da.keys() | db.keys() if da.get(k) != db.get(k)}
    healed = [H.apply_repairs(H.read_store(spark, p, SCHEMA), repairs, s, "k") for p, s in zip(paths, "ab")]
    assert Q.reconcile(*healed, "k", COLUMNS).count() == 0
    assert healed[0].count() == healed[1].count() == len(da.keys() | db.keys())
    w = work.first()
    assert (w.rows_a, w.rows_b) == (len(a), len(b)) and w.joined_a + w.joined_b < 0.02 * (len(a) + len(b))
    repairs.unpersist()


def test_only_differing_folders_are_read(spark):
    a = [(f"k{i}", i, "u", 1) for i in range(3_000)]
    b = [(k, v + (k == "k7"), w, at) for k, v, w, at in a]
    repairs, _ = _compare(spark, _stores(spark, a, b))
    plan = repairs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in plan or "PartitionFilters: [(range" in plan
    assert [r.k for r in repairs.collect()] == ["k7"]


@pytest.mark.parametrize("a,b", [([], []), ([("k", 1, None, 1)], []), ([], [("k", 1, None, 1)])])
def test_empty_stores(spark, a, b):
    repairs, work = _compare(spark, _stores(spark, a, b))
    assert [r.status for r in repairs.collect()] == (["missing_b"] if a else ["missing_a"] if b else [])
    assert work.first().ranges_differing == len(a) + len(b)
