"""Pruned vector search: the rows of the exact search, with most of the work left out where vectors cluster."""

import numpy as np
import pytest

from tessera.operators import vectors as V


def _clustered(seed=1, centres=24, each=60, dim=16):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(centres, dim))
    rows = [(c * each + i, (mid[c] + 0.08 * rng.normal(size=dim)).tolist(), int(c % 3)) for c in range(centres) for i in range(each)]
    rows += [(90_000 + i, rows[0][1], 0) for i in range(300)]  # a hot vector
    return rows + [(99_998, [0.0] * dim, 0), (99_999, [float("nan")] * dim, 1)]


@pytest.mark.parametrize("by,exclude_self", [(None, True), ("label", False)])
def test_pruned_equals_exact(spark, by, exclude_self):
    rows = _clustered()
    x = spark.createDataFrame(rows, "vid long, vec array<double>, label int").repartition(3)
    q = spark.createDataFrame(rows[::20] + rows[-2:], "qid long, qvec array<double>, label int")
    found = lambda df: {(r.qid, r["rank"]): (r.vid, round(r.score, 9)) for r in df.collect()}
    got, work = V.knn_pruned(q, x, 4, by=by, exclude_self=exclude_self, block_rows=100, chunk_rows=30)
    assert found(got) == found(V.knn_exact(q, x, 4, by=by, exclude_self=exclude_self))
    share = [(r.scored, r.total) for r in work.collect()]
    assert sum(s for s, _ in share) < 0.6 * sum(t for _, t in share) and {t for _, t in share} == {len(rows) - 2}


def test_nothing_to_find(spark):
    x = spark.createDataFrame([], "vid long, vec array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, qvec array<double>")
    assert V.knn_pruned(q, x)[0].count() == 0
    assert V.knn_pruned(q.limit(0), q.toDF("vid", "vec"))[0].count() == 0


@pytest.mark.parametrize("by,exclude_self", [(None, True), ("label", False)])
def test_hashed_search(spark, by, exclude_self):
    rows = _clustered()
    x = spark.createDataFrame(rows, "vid long, vec array<double>, label int").repartition(3)
    q = spark.createDataFrame(rows[::20] + rows[-2:], "qid long, qvec array<double>, label int")
    found = lambda df: {(r.qid, r["rank"]): (r.vid, round(r.score, 9)) for r in df.collect()}
    exact = V.knn_exact(q, x, 4, by=by, exclude_self=exclude_self)
    # Every bucket probed: the exact rows, the hot bucket in blocks and its queries in chunks.
    every = V.knn_lsh(q, x, 4, by=by, exclude_self=exclude_self, tables=1, bits=3, probes=8, block_rows=100, chunk_rows=30)
    assert found(every) == found(exact)
    few = V.knn_lsh(q, x, 4, by=by, exclude_self=exclude_self, tables=4, bits=6, probes=4)
    r = V.recall(few, exact).first()
    assert r.recall >= 0.95 and r.neighbours == exact.count()
    right = {(r.qid, r.vid): r.score for r in V.knn_exact(q, x, 2_000, by=by, exclude_self=exclude_self).collect()}
    got = few.collect()
    assert len({(r.qid, r.vid) for r in got}) == len(got) and all(abs(right[r.qid, r.vid] - r.score) < 1e-12 for r in got)


def test_hashed_search_finds_nothing_in_nothing(spark):
    x = spark.createDataFrame([], "vid long, vec array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid long, qvec array<double>")
    got = V.knn_lsh(q, x)
    assert got.count() == 0 and V.recall(got, got).first().recall == 1.0


def test_a_task_scores_slice_by_slice():
    """A block of any size is scored in matrices of bounded size, ties across slices by id."""
    import pandas as pd

    rng = np.random.default_rng(3)
    n = V.INDEX_SLICE + 500
    vec = [v.tolist() for v in rng.normal(size=(n, 4))]
    vec[-1] = vec[0] = vec[5]
    x = pd.DataFrame({"vid": np.arange(n)[::-1], "vec": vec})
    q = pd.DataFrame({"qid": [n - 6, 10**6], "qvec": [vec[5], vec[7]]})
    seen, plain = [], V._cosines
    V._cosines = lambda *a: seen.append((s := plain(*a)).shape) or s
    try:
        got = V._topk_block(3, True)(q, x)
    finally:
        V._cosines = plain
    assert max(s[1] for s in seen) <= V.INDEX_SLICE and len(seen) == 2
    unit = np.array(vec) / np.linalg.norm(vec, axis=1)[:, None]
    for qid, v, own in ((n - 6, 5, n - 6), (10**6, 7, -1)):
        score = dict(zip(x.vid, np.round(unit @ unit[v], 12)))
        want = sorted((-s, i) for i, s in score.items() if i != own)[:3]
        assert [(i, round(s, 12)) for i, s in got[got.qid == qid][["vid", "score"]].itertuples(index=False)] == [(i, -s) for s, i in want]


def test_pruned_search_makes_no_row_per_cluster(spark):
    """Vectors without clusters: every cluster is scored, yet a query goes once to a block."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 24)))]
    x = spark.createDataFrame(rows, "vid long, vec array<double>")
    got, _ = V.knn_pruned(x.toDF("qid", "qvec"), x, 3, exclude_self=True, block_rows=300)
    found = lambda df: {(r.qid, r["rank"]): (r.vid, round(r.score, 9)) for r in df.collect()}
    assert found(got) == found(V.knn_exact(x.toDF("qid", "qvec"), x, 3, exclude_self=True, index_blocks=2))
    assert "visits" in got._jdf.queryExecution().toString()  # the second round reads the blocks of each query, not its clusters
