"""Connected components of large graphs: large-star / small-star contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.skew import splittable
from tessera.session import cut_lineage, drop_table


#: Edges a task contracts at a time beside other tasks.
SLICE = 200_000
#: A graph of no more edges is finished by one task: some 300 bytes an edge of names of 30.
FOREST = 1_000_000
#: Edges a task gives out at a time.
_OUT = 20_000


def _roots(a, b, n: int):
    """For each of ``n`` nodes the smallest that edges ``(a, b)`` lead to; int arrays.

    Each root hooks to the smallest root next to it and every path is then cut short to
    its root, until no edge lies between two trees: O(log n) passes over the edges.
    """
    import numpy as np

    up = np.arange(n)
    while len(a):
        a, b = up[a], up[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := up[up], up):
            up = above
    return up


def _forest(edges: int):
    """Edges ``(u, v)`` to a spanning forest of them, ``edges`` at a time: each node with the smallest of its tree.

    Nodes are numbered in their order by Arrow, so no value becomes a Python object.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def contracted(held):
        t = pa.Table.from_batches(held)
        ends = pa.chunked_array([*t["u"].chunks, *t["v"].chunks])
        names = pc.unique(ends)
        names = names.take(pc.sort_indices(names))
        ids = pc.index_in(ends, value_set=names).to_numpy()
        root = _roots(ids[: t.num_rows], ids[t.num_rows :], len(names))
        moved = np.flatnonzero(root != np.arange(len(names)))
        for i in range(0, len(moved), _OUT):
            some = moved[i : i + _OUT]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(some)), names.take(pa.array(root[some]))], names=["u", "v"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= edges:
                yield from contracted(held)
                held, size = [], 0
        if size:
            yield from contracted(held)

    return run


def _contracted(edges: DataFrame, forest: int) -> DataFrame:
    return edges.mapInArrow(_forest(forest), edges.schema)


def star_labels(edges: DataFrame, on_round: Callable[[int], None] | None = None, forest: int = FOREST) -> DataFrame:
    """``(node, component)`` for every node of ``edges (src, dst)``; component: the smallest node reachable.

    Large-star hooks every neighbour of a node that is larger than it to the
    smallest node of its neighbourhood, small-star does so with the node itself and
    its smaller neighbours; both keep connectivity, and the rounds end when every
    edge leads to the root of its tree (O(log^2 n) rounds at most, about log n in
    practice), with no cap.  A neighbourhood is never held in one row: its minimum is
    a partial aggregate and comes back by a join, which Spark may split where one
    node has very many edges.  Each round is one job and one table in the shared
    checkpoint folder; the one before is deleted.  A round that changes nothing ends
    the loop: the driver compares the number of edges and two sums of edge hashes,
    observed on the write.

    Before the first shuffle every task contracts the edges it holds to a spanning
    forest, ``SLICE`` edges at a time (bounded memory).  Once no more than ``forest``
    edges are left, at the start or after a round, a single task does the same with
    all of them, which ends the work.
    """
    pairs = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    table, mark = _written(_contracted(pairs, min(forest, SLICE)))
    done, rounds = not mark[0], 0
    while not done:
        if mark[0] <= forest:
            new, _ = _written(_contracted(table.coalesce(1), forest + 1))
            drop_table(table)
            table = new
            break
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: (v, m) for neighbours v > u.
        large = both.where("v > u").join(splittable(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u is the larger end; its smaller neighbours and itself go to their minimum.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(splittable(least), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, now = _written(hooked.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        drop_table(table)
        table, done, mark, rounds = new, now == mark, now, rounds + 1
        if on_round:
            on_round(rounds)
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return table.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and (number, two sums of hashes) observed on the write."""
    seen = Observation()
    sums = [F.sum(F.hash("u", "v", F.lit(i)).cast("long")).alias(f"h{i}") for i in (1, 2)]
    table = cut_lineage(edges.observe(seen, F.count(F.lit(1)).alias("n"), *sums))
    got = seen.get
    return table, (got.get("n") or 0, got.get("h1"), got.get("h2"))
