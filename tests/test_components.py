"""Star contraction: long chains, hubs and many small trees, in few rounds; J12 keeps unmapped profiles."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import identity as I
from tessera.operators.components import _forest, star_labels


def _shuffled_chain(n, seed):
    names = [f"n{i:06d}" for i in range(n)]
    random.Random(seed).shuffle(names)
    return list(zip(names, names[1:])), names


@pytest.mark.parametrize("n", [500, 5000])
def test_shuffled_chain_in_few_rounds(spark, n):
    edges, names = _shuffled_chain(n, 3)
    rounds = []
    out = star_labels(spark.createDataFrame(edges, "src string, dst string"), rounds.append).collect()
    assert {r.node for r in out} == set(names)
    assert {r.component for r in out} == {min(names)}
    assert len(rounds) <= 20


@pytest.mark.parametrize("forest", [1, 40, 400])
def test_contraction_by_rounds_and_by_one_task(spark, forest):
    edges, names = _shuffled_chain(300, 5)
    edges += [(f"x{i}", f"x{i % 7}") for i in range(100)] + [("lone", "lone"), (None, "x1")]
    rounds = []
    out = {r.node: r.component for r in star_labels(spark.createDataFrame(edges, "src string, dst string").repartition(5), rounds.append, forest).collect()}
    assert out == {n: min(names) for n in names} | {f"x{i}": min(f"x{j}" for j in range(i % 7, 100, 7)) for i in range(100)}
    assert len(rounds) <= 15 and (rounds == []) == (forest == 400)


def test_hub_trees_and_repeats(spark):
    rng = random.Random(9)
    edges, up = [], {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i in range(1, 300):
        edges.append((0, i))
    for tree in range(40):
        base = 1000 + tree * 100
        edges += [(base + rng.randrange(i), base + i) for i in range(1, 1 + tree % 7 * 5)]
    edges += edges[:50] + [(b, a) for a, b in edges[50:90]] + [(5, 5), (9000, 9000)]
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in star_labels(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in up if x != 9000}


def test_no_edges(spark):
    assert star_labels(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_single_nodes_are_their_own_component(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    out = I.connected_components(nodes, spark.createDataFrame([("c", "b")], "src string, dst string"))
    assert {r.node: r.component for r in out.collect()} == {"a": "a", "b": "b", "c": "b"}


def test_merge_keeps_profiles_without_a_mapping(spark):
    ident = [("email", "x@y.z")]
    profiles = spark.createDataFrame(
        [("p1", ident, {"email": True}), ("p2", ident, {"email": False}), ("p3", [], None)],
        "profile_id string, identifiers array<struct<type:string,value:string>>, consent map<string,boolean>",
    )
    mapping = spark.createDataFrame([("p1", "c"), ("p2", "c")], "profile_id string, canonical_id string")
    merged, _ = I.merge_profiles(profiles, mapping)
    rows = {r.canonical_id: (r.members, r.n_identifiers) for r in merged.select("canonical_id", "members", "n_identifiers").collect()}
    assert rows == {"c": (2, 1), "p3": (1, 0)}
    assert merged.where(F.col("canonical_id") == "c").first().consent == {"email": False}


def _tree(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {(x, find(x)) for x in up if find(x) != x}


@pytest.mark.parametrize("kind", ["random", "rising", "falling", "hubs above their leaves", "names"])
def test_a_task_contracts_to_the_smallest_of_each_tree(kind):
    import pyarrow as pa

    rng = random.Random(kind)
    edges = {
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
        "rising": [(i, i + 1) for i in range(500)],
        "falling": [(i + 1, i) for i in range(500)],
        "hubs above their leaves": [(1000 + h, rng.randrange(300)) for h in range(40) for _ in range(9)],
        "names": [(f"é{rng.randrange(60)}" * rng.randrange(3), f"\U0001f600{rng.randrange(60)}") for _ in range(90)],
    }[kind]
    edges = [(a, b) for a, b in edges if a != b]
    rng.shuffle(edges)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*edges)], names=["u", "v"])
    out = lambda n: [x for b in _forest(n)(batch.slice(i, 7) for i in range(0, len(edges), 7)) for x in zip(*(c.to_pylist() for c in b.columns))]
    whole = out(len(edges) + 1)
    assert set(whole) == _tree(edges) and len(whole) == len(_tree(edges))
    assert _tree(out(50)) == _tree(edges)  # in slices: other edges, the same components


def test_a_graph_of_some_100000_edges_needs_no_round(spark):
    people = spark.range(130_000).select(F.col("id").cast("string").alias("p"), (F.col("id") / 2).cast("long").cast("string").alias("h"))
    edges = people.select(F.concat(F.lit("e"), "p").alias("src"), F.concat(F.lit("d"), "p").alias("dst"))
    edges = edges.unionByName(people.select(F.concat(F.lit("h"), "h").alias("src"), F.concat(F.lit("e"), "p").alias("dst")))
    rounds = []
    out = star_labels(edges.repartition(4), rounds.append)
    assert rounds == []
    sizes = out.groupBy("component").count().groupBy("count").count().collect()
    assert [tuple(r) for r in sizes] == [(5, 65_000)]
    assert out.where("substr(component, 1, 1) != 'd' OR node < component").count() == 0
