"""Resampling, sharding and search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import ngrams, op11_resampling, op12_sharding, op13_search

from .helpers import lower_az, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(lower_az(text))


def grams(text, longest):
    w = words(text)
    return [" ".join(w[i : i + k]).encode() for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


# the table


@given(st.lists(st.text(alphabet="aBc é日-1\n", max_size=90), max_size=12), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_interned_grams_are_the_grams(texts, longest):
    got = [[] for _ in texts]
    for t in ngrams.tables(pa.array(texts, pa.string()), longest):
        g = t.grams
        assert g.keys().tolist() == [xxhash.xxh64_intdigest(g.read(i)) for i in range(len(g.start))]
        for i, text in enumerate(g.text.tolist()):
            assert g.read(t.owner[t.slot[i]]) == g.read(i)
            got[text].append(g.read(i))
        assert len({g.read(i) for i in t.owner[t.used]}) == len(t.used) and t.count.sum() == len(g.start)
    assert [Counter(x) for x in got] == [Counter(grams(t, longest)) for t in texts]


def test_equal_keys_are_told_apart_by_their_bytes():
    texts = [prose(1, 200), "x" * 100 + " " + "x" * 99 + "y " + "x" * 100, prose(1, 100)]
    g = next(ngrams.scan(pa.array(texts)))
    t = ngrams.InternTable(g, np.full(len(g.start), 5, dtype=np.uint64))
    assert all(g.read(t.owner[s]) == g.read(i) for i, s in enumerate(t.slot))
    assert len(t.used) == len({g.read(i) for i in range(len(g.start))})


def test_scan_in_passes(monkeypatch):
    texts = ["", prose(2, 50), "", prose(3, 400), "one", ""]
    whole = [(g.text[i], g.read(i)) for g in ngrams.scan(pa.array(texts)) for i in range(len(g.start))]
    monkeypatch.setattr(ngrams, "PASS_BYTES", 100)
    assert [(g.text[i], g.read(i)) for g in ngrams.scan(pa.array(texts)) for i in range(len(g.start))] == whole


# op11


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_against_brute_force(spark, longest):
    rng = random.Random(4)
    docs = [(i, prose(rng.randint(1, 30), rng.randint(0, 60))) for i in range(200)] + [(500, None), (501, "É " * 25), (7, prose(1, 30)), (7, prose(1, 30))]
    target = [prose(3, 80), prose(900, 60), None]
    got = op11_resampling.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), longest, 64, percent=30
    ).collect()
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(zlib.crc32(g) % 64 for g in grams(x, longest))
    for x in target:
        t.update(zlib.crc32(g) % 64 for g in grams(x, longest))
    sn, tn = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sn + 64.0) / ((s[b] + 1.0) * (tn + 64.0)))) for b in range(64)]
    want = []
    for i, x in docs:
        g = grams(x, longest)
        weight = sum(gain[zlib.crc32(y) % 64] for y in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        want.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= 20])
    fit = sorted((w for w in want if w[4]), key=lambda w: (-w[3], w[0]))
    rank = {id(w): k + 1 for k, w in enumerate(fit[: 30 * len(fit) // 100])}
    assert sorted(map(tuple, got), key=str) == sorted(((*w[:4], rank.get(id(w))) for w in want), key=str)


def test_equal_scores_rank_by_id(spark):
    rows = spark.createDataFrame([(i, i % 5 != 0, i % 3 - 2000 * (i % 2)) for i in range(100)], "doc_id long, eligible boolean, score long").repartition(4)
    got = {r.doc_id: r["rank"] for r in op11_resampling.drawn(rows, 50).collect()}
    fit = sorted((i for i in range(100) if i % 5), key=lambda i: (-(i % 3 - 2000 * (i % 2)), i))
    assert got == {i: fit.index(i) + 1 if i in fit[:40] else None for i in range(100)}


# op12


def test_place_takes_the_highest_dot_product():
    rng = np.random.default_rng(3)
    demand = rng.random((300, 3)) ** 3
    capacity = np.tile(demand.sum(axis=0) / 7, (7, 1))
    left, want = capacity.tolist(), []
    for d in demand.tolist():
        j = max(range(7), key=lambda j: (sum(a * b for a, b in zip(left[j], d)), -j))
        left[j] = [a - b for a, b in zip(left[j], d)]
        want.append(j)
    assert op12_sharding.place(demand, capacity).tolist() == want


def _balance(rows, shards=16):
    out = {}
    for m in ("size", "tokens", "rows"):
        sums = Counter({j: 0 for j in range(shards)})
        for r in rows:
            sums[r.shard] += 1 if m == "rows" else r[m]
        out[m] = max(abs(v * shards / sum(sums.values()) - 1) for v in sums.values())
    return out


def test_sharding_with_a_hot_group(spark, monkeypatch):
    rng = random.Random(5)
    docs = [(i, prose(rng.randint(1, 1500), int(rng.paretovariate(1.2) * 8) % 900)) for i in range(2400)]
    docs += [(5000 + i, "the same line in very many documents") for i in range(1200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = op12_sharding.shard_documents(df).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in docs)
    text = dict(docs)
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode())) for r in got)
    assert max(_balance(got).values()) < 0.02
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert [len(w) > 1 for t, w in where.items() if t.startswith("the same")] == [True]
    assert all(len(w) == 1 for t, w in where.items() if not t.startswith("the same"))  # other groups stay whole
    for j in range(16):
        slots = sorted(r.slot for r in got if r.shard == j)
        assert slots == list(range(len(slots)))


def test_cells_place_every_unit_once(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(1, 3000), 0, n * 10, n * 2, 1) for i in range(6000) for n in [rng.randint(1, 300)]]
    units = spark.createDataFrame(rows, "h long, size long, piece int, bytes long, tokens long, rows long").repartition(5)
    got = op12_sharding.place_units(units, cell_units=700).collect()
    assert sorted((r.h, r.size, r.bytes) for r in got) == sorted((r[0], r[1], r[3]) for r in rows)
    for m in ("bytes", "rows"):
        sums = Counter()
        for r in got:
            sums[r.shard] += r[m]
        mean = sum(sums.values()) / 16
        assert len(sums) == 16 and max(abs(v / mean - 1) for v in sums.values()) < 0.01


# op13


def _ranked(docs, items, top):
    tf = [(i, Counter(words(t))) for i, t in docs]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    n_docs, length = len(tf), sum(n for *_, n in tf)
    df = Counter(w for _, c, _ in tf for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in tf:
            m = 25 + 75 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if c[w])
            if s > 0:
                found.append((-s, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("tree_docs,leaf", [(8192, 64), (40, 3)])
def test_search_against_brute_force(spark, tree_docs, leaf):
    rng = random.Random(7)
    voc = prose(1, 150).split()
    docs = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 40)))) for i in range(300)] + [(1000 + i, " ".join(voc[:20])) for i in range(120)] + [(2000, None)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 30)))) for i in range(20)] + [(90, " ".join(voc[:20])), (91, None), (92, "unheard")]
    got = op13_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), tree_docs=tree_docs, leaf=leaf)
    assert sorted(map(tuple, got.collect())) == _ranked(docs, items, 10)


def test_search_in_blocks_of_items(spark, monkeypatch):
    docs, items = [(i, prose(i % 40, 30)) for i in range(80)], [(i, prose(i, 20)) for i in range(12)]
    monkeypatch.setattr(op13_search, "QUERY_BYTES", 400)
    got = op13_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == _ranked(docs, items, 10)


def _tree(rows, leaf, space=None):
    sizes = [len(r) for r in rows]
    term = np.array([t for r in rows for t in sorted(r)], dtype=np.int64)
    value = np.array([r[t] for r in rows for t in sorted(r)], dtype=np.int64)
    return op13_search.BallTree(np.arange(len(rows)), np.concatenate([[0], np.cumsum(sizes)]), term, value, np.arange(term.max() + 1) // 3 if space is None else space, leaf)


_VECTORS = st.lists(st.dictionaries(st.integers(0, 30), st.integers(0, 10**11), min_size=1, max_size=8), min_size=1, max_size=60)


@given(_VECTORS, st.dictionaries(st.integers(0, 40), st.integers(1, 50), min_size=1, max_size=12), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_no_row_beats_its_bounds(rows, query, leaf):
    tree = _tree(rows + rows[:3] * 4, leaf)
    dense = np.zeros(len(tree.terms), dtype=np.int64)
    for t, c in query.items():
        at = np.flatnonzero(tree.terms == t)
        dense[at] = c
    terms = np.array(sorted(query), dtype=np.int64)
    counts = np.array([query[t] for t in sorted(query)], dtype=np.int64)
    given, real, norm = tree.query(terms, counts)
    assert (given == dense).all()

    def walk(node):
        children, leaf_rows = tree.nodes[node][3:5]
        got = [walk(c) for c in children]
        best = max([m for m, _ in got], default=0)
        least = min([i for _, i in got], default=1 << 60)
        if leaf_rows:
            ids, s = tree.scores(node, dense)
            for i, x in zip(ids.tolist(), s.tolist()):
                row = (rows + rows[:3] * 4)[i]
                assert x == sum(query.get(t, 0) * v for t, v in row.items())
            best, least = int(s.max()), int(ids.min())
        assert tree.bound(node, real, norm) >= best and tree.nodes[node][2] == least
        return best, least

    walk(0)
    found = op13_search.Best(5)
    op13_search.search_tree(tree, terms, counts, found)
    want = sorted((-sum(query.get(t, 0) * v for t, v in r.items()), i) for i, r in enumerate(rows + rows[:3] * 4))
    assert list(zip((-found.scores).tolist(), found.ids.tolist())) == [(s, i) for s, i in want if s < 0][:5]


def test_the_tree_leaves_documents_out():
    rng = random.Random(8)
    rows = []
    for _ in range(40):
        topic = rng.randrange(200)
        rows += [{topic * 20 + rng.randrange(20): rng.randint(500, 1000) for _ in range(12)} for _ in range(50)]
    tree, seen = _tree(rows, 32, np.arange(4000)), 0
    for r in rows[::100]:
        seen += op13_search.search_tree(tree, np.array(sorted(r), dtype=np.int64), np.ones(len(r), dtype=np.int64), op13_search.Best(3))
    assert seen < 0.5 * len(rows) * len(rows[::100])
