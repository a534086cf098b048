"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a sparse vector over the terms of the queries: term weight times the
document's saturated term frequency, in whole numbers.  A query is its terms' counts,
and a score is the inner product.  Each task builds ball trees over its documents.
The space is a sum of subspaces: one per term that several queries share, one for all
terms that only a certain query has.  A node knows the centroid c of its vectors and
their radius r in each subspace, so ``q.c`` plus the sum of ``|q| r`` over the
subspaces, rounded up safely, bounds every score below it: what a document says
beside the query does not widen the bound.  A query walks the tree best-first and
leaves out whatever cannot reach its tenth score; leaves are scored exactly in 64-bit
integers.  What a task has found so far prunes its later trees.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.llm.ngrams import tables
from tessera.session import cut_lineage

TOP = 10
#: Documents and vector entries of one tree, documents of a leaf, bytes of query texts handled at once: at most, about.
TREE_DOCS, TREE_ENTRIES, LEAF, QUERY_BYTES = 8192, 2_000_000, 64, 16 << 20
SCALE, B_PERCENT = 1_000_000_000, 75
#: Stands for a null id: sorts last.
NO_ID = (1 << 63) - 1
_EPS = 2.0**-52


def _counts(column, terms: dict[bytes, int], rows: int):
    """Of each text: its number of terms, and the entries (text, term, count) of the known ones, sorted."""
    total, found = np.zeros(rows, dtype=np.int64), []
    for t in tables(column):
        text = t.grams.text
        total += np.bincount(text, minlength=rows)
        known = t.value(lambda gram: terms.get(gram, -1) + 1)[t.slot]
        on = np.flatnonzero(known)
        found.append(np.unique(text[on] * (1 << 32) + known[on] - 1, return_counts=True))
    if not found:
        return total, *(np.empty(0, dtype=np.int64) for _ in range(3))
    keys = np.concatenate([k for k, _ in found])  # a long text may be in several tables
    key, place = np.unique(keys, return_inverse=True)
    count = np.bincount(place, weights=np.concatenate([c for _, c in found]), minlength=len(key)).astype(np.int64)
    return total, key >> 32, key & ((1 << 32) - 1), count


_VECTOR = "doc_id long, n long, terms array<int>, counts array<int>"


def _vectors(terms: dict[bytes, int]):
    def run(batches):
        for b in batches:
            total, text, term, count = _counts(b.column(1), terms, b.num_rows)
            ends = pa.array(np.searchsorted(text, np.arange(b.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, count)]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(total), *lists], names=["doc_id", "n", "terms", "counts"])
            yield out.filter(pa.array(total > 0))

    return run


def _holding(size: int):
    """Documents of this task that hold each term."""

    def run(batches):
        df = np.zeros(size, dtype=np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        on = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(df[on])], names=["term", "df"])

    return run


class BallTree:
    """Ball tree over sparse non-negative integer vectors (rows of a CSR matrix without empty rows, terms rising in a row).

    ``space`` numbers the subspace of each term, rising with the term.
    """

    def __init__(self, ids: np.ndarray, ends: np.ndarray, term: np.ndarray, value: np.ndarray, space: np.ndarray, leaf: int = LEAF) -> None:
        self.terms, term = np.unique(term, return_inverse=True)
        self.spaces, self._space = np.unique(space[self.terms], return_inverse=True)
        self._start, self._size = ends[:-1], np.diff(ends)
        self._term, self._value = term, value
        self._float = value.astype(float)
        self.nodes: list[list] = []  # centroid (terms, values), radii (subspaces, values), least id, children, rows of a leaf, one vector?
        self.ids, order = ids, []
        self._grow(np.arange(len(ids)), leaf, order)
        # Rows in tree order, so that a leaf is one stretch of the matrix.
        order = np.array(order, dtype=np.int64)
        at, _ = self._entries(order)
        self.ids, self._size = ids[order], self._size[order]
        self.ends = np.concatenate([[0], np.cumsum(self._size)])
        self._term, self._value = term[at], value[at]

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and where each row starts among them."""
        size = self._size[rows]
        begin = np.concatenate([[0], np.cumsum(size)])
        return np.repeat(self._start[rows] - begin[:-1], size) + np.arange(begin[-1]), begin[:-1]

    def _alike(self, rows: np.ndarray, term: np.ndarray, value: np.ndarray) -> bool:
        size = self._size[rows]
        if (size != size[0]).any():
            return False
        n = size[0]
        return bool((term.reshape(-1, n) == term[:n]).all() and (value.reshape(-1, n) == value[:n]).all())

    def _radii(self, rows: int, begin: np.ndarray, term: np.ndarray, value: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Largest distance of a row from the centroid in each subspace, rounded up."""
        space, n = self._space[term], len(self.spaces)
        new = np.ones(len(term), dtype=bool)
        new[1:] = space[1:] != space[:-1]
        new[begin] = True
        first = np.flatnonzero(new)
        here = space[first]  # a row's entries in one subspace are neighbours
        c2 = np.bincount(self._space, weights=middle**2, minlength=n)
        x2 = np.add.reduceat(value**2, first)
        cross = 2 * np.add.reduceat(value * middle[term], first)
        # Each of the three sums is off by less than (its length + 2) eps times itself: all terms are positive.
        slack = (len(middle) + 8) * _EPS
        far = np.maximum(x2 - cross + c2[here], 0.0) + slack * (x2 + cross + c2[here])
        out = np.where(np.bincount(here, minlength=n) < rows, c2 * (1 + slack), 0.0)  # rows without entries lie at 0
        np.maximum.at(out, here, far)
        return np.sqrt(out) * (1 + 8 * _EPS)

    def _halves(self, rows: np.ndarray, begin: np.ndarray, term: np.ndarray, value: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two halves by the projection on a line: through two rows far apart, then through the halves' centroids."""
        x2 = np.add.reduceat(value**2, begin)
        a = int(np.argmax(x2 - 2 * np.add.reduceat(value * middle[term], begin)))
        size, half = self._size[rows], len(rows) // 2

        def dense(i):
            out = np.zeros(len(self.terms))
            out[term[begin[i] : begin[i] + size[i]]] = value[begin[i] : begin[i] + size[i]]
            return out

        da = dense(a)
        line = da - dense(int(np.argmax(x2 - 2 * np.add.reduceat(value * da[term], begin))))
        for turn in range(3):
            by = np.argsort(np.add.reduceat(value * line[term], begin), kind="stable")
            if turn < 2:
                high = np.zeros(len(rows), dtype=bool)
                high[by[half:]] = True
                up = np.bincount(term, weights=value * np.repeat(high, size), minlength=len(self.terms))
                line = up / (len(rows) - half) - (middle * len(rows) - up) / half
        return rows[by[:half]], rows[by[half:]]

    def _grow(self, top: np.ndarray, leaf: int, order: list[int]) -> None:
        todo = [(top, None)]  # depth first, so that every node's rows are one range of ``order``
        while todo:
            rows, parent = todo.pop()
            at, begin = self._entries(rows)
            term, value = self._term[at], self._float[at]
            alike = self._alike(rows, term, value)
            if alike:
                n = self._size[rows[0]]
                held, radii = (term[:n], value[:n]), (np.empty(0, dtype=np.int64), np.empty(0))
            else:
                middle = np.bincount(term, weights=value, minlength=len(self.terms)) / len(rows)
                radius = self._radii(len(rows), begin, term, value, middle)
                on, wide = np.flatnonzero(middle), np.flatnonzero(radius)
                held, radii = (on, middle[on]), (wide, radius[wide])
            me = len(self.nodes)
            ids = self.ids[rows]
            final = alike or len(rows) <= leaf
            place = (len(order), len(order) + len(rows)) if final else None
            self.nodes.append([held, radii, int(ids.min()), [], place, alike])
            if parent is not None:
                self.nodes[parent][3].append(me)
            if final:
                order.extend(rows[np.argsort(ids, kind="stable")].tolist())
            else:
                low, high = self._halves(rows, begin, term, value, middle)
                todo += [(high, me), (low, me)]

    def query(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A query's dense counts, the same in doubles, and its length in each subspace, rounded up."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[at] == terms
        query = np.zeros(len(self.terms), dtype=np.int64)
        query[at[here]] = counts[here]
        real = query.astype(float)
        return query, real, np.sqrt(np.bincount(self._space, weights=real**2, minlength=len(self.spaces))) * (1 + (len(terms) + 8) * _EPS)

    def bound(self, node: int, real: np.ndarray, norm: np.ndarray) -> int:
        """No row of the node scores higher against the query (``query``)."""
        (term, value), (space, radius) = self.nodes[node][:2]
        most = float(value @ real[term]) + float(radius @ norm[space])
        return math.floor(most * (1 + (len(term) + len(space) + 16) * 2 * _EPS))

    def scores(self, node: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of a leaf's rows (``query`` in integers)."""
        a, b = self.nodes[node][4]
        if self.nodes[node][5]:  # one vector
            at = slice(self.ends[a], self.ends[a + 1])
            return self.ids[a:b], np.full(b - a, int((self._value[at] * query[self._term[at]]).sum()))
        at = slice(self.ends[a], self.ends[b])
        return self.ids[a:b], np.add.reduceat(self._value[at] * query[self._term[at]], self.ends[a:b] - self.ends[a])


class Best:
    """The ``k`` best of one query so far: score down, id up."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def hopeless(self, bound: int, least: int) -> bool:
        """Can no id from ``least`` up with a score up to ``bound`` get in?"""
        if bound <= 0:
            return True
        return len(self.ids) == self.k and (bound, -least) < (int(self.scores[-1]), -int(self.ids[-1]))

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        on = scores > 0
        if len(self.ids) == self.k:
            on &= scores >= self.scores[-1]
        if on.any():
            i, s = np.concatenate([self.ids, ids[on]]), np.concatenate([self.scores, scores[on]])
            order = np.lexsort((i, -s))[: self.k]
            self.ids, self.scores = i[order], s[order]


def search_tree(tree: BallTree, terms: np.ndarray, counts: np.ndarray, best: Best) -> int:
    """Walks the tree best-first for one query; gives back the number of rows scored."""
    query, real, norm = tree.query(terms, counts)
    queue, seen = [(-tree.bound(0, real, norm), 0)], 0
    while queue:
        bound, node = heapq.heappop(queue)
        _, _, least, children, rows, _ = tree.nodes[node]
        if best.hopeless(-bound, least):
            continue
        if rows:
            best.add(*tree.scores(node, query))
            seen += rows[1] - rows[0]
        for c in children:
            b = tree.bound(c, real, norm)
            if not best.hopeless(b, tree.nodes[c][2]):
                heapq.heappush(queue, (-b, c))
    return seen


def impacts(n: np.ndarray, count: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Saturated term frequencies of entries with document lengths ``n`` and counts: the contract's integers."""
    m = np.array([100 - B_PERCENT + (B_PERCENT * x * docs) // length for x in n.tolist()], dtype=np.int64)
    return (SCALE * count) // (1000 * count + 8 * m)


def _trees(batches, weight: np.ndarray, space: np.ndarray, docs: int, length: int, tree_docs: int, leaf: int):
    """Ball trees over the vectors of this task, one after the other."""
    held, size, entries = [], 0, 0
    for b in batches:
        ids, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        ends = b.column(2).offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        term, count = (b.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
        sizes = np.diff(ends)
        value = weight[term] * impacts(np.repeat(n, sizes), count, docs, length) if len(term) else count
        a = 0
        while a < len(ids):
            z = min(len(ids), a + tree_docs - size, max(a + 1, int(np.searchsorted(ends, ends[a] + TREE_ENTRIES - entries, side="right")) - 1))
            on = np.flatnonzero(sizes[a:z]) + a
            at = slice(ends[a], ends[z])
            held.append((ids[on], sizes[on], term[at], value[at]))
            size, entries, a = size + z - a, entries + int(ends[z] - ends[a]), z
            if size >= tree_docs or entries >= TREE_ENTRIES:
                yield from _tree(held, space, leaf)
                held, size, entries = [], 0, 0
    yield from _tree(held, space, leaf)


def _tree(held, space: np.ndarray, leaf: int):
    ids, sizes, term, value = (np.concatenate(x) for x in zip(*held)) if held else ([],) * 4
    if len(ids):
        yield BallTree(ids, np.concatenate([[0], np.cumsum(sizes)]), term, value, space, leaf)


def _search(queries: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray, space: np.ndarray, docs: int, length: int, top: int, tree_docs: int, leaf: int):
    def run(batches):
        best = [Best(top) for _ in queries]
        for tree in _trees(batches, weight, space, docs, length, tree_docs, leaf):
            for (_, terms, counts), b in zip(queries, best):
                search_tree(tree, terms, counts, b)
        for (q, _, _), b in zip(queries, best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.ids), q)), pa.array(b.ids), pa.array(b.scores)], names=["q", "doc_id", "score"])

    return run


def numbered_terms(items: list[tuple[int, str]]) -> tuple[dict[bytes, int], np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The terms of the items, numbered by subspace; each term's subspace; each item's ``(q, terms, counts)``."""
    column, found = pa.array([t for _, t in items], pa.large_string()), {}
    for t in tables(column):
        for i in t.owner[t.used].tolist():
            found.setdefault(t.grams.read(i), len(found))
    _, item, term, count = _counts(column, found, len(items))
    holders, owner = np.bincount(term, minlength=len(found)), np.zeros(len(found), dtype=np.int64)
    owner[term] = item
    space = np.where(holders > 1, len(items) + np.arange(len(found)), owner)
    order = np.argsort(space, kind="stable")
    number = np.empty(len(found), dtype=np.int64)
    number[order] = np.arange(len(found))
    term = number[term]
    cut = np.searchsorted(item, np.arange(len(items) + 1))
    queries = [(q, np.sort(term[a:b]), count[a:b][np.argsort(term[a:b])]) for (q, _), a, b in zip(items, cut, cut[1:]) if b > a]
    return {w: int(number[i]) for w, i in found.items()}, space[order], queries


def _block(texts: DataFrame, items, top: int, tree_docs: int, leaf: int) -> DataFrame:
    """``(q, doc_id, score)``: the best documents of each task for the items ``[(q, text)]``."""
    terms, space, queries = numbered_terms(items)
    vectors = cut_lineage(texts.mapInArrow(_vectors(terms), _VECTOR))
    sums = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
    held = np.zeros(len(terms), dtype=np.int64)
    for r in vectors.select("terms").mapInArrow(_holding(len(terms)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        held[r.term] = r.df  # a row per term of this block's queries
    weight = np.array([math.floor(1000 * math.log((2 * sums.docs + 2) / (2 * d + 1))) for d in held.tolist()], dtype=np.int64)
    return vectors.mapInArrow(_search(queries, weight, space, sums.docs, sums.length or 1, top, tree_docs, leaf), "q long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, tree_docs: int = TREE_DOCS, leaf: int = LEAF) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Null and empty texts have no terms, neither as documents (they do not count) nor as
    items (no rows).  Equal scores rank by doc_id, a null id last; repeated rows are
    documents and items of their own.  Texts of any length are read whole.  An empty
    table on either side gives an empty result; other columns are ignored.

    Items are handled in blocks of about ``QUERY_BYTES``: one pass over the documents
    for each, with the block's terms, and nothing else, on the driver and in the tasks.
    """
    texts = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of(docs).alias("text"))
    wanted = cut_lineage(items.select(F.monotonically_increasing_id().alias("q"), items["item_id"].alias("item_id"), text_of(items).alias("text")))
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    found = None
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).select("q", "text").collect()
        part = _block(texts, [(r.q, r.text) for r in rows], top, tree_docs, leaf)
        part = cut_lineage(part) if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    place = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    named = ranked.join(wanted.select("q", "item_id"), "q")
    return named.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def oracle_sql() -> str:
    """The same rows in SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
n AS (SELECT r, doc_id, len(ws) AS n FROM d WHERE len(ws) > 0),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM n),
q AS (SELECT q, item_id, w, count(*) AS c FROM (SELECT q, item_id, unnest(ws) AS w FROM (SELECT row_number() OVER () AS q, item_id, {words} AS ws FROM benchmark)) GROUP BY ALL),
tf AS (SELECT r, w, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY r, w),
wt AS (SELECT w, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), a),
v AS (SELECT tf.r, n.doc_id, tf.w, weight * (({SCALE} * tf) // (1000 * tf + 8 * ({100 - B_PERCENT} + ({B_PERCENT} * n.n * a.docs) // a.length))) AS x FROM tf JOIN n USING (r) JOIN wt USING (w), a),
s AS (SELECT q, item_id, r, doc_id, sum(c * x)::BIGINT AS score FROM q JOIN v USING (w) GROUP BY ALL HAVING sum(c * x) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
