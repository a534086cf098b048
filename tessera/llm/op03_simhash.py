"""SimHash near-dedup by the generalised pigeonhole principle.

A pair within ``MAX_BITS`` differing bits must, for any split of the 64 bits into
m parts with thresholds t_i that sum to ``MAX_BITS - m + 1``, agree up to t_i bits
in at least one part (t_i = -1: the part is not probed).  Correlated bits are put
into the same part; the parts' number and unequal thresholds come from a dynamic
programme over estimated candidate counts, which in turn come from the 64 x 64
co-occurrence counts of all distinct fingerprints.  Probes meet in buckets, every
candidate is verified on all 64 bits, and a bucket gives back a spanning forest of
its links, never all pairs.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.operators.components import star_labels
from tessera.session import cut_lineage

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Fingerprints a bucket task compares at once; larger buckets are dealt out as pairs of blocks.
BLOCK = 4096
#: Relative cost of a probe (a shuffled row) and of a candidate (one 64-bit comparison).
PROBE_COST, CANDIDATE_COST = 1.0, 0.02


def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: a bit is set if it is set in over half the shingle hashes (no words: 0)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # splits at x20 and x09-x0D
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(joined[a : b - 1], 42) for a, b in zip(starts, ends[k - 1 :])], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches):
    """Columns (text, ...) -> (fp, ...): what follows the text travels on as it is."""
    for b in batches:
        fps = np.array([fingerprint(t) for t in b.column(0).to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(fps), *b.columns[1:]], names=["fp", *b.schema.names[1:]])


def _bit_counts(batches):
    """Counts of (bit i and bit j both set) over this task's fingerprints; cell 4096: their number."""
    cells, n = np.zeros((64, 64)), 0
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), 1 << 16):
            x = np.unpackbits(fps[i : i + (1 << 16)].copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            cells += x.T @ x
        n += len(fps)
    out = np.append(cells.astype(np.int64).ravel(), n)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097, dtype=np.int32)), pa.array(out)], names=["cell", "c"])


def group_bits(cells: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Split the 64 bits into ``parts`` groups of near-equal width, correlated bits together."""
    p = np.diag(cells) / max(n, 1)
    cov = cells / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    left, groups = set(range(64)), []
    for g in range(parts):
        width = 64 // parts + (g < 64 % parts)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < width:
            nxt = max(sorted(left), key=lambda b: (corr[b, group].mean(), -b))
            group.append(nxt)
            left.discard(nxt)
        groups.append(group)
    return groups


def differing_bits(cells: np.ndarray, n: int, group: list[int]) -> np.ndarray:
    """Estimated P(two fingerprints differ in exactly d bits of the group), d = 0..MAX_BITS (chain over the group)."""
    n = max(n, 1)

    def joint(a: int, b: int) -> np.ndarray:
        p11 = cells[a, b] / n
        p10, p01 = cells[a, a] / n - p11, cells[b, b] / n - p11
        p00 = max(0.0, 1 - p11 - p10 - p01)
        out = np.empty((2, 2))  # [a differs, b differs]
        out[1, 1] = 2 * (p11 * p00 + p10 * p01)
        out[1, 0] = 2 * (p11 * p01 + p10 * p00)
        out[0, 1] = 2 * (p11 * p10 + p01 * p00)
        out[0, 0] = p11**2 + p10**2 + p01**2 + p00**2
        return out

    p = cells[group[0], group[0]] / n
    dist = np.zeros((2, MAX_BITS + 1))
    dist[0, 0], dist[1, 1] = p**2 + (1 - p) ** 2, 2 * p * (1 - p)
    for a, b in zip(group, group[1:]):
        j = joint(a, b)
        j = j / np.maximum(j.sum(axis=1, keepdims=True), 1e-300)
        nxt = np.zeros_like(dist)
        nxt[0] = dist[0] * j[0, 0] + dist[1] * j[1, 0]
        nxt[1, 1:] = dist[0, :-1] * j[0, 1] + dist[1, :-1] * j[1, 1]
        dist = nxt
    return dist.sum(axis=0)


def allocate(cells: np.ndarray, n: int) -> list[tuple[list[int], int]]:
    """Parts ``(bits, threshold)`` with the least estimated cost; thresholds sum to MAX_BITS - parts + 1."""
    best, best_cost = None, math.inf
    for parts in range(2, MAX_BITS + 2):
        groups = group_bits(cells, n, parts)
        goal = MAX_BITS - parts + 1
        cost = {0: (0.0, [])}  # threshold sum so far + parts so far -> (cost, thresholds)
        for g in groups:
            near = np.cumsum(differing_bits(cells, n, g))
            nxt: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in cost.items():
                for t in range(-1, MAX_BITS + 1):
                    ball = sum(math.comb(len(g), d) for d in range(t + 1))
                    add = 0.0 if t < 0 else PROBE_COST * n * ball + CANDIDATE_COST * n * n / 2 * near[t]
                    key = used + t + 1
                    if key not in nxt or c + add < nxt[key][0]:
                        nxt[key] = (c + add, [*ts, t])
            cost = nxt
        c, ts = cost[goal + parts]
        if c < best_cost:
            best_cost, best = c, list(zip(groups, ts))
    return best


def _probes(parts):
    """Rows (part, key, fp): a fingerprint under its own key and every key within the part's threshold."""
    from itertools import combinations

    plan = []
    for i, (bits, t) in enumerate(parts):
        if t >= 0:
            masks = [sum(1 << j for j in c) for d in range(t + 1) for c in combinations(range(len(bits)), d)]
            plan.append((i, bits, np.array(masks, dtype=np.int64)))

    def run(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            u = fps.view(np.uint64)
            for i, bits, masks in plan:
                own = np.zeros(len(u), dtype=np.int64)
                for j, bit in enumerate(bits):
                    own |= ((u >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << j
                step = max(1, (1 << 20) // len(masks))
                for a in range(0, len(own), step):
                    keys = (own[a : a + step, None] ^ masks[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), i, dtype=np.int32)), pa.array(keys), pa.array(np.repeat(fps[a : a + step], len(masks)))],
                        names=["part", "key", "fp"],
                    )

    return run


class _Forest:
    """Union-find over the fingerprints of one batch of buckets."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (nxt := up.get(root, root)) != root:
            root = nxt
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self):
        return [(x, self.find(x)) for x in list(self.up) if self.find(x) != x]


def _bucket_links(batches):
    """Verified links of each bucket as a spanning forest; rows arrive sorted by bucket."""

    def links(bucket: np.ndarray, fps: np.ndarray, forest: _Forest) -> None:
        cut = np.flatnonzero(np.any(bucket[1:] != bucket[:-1], axis=1)) + 1
        edge = np.concatenate([[0], cut, [len(fps)]])
        sizes = np.diff(edge)
        u = fps.view(np.uint64)
        number = np.repeat(np.arange(len(sizes)), sizes)
        small = np.repeat(sizes <= 32, sizes)
        for off in range(1, int(min(32, sizes.max(initial=1)))):
            ok = (number[off:] == number[:-off]) & small[off:] & (np.bitwise_count(u[off:] ^ u[:-off]) <= MAX_BITS)
            for i in np.flatnonzero(ok):
                forest.link(int(fps[i]), int(fps[i + off]))
        for s in np.flatnonzero(sizes > 32):
            part = np.unique(u[edge[s] : edge[s + 1]])
            signed = part.view(np.int64).tolist()
            label = np.arange(len(part))  # links inside one label need no second look
            for i in range(len(part) - 1):
                near = np.flatnonzero((np.bitwise_count(part[i + 1 :] ^ part[i]) <= MAX_BITS) & (label[i + 1 :] != label[i])) + i + 1
                if len(near):
                    old = np.unique(label[near])
                    for j in near:
                        forest.link(signed[i], signed[j])
                    label[np.isin(label, old)] = label[i]

    def emit(forest: _Forest):
        e = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in e], pa.int64()), pa.array([b for _, b in e], pa.int64())], names=["src", "dst"])

    keep_b, keep_f = np.empty((0, 4), dtype=np.int64), np.empty(0, dtype=np.int64)
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        bucket = np.concatenate([keep_b, np.stack(cols[:4], axis=1)])
        fps = np.concatenate([keep_f, cols[4]])
        if not len(fps):
            continue
        other = np.flatnonzero(np.any(bucket != bucket[-1], axis=1))
        end = int(other[-1]) + 1 if len(other) else 0  # the last bucket may go on in the next batch
        keep_b, keep_f = bucket[end:], fps[end:]
        if end:
            links(bucket[:end], fps[:end], forest := _Forest())
            yield emit(forest)
    if len(keep_f):
        links(keep_b, keep_f, forest := _Forest())
        yield emit(forest)


def linked_fingerprints(distinct: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` that connect the distinct fingerprints ``(fp)`` as the links within MAX_BITS do."""
    counts = {r.cell: r.c for r in distinct.select("fp").mapInArrow(_bit_counts, "cell int, c long").groupBy("cell").agg(F.sum("c").alias("c")).collect()}
    n = counts.get(4096, 0)
    cells = np.array([counts.get(i, 0) for i in range(4096)], dtype=float).reshape(64, 64)
    index = distinct.select("fp").mapInArrow(_probes(allocate(cells, n)), "part int, key long, fp long")
    # Buckets over BLOCK rows (none in even data) are dealt out as pairs of blocks.
    hot = index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    hot = hot.select("part", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    j = index.join(hot, ["part", "key"], "left").withColumn("own", F.pmod(F.hash("fp"), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
        lambda o: F.struct(F.least(F.coalesce("own", F.lit(0)), o).alias("a"), F.greatest(F.coalesce("own", F.lit(0)), o).alias("b")),
    )
    dealt = j.select("part", "key", F.explode(pairs).alias("p"), "fp").select("part", "key", "p.a", "p.b", "fp")
    keys = ["part", "key", "a", "b"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(_bucket_links, "src long, dst long")


def _fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """``fp, doc_id`` and ``more`` per row, as a table."""
    src = docs.select(text_of(docs).alias("_text"), docs["doc_id"].cast("long").alias("doc_id"), *more)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    return cut_lineage(src.mapInArrow(_fingerprint_batches, f"fp long, {types}"))


def _components(distinct: DataFrame) -> DataFrame:
    """Component of each distinct fingerprint: the rows of ``distinct`` with ``component``."""
    labels = star_labels(linked_fingerprints(distinct))
    return distinct.join(labels, distinct.fp == labels.node, "left").select(*distinct.columns, F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most MAX_BITS
    differing bits.  Null and empty texts have fingerprint zero and link like any
    other.  A null doc_id takes part in links but never names a component (it is
    null only where no id is reachable).  Very long texts are hashed whole, a block
    of shingles at a time.  Repeated rows give repeated results; an empty table an
    empty one; other columns are ignored.
    """
    rows = _fingerprints(docs)
    named = _components(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = named.join(lowest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def component_keys(docs: DataFrame, content: Column) -> DataFrame:
    """``(doc_id, content)`` of the one document that stays of each component.

    It is the one with the smallest doc_id (rows without an id come after all
    others), of one id's texts the one with the least ``content``; so a component
    of rows without ids keeps one of them, and a second text under a kept id goes.
    """
    rows = _fingerprints(docs, content.alias("content"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")
    named = _components(rows.groupBy("fp").agg(F.min(order).alias("low")))
    return named.groupBy("component").agg(F.min("low").alias("low")).select("low.doc_id", "low.content")
