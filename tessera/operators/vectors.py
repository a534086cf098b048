"""Vectors: exact top-k cosine search (T4, T5), text embedding (V1), index
stats (A17) and keyed upserts (K12).

Exact search is a blocked nested-loop in the cogroup form: the index is cut
into ``index_blocks`` hash blocks, the queries into ``query_chunks``, and each
(block, chunk) pair - optionally within one metadata partition (the filter) -
is one task that scores the pair with one matrix product in numpy and emits
only its top ``k`` per query.  The final top ``k`` per query then merges at
most ``index_blocks * k`` candidates.  No (query, vector) pair ever becomes a
row, and no task holds more than one block and one chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


QUERY_SLICE, INDEX_SLICE = 256, 8_192  # queries and vectors of one matrix product inside a task (bounds task memory)


class _Best:
    """The best ``k`` of each of ``n`` queries over any number of score matrices: score descending, then vector id ascending."""

    def __init__(self, n: int, k: int, least=None) -> None:
        import numpy as np

        self.k, self.row, self.vid, self.score = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.least = np.full(n, -np.inf) if least is None else least  # no lower score can be among the best
        self.known = least is not None

    def add(self, S, vids, rows) -> None:
        """Scores of the queries ``rows`` (positions) against the vectors ``vids``; -inf: not to be found."""
        import numpy as np

        least = self.least[rows]
        if not self.known and S.shape[1] > self.k:
            least = np.maximum(least, np.partition(S, S.shape[1] - self.k, axis=1)[:, S.shape[1] - self.k])
        r, c = np.nonzero((S >= least[:, None]) & (S > -np.inf))
        if not len(r):
            return
        row, vid, score = np.concatenate([self.row, rows[r]]), np.concatenate([self.vid, vids[c]]), np.concatenate([self.score, S[r, c]])
        order = np.lexsort((vid, -score, row))
        row, vid, score = row[order], vid[order], score[order]
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
        kept = place < self.k
        last = place == self.k - 1
        self.least[row[last]] = score[last]
        self.row, self.vid, self.score = row[kept], vid[kept], score[kept]
        self.known = True


def _cosines(Q, qn, X, xn):
    import numpy as np

    with np.errstate(divide="ignore", invalid="ignore"):
        S = Q @ X.T
        S /= qn[:, None] * xn[None, :]
    S[np.isnan(S)] = -np.inf
    return S


def _matrix(column):
    import numpy as np

    m = np.vstack([np.asarray(v, dtype=np.float64) for v in column])
    return m, np.linalg.norm(m, axis=1)


def _topk_block(k: int, exclude_self: bool, bounds=None):
    """Cogroup body: the best ``k`` of a block of vectors for each query of a chunk.

    With ``bounds`` the vectors carry their ``cluster`` and the queries ``least``, a score that
    a result must reach, and the ``cluster`` that gave it: other clusters are scored where
    ``bounds(unit queries, clusters)`` reaches that score.
    """
    import numpy as np
    import pandas as pd

    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": pd.Series([], dtype="int64"), "vid": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if q.empty or x.empty:
            return empty
        if bounds:
            x = x.sort_values("cluster", kind="stable")
            cluster = x["cluster"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
            spans = [(a + i, min(a + i + INDEX_SLICE, b), j) for j, (a, b) in enumerate(zip(cuts, np.r_[cuts[1:], len(x)])) for i in range(0, b - a, INDEX_SLICE)]
        else:
            spans = [(a, min(a + INDEX_SLICE, len(x)), 0) for a in range(0, len(x), INDEX_SLICE)]
        X, xn = _matrix(x["vec"])
        vids = x["vid"].to_numpy()
        out = []
        for lo in range(0, len(q), QUERY_SLICE):
            part = q.iloc[lo : lo + QUERY_SLICE]
            Q, qn = _matrix(part["qvec"])
            qids, every = part["qid"].to_numpy(), np.arange(len(part))
            best = _Best(len(part), k, part["least"].fillna(-np.inf).to_numpy().copy() if bounds else None)
            if bounds:
                best.known = bool(np.isfinite(best.least).all())
                open_ = bounds(Q / qn[:, None], cluster[cuts]) >= best.least[:, None]
                open_ &= part["cluster"].to_numpy()[:, None] != cluster[cuts][None, :]
            for a, b, j in spans:
                rows = np.flatnonzero(open_[:, j]) if bounds else every
                if not len(rows):
                    continue
                S = _cosines(Q[rows], qn[rows], X[a:b], xn[a:b])
                if exclude_self:
                    S[qids[rows][:, None] == vids[None, a:b]] = -np.inf
                best.add(S, vids[a:b], rows)
            out.append((qids[best.row], best.vid, best.score))
        return pd.DataFrame({"qid": np.concatenate([o[0] for o in out]), "vid": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out])})

    return run


def knn_exact(
    queries: DataFrame,
    index: DataFrame,
    k: int = 5,
    by: str | None = None,
    exclude_self: bool = False,
    index_blocks: int | None = None,
    query_chunks: int | None = None,
    block_rows: int = 20_000,
    chunk_rows: int = 20_000,
) -> DataFrame:
    """T4 / T5: exact cosine top-``k``.

    ``queries (qid, qvec[, by])``, ``index (vid, vec[, by])``; with ``by`` the
    metadata filter (equality on ``by``) applies before ranking.  Returns
    ``(qid, vid, score, rank)``.  Without explicit counts, blocks and chunks are
    sized from the row counts (two scalar counts) so that a task holds at most
    about ``block_rows`` vectors and ``chunk_rows`` queries.
    """
    import math

    if index_blocks is None:
        index_blocks = max(1, math.ceil(index.count() / block_rows))
    if query_chunks is None:
        query_chunks = max(1, math.ceil(queries.count() / chunk_rows))
    keys = ([by] if by else []) + ["_blk", "_chk"]
    blocks = F.array(*[F.lit(i) for i in range(index_blocks)])
    chunks = F.array(*[F.lit(i) for i in range(query_chunks)])
    # Both sides must carry the grouping keys with identical types, or the two
    # hash partitionings disagree and groups never meet.
    q = queries.select("qid", "qvec", *([by] if by else [])).withColumn(
        "_chk", F.pmod(F.xxhash64("qid"), F.lit(query_chunks)).cast("int")
    ).withColumn("_blk", F.explode(blocks))
    x = index.select("vid", "vec", *([by] if by else [])).withColumn(
        "_blk", F.pmod(F.xxhash64("vid"), F.lit(index_blocks)).cast("int")
    ).withColumn("_chk", F.explode(chunks))
    cand = q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInPandas(_topk_block(k, exclude_self), "qid long, vid long, score double")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("vid").asc())
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


#: Pivots at most: they and their angles are all that goes through the driver.
MOST_PIVOTS = 4096
#: Taken off every angle: many times the error of two arc cosines of rounded dot products near 1 (about 1e-7 at 64 dimensions).
_ANGLE_SLACK = 1e-5


def _units(column) -> tuple:
    """Unit vectors of a column of arrays and whether each has a direction (no zero, no null, no NaN)."""
    import numpy as np

    raw = np.vstack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.empty((0, 1))
    norm = np.linalg.norm(raw, axis=1)
    ok = np.isfinite(norm) & (norm > 0)
    return raw / np.where(ok, norm, 1.0)[:, None], ok


def pivot_index(index: DataFrame, pivots: int | None = None, by: str | None = None):
    """Clusters of an index ``(vid, vec[, by])``: ``(index with cluster, pivot vectors, widest angle per cluster)``.

    Pivots are vectors picked by a hash of their id, about the square root of the
    number of vectors (``MOST_PIVOTS`` at most); every vector joins the pivot of the
    smallest angle.  Vectors without a direction are left out: they have no cosine.
    """
    import math

    import numpy as np
    import pandas as pd

    from tessera.session import cut_lineage

    n = index.count()
    want = max(1, min(MOST_PIVOTS, pivots or math.isqrt(max(n, 1))))
    picked = index.where(F.pmod(F.xxhash64(F.lit(7), "vid"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * want / max(n, 1)))).select("vid", "vec")
    rows = picked.orderBy(F.xxhash64(F.lit(7), "vid"), "vid").limit(want).collect()  # bounded
    centre, ok = _units([r.vec for r in rows])
    centre = centre[ok] if ok.any() else np.zeros((0, 1))

    def assign(batches):
        for pdf in batches:
            unit, good = _units(pdf["vec"])
            if not len(centre) or not good.any():
                continue
            part, unit = pdf[good], unit[good]
            for lo in range(0, len(part), QUERY_SLICE):
                cos = unit[lo : lo + QUERY_SLICE] @ centre.T
                best = cos.argmax(axis=1)
                angle = np.arccos(np.clip(cos[np.arange(len(best)), best], -1.0, 1.0))
                yield part.iloc[lo : lo + QUERY_SLICE].assign(cluster=best.astype("int32"), angle=angle)

    fields = ", ".join(f"{c} {t}" for c, t in index.select("vid", "vec", *([by] if by else [])).dtypes)
    out = cut_lineage(index.select("vid", "vec", *([by] if by else [])).mapInPandas(assign, f"{fields}, cluster int, angle double"))
    width, size = np.full(len(centre), -1.0), np.zeros(len(centre), dtype=np.int64)
    for r in out.groupBy("cluster").agg(F.max("angle").alias("a"), F.count(F.lit(1)).alias("n")).collect():  # a row per pivot
        width[r.cluster], size[r.cluster] = r.a, r.n
    return out.drop("angle"), centre, width, size


def knn_pruned(
    queries: DataFrame, index: DataFrame, k: int = 5, by: str | None = None, exclude_self: bool = False, pivots: int | None = None, block_rows: int = 20_000, chunk_rows: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """T4 / T5: exact cosine top-``k`` that skips clusters which cannot hold a result.

    For a query at angle a from a pivot whose cluster is w wide, no vector of the
    cluster has a cosine over ``cos(max(0, a - w))``.  Each query first scores the
    nearest cluster; its k-th score there is the least that a result can have, and only
    clusters whose bound (rounded up) reaches it are scored as well.  For that, clusters
    lie together in blocks of about ``block_rows`` vectors, a larger one in several: a
    query goes once to each block with a cluster to score, whatever their number, and the
    task leaves out the others.  No (query, vector) or (query, cluster) pair is ever a row.

    Returns ``(result, work)``: ``(qid, vid, score, rank)`` as ``knn_exact`` gives, and
    ``(qid, scored, total)``, the vectors that the bound left to score for each query
    and all there are.
    """
    import numpy as np

    from tessera.session import cut_lineage

    held, centre, width, size = pivot_index(index, pivots, by)
    total = int(size.sum())
    extra = [by] if by else []
    q = queries.select("qid", "qvec", *extra)
    fields = ", ".join(f"{c} {t}" for c, t in q.dtypes)
    chunks = max(1, -(-q.count() // chunk_rows))

    # Blocks: pivots next to each other (by the nearest of a few of them) until a block is full.
    parts, first_block = np.maximum(1, -(-size // block_rows)), np.zeros(len(centre), dtype=np.int64)
    few = centre[: max(1, total // block_rows)]
    block = filled = 0
    for c in np.argsort((centre @ few.T).argmax(axis=1), kind="stable") if len(centre) else []:
        if filled and filled + size[c] > block_rows:
            block, filled = block + 1, 0
        first_block[c] = block
        block, filled = (block + int(parts[c]), 0) if parts[c] > 1 else (block, filled + int(size[c]))

    def bounds(unit, clusters=slice(None)):
        angle = np.arccos(np.clip(unit @ centre[clusters].T, -1.0, 1.0))
        return np.cos(np.maximum(0.0, angle - width[clusters][None, :] - _ANGLE_SLACK)) + 1e-12

    def nearest(batches):
        for pdf in batches:
            unit, good = _units(pdf["qvec"])
            if not len(centre) or not good.any():
                continue
            part, unit = pdf[good], unit[good]
            for lo in range(0, len(part), QUERY_SLICE):
                near = np.where(width[None, :] < 0, -2.0, unit[lo : lo + QUERY_SLICE] @ centre.T).argmax(axis=1)
                yield part.iloc[lo : lo + QUERY_SLICE].assign(cluster=near.astype("int32"))

    def opened(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), QUERY_SLICE):
                part = pdf.iloc[lo : lo + QUERY_SLICE]
                near = part["cluster"].to_numpy()
                open_ = (bounds(_units(part["qvec"])[0]) >= part["least"].fillna(-2.0).to_numpy()[:, None]) & (width[None, :] >= 0)
                open_[np.arange(len(part)), near] = False
                visits = [np.unique(np.concatenate([first_block[o], *(np.arange(first_block[c], first_block[c] + parts[c]) for c in np.flatnonzero(o & (parts > 1)))])).astype("int32") for o in open_]
                yield part.assign(scored=open_ @ size + size[near], visits=visits)

    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("cluster") + 1) if len(values) else F.lit(1)
    share = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    out = "qid long, vid long, score double"
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("vid").asc()))

    # The nearest cluster of each query: its vectors in parts, its queries in chunks.
    first = cut_lineage(q.mapInPandas(nearest, f"{fields}, cluster int"))
    near = np.zeros(len(centre), dtype=np.int64)
    for r in first.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per pivot
        near[r.cluster] = -(-r.n // chunk_rows)
    keys = [*extra, "cluster", "_blk", "_chk"]
    asked = first.withColumn("_chk", share("qid", pick(near))).withColumn("_blk", each(pick(parts)))
    here = held.withColumn("_n", pick(near)).where("_n > 0").withColumn("_blk", share("vid", pick(parts))).withColumn("_chk", each(F.col("_n"))).drop("_n")
    found = asked.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(_topk_block(k, exclude_self), out)
    found = cut_lineage(found.withColumn("rank", rank).where(F.col("rank") <= k))

    # The blocks that hold a cluster whose bound reaches the k-th score of the nearest one.
    least = found.where(F.col("rank") == k).select("qid", F.col("score").alias("least"))
    todo = cut_lineage(first.join(least, "qid", "left").mapInPandas(opened, f"{fields}, cluster int, least double, scored long, visits array<int>"))
    keys = [*extra, "_blk", "_chk"]
    asked = todo.drop("scored").withColumn("_blk", F.explode("visits")).drop("visits").withColumn("_chk", share("qid", F.lit(chunks)))
    here = held.withColumn("_blk", (pick(first_block) + share("vid", pick(parts))).cast("int")).withColumn("_chk", each(F.lit(chunks)))
    more = asked.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(_topk_block(k, exclude_self, bounds), out)
    best = found.drop("rank").unionByName(more).withColumn("rank", rank).where(F.col("rank") <= k)
    return best, todo.groupBy("qid").agg(F.sum("scored").alias("scored")).withColumn("total", F.lit(total).cast("long"))


#: Hyperplane hashing: tables, bits of a code, buckets probed per table.  On vectors without any clusters (64 dimensions) these
#: find about 0.97 of the true neighbours and score 0.6 of the pairs; clustered vectors need far less of both.
LSH_TABLES, LSH_BITS, LSH_PROBES = 16, 8, 16


def _bucket_rows(kind: str, tables: int, bits: int, probes: int, seed: int, keep: list[str]):
    """mapInPandas body: a row per vector and bucket (``tbl``, ``code``) that holds it, or that its query probes.

    The probes of a query are the codes whose differing bits have the least sum of
    distances to their planes: the buckets its neighbours most likely fell into.
    """
    import numpy as np
    import pandas as pd

    codes = np.arange(1 << bits)
    set_ = ((codes[:, None] >> np.arange(bits)) & 1).astype(bool)

    def run(batches):
        for pdf in batches:
            unit, good = _units(pdf[kind])
            if not good.any():
                continue
            part, unit = pdf.loc[good, keep], unit[good]
            planes = np.random.default_rng(seed).normal(size=(unit.shape[1], tables, bits))
            for t in range(tables):
                side = unit @ planes[:, t]
                if kind == "vec":
                    yield part.assign(tbl=np.int32(t), code=((side > 0) @ (1 << np.arange(bits))).astype("int32"))
                    continue
                for lo in range(0, len(part), QUERY_SLICE):
                    here = side[lo : lo + QUERY_SLICE]
                    away = np.abs(here)[:, None, :] * (set_[None] != (here > 0)[:, None, :])
                    near = np.argsort(away.sum(axis=2), axis=1, kind="stable")[:, :probes]
                    rows = part.iloc[lo : lo + QUERY_SLICE]
                    yield rows.iloc[np.repeat(np.arange(len(rows)), near.shape[1])].assign(tbl=np.int32(t), code=near.ravel().astype("int32"))

    return run


def knn_lsh(
    queries: DataFrame,
    index: DataFrame,
    k: int = 5,
    by: str | None = None,
    exclude_self: bool = False,
    tables: int = LSH_TABLES,
    bits: int = LSH_BITS,
    probes: int = LSH_PROBES,
    seed: int = 0,
    block_rows: int = 20_000,
    chunk_rows: int = 20_000,
) -> DataFrame:
    """T4: approximate cosine top-``k`` by random hyperplanes; frames and result as ``knn_exact``.

    Every vector of the index lies in one bucket per table, and a query scores, exactly,
    the vectors of the ``probes`` buckets nearest to it in each.  Buckets of any size are
    dealt out in blocks and their queries in chunks, a task emits its top ``k`` per query,
    and no (query, vector) pair is a row.  Vectors without a direction (zero, NaN, null)
    have no cosine and are neither found nor answered.  With ``probes = 2 ** bits`` the
    result is the exact one; ``recall`` measures any other setting.
    """
    extra = [by] if by else []
    keys = [*extra, "tbl", "code"]

    def buckets(df: DataFrame, kind: str, keep: list[str]) -> DataFrame:
        fields = ", ".join([*(f"{c} {t}" for c, t in df.select(*keep).dtypes), "tbl int", "code int"])
        return df.where(F.col(kind).isNotNull()).mapInPandas(_bucket_rows(kind, tables, bits, probes, seed, keep), fields)

    x, q = index.select("vid", "vec", *extra), queries.select("qid", "qvec", *extra)
    parts = lambda df, kind, rows, name: buckets(df, kind, extra).groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    meet = parts(x, "vec", block_rows, "n_blk").join(parts(q, "qvec", chunk_rows, "n_chk"), keys)
    if not by and tables << bits <= 1 << 16:  # a row per bucket at most, so the copies of the vectors are shuffled once
        meet = F.broadcast(meet)
    share = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = buckets(x, "vec", x.columns).join(meet, keys).withColumn("_blk", share("vid", "n_blk")).withColumn("_chk", each("n_chk")).drop("n_blk", "n_chk")
    asked = buckets(q, "qvec", q.columns).join(meet, keys).withColumn("_chk", share("qid", "n_chk")).withColumn("_blk", each("n_blk")).drop("n_blk", "n_chk")
    group = [*keys, "_blk", "_chk"]
    found = asked.groupBy(*group).cogroup(held.groupBy(*group)).applyInPandas(_topk_block(k, exclude_self), "qid long, vid long, score double")
    once = found.groupBy("qid", "vid").agg(F.max("score").alias("score"))  # several tables may hold the same pair
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("vid").asc())
    return once.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row ``(queries, neighbours, hits, recall)``: the true neighbours that an approximate search found (recall 1 of none)."""
    hit = exact.select("qid", "vid").join(found.select("qid", "vid", F.lit(1).alias("hit")), ["qid", "vid"], "left")
    n, hits = F.count(F.lit(1)), F.count("hit")
    return hit.agg(F.count_distinct("qid").alias("queries"), n.alias("neighbours"), hits.alias("hits"), F.when(n > 0, hits / n).otherwise(F.lit(1.0)).alias("recall"))


def hashed_embeddings(texts: DataFrame, id_col: str, text_col: str, dim: int = 64) -> DataFrame:
    """V1 default encoder: signed feature hashing of lower-case words, L2-normalised.

    Runs on Spark built-ins only: distinct texts are embedded once (the cache), words
    are exploded and hashed (md5: its first 32 bits give the bucket, the next 4 the
    sign), counts are summed per (text, bucket) - at most ``dim`` rows per text - and
    assembled into an ``ARRAY<DOUBLE>``.  Texts are joined back by the text itself.
    Not comparable with a hosted model's vectors.
    """
    uniq = texts.select(F.coalesce(text_col, F.lit("")).alias("_t")).distinct()
    words = uniq.select("_t", F.explode(F.split(F.lower("_t"), r"[^\p{L}\p{N}]+")).alias("w")).filter(F.length("w") > 0)
    h = F.md5(F.col("w").cast("binary"))
    bucket = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(dim))
    sign = F.when(F.substring(h, 9, 1) < "8", 1.0).otherwise(-1.0)
    agg = words.groupBy("_t", bucket.alias("b")).agg(F.sum(sign).alias("v"))
    per_text = agg.groupBy("_t").agg(F.map_from_entries(F.collect_list(F.struct("b", "v"))).alias("m"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.col("m")[i.cast("long")], F.lit(0.0)))
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + v * v))
    emb = per_text.select("_t", F.transform(vec, lambda v: F.when(norm > 0, v / norm).otherwise(F.lit(0.0))).alias("embedding"))
    keyed = texts.select(id_col, F.coalesce(text_col, F.lit("")).alias("_t"))
    empty = F.array_repeat(F.lit(0.0), dim)
    return keyed.join(emb, "_t", "left").select(id_col, F.coalesce("embedding", empty).alias("embedding"))


def index_stats(vectors: DataFrame, namespace: str = "label", vec: str = "embedding") -> DataFrame:
    """Vector count per namespace and the dimension."""
    return vectors.groupBy(namespace).agg(F.count(F.lit(1)).alias("vector_count"), F.max(F.size(vec)).cast("bigint").alias("dimension"))


def upsert_by_id(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Keyed upsert - an update replaces the row with the same id, others stay."""
    return current.join(updates.select(key), key, "left_anti").unionByName(updates)
