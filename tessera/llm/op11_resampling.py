"""Target-distribution importance resampling over hashed n-grams.

Every Arrow batch interns its n-grams in an open-addressed NumPy table
(``ngrams.InternTable``): XXH64 keys, bytes verified, a bucket and a count per slot.
A first pass adds up the counts by bucket for the corpus and for the target texts; a
second one gathers the buckets' gains by the slot of every occurrence, so a document's
weight is the mean gain of its n-grams.  Documents are drawn by weight plus Gumbel
noise fixed by their id (sampling without replacement by weight).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.llm.ngrams import tables
from tessera.session import cut_lineage

LONGEST, BUCKETS, SEED = 1, 10_000, 2024
#: Documents under so many words are not drawn; percent of the others that are.
LEAST_WORDS, PERCENT = 20, 10
#: Score values counted in one group while ranks are added up.
SCORE_BLOCK = 1024


def _bucket_of(buckets: int):
    return lambda gram: zlib.crc32(gram) % buckets


def _bucket_counts(longest: int, buckets: int):
    """Occurrences by bucket over this task's texts (at most ``buckets`` rows)."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for t in tables(b.column(0), longest):
                np.add.at(total, t.value(_bucket_of(buckets))[t.used], t.count[t.used])
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(total[on])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of n-grams by bucket over all texts ``(text)``; ``buckets`` numbers at most reach the driver."""
    rows = texts.mapInArrow(_bucket_counts(longest, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln) of the ratio of its smoothed shares in target and corpus."""
    s_all, t_all, b = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


_WEIGHTS = "doc_id long, n_words long, n_features long, weight long"


def _weights(gains: np.ndarray, longest: int):
    def run(batches):
        of = _bucket_of(len(gains))
        for b in batches:
            rows = b.num_rows
            total, features, words = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
            for t in tables(b.column(1), longest):
                gain = gains[t.value(of)]  # per slot
                text = t.grams.text
                np.add.at(total, text, gain[t.slot])
                features += np.bincount(text, minlength=rows)
                if longest > 1:
                    spaces = t.value(lambda gram: gram.count(b" "))
                    words += np.bincount(text[spaces[t.slot] == 0], minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words if longest > 1 else features), pa.array(features), pa.array(total // np.maximum(features, 1))],
                names=[x.split()[0] for x in _WEIGHTS.split(", ")],
            )

    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of Gumbel noise fixed by the id (null: as the text "null")."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    u = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def drawn(scored: DataFrame, percent: int) -> DataFrame:
    """``scored (doc_id, eligible, score, ...)`` with ``rank`` of the drawn rows: the ``percent`` per cent highest scores.

    Ranks come from counts: rows by score value, added up over blocks of values (the
    scores are whole thousandths of logarithms, so there are some ten thousand values
    at any size), plus the place among the rows of one score.
    """
    by_score = cut_lineage(scored.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    rows = by_score.agg(F.sum("n")).first()[0] or 0
    block = F.floor(F.col("score") / SCORE_BLOCK)
    blocks = by_score.groupBy(block.alias("block")).agg(F.sum("n").alias("n"))
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("block", above.alias("above"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = by_score.withColumn("block", block).withColumn("inside", inside).join(blocks, "block")
    before = before.select("score", (F.col("above") + F.col("inside")).alias("before")).where(F.col("before") < rows * percent // 100)
    before = cut_lineage(before)
    least = before.agg(F.min("score")).first()[0]
    none = F.lit(None).cast("long")
    if least is None:
        return scored.withColumn("rank", none)
    near = F.col("eligible") & (F.col("score") >= least)
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    rank = F.col("before") + place
    top = scored.where(near).join(before, "score").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= rows * percent // 100, F.col("rank")))
    return top.drop("before").unionByName(scored.where(~near).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank`` (null: not drawn).

    Features are all runs of 1 to ``longest`` words (``ngrams``); ``target`` holds the
    texts of the wanted distribution.  Null and empty texts have no features and
    weight 0.  Texts of any length are read whole (some 30 bytes of memory a word for
    the longest one of a batch).  Equal scores rank by doc_id, a null id last; repeated
    rows are documents of their own, with ranks next to each other.  An empty corpus
    gives an empty result, an empty target the gains of an even spread.  Other columns
    are ignored.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    corpus = bucket_counts(texts.select("text"), longest, buckets)
    wanted = bucket_counts(target.select(text_of(target).alias("text")), longest, buckets)
    gains = bucket_gains(corpus, wanted)
    rows = texts.mapInArrow(_weights(gains, longest), _WEIGHTS)
    scored = rows.select("doc_id", (F.col("n_words") >= least_words).alias("eligible"), "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"))
    return drawn(cut_lineage(scored), percent).select("doc_id", "n_features", "weight", "score", "rank")


def oracle_sql() -> str:
    """The same rows in SQL; CRC-32 is worked out from its polynomial, once per distinct word."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
q AS (SELECT unnest({words}) AS w FROM benchmark),
steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
sw AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM d) GROUP BY w),
tw AS (SELECT w, count(*) AS n FROM q GROUP BY w),
voc AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM sw UNION SELECT w FROM tw)),
bytes AS (SELECT w, list_transform(range(length(x) // 2), lambda j: CAST('0x' || substr(x, 2 * j + 1, 2) AS BIGINT)) AS b FROM voc),
crc AS (SELECT w, xor(list_reduce(list_concat([4294967295], b), lambda c, y: xor(c // 256, t[1 + (xor(c, y) % 256)])), 4294967295) % {BUCKETS} AS bucket FROM bytes, steps),
sb AS (SELECT bucket, sum(n)::BIGINT AS n FROM sw JOIN crc USING (w) GROUP BY 1),
tb AS (SELECT bucket, sum(n)::BIGINT AS n FROM tw JOIN crc USING (w) GROUP BY 1),
al AS (SELECT coalesce((SELECT sum(n) FROM sb), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM tb), 0)::DOUBLE AS t),
gain AS (SELECT w, CAST(floor(1000 * ln((coalesce(tb.n, 0) + 1)::DOUBLE * (al.s + {BUCKETS}) / ((coalesce(sb.n, 0) + 1)::DOUBLE * (al.t + {BUCKETS})))) AS BIGINT) AS g
  FROM crc LEFT JOIN sb USING (bucket) LEFT JOIN tb USING (bucket), al),
n AS (SELECT row_number() OVER () AS r, doc_id, ws FROM d),
f AS (SELECT r, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM (SELECT r, unnest(ws) AS w FROM n) JOIN gain USING (w) GROUP BY r),
sc AS (SELECT r, doc_id, coalesce(f.n, 0) AS n_features, coalesce(f.weight, 0) AS weight,
  coalesce(f.weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM n LEFT JOIN f USING (r)),
rk AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS k, count(*) OVER () AS m FROM sc WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN k <= {PERCENT} * m // 100 THEN k END AS rank FROM sc LEFT JOIN rk USING (r)
"""
