"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the top bits choose a bin, a bin keeps its least hash.
Empty bins are filled by optimal densification: each takes the value of the first
non-empty bin in its own fixed random order of bins.  The fingerprint packs the lowest
``BITS`` bits of every bin; equal bits by chance are corrected for in the likeness.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.session import cut_lineage

WORDS = 5
BINS, BITS = 512, 4
#: Odd multipliers that join the hashes of consecutive words, and the finalizer's.
STEP, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _orders() -> np.ndarray:
    """``[i, j]``: place of bin j in the probing order of bin i (a fixed random permutation per bin)."""
    i, j = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(BINS, dtype=np.uint64), indexing="ij")
    return np.argsort(np.argsort(mix64(i * np.uint64(BINS) + j + np.uint64(1)), axis=1), axis=1).astype(np.uint16)


def fingerprint(text: str) -> bytes:
    """Packed fingerprint of the 5-word shingles of a text (fewer words: the whole sequence; none: no bytes)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return b""
    h64 = xxhash.xxh3_64_intdigest
    w = np.array([h64(x) for x in words], dtype=np.uint64)
    k = min(WORDS, len(w))
    h = w[: len(w) - k + 1].copy()
    for j in range(1, k):
        h = h * np.uint64(STEP) + w[j : len(w) - k + 1 + j]
    h = np.sort(mix64(h))
    bins = (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))  # sorted: the first of a bin is its least
    full = bins[first]
    low = np.zeros(BINS, dtype=np.uint8)
    low[full] = (h[first] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    if len(full) < BINS:
        empty = np.setdiff1d(np.arange(BINS), full, assume_unique=True)
        low[empty] = low[full[_orders()[np.ix_(empty, full)].argmin(axis=1)]]
    return (low[0::2] | (low[1::2] << 4)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard likeness of the shingle sets, bias-corrected, within 0 and 1."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(a, dtype=np.uint8) ^ np.frombuffer(b, dtype=np.uint8)
    same = (np.count_nonzero((x & 15) == 0) + np.count_nonzero((x >> 4) == 0)) / BINS
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the following text."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def _results(text: str, fp: bytes, following: str, next_fp: bytes) -> tuple:
    new = edited(text, following)
    efp = fingerprint(new)
    return hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), efp, likeness(fp, efp), likeness(fp, next_fp)


_SCHEMA = pa.schema(
    [("kind", pa.string()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("sha", pa.binary()), ("fp", pa.binary()),
     ("efp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("body", pa.binary())]
)
_DDL = "kind string, part int, doc_id long, n_chars long, sha binary, fp binary, efp binary, near_edited double, near_next double, body binary"


def _compress(batches):
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        body = [z.compress(t.encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(body, pa.binary())], names=["doc_id", "h", "body"])


def _expand(body: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(body).decode("utf-8", "surrogatepass")


def _walk(batches):
    """Rows in id order: each is settled when the next arrives; the partition's first and last row go on as ``head`` and ``tail``."""
    part, last, out = TaskContext.get().partitionId(), None, []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    for b in batches:
        for doc_id, body in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            text = _expand(body)
            fp = fingerprint(text)
            if last is None:
                out.append(("head", part, None, None, None, fp, None, None, None, body))
            else:
                i, t, f, _ = last
                sha, efp, ne, nn = _results(t, f, text, fp)
                out.append(("row", part, i, len(t), sha, f, efp, ne, nn, None))
            last = (doc_id, text, fp, body)
            if len(out) >= 2000:
                yield flush()
                out = []
    if last is not None:
        out.append(("tail", part, last[0], len(last[1]), None, last[2], None, None, None, last[3]))
    if out:
        yield flush()


def _settle(batches):
    """Tails with the head that follows them."""
    for b in batches:
        out = []
        for doc_id, fp, body, next_fp, next_body in zip(*(c.to_pylist() for c in b.columns)):
            text = _expand(body)
            sha, efp, ne, nn = _results(text, fp, _expand(next_body), next_fp)
            out.append(("row", 0, doc_id, len(text), sha, fp, efp, ne, nn, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the next row by ascending doc_id (null first; repeated ids in
    the order of a hash of their text), the first after the last; a single row
    follows itself.  Null text: empty.  Texts without words have the empty
    fingerprint, alike (1.0) only among themselves.  An empty table gives an empty
    result; other columns are ignored.
    """
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    packed = d.withColumn("h", F.xxhash64("text")).mapInArrow(_compress, "doc_id long, h long, body binary")
    ordered = packed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "h").select("doc_id", "h", "body")
    walked = cut_lineage(ordered.mapInArrow(_walk, _DDL))
    heads = walked.where("kind = 'head'").select(F.col("part").alias("next_part"), F.col("fp").alias("next_fp"), F.col("body").alias("next_body"))
    # One number per partition of the walk: which part follows which, the first after the last.
    parts = walked.where("kind = 'head'").select("part")
    w = Window.partitionBy(F.lit(0)).orderBy("part")
    first = F.min("part").over(Window.partitionBy(F.lit(0)))
    follows = parts.select("part", F.coalesce(F.lead("part").over(w), first).alias("next_part"))
    tails = walked.where("kind = 'tail'").select("part", "doc_id", "fp", "body")
    settled = tails.join(follows, "part").join(heads, "next_part").select("doc_id", "fp", "body", "next_fp", "next_body").mapInArrow(_settle, _DDL)
    rows = walked.where("kind = 'row'").unionByName(settled)
    text = lambda c: F.lower(F.hex(c))
    return rows.select(
        "doc_id", "n_chars", text("sha").alias("edited_sha256"), text("fp").alias("fingerprint"), text("efp").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
