"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of the last 32 bytes decides where a text may be cut, so cuts move with
the content: an insertion changes the chunks around it and no others.  Chunks are
compared by 128-bit digest; the first of equal chunks (by id, then position) stays and
later ones go, where a run of them is at least ``LEAST_RUN`` bytes long - a phrase
that two texts share by chance is left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rolling import BYTE, LEAST_ID, keyed, packed, unpack
from tessera.operators.skew import splittable
from tessera.session import cut_lineage

#: A cut where the hash's low bits are zero; least and most bytes of a chunk; least bytes of a removed run.
CUT_BITS, LEAST, MOST = 5, 24, 256
LEAST_RUN = 96
PASS_BYTES = 2 << 20
GEAR = (BYTE & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of the last 32 bytes' numbers, each shifted once per byte since (by doubling)."""
    h, size = GEAR[data], 1
    while size < 32:
        h[size:] = h[size:] + (h[:-size] << np.uint32(size))
        size *= 2
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text."""
    n = len(data)
    if n == 0:
        return []
    # The top bits see all 32 bytes.
    marks = (np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    out, last = [], 0
    for m in [*marks, n]:
        while m - last > MOST:
            last += MOST
            out.append(last)
        if m - last >= LEAST or (m == n and m > last):
            out.append(m)
            last = m
    return out


_CHUNKS = "k long, place long, d1 long, d2 long"


def _chunk_rows(batches):
    """One row per chunk: document, hash of its text over the chunk's start, digest."""
    import xxhash

    h128 = xxhash.xxh3_128_digest
    for batch in batches:
        ks, places, digests, size = [], [], [], 0

        def emit():
            d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(places, pa.int64()), pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1]))],
                names=["k", "place", "d1", "d2"],
            )

        for k, h, text in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode("utf-8", "surrogatepass")
            ends = cuts(np.frombuffer(raw, dtype=np.uint8))
            for a, b in zip([0, *ends], ends):
                ks.append(k)
                places.append(h << 32 | a)
                digests.append(h128(raw[a:b]))
            size += len(raw)
            if size > PASS_BYTES:
                yield emit()
                ks, places, digests, size = [], [], [], 0
        if ks:
            yield emit()


_RESULT = "k long, n_bytes long, n_chunks long, n_removed long, n_spans long, spans array<struct<lo:int,hi:int>>, kept binary"
_SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _remove(least_run: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            out = []
            for k, body, dup in zip(*(c.to_pylist() for c in batch.columns)):
                raw = unpack(body)
                ends = cuts(np.frombuffer(raw, dtype=np.uint8))
                dup, runs = set(dup or ()), []
                for a, b in zip([0, *ends], ends):
                    if a in dup:
                        if runs and runs[-1][1] == a:
                            runs[-1][1] = b
                        else:
                            runs.append([a, b])
                runs = [r for r in runs if r[1] - r[0] >= least_run]
                kept, at = [], 0
                for lo, hi in runs:
                    kept.append(raw[at:lo])
                    at = hi
                kept = b"".join([*kept, raw[at:]])
                spans = [{"lo": lo, "hi": hi} for lo, hi in runs]
                out.append((k, len(raw), len(ends), len(raw) - len(kept), len(runs), spans, kept if keep_text else hashlib.sha256(kept).digest()))
            c = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in c[:5]), pa.array(c[5], _SPANS), pa.array(c[6], pa.binary())], names=["k", "n_bytes", "n_chunks", "n_removed", "n_spans", "spans", "kept"])

    return run


def substring_dedup(docs: DataFrame, least_run: int = LEAST_RUN, keep_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_chunks, n_removed, n_spans, spans, kept_sha256`` (``kept``, the bytes left, with ``keep_text``).

    Spans are byte ranges.  Null or empty text: no chunks.  A null doc_id comes before
    all others.  Rows that repeat an id and its text are one document and lose the
    same bytes.  An empty table gives an empty result; other columns are ignored.
    """
    chunks = cut_lineage(keyed(docs).mapInArrow(_chunk_rows, _CHUNKS))
    # Partial aggregates first: a chunk of a third of all documents leaves each task as one row.
    first = chunks.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", F.shiftright("place", 32).alias("h"), F.col("place").bitwiseAND(0xFFFFFFFF).alias("at"))).alias("first"))
    again = first.where("n > 1").select("d1", "d2", "first")
    at = F.col("place").bitwiseAND(0xFFFFFFFF)
    later = chunks.join(splittable(again), ["d1", "d2"]).where(~((F.col("k") == F.col("first.k")) & (F.shiftright("place", 32) == F.col("first.h")) & (at == F.col("first.at"))))
    marks = later.groupBy("k", F.shiftright("place", 32).cast("int").alias("h")).agg(F.collect_set(at.cast("int")).alias("dup"))
    out = packed(docs).join(marks, ["k", "h"], "left").select("k", "body", "dup").mapInArrow(_remove(least_run, keep_text), _RESULT)
    doc_id = F.when(F.col("k") != LEAST_ID, F.col("k")).alias("doc_id")
    kept = F.col("kept") if keep_text else F.lower(F.hex("kept")).alias("kept_sha256")
    return out.select(doc_id, "n_bytes", "n_chunks", "n_removed", "n_spans", "spans", kept)
