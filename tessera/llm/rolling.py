"""Hashes of all windows of byte strings, as array operations; documents as packed bodies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of

_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
LEAST_ID = -(1 << 63)


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_M1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_M2)
    return h ^ (h >> np.uint64(31))


#: One fixed 64-bit number per byte value.
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def window_hash(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every window of ``length`` bytes: windows of powers of two by doubling, then joined."""
    if len(data) < length:
        return np.empty(0, dtype=np.uint64)
    n, out, at = len(data) - length + 1, None, 0
    level, size, factor = BYTE[data], 1, _BASE
    rest = length
    while True:
        if rest & size:  # this power is part of the length: the next bytes of the window
            part = mix64(level[at : at + n] + np.uint64(size))
            out = part if out is None else out * np.uint64(_M1) + part
            at += size
            rest -= size
        if not rest:
            return out
        level = level[:-size] * np.uint64(factor) + level[size:]
        factor = factor * factor % (1 << 64)
        size *= 2


def slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def keyed(docs: DataFrame) -> DataFrame:
    """``(k, h, text)``: the id (null: the least long) and a hash of the text tell a document; null text is empty."""
    d = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST_ID)).alias("k"), text_of(docs).alias("text"))
    return d.select("k", F.hash("text").alias("h"), "text")


def _compress(batches):
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        body = [z.compress(t.encode("utf-8", "surrogatepass")) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(body, pa.binary())], names=["k", "h", "body"])


def packed(docs: DataFrame) -> DataFrame:
    """``(k, h, body)`` with zstd frames of the texts, for shuffles."""
    return keyed(docs).mapInArrow(_compress, "k long, h int, body binary")


def unpack(body: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(body)
