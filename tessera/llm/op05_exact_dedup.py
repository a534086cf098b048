"""Exact dedup by skew-safe combining.

Three levels, each comparing whole contents (the zstd frame of the normalised
text: one compressor and level, so equal frames mean equal texts):

1. local: a task reads its rows once and keeps one winner per content; a buffer
   of bounded size is emitted and emptied when full, so memory never depends on
   the data;
2. salted: the local winners of a digest are spread over ``SALTS`` groups, so a
   text that holds a third of all rows meets in no single task;
3. global: at most ``SALTS`` winners of each content meet and name the row that
   stays.

Decisions go back to the rows along the winners' row numbers (row -> local winner
-> salt winner -> row that stays): the keys of those joins are bounded by the
rows of one task, not by the size of a group of copies.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.session import cut_lineage, drop_table

SALTS = 8
BUFFER_BYTES = 48 << 20
_LOCAL = "doc_id long, rid long, local_id long, digest binary, n long, body binary"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("rid", pa.int64()), ("local_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("body", pa.binary())]
)


def _local_combine(batches):
    """Level 1: one output row per input row; the winner of a content in this buffer carries its body."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    base = TaskContext.get().partitionId() << 36
    seen, rows, held, rid = {}, [], 0, 0

    def emit():
        # winner: largest id (null below all), then largest row number
        out = []
        for doc_id, row, key in rows:
            best, n, body = seen[key]
            won = best[1] == row
            out.append((doc_id, row, best[1], key[0], n if won else 0, body if won else None))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode("utf-8", "surrogatepass").lower()
            body = pack.compress(raw)
            key = (hashlib.sha256(raw).digest(), body)
            rank = ((doc_id is not None, doc_id or 0), base + rid)
            old = seen.get(key)
            if old is None:
                seen[key] = (rank, 1, body)
                held += len(body)
            else:
                seen[key] = (max(old[0], rank), old[1] + 1, body)
            rows.append((doc_id, base + rid, key))
            rid += 1
            if held > BUFFER_BYTES or len(rows) >= 100_000:
                yield emit()
                seen, rows, held = {}, [], 0
    if rows:
        yield emit()


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row
    with the largest doc_id stays.  Null text: empty text.  Null doc_id: a row like
    any other, below every id (``keep_id`` is null if all ids of a group are).
    Repeated rows: each counts in ``group_size``, exactly one is ``kept``.  An empty
    table gives an empty result; other columns are ignored.
    """
    return _decisions(_local_level(docs))


def kept_keys(docs: DataFrame) -> DataFrame:
    """``(doc_id, content)`` of the row that stays of each text (null id: no row of that text has one), as a table; the level tables are deleted."""
    local = _local_level(docs)
    kept = cut_lineage(_decisions(local).where("kept").select("doc_id", F.col("text_sha256").alias("content")))
    drop_table(local)
    return kept


def _local_level(docs: DataFrame) -> DataFrame:
    """Level 1, materialised once: row numbers must be the same for every reader."""
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return cut_lineage(src.mapInArrow(_local_combine, _LOCAL))


def _decisions(local: DataFrame) -> DataFrame:
    """Levels 2 and 3, and the way back to the rows."""
    winners = local.where("body IS NOT NULL").select("doc_id", "local_id", "digest", "n", "body")
    salted = winners.withColumn("salt", F.pmod(F.xxhash64("local_id"), F.lit(SALTS)))
    rank = F.struct(F.col("doc_id").isNotNull(), "doc_id", "local_id")
    w = Window.partitionBy("digest", "salt", "body")
    salt_level = salted.withColumn("top", F.max(rank).over(w)).withColumn("sum_n", F.sum("n").over(w)).select(
        "local_id", "digest", "doc_id", F.col("top.local_id").alias("salt_id"),
        F.when(F.col("top.local_id") == F.col("local_id"), F.col("body")).alias("body"), "sum_n",
    )
    # Salt losers travel on as (local_id, salt_id) without their bodies.
    g = Window.partitionBy("digest", "body")
    top = F.max(F.when(F.col("body").isNotNull(), F.struct(F.col("doc_id").isNotNull(), "doc_id", F.col("salt_id").alias("id")))).over(g)
    size = F.sum(F.when(F.col("body").isNotNull(), F.col("sum_n"))).over(g)
    final = salt_level.repartition("digest").withColumn("top", top).withColumn("size", size)
    back = Window.partitionBy("digest", "salt_id")
    mapping = final.select(
        "local_id",
        F.max("top.doc_id").over(back).alias("keep_id"),
        F.max("top.id").over(back).alias("keep_rid"),
        F.max("size").over(back).alias("group_size"),
    )
    rows = local.select("doc_id", "rid", "local_id", "digest")
    return rows.join(mapping, "local_id").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
