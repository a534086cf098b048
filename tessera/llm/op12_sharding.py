"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group that is placed whole, on the shard where the dot product of
its demand with the residual capacity is highest (demands and capacities in parts of a
shard's fair share; of equal products the lowest shard).  Larger groups go first:

1. A group over 1/``WHOLE`` of a share in any measure is cut into pieces of 1/``PIECES``,
   so no group of copies, however large, decides a shard.  The few units over
   1/``GIANTS`` of a share (3 * shards * GIANTS at most, by their sums) are placed
   together.
2. The others are dealt by hash to cells; each cell places its units against its part
   of what is left, all cells at once.
3. One unit in ``FILL``, kept back, is placed last in the same way against what the
   cells have really left, which evens out their errors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of, token_estimate
from tessera.session import cut_lineage

SHARDS = 16
WHOLE, PIECES, GIANTS, FILL = 2, 8, 64, 8
#: Units of a cell and rows that are numbered together, about.
CELL_UNITS, PART_ROWS = 50_000, 4096
MEASURES = ("bytes", "tokens", "rows")
_UNIT = ["h", "size", "piece"]


def place(demand: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Shard of each unit (rows of ``demand``, in the order given) by the highest dot product with the residual capacity."""
    left, out = capacity.astype(float).copy(), np.empty(len(demand), dtype=np.int32)
    for i, d in enumerate(demand):
        j = int(np.argmax(left @ d))
        left[j] -= d
        out[i] = j
    return out


def falling(demand: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """Order of units by falling largest demand, ties by the given keys."""
    return np.lexsort((*reversed(ties), -demand.max(axis=1, initial=0)))


def _cells(share: np.ndarray, residual: np.ndarray):
    """Places the units of each cell; ``residual``: what all cells together may fill, in shares."""
    want = np.maximum(residual, 0.0)
    want = want / np.maximum(want.sum(axis=0), 1e-300)

    def run(pdf):
        raw = pdf[list(MEASURES)].to_numpy(dtype=float)
        demand = raw / share
        order = falling(demand, pdf["h"].to_numpy(), pdf["size"].to_numpy(), pdf["piece"].to_numpy())
        placed = pdf.iloc[order][[*_UNIT, *MEASURES]].copy()
        placed["shard"] = place(demand[order], want * demand.sum(axis=0))
        return placed

    return run


_PLACED = "h long, size long, piece int, bytes long, tokens long, rows long, shard int"


def _loads(placed: DataFrame, shards: int, share: np.ndarray) -> np.ndarray:
    out = np.zeros((shards, len(MEASURES)))
    for r in placed.groupBy("shard").agg(*[F.sum(m).alias(m) for m in MEASURES]).collect():  # a row per shard
        out[r.shard] = [r[m] for m in MEASURES]
    return out / share


def place_units(units: DataFrame, shards: int = SHARDS, cell_units: int = CELL_UNITS) -> DataFrame:
    """``units (h, size, piece, bytes, tokens, rows)`` with their ``shard``."""
    spark = units.sparkSession
    sums = units.agg(F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in MEASURES]).first()
    if not sums.n:
        return spark.createDataFrame([], _PLACED)
    share = np.array([max(float(sums[m]), 1.0) / shards for m in MEASURES])
    most = F.greatest(*[F.col(m) / F.lit(float(s)) for m, s in zip(MEASURES, share)])
    giant = most * GIANTS > 1
    first = units.where(giant).toPandas()  # bounded: each holds over 1 / (GIANTS * shards) of a measure
    demand = first[list(MEASURES)].to_numpy(dtype=float) / share
    order = falling(demand, first["h"].to_numpy(), first["size"].to_numpy(), first["piece"].to_numpy())
    first, demand = first.iloc[order], demand[order]
    shard = place(demand, np.ones((shards, len(MEASURES))))
    load = np.zeros((shards, len(MEASURES)))
    np.add.at(load, shard, demand)
    rows = list(zip(*(first[c].tolist() for c in [*_UNIT, *MEASURES]), shard.tolist()))
    placed = [spark.createDataFrame(rows, _PLACED)] if rows else []
    if sums.n > len(rows):
        cells = max(1, -(-sums.n // cell_units))
        where = F.xxhash64(F.lit(12), *_UNIT)
        rest = units.where(~giant).withColumn("cell", F.pmod(where, F.lit(cells)).cast("int")).withColumn("late", F.pmod(F.shiftright(where, 32), F.lit(FILL)) == 0)
        for late in (False, True):
            step = rest.where(F.col("late") == late).groupBy("cell").applyInPandas(_cells(share, 1.0 - load), _PLACED)
            step = cut_lineage(step)
            load = load + _loads(step, shards, share)
            placed.append(step)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def _numbered(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Adds ``slot``: gapless from 0 in each shard, from counts by parts of a shard and the place in the part."""
    parts = max(1, -(-n // (shards * PART_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(13), "rid"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    here = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "rid")) - 1
    return rows.withColumn("here", here).join(counts.select("shard", "part", before.alias("before")), ["shard", "part"]).withColumn("slot", F.col("before") + F.col("here"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, and its ``tokens``.

    Size: UTF-8 bytes plus 1 (null text: as empty).  The law is ``bytes``: sizes by
    shard are near equal, and so are tokens (estimated) and rows; ``grown_shard`` is
    null.  Equal texts, empty ones among them, share a shard unless their group was
    cut; repeated rows and rows without an id are rows like any other.  A text larger
    than a shard's share, however long, stays whole.  An empty table gives an empty
    result; other columns are ignored.
    """
    text = text_of(docs)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        token_estimate(text).alias("tokens"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("rid"),
    )
    rows = cut_lineage(rows)
    groups = cut_lineage(rows.groupBy("h", "size").agg(F.count(F.lit(1)).alias("rows"), F.max("tokens").alias("each")))
    groups = groups.select("h", "size", (F.col("size") * F.col("rows")).alias("bytes"), (F.col("each") * F.col("rows")).alias("tokens"), "rows")
    sums = groups.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    share = {m: max(float(sums[m] or 0), 1.0) / shards for m in MEASURES}
    most = F.greatest(*[F.col(m) / F.lit(s) for m, s in share.items()])
    # Bounded: each such group holds over 1 / (WHOLE * shards) of a measure.
    large = groups.where((most * WHOLE > 1) & (F.col("rows") > 1)).select("h", "size", F.least(F.ceil(most * PIECES), "rows").cast("int").alias("pieces"))
    cut = rows.join(F.broadcast(large), ["h", "size"], "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("rid"), F.col("pieces")), F.lit(0)).cast("int"))
    of_large = cut.where(F.col("pieces").isNotNull()).groupBy(*_UNIT).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    whole = groups.join(F.broadcast(large), ["h", "size"], "left_anti").withColumn("piece", F.lit(0))
    units = cut_lineage(whole.select(*_UNIT, *MEASURES).unionByName(of_large.select(*_UNIT, *MEASURES)))
    placed = place_units(units, shards).select(*_UNIT, "shard")
    out = _numbered(cut.join(placed, _UNIT), int(sums["rows"] or 0), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")
