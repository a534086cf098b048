"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every document is tokenized once, inside the task that reads it.  Whole windows of
``WINDOW`` tokens stand alone; what is left of a document is cut into pieces of at
most ``PIECE`` tokens, so that differencing has fine parts to balance.  Documents
are dealt by a hash into groups of about ``WAYS`` windows - the number of groups
follows the measured tokens, the size of one doesn't - and each group is packed by
largest differencing: the two partial partitions with the largest spread are merged,
the heaviest window of one with the lightest of the other, until one is left.  Where
a window would exceed the capacity the number of windows rises and the group is
packed again.  No token is dropped; only piece rows (never ids) are shuffled.
"""

from __future__ import annotations

import heapq
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.llm.pretokens import class_table, load, rank_merger, split
from tessera.session import cut_lineage

WINDOW = 1024
PIECE = 256
WAYS = 256
CACHE_WORDS = 800_000
SEPARATOR = (0).to_bytes(4, "little")

_PIECES = "doc_id long, rid long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long"
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


class Encoder:
    """Token ids of whole texts, little-endian 32-bit: the ids the library gives for the tokenizer file.

    Maps a pre-token to its ids; one not met before is merged on its own (merges never
    cross a pre-token) by the rank merger over the file's vocabulary, whose ids are its
    merge ranks.  Emptied when full.
    """

    def __init__(self, tokenizer_file: str):
        self.table = class_table(tokenizer_file)
        self.special = {t.content: i.to_bytes(4, "little") for i, t in load(tokenizer_file).get_added_tokens_decoder().items()}
        self.merge = rank_merger(tokenizer_file)
        self.known: dict[str, bytes] = dict(self.special)

    def learn(self, word: str) -> bytes:
        ids = self.merge(word.encode("utf-8", "surrogatepass"))
        out = self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens, special tokens cut out first."""
        for s in self.special:
            if s in text:
                out = []
                for i, part in enumerate(text.split(s)):
                    out += ([s] if i else []) + self.pieces(part)
                return out
        return split(text, self.table)

    def encode(self, text: str) -> bytes:
        if len(self.known) > CACHE_WORDS:
            self.known = dict(self.special)
        words = self.pieces(text)
        found = list(map(self.known.get, words))
        if None in found:
            known, learn = self.known, self.learn
            found = [x if x is not None else known.get(w) or learn(w) for x, w in zip(found, words)]
        return b"".join(found)


def _cut(tokenizer_file: str):
    def run(batches):
        encode = Encoder(tokenizer_file).encode
        base, n_rows, n_full = TaskContext.get().partitionId() << 36, 0, 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + SEPARATOR
                total, rid = len(ids) // 4, base + n_rows
                n_rows += 1
                whole = total - total % WINDOW
                at = [*range(0, whole, WINDOW), *range(whole, total, PIECE)]
                for start, end in zip(at, [*at[1:], total]):
                    seq = None
                    if start < whole:
                        seq = (1 << 62) | (base + n_full)
                        n_full += 1
                    out.append((doc_id, rid, start, end - start, zlib.crc32(ids[4 * start : 4 * end]), total, seq))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=_NAMES)

    return run


def difference(sizes: list[int], ways: int) -> tuple[list[int], list[list[int]]]:
    """Largest differencing into ``ways`` parts: their sums and the items of each."""
    left: list[int] = []
    right: list[int] = []  # inner node i joins the nodes left[i], right[i]; leaves are 0..n-1, inner nodes follow
    n, heap = len(sizes), []
    for i, s in enumerate(sizes):
        heap.append((-s, i, (s,), (i,)))  # sums and nodes of the non-empty parts, heaviest first
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        if len(sa) + len(sb) <= min(ways, 16):  # few parts, all with room beside each other
            sums, nodes = zip(*sorted(zip((*sa, *sb), (*na, *nb)), key=lambda p: -p[0]))
            low = int(sums[-1]) if len(sums) == ways else 0
            heapq.heappush(heap, (low - int(sums[0]), tie, sums, nodes))
            tie += 1
            continue
        sa, na, sb, nb = np.asarray(sa), np.asarray(na), np.asarray(sb), np.asarray(nb)
        free = ways - len(sa)
        if len(sb) <= free:  # the lightest windows of a are empty ones
            sums, nodes = np.concatenate([sa, sb]), np.concatenate([na, nb])
        else:
            # b's heaviest meet a's empty windows, its others a's lightest first.
            both = len(sb) - free
            sums, nodes = np.concatenate([sa, sb[:free]]), np.concatenate([na, nb[:free]])
            at = np.arange(len(sa) - 1, len(sa) - 1 - both, -1)
            sums[at] += sb[free:]
            first = n + len(left)
            left += na[at].tolist()
            right += nb[free:].tolist()
            nodes[at] = np.arange(first, first + both)
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        low = int(sums[-1]) if len(sums) == ways else 0
        heapq.heappush(heap, (low - int(sums[0]), tie, sums, nodes))
        tie += 1
    if not heap:
        return [], []
    _, _, sums, nodes = heap[0]
    parts = []
    for node in np.asarray(nodes).tolist():
        items, stack = [], [node]
        while stack:
            x = stack.pop()
            if x < n:
                items.append(x)
            else:
                stack += [left[x - n], right[x - n]]
        parts.append(items)
    return np.asarray(sums).tolist(), parts


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows (lists of items) of at most ``capacity``; their number rises while one exceeds it."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, parts = difference(sizes, ways)
        if not sums or max(sums) <= capacity:
            return parts
        ways += 1


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["rid", "start"]).reset_index(drop=True)
    seq, offset = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
    lengths = pdf["length"].to_numpy()
    group = int(pdf["grp"].iloc[0])
    for w, items in enumerate(pack(lengths.tolist(), WINDOW)):
        items = np.sort(np.array(items))
        seq[items] = (group << 32) | w
        offset[items] = np.cumsum(lengths[items]) - lengths[items]
    return pdf.assign(sequence_id=seq, offset=offset)[[*_OUT]]


_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Null or empty text: the one separator token.  Null doc_id and repeated rows are
    packed like any row (one set of pieces per row).  Very long texts give as many
    windows as they need.  An empty table gives an empty result; other columns are
    ignored.
    """
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    pieces = cut_lineage(src.mapInArrow(_cut(tokenizer_file), _PIECES))
    whole = pieces.where("sequence_id IS NOT NULL").select(*_OUT[:-1], F.lit(0).cast("long").alias("offset"))
    rest = pieces.where("sequence_id IS NULL")
    left = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(left / (WINDOW * WAYS)))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInPandas(_pack_group, ", ".join(f"{c} long" for c in _OUT))
    return whole.unionByName(packed)
