"""Repeated byte strings by longest-previous-factor arrays.

Every window of ``MATCH`` bytes belongs to a bucket named by the least hash of the
``GRAM``-byte strings in it, so equal windows meet whatever document they are in.
Neighbouring windows of one bucket travel as one stretch of text; only stretches
whose bucket has company go on, equal stretches as one.  Inside a bucket the suffixes
at the window starts are put in order, truncated at the match length (suffixes that
agree in MATCH bytes are neighbours, in position order), and the previous and next
smaller positions in that order tell for each start whether the longest previous
factor, or any other occurrence, reaches MATCH bytes.

The order is a real one: ``suffix_ranks`` sorts the suffixes by their bytes, eight at
first and twice as many each round up to the match length, so equal ranks are equal
bytes and no hash decides what is removed.  ``shared_ranks`` spares it the suffixes whose
window hash is alone in the bucket, and those that a byte by byte comparison finds equal
to one that is sorted.  ``longest_previous`` takes the previous and
next smaller positions from that order and the lengths of the agreements with them.

Buckets with more than ``BLOCK`` different stretches are split by a hash of the suffix,
so no task holds one: each part gets the 64-bit names of its share of the starts, and
only there names beside the bucket's own 64 bits stand for bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rolling import LEAST_ID, keyed, mix64, packed, slide_min, unpack, window_hash
from tessera.operators.skew import splittable
from tessera.session import cut_lineage

MATCH, GRAM = 400, 64
#: Window starts of one stretch at most, and different stretches a bucket may hold unsplit.
STRETCH, BLOCK = 512, 4096
#: Bytes worked on at once: their arrays of 64-bit numbers stay in a core's cache.
PASS_BYTES = 128 << 10
_OCC = "k long, h int, at int, starts int, bucket long, digest long, weight int"


def _stretches(match: int, gram: int):
    """Stretches of window starts with one bucket: (k, h, first start, starts, bucket, digest, weight 2 if it may repeat itself)."""
    import xxhash

    h64 = xxhash.xxh3_64_intdigest

    width = match - gram + 1

    def several(group: list[tuple[int, int, bytes]]):
        ks, hs, texts = zip(*group)
        joined = b"".join(texts)
        end = np.cumsum([len(d) for d in texts])
        base = np.concatenate([[0], end[:-1]])
        last = end - match + 1  # of each text, the first start without a whole window
        hashes = window_hash(np.frombuffer(joined, dtype=np.uint8), gram)
        least = slide_min(hashes, width)
        edges = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, base, last]))
        a, b = edges[:-1], edges[1:]
        text = np.searchsorted(base, a, side="right") - 1
        real = a < last[text]
        a, b, text = a[real], b[real], text[real]
        pieces = -(-(b - a) // STRETCH)
        of = np.repeat(np.arange(len(a)), pieces)
        x = a[of] + STRETCH * (np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of])
        y, text = np.minimum(b[of], x + STRETCH), text[of]
        # Where the least hash of some window lies; a stretch that holds its own twice may repeat itself.
        pad = np.zeros(width - 1, dtype=np.uint64)
        lies = np.flatnonzero(hashes == ~slide_min(~np.concatenate([pad, least, pad]), width))
        values, which = np.unique(hashes[lies], return_inverse=True)
        places = np.sort(which * len(joined) + lies)
        own = np.searchsorted(values, least[x]) * len(joined)
        held = np.searchsorted(places, own + y - 1 + width) - np.searchsorted(places, own + x)
        twice = ((b - a)[of] > width) | (held > 1)
        view = memoryview(joined)
        digest = [h64(view[i:j]) for i, j in zip(x.tolist(), (y - 1 + match).tolist())]
        columns = [
            np.array(ks, dtype=np.int64)[text], np.array(hs, dtype=np.int32)[text], (x - base[text]).astype(np.int32), (y - x).astype(np.int32),
            least[x].view(np.int64), np.array(digest, dtype=np.uint64).view(np.int64), np.where(twice, 2, 1).astype(np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _OCC.split(", ")])

    def run(batches):
        for batch in batches:
            group, size = [], 0
            for k, h, t in zip(*(c.to_pylist() for c in batch.columns)):
                d = t.encode("utf-8", "surrogatepass")
                if len(d) >= match:
                    group.append((k, h, d))
                    size += len(d)
                if size > PASS_BYTES:
                    yield several(group)
                    group, size = [], 0
            if group:
                yield several(group)

    return run


_BUCKET = "bucket long, part int, k long, h int, at int, starts int, text binary, offsets binary, names binary"


def _bucket_rows(out):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in _BUCKET.split(", ")])


def _texts(match: int):
    """Rows for the buckets: a stretch's text, or for a split bucket its suffix names by part."""

    def run(batches):
        for batch in batches:
            out = []
            for k, h, body, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                data = unpack(body)
                for w in wanted:
                    place = k, h, w["at"], w["starts"]
                    piece = data[w["at"] : w["at"] + w["starts"] - 1 + match]
                    if w["parts"] == 1:
                        out.append((w["bucket"], 0, *place, piece, None, None))
                        continue
                    names = window_hash(np.frombuffer(piece, dtype=np.uint8), match)
                    part = (names % np.uint64(w["parts"])).astype(np.int64)
                    order = np.argsort(part, kind="stable")
                    for one in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                        out.append((w["bucket"], int(part[one[0]]), *place, None, one.astype("<i4").tobytes(), names[one].tobytes()))
                if len(out) > 4000:
                    yield _bucket_rows(out)
                    out = []
            if out:
                yield _bucket_rows(out)

    return run


def suffix_ranks(text: np.ndarray, starts: np.ndarray, match: int) -> np.ndarray:
    """Rank of the suffix at each of ``starts`` among all suffixes of ``text``, by its first ``match`` bytes.

    Prefix doubling: ranks by eight bytes first, then of twice the length from pairs of
    ranks, and of the match length from two overlapping ones.  ``text`` reaches
    ``match`` bytes beyond every start.
    """
    if match < 8:  # a few bytes are their own number
        out = np.zeros(len(starts), dtype=np.int64)
        for i in range(match):
            out = (out << 8) | text[starts + i].astype(np.int64)
        return np.unique(out, return_inverse=True)[1]
    lanes = np.lib.stride_tricks.sliding_window_view(text, 8).copy().view(">u8").ravel().astype(np.uint64)
    rank, size = np.unique(lanes, return_inverse=True)[1].astype(np.int64), 8
    while size * 2 <= match:
        key = rank[:-size] << 32 | rank[size:]
        rank, size = np.unique(key, return_inverse=True)[1].astype(np.int64), size * 2
    return np.unique(rank[starts] << 32 | rank[starts + match - size], return_inverse=True)[1]


def _agree(text: np.ndarray, x: np.ndarray, y: np.ndarray, match: int) -> bool:
    """Are the ``match`` bytes at each ``x`` those at its ``y``?  Pairs that go on from the pair before are compared as one stretch."""
    first = np.flatnonzero(np.concatenate([[True], (np.diff(x) != 1) | (np.diff(y) != 1)]))
    size = np.diff(np.append(first, len(x))) + match - 1
    total, a = np.cumsum(size), 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(total, total[a] - size[a] + PASS_BYTES, side="right")))
        n = size[a:b]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if not np.array_equal(text[np.repeat(x[first[a:b]], n) + step], text[np.repeat(y[first[a:b]], n) + step]):
            return False
        a = b
    return True


def shared_ranks(text: np.ndarray, starts: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """``(which, rank)``: the starts (ascending) whose ``match`` bytes occur at another one, and their suffix ranks.

    Equal bytes have equal hashes: a start whose window hash is alone has no agreement of
    ``match`` bytes and needs no rank.  Starts of one hash are compared byte by byte, each
    with the one before it; then the first of them is sorted and the others share its rank.
    If two texts have one hash, all starts are sorted.
    """
    names = window_hash(text, match)[starts]
    order = np.argsort(names, kind="stable")
    again = names[order][1:] == names[order][:-1]
    before = np.full(len(starts), -1)
    before[order[1:][again]] = order[:-1][again]
    later = np.flatnonzero(before >= 0)
    if not len(later):
        return later, later
    if not _agree(text, starts[later], starts[before[later]], match):
        return np.arange(len(starts)), suffix_ranks(text, starts, match)
    group = np.empty(len(starts), dtype=np.int64)
    group[order] = np.cumsum(np.concatenate([[True], ~again])) - 1
    first = order[np.concatenate([[True], ~again])]  # of each group, in its order
    heads = np.unique(first[group[later]])
    edge = np.zeros(len(text) + 1, dtype=np.int32)
    edge[starts[heads]] += 1
    np.add.at(edge, starts[heads] + match, -1)
    covered = np.cumsum(edge[:-1]) > 0
    rank = suffix_ranks(text[covered], (np.cumsum(covered) - 1)[starts[heads]], match)
    which = np.union1d(heads, later)
    return which, rank[np.searchsorted(heads, first[group[which]])]


def longest_previous(rank: np.ndarray, place: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Does the longest previous factor of each start, and the longest one later, reach ``match`` bytes?

    ``rank``: of the suffix, ``place``: its position (positions of all documents in one
    order).  In suffix order with ties by position, the previous smaller position is the
    last one before it that is smaller, the next smaller one the first after it.  Of
    equal suffixes the previous smaller one is the neighbour before, and no other
    suffix agrees in ``match`` bytes; so agreements are counted on neighbours, cut off at ``match``.
    """
    order = np.lexsort((place, rank))
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), dtype=bool), np.zeros(len(rank), dtype=bool)
    earlier[order[1:][same]] = True
    later[order[:-1][same]] = True
    return earlier, later


def _spans(match: int, later_only: bool):
    """(k, h, lo, hi) of the repeated windows of each stretch; rows arrive sorted by bucket and part."""

    def settle(rows):
        offset, ranks, stretch = [], [], []
        texts = [i for i, r in enumerate(rows) if r[6] is not None]
        joined, base = np.frombuffer(b"".join(rows[i][6] for i in texts), dtype=np.uint8), 0
        starts = []
        for i in texts:
            n = rows[i][5]
            starts.append(np.arange(base, base + n))
            offset.append(np.arange(n, dtype=np.int64))
            stretch.append(np.full(n, i))
            base += len(rows[i][6])
        if texts:
            which, rank = shared_ranks(joined, np.concatenate(starts), match)
            ranks.append(rank)
            offset, stretch = [np.concatenate(offset)[which]], [np.concatenate(stretch)[which]]
        split = [i for i, r in enumerate(rows) if r[6] is None]
        for i in split:
            offset.append(np.frombuffer(rows[i][7], dtype="<i4").astype(np.int64))
            stretch.append(np.full(len(offset[-1]), i))
        stretch = np.concatenate(stretch)
        bucket, k, at = (np.array([r[c] for r in rows], dtype=np.int64)[stretch] for c in (0, 2, 4))
        at = at + np.concatenate(offset)
        if split:  # whole buckets or split ones never mix, but several split ones may meet here
            names = mix64(np.concatenate([np.frombuffer(rows[i][8], dtype=np.uint64) for i in split])) ^ mix64(bucket[len(bucket) - sum(len(rows[i][8]) // 8 for i in split) :].view(np.uint64) + np.uint64(1))
            low = len(ranks[0]) if ranks else 0
            ranks.append(np.unique(names, return_inverse=True)[1] + low)
        place = np.empty(len(at), dtype=np.int64)
        place[np.lexsort((at, k))] = np.arange(len(at))
        earlier, later = longest_previous(np.concatenate(ranks), place, match)
        hit = np.flatnonzero(earlier if later_only else earlier | later)
        hit = hit[np.lexsort((at[hit], stretch[hit]))]
        s, o = stretch[hit], at[hit]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1] + 1)
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(s))[: len(a)] - 1
        h = np.array([r[3] for r in rows], dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(k[hit][a]), pa.array(h[s[a]]), pa.array(o[a].astype(np.int32)), pa.array((o[b] + match).astype(np.int32))], names=["k", "h", "lo", "hi"]
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if size > PASS_BYTES and r[:2] != held[-1][:2]:  # whole buckets only
                    yield settle(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[6] or r[8])
        if held:
            yield settle(held)

    return run


_RESULT = "k long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(batches):
    for batch in batches:
        out = []
        for k, body, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data = unpack(body)
            kept, removed, n, end = hashlib.sha256(), 0, 0, 0
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                if lo > end or n == 0:
                    kept.update(data[end:lo])
                    n += 1
                    start = lo
                else:
                    start = end
                if hi > start:
                    removed += hi - start
                    end = hi
            kept.update(data[end:])
            out.append((k, len(data), removed, n, kept.digest()))
        c = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.binary())], names=[x.split()[0] for x in _RESULT.split(", ")])


def repeated_spans(docs: DataFrame, match: int = MATCH, gram: int = GRAM, later_only: bool = False) -> DataFrame:
    """``(k, h, lo, hi)``: byte ranges of documents (``rolling.keyed``) covered by repeated strings of ``match`` bytes.

    ``later_only`` leaves the first occurrence of each string, by id and position.
    Ranges may overlap.
    """
    occ = cut_lineage(keyed(docs).mapInArrow(_stretches(match, gram), _OCC))
    company = occ.groupBy("bucket").agg(F.sum("weight").alias("n")).where("n > 1").select("bucket")
    live = cut_lineage(occ.join(splittable(company), "bucket", "left_semi"))
    kinds = live.groupBy("bucket", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"), F.min(F.struct("k", "at", "h", "starts")).alias("rep")
    )
    kinds = cut_lineage(kinds)
    # Texts are asked for where a bucket holds different stretches, or one that may repeat itself.
    sizes = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.max("weight").alias("own")).where("kinds > 1 OR own > 1")
    ask = kinds.join(splittable(sizes), "bucket").select(
        F.col("rep.k").alias("k"), F.col("rep.h").alias("h"),
        F.struct("bucket", F.col("rep.at").alias("at"), F.col("rep.starts").alias("starts"), F.ceil(F.col("kinds") / BLOCK).cast("int").alias("parts")).alias("w"),
    )
    wanted = ask.groupBy("k", "h").agg(F.collect_list("w").alias("wanted"))  # bounded by the length of one document
    rows = packed(docs).join(wanted, ["k", "h"]).select("k", "h", "body", "wanted").mapInArrow(_texts(match), _BUCKET)
    rows = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    compared = rows.mapInArrow(_spans(match, later_only), "k long, h int, lo int, hi int")
    # Stretches that occur as a whole more than once need no comparison.
    copies = kinds.where("n > 1").select("bucket", "digest", F.col("rep.k").alias("rep_k"), F.col("rep.at").alias("rep_at"))
    whole = live.join(copies, ["bucket", "digest"])
    if later_only:
        whole = whole.where("NOT (k = rep_k AND at = rep_at)")
    return compared.unionByName(whole.select("k", "h", F.col("at").alias("lo"), (F.col("at") + F.col("starts") + (match - 1)).cast("int").alias("hi")))


def remove_repeats(docs: DataFrame, match: int = MATCH, gram: int = GRAM, later_only: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null text: empty.  Texts shorter than ``match`` keep everything.  Rows with a null
    doc_id are documents like any other; rows that repeat an id and its text are
    occurrences of their own.  An empty table gives an empty result; other columns are
    ignored.
    """
    spans = repeated_spans(docs, match, gram, later_only).groupBy("k", "h").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    out = packed(docs).join(spans, ["k", "h"], "left").select("k", "body", "spans").mapInArrow(_remove, _RESULT)
    doc_id = F.when(F.col("k") != LEAST_ID, F.col("k")).alias("doc_id")
    return out.select(doc_id, "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))
