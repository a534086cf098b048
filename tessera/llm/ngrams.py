"""Words of Arrow string batches and an open-addressed table that interns their n-grams, as array operations.

A word is a maximal run of ASCII digits and letters and of code points over 127; only
A-Z are lower-cased.  In UTF-8 that is a question of single bytes, so a batch is
scanned as one byte array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of text scanned at once (a longer text is scanned alone) and n-grams a table interns at most.
PASS_BYTES, PASS_GRAMS = 4 << 20, 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True
#: The five primes of XXH64 (fixed values).
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(11400714785074694791), np.uint64(14029467366897019727), np.uint64(1609587929392839161),
    np.uint64(9650029242287828579), np.uint64(2870177450012600261),
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


@dataclass
class Grams:
    """N-grams of some texts: byte ranges of ``data`` (padded by 8 bytes), with the number of their text."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray

    def part(self, a: int, b: int) -> Grams:
        return Grams(self.data, self.start[a:b], self.length[a:b], self.text[a:b])

    def read(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.length[i]].tobytes()

    def _lanes(self) -> np.ndarray:
        """The eight bytes from every position as a little-endian number."""
        return np.ndarray(len(self.data) - 7, dtype="<u8", buffer=self.data, strides=(1,))

    def keys(self) -> np.ndarray:
        """XXH64 (seed 0) of every n-gram: in step for those under 32 bytes, one by one for longer ones."""
        import xxhash

        lanes, n = self._lanes(), self.length
        h = n.astype(np.uint64) + _P5
        for i in range(3):  # whole eights
            on = np.flatnonzero((n >> 3 > i) & (n < 32))
            if len(on):
                h[on] = _turn(h[on] ^ (_turn(lanes[self.start[on] + 8 * i] * _P2, 31) * _P1), 27) * _P1 + _P4
        at = self.start + (n & ~7)
        on = np.flatnonzero((n & 4 != 0) & (n < 32))
        if len(on):
            h[on] = _turn(h[on] ^ ((lanes[at[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at += n & 4
        for i in range(3):
            on = np.flatnonzero((n & 3 > i) & (n < 32))
            if len(on):
                h[on] = _turn(h[on] ^ (self.data[at[on] + i].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(n >= 32):
            h[i] = xxhash.xxh64_intdigest(self.read(i))
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are the bytes of n-grams a[i] and b[i] equal?  (Their lengths are.)"""
        lanes, out = self._lanes(), np.ones(len(a), dtype=bool)
        x, y, n = self.start[a], self.start[b], self.length[a]
        left, at = np.flatnonzero(a != b), 0
        while len(left):
            rest = np.minimum(n[left] - at, 8).astype(np.uint64)
            differ = (lanes[x[left] + at] ^ lanes[y[left] + at]) << (np.uint64(8) * (np.uint64(8) - rest))
            out[left[differ != 0]] = False
            at += 8
            left = left[(differ == 0) & (n[left] > at)]
        return out


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets (one more than texts) of an Arrow string column without nulls."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    o = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def _scan(data: np.ndarray, offsets: np.ndarray, first: int, longest: int) -> Grams:
    """All runs of 1 to ``longest`` words of these texts, words joined by one space, shorter runs first."""
    low = _LOWER[data]
    inside = _WORD[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(low))]  # no word crosses texts
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, side="right") - 1 + first
    size = end - start
    if longest > 1:  # the words in a row, one space after each
        start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        joined = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
        letters = np.ones(len(joined), dtype=bool)
        letters[start + size] = False
        joined[letters] = low[inside]
        low = joined
    padded = np.concatenate([low, np.zeros(8, dtype=np.uint8)])
    starts, sizes, texts = [start], [size], [text]
    for k in range(2, longest + 1):
        if len(start) >= k:
            ok = text[: -k + 1] == text[k - 1 :]
            starts.append(start[: -k + 1][ok])
            sizes.append((start[k - 1 :] + size[k - 1 :] - start[: -k + 1])[ok])
            texts.append(text[: -k + 1][ok])
    return Grams(padded, np.concatenate(starts), np.concatenate(sizes), np.concatenate(texts))


def scan(column, longest: int = 1) -> Iterator[Grams]:
    """N-grams of the texts of an Arrow string column, for some whole texts at a time."""
    data, offsets = text_bytes(column)
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PASS_BYTES, side="right")) - 1)
        yield _scan(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a, longest)
        a = b


class InternTable:
    """Open addressing with linear probing: ``slot`` of every occurrence, ``owner`` (an occurrence, or -1) of every slot.

    The key of an n-gram is its XXH64; an occurrence takes a slot only if key, length
    and bytes are the owner's.  All occurrences probe in step, one slot a round, so
    equal n-grams always meet.  At most half of the slots are in use.
    """

    def __init__(self, grams: Grams, keys: np.ndarray | None = None) -> None:
        n = len(grams.start)
        size = 1 << max(4, (2 * n - 1).bit_length())
        key = grams.keys() if keys is None else keys
        at = (key & np.uint64(size - 1)).astype(np.int64)
        self.grams, self.slot, self.owner = grams, np.empty(n, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        todo = np.arange(n)
        while len(todo):
            here = at[todo]
            free = self.owner[here] < 0
            self.owner[here[free]] = todo[free]
            owner = self.owner[here]
            hit = np.flatnonzero((key[owner] == key[todo]) & (grams.length[owner] == grams.length[todo]))
            hit = hit[grams.same(owner[hit], todo[hit])]
            self.slot[todo[hit]] = here[hit]
            missed = np.ones(len(todo), dtype=bool)
            missed[hit] = False
            todo = todo[missed]
            at[todo] = (at[todo] + 1) & (size - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)

    def value(self, of) -> np.ndarray:
        """A number per slot, ``of(bytes)`` of its n-gram (0 where free): worked out once per distinct n-gram."""
        out = np.zeros(len(self.owner), dtype=np.int64)
        out[self.used] = [of(self.grams.read(i)) for i in self.owner[self.used].tolist()]
        return out


def tables(column, longest: int = 1) -> Iterator[InternTable]:
    """Interned n-grams of a string column, ``PASS_GRAMS`` at a time."""
    for grams in scan(column, longest):
        for a in range(0, len(grams.start), PASS_GRAMS):
            yield InternTable(grams.part(a, a + PASS_GRAMS))
