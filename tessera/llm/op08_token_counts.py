"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers are compiled from the tokenizer file:

* ``Splitter`` reads character classes and marks where pre-tokens start.  A text is cut
  into chunks; each chunk gives a state map (entry state -> exit state), the maps are
  composed by a parallel prefix scan, and with the entry states known every chunk emits
  its marks.  All of it runs on arrays over many chunks at once.
* ``MergeTransducer`` reads the bytes of a pre-token and annotates each transition with
  the tokens it adds.  A prefix has exactly one encoding whose neighbours are all
  stable under the merges, so its last token follows from the last tokens at the
  starts of the vocabulary entries still open.  That set is the state; states and
  transitions are made when first reached and dropped when too many (the result does
  not depend on it).
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.llm.pretokens import NUMBER, OTHER, QUOTE, SPACE, WHITE, byte_letters, class_table, load

LIMIT = 512
#: Characters an array pass holds, and the length of its chunks.
PASS_CHARS, CHUNK = 2_000_000, 256
MOST_STATES, MOST_WORDS = 300_000, 600_000
#: Pre-tokens up to this many bytes run in lockstep.
LANE_BYTES = 48

# Input classes of the splitter beyond those of pretokens (letters that occur in contractions, end of a text).
ONE, FIRST, E, ELL, END = 6, 7, 8, 9, 10
N_CLASSES = 11
# States: what the last characters were.
(AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, SPACES, ONE_WHITE, WHITES, AT_QUOTE, QUOTE_FIRST, QUOTE_ELL, AFTER_SHORT) = range(12)
N_STATES = 12
HERE, BEFORE = 1, 2  # marks: a pre-token starts at this character, at the one before


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """``(next state, marks)`` by state and class."""
    move, mark = np.zeros((N_STATES, N_CLASSES), dtype=np.uint8), np.zeros((N_STATES, N_CLASSES), dtype=np.uint8)

    def fresh(c: int) -> int:
        if c == NUMBER:
            return IN_NUMBERS
        if c == OTHER:
            return IN_OTHERS
        if c == WHITE:
            return ONE_WHITE
        if c == SPACE:
            return ONE_SPACE
        if c == QUOTE:
            return AT_QUOTE
        return AT_START if c == END else IN_LETTERS

    run = {IN_LETTERS: IN_LETTERS, IN_NUMBERS: IN_NUMBERS, IN_OTHERS: IN_OTHERS, AT_QUOTE: IN_OTHERS}

    def step(s: int, c: int) -> tuple[int, int]:
        if s in (AT_START, AFTER_SHORT):
            return fresh(c), HERE
        if s in (QUOTE_FIRST, QUOTE_ELL):  # a contraction may end here; else its letter began a word
            if c == (E if s == QUOTE_FIRST else ELL):
                return AFTER_SHORT, 0
            nxt, m = step(IN_LETTERS, c)
            return nxt, m | BEFORE
        if s == AT_QUOTE and c in (ONE, FIRST, ELL):
            return {ONE: AFTER_SHORT, FIRST: QUOTE_FIRST, ELL: QUOTE_ELL}[c], 0
        if s in (ONE_SPACE, SPACES, ONE_WHITE, WHITES):
            if c in (WHITE, SPACE):
                return (SPACES if c == SPACE else WHITES), 0
            if c == END:
                return AT_START, HERE
            last = BEFORE if s in (SPACES, WHITES) else 0  # the run's last character parts from it
            if s in (ONE_SPACE, SPACES):  # a space joins the word
                joined = fresh(c)
                return (IN_OTHERS if joined == AT_QUOTE else joined), last
            return fresh(c), last | HERE
        kind = fresh(c)
        if run[s] == (IN_OTHERS if kind == AT_QUOTE else kind):
            return run[s], 0
        return kind, HERE

    for s in range(N_STATES):
        for c in range(N_CLASSES):
            move[s, c], mark[s, c] = step(s, c)
    return move, mark


@lru_cache(maxsize=4)
def _classes(tokenizer_file: str) -> np.ndarray:
    table = class_table(tokenizer_file).copy()
    for letters, c in (("stmd", ONE), ("rv", FIRST), ("e", E), ("l", ELL)):
        table[[ord(x) for x in letters]] = c
    return table


def scan(maps: np.ndarray) -> np.ndarray:
    """Entry state of every chunk from the chunks' state maps (inclusive prefix composition, log rounds)."""
    maps, d = maps.copy(), 1
    while d < len(maps):
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), axis=1)
        d *= 2
    return np.concatenate([[AT_START], maps[:-1, AT_START]]).astype(np.uint8)


def mark_starts(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Positions where pre-tokens start; ``classes`` ends with END."""
    move, mark = splitter()
    flat_move = move.ravel()
    n = len(classes)
    k = -(-n // chunk)
    cols = np.full((k, chunk), END, dtype=np.uint8)
    cols.ravel()[:n] = classes
    cols = np.ascontiguousarray(cols.T)
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8)[:, None], (1, k))  # state map of each chunk, by entry state
    for row in cols:
        maps = flat_move[maps * np.uint8(N_CLASSES) + row]
    state = scan(np.ascontiguousarray(maps.T))
    marks = np.empty((chunk, k), dtype=np.uint8)
    flat_mark = mark.ravel()
    for j, row in enumerate(cols):
        at = state * np.uint8(N_CLASSES) + row
        marks[j] = flat_mark[at]
        state = flat_move[at]
    marks = np.ascontiguousarray(marks.T).ravel()[:n]
    first = (marks & HERE) > 0
    first[:-1] |= (marks[1:] & BEFORE) > 0
    return np.flatnonzero(first)


class MergeTransducer:
    """Tokens of one pre-token, byte by byte."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        spell = lambda s: bytes(letters[ch] for ch in s)
        rank = {bytes([b]): b for b in range(256)}  # bytes first, then the merges in order
        self.parts, self.merged = [(b, b) for b in range(256)], {}
        for m in model["merges"]:
            a, b = (spell(x) for x in (m if isinstance(m, list) else m.split(" ")))
            pair = rank[a], rank[b]
            token = rank.setdefault(a + b, len(rank))
            self.merged.setdefault(pair, token)
            if token == len(self.parts):
                self.parts.append(pair)
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [False]
        for word, r in rank.items():
            node = 0
            for byte in word:
                key, nxt = node << 8 | byte, self.child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = nxt
            self.token[node] = r
        self.beside: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]  # open entries: (trie node, last token at their start, tokens there - tokens here)
        self.ids = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def stable(self, a: int, b: int) -> bool:
        """No merge crosses the border of tokens ``a b``: undo both sides' merges, latest first, and look for an earlier one across."""
        key = (a, b)
        if (known := self.beside.get(key)) is not None:
            return known
        bound, answer = len(self.parts), None
        while answer is None:
            if self.merged.get((a, b), bound) < bound:
                answer = False
            elif a > b and a > 255:
                bound, a = a, self.parts[a][1]
            elif b > 255:
                bound, b = b + 1, self.parts[b][0]
            elif a > 255:
                bound, a = a, self.parts[a][1]
            else:
                answer = True
        self.beside[key] = answer
        return answer

    def make(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state on a byte: (next state, tokens added)."""
        opened, last, count = [], None, 0
        for node, before, tokens in self.states[state]:
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            t = self.token[nxt]
            if last is None and t >= 0 and (before < 0 or self.stable(before, t)):
                last, count = t, tokens + 1
            if self.inner[nxt]:
                opened.append((nxt, before, tokens))
        key = (*((n, b, t - count) for n, b, t in opened), (0, last, 0))
        new = self.ids.get(key)
        if new is None:
            new = self.ids[key] = len(self.states)
            self.states.append(key)
        out = self.moves[state << 8 | byte] = (new, count)
        return out

    def count_all(self, words: list[bytes]) -> list[int]:
        """Tokens of each pre-token: one lane per word, all lanes a byte at a time, each distinct move looked up once."""
        if len(self.states) > MOST_STATES:
            self.reset()
            self.beside.clear()
        out = np.zeros(len(words), dtype=np.int64)
        size = np.array([len(w) for w in words], dtype=np.int64)
        for i in np.flatnonzero(size > LANE_BYTES):
            out[i] = self.count(words[i])
        lanes = np.flatnonzero(size <= LANE_BYTES)
        lanes = lanes[np.argsort(-size[lanes], kind="stable")]  # longest first: the lanes still running are a prefix
        if len(lanes):
            longest = int(size[lanes[0]])
            letters = np.array([words[i] for i in lanes], dtype=f"S{max(1, longest)}").view(np.uint8).reshape(len(lanes), -1)
            state, total = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes), dtype=np.int64)
            running, moves = len(lanes), self.moves
            for j in range(longest):
                while running and size[lanes[running - 1]] <= j:
                    running -= 1
                keys, which = np.unique(state[:running] << 8 | letters[:running, j], return_inverse=True)
                got = np.array([moves.get(k) or self.make(k >> 8, k & 255) for k in keys.tolist()], dtype=np.int64)
                state[:running] = got[which, 0]
                total[:running] += got[which, 1]
            out[lanes] = total
        return out.tolist()

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        state, total, moves = 0, 0, self.moves
        for byte in word:
            got = moves.get(state << 8 | byte)
            state, add = got if got is not None else self.make(state, byte)
            total += add
        return total


class Counter:
    """Token counts of whole texts, as the library gives them (special strings in a text are one token)."""

    def __init__(self, tokenizer_file: str):
        self.classes = _classes(tokenizer_file)
        self.merge = MergeTransducer(tokenizer_file)
        special = [t.content for t in load(tokenizer_file).get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        out, group, size = np.zeros(len(texts), dtype=np.int64), [], 0
        for i, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                out[i] += len(parts) - 1
            for part in parts:
                for piece in _pieces(part):
                    group.append((i, piece))
                    size += len(piece) + 1
                    if size > PASS_CHARS:
                        self._add(group, out)
                        group, size = [], 0
        self._add(group, out)
        return out.tolist()

    def _add(self, group: list[tuple[int, str]], out: np.ndarray) -> None:
        if not group:
            return
        joined = "\n".join(p for _, p in group) + "\n"
        classes = self.classes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        ends = np.cumsum([len(p) + 1 for _, p in group]) - 1
        classes[ends] = END
        at = mark_starts(classes)
        spots = at.tolist()
        words = [joined[a:b] for a, b in zip(spots, [*spots[1:], len(joined)])]
        known = self.known
        if len(known) > MOST_WORDS:
            known.clear()
        new = [w for w in set(words) if w not in known]
        known.update(zip(new, self.merge.count_all([w.encode("utf-8", "surrogatepass") for w in new])))
        tokens = np.array([known[w] for w in words], dtype=np.int64)
        doc = np.searchsorted(ends, at)
        tokens[at == ends[doc]] = 0  # the joints
        np.add.at(out, [i for i, _ in group], np.bincount(doc, weights=tokens, minlength=len(group)).astype(np.int64))


def _pieces(text: str):
    """A very long text in parts, cut where white space follows another character (always a pre-token border)."""
    start = 0
    while len(text) - start > PASS_CHARS:
        m = _CUT.search(text, start + PASS_CHARS - 1)
        if not m:
            break
        yield text[start : m.start() + 1]
        start = m.start() + 1
    yield text[start:] if start else text


_CUT = re.compile(r"[^\s\x1c-\x1f](?=[ \t\n\r])")


def token_count(text: Column, tokenizer_file: str) -> Column:
    """Number of tokens of a text column (null text: 0)."""
    counter: list[Counter] = []

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        if not counter:
            counter.append(_counter(tokenizer_file))
        return pd.Series(counter[0](texts.tolist()), dtype="int64")

    return count(text)


@lru_cache(maxsize=2)
def _counter(tokenizer_file: str) -> Counter:
    return Counter(tokenizer_file)


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    Null text: empty, 0 tokens.  Null doc_id and repeated rows give rows like any
    other; very long texts are read in parts.  An empty table gives an empty result;
    other columns are ignored.
    """
    d = docs.select("doc_id", text_of(docs).alias("text"))
    out = d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), token_count(F.col("text"), tokenizer_file).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
