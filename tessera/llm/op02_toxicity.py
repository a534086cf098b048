"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause.  A lexical acceptor turns words into symbols: insults
and threats (fixed words and learned stems, each with a weight), targets, negations
and verbs of reported speech.  Three transducers - target, negation, reported speech -
each rewrite the symbols within their scope; composed once into a single deterministic
machine, they turn "you are an idiot", "not an idiot" and "she said he was an idiot"
into different matches.  A clause is scored by its matches, never by loose words, and
a logistic model over the matched weights gives the score.

Stems are learned with weights from labelled rows: word prefixes whose documents are
toxic far more often than chance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, text_of, training_rows
from tessera.session import cut_lineage

#: Labelled rows the grammar is fitted on (bounded sample; scoring reads everything).
TRAIN_ROWS = 12_000
#: Learned stems: prefix lengths, least toxic documents, least odds ratio, most stems kept.
STEM_LENGTHS = range(3, 9)
STEM_SUPPORT, STEM_ODDS, STEM_MOST = 5, 20.0, 400
#: Texts whose stems a task counts at once.
GROUP = 128

# Word lists of the grammar.
INSULTS = [
    "asshole", "bastard", "bitch", "clown", "cretin", "crétin", "disgusting", "dumb", "dummkopf", "estúpido", "fool",
    "freak", "garbage", "idiot", "idiota", "imbecile", "imbécil", "imbécile", "jerk", "loser", "moron", "pathetic",
    "scum", "stupid", "stupide", "trash", "vermin", "worthless", "wretch", "abschaum", "blödmann", "trottel", "ordure",
    "basura", "tonto",
]
THREATS = [
    "kill", "hurt", "destroy", "murder", "strangle", "stab", "beat", "burn", "töten", "umbringen", "verletzen",
    "tuer", "frapper", "détruire", "matar", "golpear", "destruir",
]
TARGETS = [
    "you", "your", "yours", "u", "he", "she", "they", "them", "him", "her", "du", "dich", "dir", "ihr", "euch", "sie",
    "tu", "toi", "vous", "ils", "elles", "tú", "usted", "ustedes", "vosotros", "ellos", "ellas",
]
NEGATIONS = [
    "not", "no", "never", "isn't", "aren't", "wasn't", "don't", "nobody", "nicht", "kein", "keine", "keiner", "niemals",
    "ne", "pas", "jamais", "nunca", "jamás", "ni",
]
REPORTS = [
    "said", "says", "say", "called", "calls", "wrote", "writes", "claimed", "quoted", "reported", "sagte", "schrieb",
    "nannte", "dit", "écrit", "appelé", "dijo", "escribió", "llamó",
]

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]+|[,|]\s")
KINDS = ["insult", "threat"]
#: Features: kind x targeted x negated x reported.
MATCHES = [(k, t, n, r) for k in KINDS for t in (0, 1) for n in (0, 1) for r in (0, 1)]
INDEX = {m: i for i, m in enumerate(MATCHES)}


@dataclass
class Transducer:
    """A deterministic letter transducer: ``step[state, symbol] -> (state, symbol)``; others pass unchanged to ``rest[state]``."""

    start: int
    step: dict
    rest: dict

    def move(self, state: int, symbol):
        return self.step.get((state, symbol), (self.rest[state], symbol))


def _scoped(opens: str, position: int, scope: int) -> Transducer:
    """After ``opens``, matches among the next ``scope`` words get their flag at ``position`` set (a match closes the scope)."""
    step, rest = {}, {0: 0}
    for s in range(scope + 1):
        step[s, opens] = (scope, opens)
        if s:
            rest[s] = s - 1
            for m in MATCHES:
                step[s, m] = (s - 1, tuple(1 if i == position else v for i, v in enumerate(m)))
    return Transducer(0, step, rest)


def compose(machines: list[Transducer], symbols: list) -> tuple[dict, tuple]:
    """One machine that does the work of all, in order: ``table[state, symbol] -> (state, symbol)`` over reachable states."""
    start = tuple(m.start for m in machines)
    table, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            out, nxt = symbol, []
            for m, s in zip(machines, state):
                s2, out = m.move(s, out)
                nxt.append(s2)
            nxt = tuple(nxt)
            table[state, symbol] = (nxt, out)
            if nxt not in seen:
                seen.add(nxt)
                todo.append(nxt)
    return table, start


PLAIN = [(k, 0, 0, 0) for k in KINDS]
#: Target within 6 words before a match, negation within 3, reported speech for the rest of the clause (12 words).
GRAMMAR, START = compose([_scoped("target", 1, 6), _scoped("negation", 2, 3), _scoped("report", 3, 12)], [*PLAIN, "target", "negation", "report", "other"])
#: Prior weights: a match counts, a target adds, negation and reported speech take away.
PRIOR = np.array([1.2 + 0.6 * t - 0.9 * n - 0.7 * r for _, t, n, r in MATCHES])
PRIOR_BIAS, PRIOR_VARIANCE = -3.0, 4.0


class Grammar:
    """Lexical acceptor and composed machine; ``stems`` maps a learned word prefix to (kind, weight)."""

    def __init__(self, stems: dict[str, float], dropped: frozenset[str] = frozenset()):
        self.words: dict[str, object] = {}
        for name, words in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS)):
            self.words |= dict.fromkeys(words, name)
        self.weights = {w: 1.0 for w in [*INSULTS, *THREATS] if w not in dropped}
        self.words |= {w: PLAIN[0] for w in INSULTS if w not in dropped} | {w: PLAIN[1] for w in THREATS if w not in dropped}
        self.stems = stems
        exact = sorted((w for w, s in self.words.items() if s in PLAIN), key=len, reverse=True)
        heads = [re.escape(w) + r"(?!\w)" for w in exact] + [re.escape(s) for s in sorted(stems, key=len, reverse=True)]
        self.anchor = re.compile(r"(?<!\w)(?:" + "|".join(heads) + ")")
        self.lengths = sorted({len(s) for s in stems}, reverse=True)

    def symbol(self, word: str):
        """(symbol, weight) of a lower-case word."""
        s = self.words.get(word)
        if s in PLAIN:
            return s, self.weights[word]
        for k in self.lengths:
            w = self.stems.get(word[:k])
            if w is not None:
                return PLAIN[0], w
        return s or "other", 0.0

    def features(self, text: str) -> np.ndarray:
        """Matched weight per kind of match, over the clauses of a text."""
        low, out = text.lower(), np.zeros(len(MATCHES))
        hit, pos = self.anchor.search(low), 0
        if hit is None:
            return out
        ends = [m.end() for m in CLAUSE.finditer(low)] + [len(low)]
        for end in ends:
            if hit is None:
                break
            if hit.start() < end:  # only clauses that hold a match run through the machine
                state = START
                for word in WORD.findall(low[pos:end]):
                    symbol, weight = self.symbol(word)
                    state, match = GRAMMAR[state, symbol]
                    if weight:
                        out[INDEX[match]] += weight
                hit = self.anchor.search(low, end)
            pos = end
        return out


def _keys(text: str) -> set[str]:
    """Prefixes of the words of a text, and its whole words (ending in a blank)."""
    words = set(WORD.findall(text.lower()))
    return {w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k} | {w + " " for w in words}


def _stem_counts(among: frozenset[str] | None):
    """(stem, documents) over a task's texts, ``GROUP`` texts at a time; ``among``: only these stems."""

    def run(batches):
        for b in batches:
            texts = b.column(0)
            for i in range(0, len(texts), GROUP):
                count: Counter[str] = Counter()
                for text in texts.slice(i, GROUP).to_pylist():
                    keys = _keys(text)
                    count.update(keys if among is None else keys & among)
                yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["stem", "n"])

    return run


def _count(texts: DataFrame, among: frozenset[str] | None, least: int) -> dict[str, int]:
    """Documents of each stem, at least ``least``; bounded by the words of the bounded training sample."""
    counts = texts.select("text").mapInArrow(_stem_counts(among), "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    return {r.stem: r.n for r in counts.where(F.col("n") >= least).toLocalIterator()}


def learn_stems(train: DataFrame) -> tuple[dict[str, float], frozenset[str]]:
    """Weighted stems whose documents are toxic, and fixed words the labels speak against."""
    total = train.agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    pos, neg = int(total.t or 0), int(total.n) - int(total.t or 0)
    if not pos or not neg:
        return {}, frozenset()
    fixed = frozenset(w + " " for w in [*INSULTS, *THREATS])
    toxic = _count(train.where("y = 1"), None, STEM_SUPPORT)
    clean = _count(train.where("y = 0"), frozenset(toxic) | fixed, 1)
    odds = {s: ((toxic.get(s, 0) + 0.5) / (pos + 1)) / ((clean.get(s, 0) + 0.5) / (neg + 1)) for s in {*toxic, *clean}}
    found = sorted((s for s in toxic if odds[s] >= STEM_ODDS), key=lambda s: (-toxic[s] * math.log(odds[s]), -len(s), s))
    stems: dict[str, float] = {}
    for key in found[:STEM_MOST]:
        s = key.rstrip(" ")
        if not any(s.startswith(o) or o.startswith(s) for o in stems):
            stems[s] = min(1.5, math.log(odds[key]) / math.log(STEM_ODDS) / 2)
    against = {w.strip() for w in fixed if clean.get(w, 0) >= STEM_SUPPORT and odds[w] < 1.5}
    return stems, frozenset(against)


def fit(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic weights (bias last) by Newton steps, drawn to the prior weights."""
    prior = np.append(PRIOR, PRIOR_BIAS)
    a, w = np.hstack([x, np.ones((len(x), 1))]), prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + (w - prior) / PRIOR_VARIANCE
        h = (a * (p * (1 - p))[:, None]).T @ a + np.eye(len(w)) / PRIOR_VARIANCE
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    stems: dict[str, float]
    dropped: frozenset[str]
    weights: np.ndarray

    def column(self, text: Column) -> Column:
        """Score of a text column, 0 to 1."""
        stems, dropped, w = self.stems, self.dropped, self.weights
        grammar: list[Grammar] = []

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            if not grammar:
                grammar.append(Grammar(stems, dropped))
            rows = np.array([grammar[0].features(t) for t in texts]).reshape(-1, len(MATCHES))
            return pd.Series(1 / (1 + np.exp(-np.clip(np.log1p(rows) @ w[:-1] + w[-1], -30, 30))))

        return score(text)


def train_toxicity(docs: DataFrame, marks: DataFrame, bound: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit stems and match weights on at most ``bound`` labelled rows of the training folds."""
    train = cut_lineage(training_rows(docs, marks, "toxic", bound))
    stems, dropped = learn_stems(train)

    def run(batches):
        grammar = Grammar(stems, dropped)
        for b in batches:
            x = [grammar.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tolist() for r in x], pa.list_(pa.float64())), b.column(1)], names=["x", "y"])

    rows = train.mapInArrow(run, "x array<double>, y int").toPandas()  # at most ``bound`` rows of 16 numbers
    x = np.log1p(np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(MATCHES)))
    return ToxicityModel(stems, dropped, fit(x, rows["y"].to_numpy(dtype=float)))


def toxicity(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Null or empty texts score as a text without matches.  A null doc_id is not held
    out and gives no training row.  Without labels (an empty table) the prior weights
    score.  Repeated rows give repeated results; other columns are ignored.
    """
    model = train_toxicity(docs, marks)
    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), model.column(text_of(docs)).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
