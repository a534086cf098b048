"""Quality by naive Bayes support vectors.

Indicators of word and punctuation n-grams (one and two tokens) are scaled by their
class log-count ratios; a linear hinge-loss model is fitted to them by dual coordinate
descent, and a logistic curve on rows kept out of that fit turns margins into scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, text_of, training_rows
from tessera.session import cut_lineage

#: Labelled rows the model is fitted on (bounded sample; scoring reads everything).
TRAIN_ROWS = 6_000
#: Hashed n-gram indicators, smoothing of the counts, cost of the hinge loss, passes.
DIM_BITS, SMOOTH, COST, EPOCHS = 18, 1.0, 1.0, 40
TOKEN = re.compile(r"\w+|[^\w\s]+")
MOST_TOKENS = 400_000


class Indicators:
    """Distinct hashed n-grams of a text; hashes of known tokens are kept, up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        import xxhash

        known, h64, words = self.known, xxhash.xxh3_64_intdigest, TOKEN.findall(text)
        if len(known) > MOST_TOKENS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = h64(w.lower().encode("utf-8", "surrogatepass"))
        one = np.array([known[w] for w in words], dtype=np.uint64)
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique((np.concatenate([one, two, self.repeats(one)]) >> np.uint64(64 - DIM_BITS)).astype(np.int32))

    @staticmethod
    def repeats(one: np.ndarray) -> np.ndarray:
        """Indicators of two- and three-grams of one repeated token: their number and share, in steps."""
        out = []
        for k in (1, 2):
            same = one[k:] == one[:-k] if len(one) > k else np.zeros(0, dtype=bool)
            n = int((same if k == 1 else same & (one[1:-1] == one[2:])).sum()) if len(same) else 0
            out += [(k, 0, n.bit_length()), (k, 1, int(np.ceil(10 * n / max(1, len(one)))))]
        return np.array([hash(x) & 0xFFFFFFFF for x in out], dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Naive Bayes log ratio of every indicator."""
    pos, neg = np.full(1 << DIM_BITS, SMOOTH), np.full(1 << DIM_BITS, SMOOTH)
    for r, label in zip(rows, y):
        (pos if label else neg)[r] += 1
    return np.log(pos / pos.sum()) - np.log(neg / neg.sum())


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over scaled, length-normalised indicators, one dual variable at a time."""
    x = [ratio[r] / (np.linalg.norm(ratio[r]) or 1.0) for r in rows]
    sign, w, bias = np.where(y > 0, 1.0, -1.0), np.zeros(1 << DIM_BITS), 0.0
    # A rarer class weighs more, so that the margin isn't left to the common one.
    share = y.mean()
    top = np.where(y > 0, cost * 0.5 / max(share, 1e-9), cost * 0.5 / max(1 - share, 1e-9))
    alpha, rng = np.zeros(len(y)), np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            r, v = rows[i], x[i]
            g = sign[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - g / (v @ v + 1.0), 0.0), top[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[r] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels (smoothed targets, Newton steps)."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        q = p * (1 - p) + 1e-9
        g = np.array([((p - t) * margin).sum() + 1e-3 * (a - 1), (p - t).sum()])
        h = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, r: np.ndarray) -> float:
        v = self.ratio[r]
        return float(self.weight[r] @ v / (np.sqrt(v @ v) or 1.0) + self.bias)

    def score(self, r: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(r) + self.offset, -30, 30))))

    def column(self, text: Column) -> Column:
        """Score of a text column, 0 to 1."""
        model, state = self, []

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            if not state:
                state.append(Indicators())
            return pd.Series([model.score(state[0](t)) for t in texts], dtype="float64")

        return score(text)


def fit(rows: list[np.ndarray], y: np.ndarray) -> QualityModel:
    """Fit on four rows of five, calibrate on the fifth."""
    fifth = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~fifth])) < 2 or not fifth.any():  # one class or nothing to learn from: a constant score
        p = (y.sum() + 1) / (len(y) + 2)
        return QualityModel(np.zeros(1 << DIM_BITS, np.float32), np.zeros(1 << DIM_BITS, np.float32), 0.0, 1.0, float(np.log(p / (1 - p))))
    own = [r for r, f in zip(rows, fifth) if not f]
    ratio = log_count_ratio(own, y[~fifth])
    weight, bias = dual_descent(own, y[~fifth], ratio)
    model = QualityModel(ratio.astype(np.float32), weight.astype(np.float32), bias, 1.0, 0.0)
    model.slope, model.offset = calibrate(np.array([model.margin(r) for r, f in zip(rows, fifth) if f]), y[fifth])
    return model


def train_quality(docs: DataFrame, marks: DataFrame, bound: int = TRAIN_ROWS) -> QualityModel:
    """Fit on at most about ``bound`` labelled rows of the training folds (their hashed indicators come to the driver)."""

    def run(batches):
        indicators = Indicators()
        for b in batches:
            x = [indicators(t).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1)], names=["x", "y"])

    got = cut_lineage(training_rows(docs, marks, "quality", bound).mapInArrow(run, "x binary, y int")).toPandas()
    got = got.sort_values(["x", "y"]).reset_index(drop=True)  # the same model whatever the partitions
    order = np.random.default_rng(11).permutation(len(got))
    rows = [np.frombuffer(bytes(got["x"][i]), dtype=np.int32) for i in order]
    return fit(rows, got["y"].to_numpy(dtype=float)[order])


def quality(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Null or empty texts have no indicators and score by the bias alone.  A null doc_id
    is not held out and gives no training row.  Without labels every score is 0.5.
    Repeated rows give repeated results; other columns are ignored.
    """
    model = train_quality(docs, marks)
    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), model.column(text_of(docs)).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
