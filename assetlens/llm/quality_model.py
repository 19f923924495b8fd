"""Quality classifier by positive-unlabelled learning.

The trainer sees trusted positives and unlabelled web text, never a negative. A linear model minimises the
non-negative unbiased risk: the positive part ``prior * E_p[loss(+)]`` plus the negative part ``E_u[loss(-)] - prior *
E_p[loss(-)]``, which an overfitted model can push below zero; where that happens the step goes up the negative part
instead. The class prior is estimated from the same two samples: above any cut of a score, the share of unlabelled
text is at least ``prior`` times the share of positives, so the smallest such ratio bounds it.

Features are shares of character classes, of pairs of them and of repeated words, computed from the text alone. Fitting
uses a bounded sample (``sample`` rows of each kind, picked by hash of the id); scoring is a map over all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import fold

SAMPLE = 10_000
THRESHOLD = 0.3

# Classes of UTF-8 bytes: letters by case, digits, spaces, line ends, sentence marks, loud marks, symbols, non-ASCII, rest.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:'\"-()", "!?",
           "#*$%&|<>@^_=+~/\\[]{}`")
N_CLASSES = len(CLASSES) + 2
_CLASS = np.full(256, N_CLASSES - 1, np.uint8)
_CLASS[0x80:] = N_CLASSES - 2
for _i, _chars in enumerate(CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _i
N_FEATURES = N_CLASSES + N_CLASSES ** 2 + 6
CHUNK = 1 << 20


def features(text: str | None) -> np.ndarray:
    """The feature vector of one whole text; a null text counts as empty, an empty one has zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(N_FEATURES)
    if not len(raw):
        return out
    pairs = np.zeros(N_CLASSES ** 2, np.int64)
    single = np.zeros(N_CLASSES, np.int64)
    for at in range(0, len(raw), CHUNK):
        c = _CLASS[raw[at:at + CHUNK + 1]]  # one byte more, for the pair over the cut
        pairs += np.bincount(c[:-1].astype(np.int16) * N_CLASSES + c[1:], minlength=N_CLASSES ** 2)
        single += np.bincount(c[:CHUNK], minlength=N_CLASSES)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    follows = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    out[:N_CLASSES] = np.sqrt(single / len(raw))
    out[N_CLASSES:N_CLASSES + N_CLASSES ** 2] = np.sqrt(pairs / len(raw))
    out[-6:] = (np.log1p(n), min(20.0, len(raw) / n), follows / n, max(counts.values(), default=0) / n,
                # distinct words against what a text of this length has at ease
                min(1.0, len(counts) / n ** 0.8), len(set(lines)) / max(1, len(lines)))
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _adam(grad, size: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(scores_p: np.ndarray, scores_u: np.ndarray) -> float:
    """The smallest ratio of unlabelled to positive mass above a cut, over cuts that keep a tenth of the positives."""
    cuts = np.quantile(scores_p, np.linspace(0.0, 0.9, 46))
    p = 1 - np.searchsorted(np.sort(scores_p), cuts, "left") / len(scores_p)
    u = 1 - np.searchsorted(np.sort(scores_u), cuts, "left") / len(scores_u)
    # the upper end of each ratio, so that chance does not lower the minimum
    error = np.sqrt(np.maximum(u * (1 - u), 1e-4) / len(scores_u)) + np.sqrt(np.maximum(p * (1 - p), 1e-4) / len(scores_p))
    return float(np.clip(((u + error) / p).min(), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 400,
        rate: float = 0.05, decay: float = 1e-3) -> QualityModel:
    """The linear model of least non-negative risk; ``prior`` is estimated where it is not given.

    Without positives every text scores 0; without unlabelled text the positives stand in for it.
    """
    width = positive.shape[1] if len(positive) else N_FEATURES
    if not len(positive):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), -30.0, 0.0)
    unlabelled = unlabelled if len(unlabelled) else positive
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    prepare = lambda x: np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    p, u = prepare(positive), prepare(unlabelled)
    shrink = np.append(np.ones(width), 0) * decay

    if prior is None:
        # positives against unlabelled text, both of weight one half
        told = lambda w: (-(1 - _sigmoid(p @ w)) @ p / len(p) + _sigmoid(u @ w) @ u / len(u)) / 2 + shrink * w
        w = _adam(told, width + 1, steps, rate)
        prior = estimate_prior(p @ w, u @ w)

    def risk_gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        positive_part = -prior * (1 - _sigmoid(zp)) @ p / len(p)
        negative_part = _sigmoid(zu) @ u / len(u) - prior * _sigmoid(zp) @ p / len(p)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return (positive_part + negative_part if negative_risk >= 0 else -negative_part) + shrink * w

    w = _adam(risk_gradient, width + 1, steps, rate)
    return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)


def _picked(doc_id: Column, rate: float, seed: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, rate) * (1 << 30))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on documents outside the held-out fold: positives are those whose labels all say quality 1, unlabelled
    text is any document, its labels unread. About ``sample`` ids of each are picked by hash, and one row of each id, the
    first by a hash of its text (so the driver gets at most that many small vectors, also where an id repeats); null
    ids are left out."""
    good = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("quality")).where("quality = 1").select(F.col("doc_id").alias("good")))
    good = good.where(fold(F.col("good")) != 0)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & (fold(F.col("id")) != 0))
    n_good, n_rows = good.count(), rows.select("id").count()
    chosen = good.where(_picked(F.col("good"), sample / max(1, n_good), 1))
    vector = F.pandas_udf(lambda texts: pd.Series([features(t).astype(np.float32).tolist() for t in texts]), "array<float>")
    # at most about ``sample`` ids are broadcast
    got = (rows.join(F.broadcast(chosen), F.col("id") == F.col("good"), "left")
           .withColumn("u", _picked(F.col("id"), sample / max(1, n_rows), 2))
           .where("good is not null or u")
           .groupBy("id", F.col("good").isNotNull().alias("p"), "u").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
           .select("id", "p", "u", vector("text").alias("x")).toPandas())
    got = got.sort_values("id", kind="stable")
    stack = lambda part: np.array(part["x"].tolist(), float).reshape(len(part), N_FEATURES)
    return fit(stack(got[got["p"]]), stack(got[got["u"]]))


def score_column(model: QualityModel, text: Column) -> Column:
    """A text's score, 0 to 1; null and empty texts are scored by the model like any other."""
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts]).reshape(len(texts), N_FEATURES)
            yield pd.Series(model.score(x))
    return scores(text)


def classify(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` per input row; repeated rows get a row each, other columns are not read,
    and an empty table gives an empty table."""
    scored = docs.select(F.col(id_col).alias("id"), (fold(F.col(id_col)) == 0).alias("held_out"),
                         score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
