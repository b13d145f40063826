"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  A line's features are shares of character classes, word
statistics and repetition, of itself and of the lines before and after it.  The field is
trained on labelled documents, whose lines take the document's label; marginals come
from forward and backward passes; a document's quality is the mean marginal weighted by
line length, calibrated into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import (
    bound_batches,
    fit_logistic,
    labelled_sample,
    replacing,
    sigmoid,
)

# Bound of the training sample, in documents of each label.
MOST_PER_LABEL = 3000
EPOCHS = 150
STEP = 0.05
RIDGE = 1e-3

# Classes of bytes: upper case, lower case, digit, space, sentence marks, other marks, non-ASCII.
_CLASSES = np.full(256, 5, dtype=np.uint8)
_CLASSES[[*range(0x41, 0x5B)]] = 0
_CLASSES[[*range(0x61, 0x7B)]] = 1
_CLASSES[[*range(0x30, 0x3A)]] = 2
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 3
_CLASSES[list(b".,;:'\"?-()")] = 4
_CLASSES[0x80:] = 6
_N_CLASSES = 7
_SENTENCE_ENDS = frozenset(b".!?:")
WIDTH = _N_CLASSES + 6


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features and byte lengths of the lines of a text; empty text is one empty line."""
    raw = (text or "").encode("utf-8")
    lines = raw.split(b"\n")
    lengths = np.array([len(x) for x in lines], dtype=np.int64)
    out = np.zeros((len(lines), WIDTH))
    if raw:
        starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        kinds = _CLASSES[np.frombuffer(raw + b"\n", dtype=np.uint8)]
        for kind in range(_N_CLASSES):
            out[:, kind] = np.add.reduceat((kinds == kind).astype(np.int32), starts)
        out[:, 3] -= 1  # the line break
        out[:, :_N_CLASSES] /= np.maximum(lengths, 1)[:, None]
    seen: set[bytes] = set()
    at = _N_CLASSES
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        out[i, at] = np.log1p(n)
        out[i, at + 1] = (len(line) - n + 1) / n / 10 if n else 0.0
        out[i, at + 2] = len(set(words)) / n if n else 1.0
        out[i, at + 3] = line in seen and n > 0
        out[i, at + 4] = bool(line) and line[-1] in _SENTENCE_ENDS
        out[i, at + 5] = n == 0
        seen.add(line)
    return out, lengths


def _with_neighbours(x: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after, and a constant."""
    edge = np.zeros((1, x.shape[1]))
    before, after = np.vstack([edge, x[:-1]]), np.vstack([x[1:], edge])
    return np.hstack([x, before, after, np.ones((len(x), 1))])


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The probability of each label (columns) for each line (rows)."""
    n = len(emit)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = emit[0]
    # Plain floats: texts have few labels and sometimes very many lines.
    (m00, m01), (m10, m11) = move.tolist()
    score = emit.tolist()
    a0, a1 = score[0]
    for t in range(1, n):
        a0, a1 = (
            np.logaddexp(a0 + m00, a1 + m10) + score[t][0],
            np.logaddexp(a0 + m01, a1 + m11) + score[t][1],
        )
        ahead[t] = a0, a1
    b0 = b1 = 0.0
    for t in range(n - 2, -1, -1):
        n0, n1 = b0 + score[t + 1][0], b1 + score[t + 1][1]
        b0, b1 = np.logaddexp(m00 + n0, m01 + n1), np.logaddexp(m10 + n0, m11 + n1)
        back[t] = b0, b1
    joint = ahead + back
    return np.exp(joint - _logsumexp(joint, 1)[:, None])


@dataclass
class LineField:
    """Weights of the field and of the calibration of documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features x 2
    move: np.ndarray  # label before x label after
    calibration: np.ndarray | None = None

    def lines(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The probability of being good, and the length, of each line."""
        x, lengths = line_features(text)
        emit = _with_neighbours((x - self.mean) / self.scale) @ self.weights
        return marginals(emit, self.move)[:, 1], lengths

    def quality(self, text: str | None) -> float:
        """The length-weighted mean of the lines' marginals."""
        good, lengths = self.lines(text)
        weight = np.maximum(lengths, 1)
        return float((good * weight).sum() / weight.sum())

    def score(self, text: str | None) -> float:
        return sigmoid(float(_stretched(self.quality(text)) * self.calibration[0] + self.calibration[1]))


def _stretched(q: float) -> float:
    q = min(max(q, 1e-4), 1 - 1e-4)
    return float(np.log(q / (1 - q)))


def _padded(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(s) for s in sequences)
    x = np.zeros((len(sequences), longest, sequences[0].shape[1]))
    there = np.zeros((len(sequences), longest), dtype=bool)
    for i, s in enumerate(sequences):
        x[i, : len(s)], there[i, : len(s)] = s, True
    return x, there


def _slopes(x, there, y, weights, move):
    """Gradient of the mean log-likelihood of a padded batch whose lines share a label."""
    b, t, _ = x.shape
    emit = x @ weights
    ahead, back = np.zeros((b, t, 2)), np.zeros((b, t, 2))
    ahead[:, 0] = emit[:, 0]
    for i in range(1, t):
        new = _logsumexp(ahead[:, i - 1, :, None] + move[None], 1) + emit[:, i]
        ahead[:, i] = np.where(there[:, i, None], new, ahead[:, i - 1])
    for i in range(t - 2, -1, -1):
        new = _logsumexp(move[None] + (emit[:, i + 1] + back[:, i + 1])[:, None, :], 2)
        back[:, i] = np.where(there[:, i + 1, None], new, 0.0)
    whole = _logsumexp(ahead[:, -1], 1)
    node = np.exp(ahead + back - whole[:, None, None]) * there[..., None]
    pair = ahead[:, :-1, :, None] + move[None, None] + (emit + back)[:, 1:, None, :]
    edge = np.exp(np.minimum(pair - whole[:, None, None, None], 0.0)) * there[:, 1:, None, None]
    truth = np.eye(2)[y][:, None, :] * there[..., None]
    steps = there[:, 1:].sum(1)
    told = np.zeros((2, 2))
    for label in (0, 1):
        told[label, label] = steps[y == label].sum()
    n = there.sum()
    return np.einsum("btf,btl->fl", x, truth - node) / n, (told - edge.sum((0, 1))) / n


def train_field(texts: Sequence[str], labels: Sequence[int], epochs: int = EPOCHS, seed: int = 5) -> LineField:
    """Fits the field on three quarters of the texts and calibrates on the rest.

    Both labels weigh alike in the field; the calibration restores their shares.
    """
    sequences = [line_features(t)[0] for t in texts]
    labels = np.asarray(labels, dtype=np.int64)
    rest = np.arange(len(texts)) % 4 == 0
    lines = np.vstack([s for s, r in zip(sequences, rest, strict=True) if not r] or [np.zeros((1, WIDTH))])
    mean, scale = lines.mean(0), lines.std(0) + 1e-3
    width = 3 * WIDTH + 1
    field = LineField(mean, scale, np.zeros((width, 2)), np.zeros((2, 2)))
    ready = [_with_neighbours((s - mean) / scale) for s in sequences]
    rng = np.random.default_rng(seed)
    groups = [[i for i in np.flatnonzero(~rest) if labels[i] == v] for v in (0, 1)]
    if all(groups):
        # Adam on batches with as many documents of either label, alike in length.
        params = [field.weights, field.move]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for number in range(1, epochs + 1):
            picked = np.concatenate([rng.choice(g, 48) for g in groups])
            picked = sorted(picked, key=lambda i: len(ready[i]))
            slopes = [np.zeros_like(p) for p in params]
            for part in (picked[:48], picked[48:80], picked[80:]):
                x, there = _padded([ready[i] for i in part])
                for total, one in zip(slopes, _slopes(x, there, labels[part], *params), strict=True):
                    total += one * len(part) / len(picked)
            for p, s, m, v in zip(params, slopes, first, second, strict=True):
                s = s - RIDGE * p
                m += 0.1 * (s - m)
                v += 0.01 * (s * s - v)
                p += STEP * (m / (1 - 0.9**number)) / (np.sqrt(v / (1 - 0.99**number)) + 1e-8)
    stretched = [_stretched(field.quality(t)) for t, r in zip(texts, rest, strict=True) if r]
    field.calibration = fit_logistic(np.array(stretched), labels[rest])
    return field


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_per_label: int = MOST_PER_LABEL,
) -> LineField:
    """Fits the field on the texts whose key has label 1 (good) or 0 in ``labels``.

    At most about ``most_per_label`` texts of each label come to the driver; the bound
    holds at every size of the tables.
    """
    bounds = {0: most_per_label, 1: most_per_label}
    sample = labelled_sample(docs, labels, key, text, label, bounds)
    order = np.random.default_rng(1).permutation(len(sample))
    return train_field([sample[i][0] for i in order], [sample[i][1] for i in order])


def score_quality(df: DataFrame, field: LineField, text: str = "text", output: str = "score") -> DataFrame:
    """Adds the probability that a text is of good quality.

    Whole texts are read.  NULL counts as empty text, which is one empty line.  Equal
    texts get equal scores; a column named ``output`` is replaced; an empty table gives
    an empty one.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    scored = df.withColumn("_score", score(F.col(f"`{text}`")))
    return replacing(scored, [output]).withColumnRenamed("_score", output)


def label_lines(df: DataFrame, field: LineField, text: str = "text", output: str = "lines_good") -> DataFrame:
    """Adds each line's probability of being good, in order."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("array<double>")
    def label(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.lines(t)[0] for t in texts])

    labelled = df.withColumn("_lines", label(F.col(f"`{text}`")))
    return replacing(labelled, [output]).withColumnRenamed("_lines", output)
