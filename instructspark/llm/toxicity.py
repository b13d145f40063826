"""Toxicity by compression distance: two zstandard dictionaries, one window at a time.

Dictionaries are trained on labelled text.  The ordinary one is trained on windows of
ordinary documents.  The toxic one is trained on the windows that toxic documents hold
more often than chance allows, and keeps the ordinary content as its background, so
that a difference between the two compressed lengths comes from toxic matches alone.

A window is a word between spaces.  Longer windows were tried: in them a dictionary
match is lost in the noise of chance matches.  Windows are compressed in front of a
fixed text that both dictionaries know, because zstandard does not search for matches in
the last bytes of its input.  The share of a window's ordinary length that the toxic
dictionary saves is held against thresholds; counts of windows above each threshold,
alone and per word, are calibrated into a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import (
    bound_batches,
    fit_logistic,
    labelled_sample,
    replacing,
    sigmoid,
    words_of,
)

# Bounds of the training sample, in documents, and of the dictionaries.
MOST_TOXIC = 3000
MOST_ORDINARY = 6000
ORDINARY_BYTES = 4096
MOST_TOXIC_WINDOWS = 3000

# A window is toxic training text if this many standard deviations and documents speak for it.
LEAST_DEVIATION = 4.5
LEAST_DOCUMENTS = 4

THRESHOLDS = (0.5, 0.6, 0.65, 0.7, 0.75, 0.8)
CACHE_WINDOWS = 200_000


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=4,
        strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=params)


@dataclass
class ToxicityModel:
    """Dictionary contents and calibration; compressors are made where they are used."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None = None
    thresholds: Sequence[float] = THRESHOLDS
    _shares: dict[bytes, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_shares", "_pair")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._shares = {}

    def _lengths(self, window: bytes) -> tuple[int, int]:
        if not hasattr(self, "_pair"):
            self._tail = self.ordinary[-48:-16]
            # Nor are the last bytes of a dictionary searched.
            end = b" " * 16
            self._pair = _compressor(self.ordinary + end), _compressor(self.ordinary + self.toxic + end)
            self._base = [len(c.compress(b" " + self._tail)) for c in self._pair]
        text = b" " + window + b" " + self._tail
        plain, toxic = (len(c.compress(text)) - b for c, b in zip(self._pair, self._base, strict=True))
        return plain, toxic

    def share(self, window: bytes) -> float:
        """The share of the ordinary length that the toxic dictionary saves."""
        known = self._shares.get(window)
        if known is None:
            plain, toxic = self._lengths(window)
            known = (plain - toxic) / plain if plain - toxic >= 2 else 0.0
            if len(self._shares) >= CACHE_WINDOWS:
                self._shares.clear()
            self._shares[window] = known
        return known

    def features(self, text: str | None) -> list[float]:
        """Windows above each threshold, as logarithms of counts and as shares of all."""
        words = words_of(text)
        shares = [s for s in map(self.share, words) if s > 0]
        counts = [sum(s >= t for s in shares) for t in self.thresholds]
        size = max(1, len(words))
        return [math.log1p(c) for c in counts] + [math.log1p(100 * c / size) for c in counts]

    def score(self, text: str | None) -> float:
        return sigmoid(float(np.dot(self.weights[:-1], self.features(text)) + self.weights[-1]))


def _salient(toxic: Sequence[str], ordinary: Sequence[str]) -> list[bytes]:
    """Windows that more toxic documents hold than chance allows, strongest last."""
    a, b = Counter(), Counter()
    for text in toxic:
        a.update(set(words_of(text)))
    for text in ordinary:
        b.update(set(words_of(text)))
    p, n = len(toxic), len(ordinary)
    found = []
    for window, seen in a.items():
        if seen < LEAST_DOCUMENTS or len(window) < 3:
            continue
        share = (seen + b[window]) / (p + n)
        spread = math.sqrt(p * share * (1 - share) * n / (p + n)) + 1e-9
        if (deviation := (seen - p * share) / spread) >= LEAST_DEVIATION:
            found.append((deviation, window))
    return [w for _, w in sorted(found)[-MOST_TOXIC_WINDOWS:]]


def _ordinary_dictionary(texts: Sequence[str]) -> bytes:
    """Trained content; where there is too little text to train on, that text itself."""
    samples = []
    for text in texts[:2000]:
        words = words_of(text)
        samples += [b" " + b" ".join(words[i : i + 10]) + b" " for i in range(0, len(words), 10)]
    try:
        content = zstandard.train_dictionary(ORDINARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)[-ORDINARY_BYTES:]
    return b" " * 64 + content if len(content) < 64 else content


def _fit_and_rest(texts: Sequence[str]) -> tuple[list[str], list[str]]:
    return [t for i, t in enumerate(texts) if i % 4], list(texts[::4])


def train_toxicity(toxic: Sequence[str], ordinary: Sequence[str]) -> ToxicityModel:
    """A model from labelled texts; a quarter of them is kept back for calibration."""
    toxic_fit, toxic_rest = _fit_and_rest(toxic)
    plain_fit, plain_rest = _fit_and_rest(ordinary)
    windows = _salient(toxic_fit, plain_fit)
    model = ToxicityModel(_ordinary_dictionary(plain_fit), b" " + b" ".join(windows) + b" ")
    rest = toxic_rest + plain_rest
    rows = np.array([model.features(t) for t in rest]).reshape(len(rest), 2 * len(THRESHOLDS))
    labels = np.array([1] * len(toxic_rest) + [0] * len(plain_rest))
    model.weights = fit_logistic(rows, labels, ridge=0.3)
    return model


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_toxic: int = MOST_TOXIC,
    most_ordinary: int = MOST_ORDINARY,
) -> ToxicityModel:
    """Fits a model on the texts whose key has label 1 (toxic) or 0 in ``labels``.

    At most about ``most_toxic`` and ``most_ordinary`` texts come to the driver; these
    bounds hold at every size of the tables.
    """
    bounds = {1: most_toxic, 0: most_ordinary}
    sample = labelled_sample(docs, labels, key, text, label, bounds)
    return train_toxicity([t for t, y in sample if y == 1], [t for t, y in sample if y == 0])


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", output: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic.

    Whole texts are read.  NULL and empty text have no windows and get the constant of
    the calibration.  Equal texts get equal scores; a column named ``output`` is
    replaced; an empty table gives an empty one.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    scored = df.withColumn("_score", score(F.col(f"`{text}`")))
    return replacing(scored, [output]).withColumnRenamed("_score", output)
