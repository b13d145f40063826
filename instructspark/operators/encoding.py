"""Text embeddings with a user's encoder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from instructspark.operators.generation import in_batches
from instructspark.operators.scoring import completion_text

# A function without arguments that loads an encoder: texts in, vectors out.
EncoderFactory = Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]

ENCODER_BATCH_SIZE = 32


def _unit(vector: Sequence[float]) -> np.ndarray:
    """The vector at length one; a zero vector stays zero."""
    values = np.asarray(vector, dtype=np.float64)
    return (values / (np.linalg.norm(values) or 1.0)).astype(np.float32)


def embed(
    df: DataFrame,
    text: str,
    output: str,
    encoder: EncoderFactory,
    batch_size: int = ENCODER_BATCH_SIZE,
) -> DataFrame:
    """Adds the unit vector of a text or completion column; NULL text gives NULL.

    Only the text crosses to Python, in Arrow batches; the encoder is loaded once
    per worker.  Embed a text before it is joined to many rows, not after.
    """
    encode = in_batches(encoder, batch_size, "array<float>", write=_unit)
    return df.withColumn(output, encode(completion_text(df, text)))
