"""Rewards that compare the completions of a prompt with each other.

A group reward sees, for each completion, what the other completions of its prompt
did, without a prompt ever being one task: every completion gets a label (the
user's function over Arrow batches, or a Column), the labels are counted per prompt
and per (prompt, label) in aggregations that combine before the shuffle, and the
counts are joined back with hot prompts salted.  The user's score then sees each
completion with ``same`` (completions of its prompt with its label, itself
included) and ``group`` (completions of its prompt), again in Arrow batches.

Majority-vote agreement (``same / group``), diversity (``1 - same / group``) or a
bonus for the only correct answer all take this form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.operators.skew import lookup_join
from instructspark.session import materialize


@dataclass(frozen=True)
class GroupReward:
    """``label``: completions to labels (a batch function, or a Column builder);
    ``score``: a frame of ``completion, same, group`` to one value per row."""

    name: str
    weight: float
    label: Callable[[Sequence[str | None]], Sequence[str | None]] | Callable[[Column], Column]
    score: Callable[[pd.DataFrame], Sequence[float]]
    native_label: bool = False


def _labels(reward: GroupReward, completion: Column) -> Column:
    if reward.native_label:
        return reward.label(completion)
    label = reward.label

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(label(list(batch))), dtype=object)

    return F.pandas_udf(run, "string")(completion)


def group_reward(
    df: DataFrame,
    reward: GroupReward,
    key: str = "prompt_id",
    completion_key: str = "completion_id",
    completion: str = "completion",
) -> DataFrame:
    """Adds ``reward.name``: the reward of each completion among its prompt's.

    A NULL label is a label like others (completions without one agree with each
    other); NULL prompts form no group: their completions have ``same`` and ``group``
    NULL.  Repeated rows count each time.  Columns named ``_label``, ``_same`` or
    ``_group`` in ``df`` are replaced.
    """
    base = df.drop("_label", "_same", "_group")
    labelled = materialize(base.withColumn("_label", _labels(reward, F.col(completion))), "labelled")
    # No NULL inside the pair: struct equality with a NULL field never holds.
    pair = F.struct(F.col(key).alias("k"), F.col("_label").isNull().alias("n"), F.coalesce("_label", F.lit("")).alias("l"))
    same = labelled.groupBy(pair.alias("_pair")).agg(F.count("*").alias("_same"))
    group = labelled.groupBy(key).agg(F.count("*").alias("_group"))
    counted = lookup_join(labelled.withColumn("_pair", pair), same.where(F.col("_pair.k").isNotNull()), "_pair", completion_key, "left")
    counted = lookup_join(counted.drop("_pair"), group, key, completion_key, "left")
    score = reward.score

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(score(batch)), dtype="float64")

    scored = F.pandas_udf(run, "double")(
        F.struct(F.col(completion).alias("completion"), F.col("_same").alias("same"), F.col("_group").alias("group"))
    )
    return counted.withColumn(reward.name, scored).drop("_label", "_same", "_group")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(_UPPER, _UPPER.lower())


def first_line(completions: Sequence[str | None]) -> list[str | None]:
    """The answer a completion gives: its first line (split at LF) that is not blank after
    trimming spaces, tabs and CR, with A-Z lower-cased; NULL if it has none."""
    out = []
    for text in completions:
        lines = [line.strip(" \t\r").translate(_LOWER) for line in (text or "").split("\n")]
        out.append(next((line for line in lines if line), None))
    return out


def agreement(frame: pd.DataFrame) -> Sequence[float]:
    """The share of the prompt's completions that give the same answer; NULL without a prompt."""
    return (frame["same"].astype("float64") / frame["group"].astype("float64")).astype("float64")


AGREEMENT = GroupReward("agreement", 1.0, first_line, agreement)
