"""Scoring completions against references."""

from __future__ import annotations

import inspect
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.functions.prompts import first_content
from instructspark.functions.rewards import DEFAULT_REWARDS, Reward, weighted_total
from instructspark.operators.skew import lookup_join

# Which column of a scored table each reward parameter reads by default.
SCORE_COLUMNS = {
    "completion": "completion",
    "reference": "output_improved",
    "task_type": "task_type",
    "completion_embedding": "completion_embedding",
    "reference_embedding": "reference_embedding",
}


def completion_text(df: DataFrame, name: str) -> Column:
    """Text of a completion column: the first message's content, or the value as string."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return first_content(F.col(name))
    return F.col(name).cast("string")


class RepeatedPromptsError(ValueError):
    """A reference table has several rows for a prompt."""


def require_unique(references: DataFrame, key: str = "prompt_id") -> DataFrame:
    """The references themselves, or an error: a repeated prompt would repeat completions.

    One aggregation, of which a single row reaches the driver.
    """
    repeated = references.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1).first()
    if repeated is not None:
        raise RepeatedPromptsError(f"{key} {repeated[key]} has {repeated['n']} references")
    return references


def pair_completions(
    completions: DataFrame,
    references: DataFrame,
    key: str = "prompt_id",
    completion_key: str = "completion_id",
) -> DataFrame:
    """Gives every completion the reference of its prompt.

    ``references`` has one row per prompt.  A prompt may hold any share of the
    completions; hot prompts are salted.
    """
    return lookup_join(completions, references, key, completion_key)


def score(
    df: DataFrame,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    columns: Mapping[str, str] = SCORE_COLUMNS,
    total: str = "total",
) -> DataFrame:
    """Adds a column per reward and their weighted total.

    A reward's parameters without a default are filled with the columns of the
    same name, or of the name that ``columns`` gives.
    """
    added = {}
    for reward in rewards:
        wanted = [
            name
            for name, p in inspect.signature(reward.build).parameters.items()
            if p.default is p.empty and p.kind in (p.POSITIONAL_OR_KEYWORD, p.KEYWORD_ONLY)
        ]
        arguments = {}
        for name in wanted:
            column = columns.get(name, name)
            arguments[name] = completion_text(df, column) if name == "completion" else F.col(column)
        added[reward.name] = reward.build(**arguments)
    return df.withColumns(added).withColumn(total, weighted_total(rewards))


def group_advantage(
    scored: DataFrame,
    value: str = "total",
    key: str = "prompt_id",
    completion_key: str = "completion_id",
    scale: bool = False,
    epsilon: float = 1e-4,
    output: str = "advantage",
) -> DataFrame:
    """Reward minus the mean reward of the prompt's completions.

    ``scale`` divides by the group's standard deviation plus ``epsilon``.  The
    mean is an aggregation that combines before the shuffle and is joined back
    with salted hot prompts; a window would put a hot prompt into one task.
    ``scored`` is read twice, so pass a written table.
    """
    statistics = [F.avg(value).alias("_mean")]
    if scale:
        statistics.append(F.stddev_pop(value).alias("_deviation"))
    groups = scored.groupBy(key).agg(*statistics)
    joined = lookup_join(scored, groups, key, completion_key)
    advantage = F.col(value) - F.col("_mean")
    if scale:
        advantage = advantage / (F.col("_deviation") + F.lit(epsilon))
    return joined.withColumn(output, advantage).drop("_mean", "_deviation")


def reward_by_task(
    scored: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS, total: str = "total"
) -> DataFrame:
    """Completions and mean rewards per task type."""
    means = [F.avg(name).alias("avg_" + name) for name in [*(r.name for r in rewards), total]]
    return scored.groupBy("task_type").agg(F.count("*").alias("n"), *means)
