"""Rewards: scores in [0, 1] of a completion, as column expressions.

A reward is a function from columns to a column.  Its parameter names say which
columns of a scored table it wants, so a user can register their own (native or
a pandas UDF) next to the four built-in ones; see ``operators.scoring.score``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from instructspark import fixed_values as fixed
from instructspark.functions.text import clamp, is_blank, or_empty, strip


def dot(left: Column, right: Column) -> Column:
    """Dot product in double precision, elements in order.

    NULL when a side is NULL, holds a NULL element or has another length.
    """
    product = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda total, item: total + item)


def semantic_reward(
    completion_embedding: Column,
    reference_embedding: Column,
    floor: float = fixed.SIMILARITY_FLOOR,
    span: float = fixed.SIMILARITY_SPAN,
) -> Column:
    """Similarity of two unit vectors, 0 up to ``floor`` and 1 from ``floor + span``."""
    similarity = dot(completion_embedding, reference_embedding)
    return clamp((similarity - F.lit(floor)) / F.lit(span), 0.0, 1.0)


def language_reward(
    completion: Column,
    alphabet: str = fixed.LANGUAGE_ALPHABET,
    base: float = fixed.LANGUAGE_BASE,
    density: float = fixed.LANGUAGE_DENSITY,
) -> Column:
    """``base`` for any text, more with the share of the language's own letters.

    Full at ``2 * base * density`` letters per character (1 % by default);
    0 for blank text.
    """
    text = or_empty(completion)
    own = F.regexp_count(text, F.lit("[" + re.escape(alphabet) + "]"))
    share = own / (F.length(text) * F.lit(density))
    return F.when(is_blank(text), F.lit(0.0)).otherwise(
        F.lit(base) + F.least(F.lit(1.0 - base), share)
    )


def length_reward(
    completion: Column,
    reference: Column,
    full: tuple[float, float] = fixed.LENGTH_FULL,
    half: tuple[float, float] = fixed.LENGTH_HALF,
) -> Column:
    """1 inside ``full`` times the reference's length, 0.5 inside ``half``, else 0."""
    ratio = F.length(or_empty(completion)) / F.greatest(F.length(reference), F.lit(1))
    score = (
        F.when(ratio.between(*full), F.lit(1.0))
        .when(ratio.between(*half), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )
    return F.when(reference.isNotNull(), score)


def accuracy_reward(
    completion: Column,
    reference: Column,
    task_type: Column,
    tasks: Sequence[str] = tuple(fixed.VERIFIABLE_TASKS),
) -> Column:
    """For tasks with a checkable answer: 1 when equal, 0.5 when one holds the other.

    Compared stripped and lower-cased.  Other tasks score 0; an empty side is
    inside anything and scores 0.5.
    """
    said = F.lower(strip(or_empty(completion)))
    wanted = F.lower(strip(reference))
    score = (
        F.when(said == wanted, F.lit(1.0))
        .when(F.contains(said, wanted) | F.contains(wanted, said), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )
    checkable = F.coalesce(task_type.isin(*tasks), F.lit(False))
    return F.when(~checkable, F.lit(0.0)).when(reference.isNotNull(), score)


@dataclass(frozen=True)
class Reward:
    """A named, weighted reward."""

    name: str
    weight: float
    build: Callable[..., Column]


DEFAULT_REWARDS = [
    Reward("semantic", fixed.REWARD_WEIGHTS["semantic"], semantic_reward),
    Reward("language", fixed.REWARD_WEIGHTS["language"], language_reward),
    Reward("length", fixed.REWARD_WEIGHTS["length"], length_reward),
    Reward("accuracy", fixed.REWARD_WEIGHTS["accuracy"], accuracy_reward),
]


def weighted_total(rewards: Sequence[Reward]) -> Column:
    """Sum of weight times reward over columns named like the rewards.

    A reward that is NULL makes the total NULL.
    """
    total = F.lit(0.0)
    for reward in rewards:
        total = total + F.lit(float(reward.weight)) * F.col(reward.name)
    return total
