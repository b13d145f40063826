"""Score: completions against the references of their prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from instructspark.fixed_values import SCORE_INPUTS
from instructspark.functions.rewards import DEFAULT_REWARDS, Reward
from instructspark.operators.encoding import EncoderFactory, embed
from instructspark.operators.fields import require_columns
from instructspark.operators.scoring import group_advantage, pair_completions, require_unique, score
from instructspark.sources.tables import read_stage, write_stage


def score_completions(
    completions: DataFrame,
    references: DataFrame,
    encoder: EncoderFactory | None = None,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
) -> DataFrame:
    """Rewards and total per completion.

    ``completions`` has ``prompt_id, completion_id, completion``; ``references``
    has one row per prompt with ``output_improved`` and ``task_type``.  With an
    encoder, each reference is embedded once, before the join repeats it, and
    each completion after, when hot prompts are spread out.  Without one the
    embedding columns must be there already.
    """
    require_columns(references, ["prompt_id", *SCORE_INPUTS])
    if encoder is not None:
        references = embed(references, "output_improved", "reference_embedding", encoder)
    paired = pair_completions(completions, references)
    if encoder is not None:
        paired = embed(paired, "completion", "completion_embedding", encoder)
    return score(paired, rewards)


def score_and_rank(
    completions: DataFrame,
    references: DataFrame,
    path: str,
    encoder: EncoderFactory | None = None,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    scale: bool = False,
) -> DataFrame:
    """Scores, writes the narrow scores, and adds the advantage within each prompt.

    Raises before anything is written if a prompt has several references.
    """
    require_unique(references)
    scored = score_completions(completions, references, encoder, rewards)
    names = ["prompt_id", "completion_id", "task_type", *[r.name for r in rewards], "total"]
    write_stage(scored.select(*names), path)
    return group_advantage(read_stage(completions.sparkSession, path), scale=scale)
