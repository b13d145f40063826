"""Preparation of instruction-tuning tables as Spark jobs.

Column expressions live in ``functions``, DataFrame operators in ``operators``,
readers and writers in ``sources``, whole jobs in ``plans`` and the file-stream
job in ``streaming``.  The names below are the ones most jobs need.
"""

from instructspark.functions.classification import task_type
from instructspark.functions.predicates import should_skip
from instructspark.functions.prompts import chat_prompt, rewrite_prompt
from instructspark.functions.rewards import (
    DEFAULT_REWARDS,
    Reward,
    accuracy_reward,
    language_reward,
    length_reward,
    semantic_reward,
)
from instructspark.functions.validation import ValidationRules, validate_response
from instructspark.operators.encoding import embed
from instructspark.operators.fields import field_pairs, first_rows, preview, require_columns
from instructspark.operators.generation import generate, rewrite
from instructspark.operators.reports import (
    change_rate,
    change_stats,
    sample_per_task,
    task_distribution,
    task_distribution_pct,
    validation_report,
)
from instructspark.operators.scoring import group_advantage, pair_completions, reward_by_task, score
from instructspark.operators.validate import with_validated
from instructspark.plans.chains import distilled_chain, standard_chain
from instructspark.plans.distil import distil_generate, distil_polish
from instructspark.plans.improve import improve
from instructspark.plans.prepare import prepare, prepare_and_publish, prepare_distilled
from instructspark.plans.scoring import score_and_rank, score_completions
from instructspark.session import build_session
from instructspark.sources.jsonl import load_checkpoint, save_checkpoint
from instructspark.sources.store import ResponseStore
from instructspark.sources.tables import (
    ingest_instructions,
    load_instructions,
    read_stage,
    write_stage,
)
from instructspark.streaming.incremental import incremental_validate

__all__ = [
    "DEFAULT_REWARDS",
    "ResponseStore",
    "Reward",
    "ValidationRules",
    "accuracy_reward",
    "build_session",
    "change_rate",
    "change_stats",
    "chat_prompt",
    "distil_generate",
    "distil_polish",
    "distilled_chain",
    "embed",
    "field_pairs",
    "first_rows",
    "generate",
    "group_advantage",
    "improve",
    "incremental_validate",
    "ingest_instructions",
    "language_reward",
    "length_reward",
    "load_checkpoint",
    "load_instructions",
    "pair_completions",
    "prepare",
    "prepare_and_publish",
    "prepare_distilled",
    "preview",
    "read_stage",
    "require_columns",
    "reward_by_task",
    "rewrite",
    "rewrite_prompt",
    "sample_per_task",
    "save_checkpoint",
    "score",
    "score_and_rank",
    "score_completions",
    "semantic_reward",
    "should_skip",
    "standard_chain",
    "task_distribution",
    "task_distribution_pct",
    "task_type",
    "validate_response",
    "validation_report",
    "with_validated",
    "write_stage",
]
