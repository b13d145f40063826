"""Ordered keyword classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from instructspark.fixed_values import OTHER_TASK, TASK_KEYWORDS
from instructspark.functions.text import any_contains, or_empty


def task_type(
    text: Column,
    rules: Mapping[str, Sequence[str]] = TASK_KEYWORDS,
    other: str = OTHER_TASK,
) -> Column:
    """The first label, in rule order, with a keyword inside the lower-cased text.

    Keywords are substrings, not words: "rewrite" holds "write" and "show"
    holds "how".  NULL and empty text hold nothing and get ``other``.
    """
    lowered = F.lower(or_empty(text))
    labels = [
        F.when(any_contains(lowered, list(keywords)), F.lit(label))
        for label, keywords in rules.items()
    ]
    return F.coalesce(*labels, F.lit(other))
