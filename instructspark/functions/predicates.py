"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from instructspark.fixed_values import MIN_TEXT_CHARS
from instructspark.functions.text import or_empty, strip


def should_skip(text: Column, reference: Column, min_chars: int = MIN_TEXT_CHARS) -> Column:
    """Text that is not worth rewriting.

    Blank text is shorter than any positive minimum, so two tests remain: too
    short after stripping, or the same as its reference after stripping.
    """
    bare = strip(or_empty(text))
    return (F.length(bare) < F.lit(max(min_chars, 1))) | (bare == strip(or_empty(reference)))


def is_changed(before: Column, after: Column) -> Column:
    """Null-safe inequality: NULL against NULL is unchanged."""
    return ~before.eqNullSafe(after)
