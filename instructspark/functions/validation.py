"""Checks on generated text, with fallback to the original.

A response gets one reason:

=============  ==============================================================
``missing``    no response (NULL)
``short``      under ``min_chars`` after stripping
``marker_line``  opens with a preamble marker, but has a usable line
``marker_only``  opens with a preamble marker and has no usable line
``overlap``    shares too few of the original's words
``runaway``    much longer than the original
``ok``         none of the above
=============  ==============================================================

``ok`` keeps the stripped response, ``marker_line`` keeps that line (it skips
the overlap and length tests), every other reason keeps the unstripped original.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column

from instructspark import fixed_values as fixed
from instructspark.functions.text import bind, or_empty, sql_literal, strip, word_overlap_sql

REASONS = ["missing", "short", "marker_line", "marker_only", "overlap", "runaway", "ok"]


@dataclass(frozen=True)
class ValidationRules:
    """Thresholds and markers of the response checks."""

    markers: list[str] = field(default_factory=lambda: list(fixed.PREAMBLE_MARKERS))
    min_chars: int = fixed.MIN_RESPONSE_CHARS
    min_line_chars: int = fixed.MIN_LINE_CHARS
    min_overlap: float = fixed.MIN_WORD_OVERLAP
    max_growth: int = fixed.MAX_GROWTH
    growth_slack: int = fixed.GROWTH_SLACK

    def marker_pattern(self) -> str:
        """A regex that matches any marker; one that never matches if there are none."""
        return "|".join(re.escape(marker) for marker in self.markers) or "(?!)"


DEFAULT_RULES = ValidationRules()


def _opens_sql(bare: str, rules: ValidationRules) -> str:
    # Only the head can match, so only the head is lower-cased.
    longest = max((len(marker) for marker in rules.markers), default=0)
    pattern = sql_literal(f"^(?:{rules.marker_pattern()})")
    return f"lower(substring({bare}, 1, {longest})) rlike {pattern}"


def _line_sql(bare: str, rules: ValidationRules) -> str:
    stripped = f"transform(split({bare}, '\\n'), line -> btrim(line, {sql_literal(fixed.WHITESPACE)}))"
    good = (
        f"length(line) > {rules.min_line_chars}"
        f" and not lower(line) rlike {sql_literal(rules.marker_pattern())}"
    )
    return f"get(filter({stripped}, line -> {good}), 0)"


def has_marker_prefix(response: Column, rules: ValidationRules = DEFAULT_RULES) -> Column:
    """True when the stripped response opens with a marker, in any case."""
    return bind(_opens_sql("v.bare", rules), bare=strip(response))


def usable_line(response: Column, rules: ValidationRules = DEFAULT_RULES) -> Column:
    """First stripped line that is long enough and holds no marker, else NULL."""
    return bind(_line_sql("v.bare", rules), bare=strip(response))


def _unchanged_sql(rules: ValidationRules) -> str:
    """SQL test for a response equal to the stripped original.

    Such a response has all words and no growth, so under any sensible rules it
    passes without building word sets.
    """
    if rules.min_overlap > 1 or rules.max_growth < 1 or rules.growth_slack < 0 or rules.min_chars < 1:
        return "false"
    return f"v.bare = btrim(v.original, {sql_literal(fixed.WHITESPACE)})"


def checked_response(
    response: Column, original: Column, rules: ValidationRules = DEFAULT_RULES
) -> Column:
    """A struct of the ``reason`` code and the ``text`` it keeps.

    One conditional with the cheap tests before the word sets: a response that
    is missing, short or marked never pays for them.
    """

    def outcome(reason: str, text: str) -> str:
        return f"named_struct('reason', '{reason}', 'text', {text})"

    longest = f"{rules.max_growth} * length(v.original) + {rules.growth_slack}"
    line = f"named_struct('line', {_line_sql('v.bare', rules)})"
    marked = (
        f"get(transform(array({line}), m -> if(m.line is null,"
        f" {outcome('marker_only', 'v.original')}, {outcome('marker_line', 'm.line')})), 0)"
    )
    body = f"""case
        when v.bare is null then {outcome("missing", "v.original")}
        when length(v.bare) < {rules.min_chars} then {outcome("short", "v.original")}
        when {_opens_sql("v.bare", rules)} then {marked}
        when {_unchanged_sql(rules)} then {outcome("ok", "v.bare")}
        when {word_overlap_sql("v.bare", "v.original")} < {rules.min_overlap}D
            then {outcome("overlap", "v.original")}
        when length(v.bare) > {longest} then {outcome("runaway", "v.original")}
        else {outcome("ok", "v.bare")} end"""
    return bind(body, bare=strip(response), original=or_empty(original))


def validation_reason(
    response: Column, original: Column, rules: ValidationRules = DEFAULT_RULES
) -> Column:
    """The reason code of a response."""
    return checked_response(response, original, rules).getField("reason")


def validate_response(
    response: Column, original: Column, rules: ValidationRules = DEFAULT_RULES
) -> Column:
    """The text a response leaves: the accepted response or the original.

    When only the text matters, all failed tests lead to the same value, so the
    length test goes before the word sets and spares them runaway responses.
    """
    longest = f"{rules.max_growth} * length(v.original) + {rules.growth_slack}"
    body = f"""case
        when v.bare is null or length(v.bare) < {rules.min_chars} then v.original
        when {_opens_sql("v.bare", rules)} then coalesce({_line_sql("v.bare", rules)}, v.original)
        when {_unchanged_sql(rules)} then v.bare
        when length(v.bare) > {longest} then v.original
        when {word_overlap_sql("v.bare", "v.original")} < {rules.min_overlap}D then v.original
        else v.bare end"""
    return bind(body, bare=strip(response), original=or_empty(original))
