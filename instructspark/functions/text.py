"""Text primitives with Unicode whitespace, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from instructspark.fixed_values import WHITESPACE

# The same 29 code points as WHITESPACE.  Single Latin-1 characters land in the
# regex engine's bit table and \p{Z} is one category test, which splits about
# three times faster than listing every code point.
WHITESPACE_CLASS = r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0\p{Z}]"


def or_empty(text: Column) -> Column:
    """NULL as the empty string."""
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Removes Unicode whitespace at both ends (``trim`` alone knows only U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return strip(or_empty(text)) == F.lit("")


def sql_literal(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(body: str, **values: Column) -> Column:
    """Evaluates SQL text over named values, each of them computed once.

    The text reads the values as ``v.name``.  Spark does not share a
    subexpression between the branches of a conditional; a one-element
    ``transform`` does, and stays a native expression.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.get(F.call_function("transform", F.array(row), F.expr(f"v -> {body}")), F.lit(0))


def words_sql(text: str) -> str:
    """SQL text for the lower-cased words of ``text``; an empty array when none.

    Splitting at every single whitespace character and dropping the empty pieces
    is faster than a pattern for whole runs, and needs no stripping first.
    """
    return f"array_remove(split(lower({text}), {sql_literal(WHITESPACE_CLASS)}), '')"


def word_overlap_sql(response: str, original: str) -> str:
    """SQL text for the share of ``original``'s distinct words found in ``response``."""
    return (
        f"get(transform(array({words_sql(original)}), known ->"
        f" size(array_intersect(known, {words_sql(response)}))"
        f" / greatest(size(array_distinct(known)), 1)), 0)"
    )


def words(text: Column) -> Column:
    """Lower-cased words in order; an empty array when there are none."""
    return bind(words_sql("v.text"), text=text)


def word_overlap(response: Column, original: Column) -> Column:
    """Share of the original's distinct words that the response also has."""
    return bind(word_overlap_sql("v.response", "v.original"), response=response, original=original)


def any_contains(text: Column, needles: list[str]) -> Column:
    """True when the text holds any of the needles as a plain substring."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(text, F.lit(needle))
    return found


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` limited to [low, high]; NULL stays NULL (least/greatest skip it)."""
    limited = f"greatest({float(low)}D, least({float(high)}D, v.x))"
    return bind(f"if(v.x is null, cast(null as double), {limited})", x=value)
