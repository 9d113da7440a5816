"""Unicode-aware text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingweave import fixed_values as fv

# Spark's trim and Java's \s know only ASCII blanks; these are all characters Unicode treats as space.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)


def trim_u(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return trim_u(F.coalesce(c, F.lit(""))) == ""


#: What squashed text does not hold.
SQUASHED = "\"'" + WHITESPACE


def squash(c: Column) -> Column:
    """Text without quotes and without any whitespace."""
    return F.translate(c, SQUASHED, "")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def contains_all(c: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(c, F.lit(w)) for w in words])


def first_contained(c: Column, words: Sequence[str]) -> Column:
    """The first word of the list that occurs in the text, else null."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(w)), F.lit(w)) for w in words])


def token_count(c: Column, tokens: Sequence[str] = fv.HEADER_TOKENS) -> Column:
    """How many of the tokens occur at all (presence, not frequency)."""
    return reduce(lambda a, b: a + b, [F.contains(c, F.lit(t)).cast("int") for t in tokens])


def document_hint(
    text: Column,
    hints: Sequence[str] = fv.HINTS,
    fallback: str = fv.HINT_FALLBACK,
    triggers: Sequence[str] = fv.HINT_TRIGGERS,
) -> Column:
    """Which roster heading a document seems to hold; '' when none of the triggers occurs."""
    return F.when(
        contains_any(text, triggers), F.coalesce(first_contained(text, hints), F.lit(fallback))
    ).otherwise("")


def bullets_to_commas(c: Column, bullets: str = fv.BULLETS) -> Column:
    """'·a·b' -> 'a, b'."""
    parts = F.transform(F.split(c, f"[{bullets}]"), trim_u)
    return F.array_join(F.filter(parts, lambda p: p != ""), ", ")


def estimated_tokens(c: Column) -> Column:
    """Two tokens a character."""
    return F.length(F.coalesce(c, F.lit(""))) * 2
