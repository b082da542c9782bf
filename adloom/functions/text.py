"""Column expressions for text: cleaning, tokens, splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The punctuation class, the whitespace class and the word pattern.
PUNCTUATION = r"|!?:;./\-%&"
WHITESPACE = r"\t\n\f\r "  # no vertical tab, unlike Java's \s
WORD = r"(\w+)"


def clean_text(text: Column) -> Column:
    """Lower-case; punctuation to spaces; whitespace runs to one space.

    Replacing punctuation first and collapsing afterwards is the same as
    replacing every run of either class by one space, so one pass is enough.
    """
    return F.regexp_replace(F.lower(text), f"[{PUNCTUATION}{WHITESPACE}]+", " ")


def words(text: Column) -> Column:
    """All ASCII word tokens, in order, duplicates kept."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def keyword_list(line: Column) -> Column:
    return words(F.lower(line))


def slash_list(value: Column) -> Column:
    return F.split(F.lower(value), "/")


def distinct_known(values: Column) -> Column:
    """Distinct elements without NULL."""
    return F.array_compact(F.array_distinct(values))


def without_words(tokens: Column, excluded: list[str]) -> Column:
    if not excluded:
        return tokens
    return F.filter(tokens, lambda word: ~word.isin(excluded))


def word_groups(tokens: Column, size: int) -> Column:
    """Consecutive, non-overlapping groups of ``size`` words; a short rest is dropped."""
    if size == 1:
        return tokens
    pattern = r"\w+" + r"\s+\w+" * (size - 1)
    return F.regexp_extract_all(F.array_join(tokens, " "), F.lit(pattern), F.lit(0))


def replace_nul(text: Column) -> Column:
    return F.translate(text, "\u0000", "\ufffd")


def drop_nbsp(text: Column) -> Column:
    return F.replace(text, F.lit("\u00a0"), F.lit(""))


def label_key(text: Column) -> Column:
    """A printed label as an attribute key: no colon, lower case, trimmed."""
    return F.trim(F.lower(F.replace(text, F.lit(":"), F.lit(""))))
