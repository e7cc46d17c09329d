"""Title clean-up as ordered rewrite rules, and seniority."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    BILINGUAL_RULES,
    COMMON_TERM_RULES,
    JUNIOR_UP_TO_YEARS,
    KEYWORD_LEFT,
    KEYWORD_RIGHT,
    KEYWORD_ROLES,
    LEADING_NON_LETTERS,
    SENIOR_FROM_YEARS,
    SENIORITY_TITLE_WORDS,
    SENIORITY_WORDS,
)
from jobtide.functions.text import collapse, strip, with_computed

Rules = Sequence[tuple[str, str]]


def unicode_pattern(pattern: str, ignore_case: bool = False) -> str:
    """Java flags that make ``\\s``, ``\\w`` and ``\\b`` follow Unicode on any JVM."""
    needs_unicode = any(mark in pattern for mark in (r"\s", r"\b", r"\w"))
    flags = ("i" if ignore_case else "") + ("U" if needs_unicode else "")
    return f"(?{flags}){pattern}" if flags else pattern


def rewrite(text: Column, rules: Rules) -> Column:
    """Apply every rule to all its occurrences, in order.

    A text none of the patterns matches cannot be changed by any rule, so one
    test over all of them spares most titles the chain.  ``text`` is mentioned
    three times: make it a column, not a costly expression.
    """
    changed = text
    for pattern, replacement in rules:
        changed = F.regexp_replace(changed, unicode_pattern(pattern), replacement)
    any_rule = unicode_pattern("|".join(f"(?:{pattern})" for pattern, _ in rules))
    return F.when(text.rlike(any_rule), changed).otherwise(text)


def normalize_bilingual(title: Column) -> Column:
    return strip(rewrite(F.lower(title), BILINGUAL_RULES))


def remove_seniority(title: Column) -> Column:
    without = F.regexp_replace(title, unicode_pattern(SENIORITY_WORDS, ignore_case=True), "")
    return collapse(F.regexp_replace(without, LEADING_NON_LETTERS, ""))


def normalize_common_terms(title: Column) -> Column:
    return collapse(rewrite(title, COMMON_TERM_RULES))


def with_clean_title(df: DataFrame, title_col: str, out_col: str = "cleaned_title") -> DataFrame:
    """Add the title after bilingual terms, seniority and common terms; null becomes ''.

    Each step is a projection of its own: together their code would exceed what
    the JVM compiles as one method.
    """
    staged = with_computed(df, _local=remove_seniority(normalize_bilingual(F.col(title_col))))
    cleaned = F.coalesce(normalize_common_terms(F.col("_local")), F.lit(""))
    return with_computed(staged, **{out_col: cleaned}).drop("_local")


def whole_word_pattern(aliases: Sequence[str]) -> str:
    return unicode_pattern(r"\b(" + "|".join(re.escape(a) for a in aliases) + r")\b", ignore_case=True)


def keyword_role(title: Column) -> Column:
    """Role named by a keyword, the first list that matches; null if none does."""
    role = None
    for name, keywords in KEYWORD_ROLES:
        hit = title.rlike(unicode_pattern(f"{KEYWORD_LEFT}({keywords}){KEYWORD_RIGHT}", ignore_case=True))
        role = F.when(hit, name) if role is None else role.when(hit, name)
    return role


def infer_seniority(title: Column, min_years: Column) -> Column:
    """Seniority from words anywhere in the title, else from the years asked for."""
    lowered = F.lower(F.coalesce(title, F.lit("")))
    level = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, words in SENIORITY_TITLE_WORDS:
        hit = F.contains(lowered, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(lowered, F.lit(word))
        level = level.when(hit, name)
    return (
        level.when(min_years <= JUNIOR_UP_TO_YEARS, "junior")
        .when(min_years >= SENIOR_FROM_YEARS, "senior")
        .when(min_years.isNotNull(), "mid")
    )
