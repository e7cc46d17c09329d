"""Structured requirements: gazetteer terms, years, responses to validate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed_values import DROPPED_LIST_VALUES
from jobtide.functions.text import strip

# A word may carry a leading dot (".net") and inner "+" or "#" ("c++", "c#").
# A line break is a token too, so that no phrase reaches across two lines.
TOKEN = r"\n|\.?[\p{L}\p{N}_][\p{L}\p{N}_+#]*"
# A number of years counts with its whole part: "2.5" and "2,5" are 2.
_NUMBER = r"(\d{1,2})(?:[.,]\d{1,2})?"
_OR_MORE = r"(?:\s*\+|\s*-?\s*plus\b|\s+or\s+more\b|\s+ou\s+plus\b)?"
YEARS = (
    rf"(?iU)(?<![\p{{L}}\p{{N}}_])(?<!\d[.,]){_NUMBER}{_OR_MORE}"
    rf"(?:\s*(?:-|–|—|to\b|à)\s*{_NUMBER}{_OR_MORE})?\s*-?\s*(?:years?|yrs?|ans?|années?)\b"
)
# "between 3 and 5" is read as "3-5".
BETWEEN = rf"(?iU)\b(?:between|entre)\s+{_NUMBER}\s+(?:and|et)\s+(?=\d)"

LIST_FIELDS = ("technical_tools", "technical_concepts", "certifications")
YEAR_FIELDS = ("min_years", "max_years")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def phrases(words: Column, max_words: int) -> Column:
    """Distinct runs of 1 to ``max_words`` words.  ``words`` must be a column of its own."""

    def runs_of(n: int) -> Column:
        return F.transform(words, lambda _, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))

    return F.array_distinct(F.concat(words, *[runs_of(n) for n in range(2, max_words + 1)]))


def _ranges(text: Column) -> Column:
    return F.regexp_replace(text, BETWEEN, "$1-")


def min_years(text: Column) -> Column:
    found = F.regexp_extract_all(_ranges(text), F.lit(YEARS), F.lit(1))
    return F.array_min(F.transform(found, lambda y: y.cast("int")))


def max_years(text: Column) -> Column:
    found = F.regexp_extract_all(_ranges(text), F.lit(YEARS), F.lit(2))
    return F.array_max(F.transform(F.filter(found, lambda y: y != ""), lambda y: y.cast("int")))


def clean_list(values: Column, dropped: Iterable[str] = DROPPED_LIST_VALUES) -> Column:
    """Drop nulls and placeholder values; a null list becomes an empty one."""
    words = list(dropped)
    kept = F.filter(values, lambda v: v.isNotNull() & ~F.lower(strip(v)).isin(words))
    return F.coalesce(kept, F.array().cast("array<string>"))


def variant_kind(value: Column, field: str) -> Column:
    """Type name of a field of a variant; a missing field counts as ``VOID``."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant")), F.lit("VOID"))


def variant_items(value: Column, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "array<variant>")


def holds_text_only(items: Column) -> Column:
    """No element of the list is of another type than text or null."""
    return F.coalesce(F.forall(items, lambda v: F.schema_of_variant(v).isin("STRING", "VOID")), F.lit(False))


def whole_number(value: Column) -> Column:
    """An integer that may be written as text or with a zero fraction; else null."""
    return F.regexp_extract(value, r"^\s*([+-]?\d+)(?:\.0+)?\s*$", 1).try_cast("int")
