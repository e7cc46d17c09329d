"""Text clean-up expressions: whitespace, entities, tags."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import APOSTROPHES

WORD = r"[\p{L}\p{N}_]+"
WORD_WITH_HYPHENS = r"[\p{L}\p{N}_]+(?:-[\p{L}\p{N}_]+)*"

NBSP = "\u00a0"
# Decoded "<" and ">" travel as private-use characters until all tags are gone.
HIDDEN_LT, HIDDEN_GT = "\ue000", "\ue001"
# Separators used inside a document while it is taken apart.
CUT = "\x1f"
RESERVED = "\x1c\x1d\x1e\x1f" + HIDDEN_LT + HIDDEN_GT

ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]*+;?|#[0-9]++;?|#[xX][0-9A-Fa-f]++;?)"
# Names that stand without a semicolon, whatever follows; the longest first.
LEGACY_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Numbers 128 to 159 stand for what windows-1252 has there.
_WINDOWS = {str(c): bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160)}
INVISIBLE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"<[/!?]?[A-Za-z][^>]*>"


def searched(pattern: str) -> str:
    """``pattern``, all alternatives of which begin with ``<``, with that in front: a search tries them nowhere else."""
    flags = re.match(r"(?:\(\?[a-z]+\))?", pattern).group()
    return f"{flags}(?=<)(?:{pattern[len(flags):]})"


#: What ``normalize_text`` and ``normalize_hidden`` rewrite one for one; most texts hold none of it.
_REWRITTEN = f"[{APOSTROPHES}{HIDDEN_LT}{HIDDEN_GT}]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are computed once per row.

    A plain column would be copied into every filter on it that the optimizer
    pushes down, and with it all the work behind it.  A generator of one row is
    a place the optimizer does not push or merge through.
    """
    kept = [c for c in df.columns if c not in columns]
    value = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(value)))


def valid_json(text: Column) -> Column:
    """Is the text one JSON value and nothing else?

    The parser stops after a value.  Only one value alone fits both into a list and
    after a key.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return listed.isNotNull() & keyed.isNotNull()


def strip(text: Column) -> Column:
    """Remove white space, in the Unicode sense, from both ends."""
    # A search stops at white space only.  The look-behind lets the end run start once, so long runs stay linear.
    return F.regexp_replace(text, r"(?U)\s(?:(?<=\A\s)\s*+|(?<!\s\s)\s*+\z)", "")


def collapse(text: Column) -> Column:
    """Every run of white space becomes one space; none is left at the ends."""
    # Single plain spaces are no match, so tidy text passes through untouched.
    return F.trim(F.regexp_replace(text, r"(?U)\s(?:(?<! )\s*+|\s++)", " "))


def normalize_text(text: Column) -> Column:
    """One-line text: plain spaces, plain apostrophes, ``&amp;`` resolved; null becomes ''."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{APOSTROPHES}]", "'")  # NBSP is white space
    return collapse(F.replace(text, F.lit("&amp;"), F.lit("&")))


def normalize_hidden(text: Column) -> Column:
    """``normalize_text`` for text whose decoded angle brackets are still hidden."""
    hidden, plain = APOSTROPHES + HIDDEN_LT + HIDDEN_GT, "'" * len(APOSTROPHES) + "<>"
    text = bind(text, lambda t: F.when(t.rlike(_REWRITTEN), F.translate(t, hidden, plain)).otherwise(t))
    return collapse(F.replace(text, F.lit("&amp;"), F.lit("&")))


def _constant_map(table: dict[str, str]) -> Column:
    # One constant: parsed while planning, not once per row.
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _reference_named(entity: Column) -> Column:
    """What HTML names so; null if nothing.  A map is read from its start, so names are kept by how they begin."""
    by_start: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        by_start.setdefault(f"&{name}"[:3], {})[f"&{name}"] = text
    names = F.from_json(F.lit(json.dumps(by_start)), "map<string,map<string,string>>")
    return F.try_element_at(F.try_element_at(names, F.left(entity, F.lit(3))), entity)


def _numbered(code: Column) -> Column:
    """The character of a number; one that stands for none is U+FFFD."""
    fits = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    special = F.when(code.between(128, 159), F.try_element_at(_constant_map(_WINDOWS), code.cast("string")))
    return F.coalesce(special, F.when(fits, char), F.lit("\ufffd"))


def _entity_text(entity: Column) -> Column:
    """What a character reference stands for; itself, if nothing."""
    common = {"&amp;": "&", "&nbsp;": NBSP, "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
    quick = F.when(F.lit(False), F.lit(""))
    for name, char in common.items():
        quick = quick.when(entity == name, char)
    legacy = F.regexp_extract(entity, "^&(?:" + "|".join(LEGACY_NAMES) + ")", 0)
    by_prefix = F.when(
        legacy != "", F.concat(_reference_named(legacy), F.substr(entity, F.length(legacy) + 1))
    )
    hexadecimal = F.regexp_extract(entity, "(?i)^&#x0*([0-9a-f]*);?$", 1)
    decimal = F.regexp_extract(entity, "^&#0*([0-9]*);?$", 1)
    # More digits than a character needs stand for none.
    hex_code = F.when(F.length(hexadecimal) <= 6, F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).cast("bigint"))
    code = F.when(F.length(decimal) <= 7, F.concat(F.lit("0"), decimal).try_cast("bigint"))
    numbered = F.when(
        entity.startswith("&#"),
        _numbered(F.coalesce(F.when(entity.rlike("^&#[xX]"), hex_code).otherwise(code), F.lit(0).cast("bigint"))),
    )
    return F.coalesce(quick, numbered, _reference_named(entity), by_prefix, entity)


def replace_each(text: Column, pattern: str, use: Callable[[Column], Column]) -> Column:
    """``text`` with ``use`` of every match in its place, in one pass."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.zip_with(between, found, lambda b, m: F.concat(b, F.coalesce(use(m), F.lit(""))))
    return F.array_join(joined, "")


def decode_entities(html: Column) -> Column:
    """Resolve every character reference once, keeping decoded angle brackets hidden.

    Text without ``&`` is left alone.
    """
    html = F.regexp_replace(F.coalesce(html, F.lit("")), f"[{RESERVED}]", "")

    def shown(entity: Column) -> Column:
        return F.translate(_entity_text(entity), "<>", HIDDEN_LT + HIDDEN_GT)

    return bind(html, lambda t: F.when(F.instr(t, "&") > 0, replace_each(t, ENTITY, shown)).otherwise(t))


def reveal(text: Column) -> Column:
    return F.translate(text, HIDDEN_LT + HIDDEN_GT, "<>")


def text_nodes(html: Column) -> Column:
    """The visible pieces of text of a page in order, stripped, empty ones left out."""
    pieces = F.split(F.regexp_replace(decode_entities(html), searched(f"{INVISIBLE}|{TAG}"), CUT), CUT)
    return F.filter(F.transform(pieces, lambda p: reveal(strip(p))), lambda p: p != "")


def plain_text(html: Column, separator: str = "") -> Column:
    """Visible text of a page, its pieces joined by ``separator``; null becomes ''."""
    return F.array_join(text_nodes(html), separator)
