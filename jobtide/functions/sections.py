"""Requirement sections of a description page.

The work stays inside the row: a page is cut at its block tags with regular
expressions and the pieces are classified with array functions.  Nothing is
shuffled and no page meets another one, so a huge page costs only itself.

A page becomes *groups*: running text followed by the lists that stand right
below it.  Each leaf block is visited once, in document order:

* ``H``  heading text: gives context, holds no items;
* ``T``  paragraph or division: its bulleted lines are items;
* ``L``  list: its entries are items.

The context of a block is the text of the nearest text block before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import BULLET_PREFIX, SKILL_HEADERS
from jobtide.functions.text import (
    INVISIBLE,
    NBSP,
    TAG,
    decode_entities,
    normalize_hidden,
    normalize_text,
    plain_text,
    searched,
    with_computed,
)

# A page is cut at GROUP, LIST and BLOCK marks.  A LIST or BLOCK mark is followed
# by what it stands for and END: "ul" or "ol" for an opened list, "</li>" for a
# list closed inside an entry, a heading's name, or nothing.
GROUP, LIST, BLOCK, END = "\x1c", "\x1d", "\x1e", "\x1f"

# A header begins a word, so no ASCII letter stands before it, and with one of few letters (or
# beyond ASCII, where one may count as the same in another case): most places are ruled out by that.
_FIRST = "".join(sorted({c for h in SKILL_HEADERS for c in h[0].lower() + h[0].upper()}))
HEADER = rf"(?U)(?<![A-Za-z])(?=[{_FIRST}[^\x00-\x7f]])(?i)\b(?:" + "|".join(SKILL_HEADERS) + r")\b"

NO_TEXT = f"{INVISIBLE}|<br\\s*/?>"
LIST_TAG = r"(?i)<(ul|ol)\b[^>]*>|</(?:ul|ol)\s*>(\s*</li\s*>)?"
ITEM_OPEN = r"(?i)<li\b[^>]*>"
BLOCK_TAG = (
    r"(?i)</?(?:p|div|section|article|header|footer|main|nav|aside|table|thead|tbody|tr|td|th"
    r"|dl|dt|dd|blockquote|form|fieldset|figure|address|body|html|head|title|hr)\b[^>]*>"
    r"|</h[1-6]\s*>|<(h[1-6])\b[^>]*>"
)
# Bold text right above a list is the heading of that list.
BOLD_ABOVE_LIST = r"(?is)(<(?:b|strong)\b[^>]*>[^<]*</(?:b|strong)\s*>\s*)(<(?:ul|ol)\b)"
MARK = BLOCK + "(?:h|h[1-6]|H[1-6])?" + END
MARK_OR_TAG = f"(?=[{BLOCK}<])(?:{MARK}|{TAG})"
# A closed list followed by more text starts a new group.
TEXT_AFTER_LIST = "(?U)" + LIST + END + r"((?:\s++|<[^>]*+>|" + MARK + r")*+[^\s<" + LIST + BLOCK + "])"
MARKS = (
    (NO_TEXT, "\n"),
    (BOLD_ABOVE_LIST, BLOCK + "h" + END + "$1$2"),
    (BLOCK_TAG, BLOCK + "$1" + END),
    (LIST_TAG, LIST + "$1$2" + END),
    (TEXT_AFTER_LIST, GROUP + END + "$1"),
)
FIRST_LINE = r"^(?:<[^>]*+>)*+([^<\n]*)"


def is_skill_header(text: Column) -> Column:
    """Does the text name a requirement section, anywhere, in any case?"""
    return text.rlike(HEADER)


def is_bullet(line: Column) -> Column:
    return line.rlike(BULLET_PREFIX)


def strip_bullet(line: Column) -> Column:
    """Remove one leading bullet sign or number."""
    return F.trim(F.regexp_replace(line, BULLET_PREFIX, ""))


def mark_blocks(html: Column) -> Column:
    """The page with separator characters in place of its block and list tags."""
    text = F.replace(decode_entities(html), F.lit(NBSP), F.lit(" "))
    for pattern, replacement in MARKS:
        text = F.regexp_replace(text, pattern if pattern == TEXT_AFTER_LIST else searched(pattern), replacement)
    # Text before the first block tag belongs to no block: context only.
    return F.concat(F.lit("h" + END), text)


def _inner_text(raw: Column) -> Column:
    return normalize_hidden(F.regexp_replace(raw, MARK_OR_TAG, ""))


def _after_mark(piece: Column) -> Column:
    return F.substr(piece, F.instr(piece, END) + 1)


def _group(parts: Column) -> Column:
    """One group from its parts: running text first, then list bodies."""

    def text_block(piece: Column) -> Column:
        raw = _after_mark(piece)
        kind = F.when(F.startswith(piece, F.lit("h")) | F.startswith(piece, F.lit("H")), "H").otherwise("T")
        return F.struct(kind.alias("kind"), raw.alias("raw"), _inner_text(raw).alias("text"))

    flow = F.filter(F.transform(F.split(parts[0], BLOCK), text_block), lambda b: b["text"] != "")
    bodies = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _after_mark)
    return F.struct(flow.alias("flow"), F.filter(bodies, lambda p: p.rlike(ITEM_OPEN)).alias("lists"))


def _texts_before(groups: Column) -> Column:
    """For each group the last text of all groups before it."""

    def extend(texts: Column, group: Column) -> Column:
        last = F.try_element_at(group["flow"], F.lit(-1))["text"]
        return F.concat(texts, F.array(F.coalesce(last, F.element_at(texts, -1))))

    return F.aggregate(groups, F.array(F.lit("")), extend)


def _blocks(groups: Column, texts_before: Column) -> Column:
    """Flatten groups to blocks that know their context."""

    def of_group(group: Column, i: Column) -> Column:
        flow = group["flow"]
        before = F.get(texts_before, i)
        nearest = F.coalesce(F.try_element_at(flow, F.lit(-1))["text"], before, F.lit(""))

        def with_context(block: Column, j: Column) -> Column:
            context = F.when(j > 0, F.get(flow, j - 1)["text"]).otherwise(before)
            return F.struct(
                block["kind"].alias("kind"), block["raw"].alias("raw"), F.coalesce(context, F.lit("")).alias("context")
            )

        def listed(raw: Column) -> Column:
            return F.struct(F.lit("L").alias("kind"), raw.alias("raw"), nearest.alias("context"))

        return F.concat(F.transform(flow, with_context), F.transform(group["lists"], listed))

    return F.flatten(F.transform(groups, of_group))


def _lines(raw: Column) -> Column:
    """Non-empty lines of a text block with their classification."""
    texts = F.transform(F.split(F.regexp_replace(raw, TAG, "\n"), "\n"), normalize_hidden)

    def classify(text: Column) -> Column:
        return F.struct(
            text.alias("text"), is_bullet(text).alias("bullet"), (~is_bullet(text) & is_skill_header(text)).alias("header")
        )

    return F.transform(F.filter(texts, lambda t: t != ""), classify)


def _entries(raw: Column) -> Column:
    """Non-empty entries of a list."""
    pieces = F.split(raw, ITEM_OPEN)
    return F.filter(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _inner_text), lambda t: t != "")


def _classified(block: Column) -> Column:
    no_lines = F.array().cast("array<struct<text:string,bullet:boolean,header:boolean>>")
    no_entries = F.array().cast("array<string>")
    first_line = F.regexp_extract(block["raw"], FIRST_LINE, 1)
    return F.struct(
        block["kind"].alias("kind"),
        block["context"].alias("context"),
        (is_skill_header(block["context"]) | is_skill_header(first_line)).alias("flagged"),
        F.when(block["kind"] == "T", _lines(block["raw"])).otherwise(no_lines).alias("lines"),
        F.when(block["kind"] == "L", _entries(block["raw"])).otherwise(no_entries).alias("entries"),
    )


def _with_header_position(block: Column) -> Column:
    return F.struct(
        *[block[name].alias(name) for name in ("kind", "context", "flagged", "lines", "entries")],
        F.array_position(F.transform(block["lines"], lambda x: x["header"]), True).alias("header_at"),
    )


def _items(block: Column) -> Column:
    """Items of a block: list entries, or bulleted lines with their continuations.

    A line without a bullet continues the item above it once the block counts as
    a requirement section; the header line itself is dropped.
    """

    def kept(line: Column, i: Column) -> Column:
        in_section = block["flagged"] | ((block["header_at"] > 0) & (i >= block["header_at"]))
        return line["bullet"] | (~line["header"] & in_section)

    def written(line: Column) -> Column:
        return F.when(line["bullet"], F.concat(F.lit("\n"), strip_bullet(line["text"]))).otherwise(
            F.concat(F.lit(" "), line["text"])
        )

    joined = F.array_join(F.transform(F.filter(block["lines"], kept), written), "")
    bulleted = F.slice(F.split(joined, "\n"), F.lit(2), F.size(block["lines"]) + 1)
    items = F.when(block["kind"] == "L", block["entries"]).otherwise(F.filter(bulleted, lambda t: t != ""))
    return F.struct(
        block["kind"].alias("kind"),
        block["context"].alias("context"),
        (block["flagged"] | (block["header_at"] > 0)).alias("is_section"),
        items.alias("items"),
    )


def with_blocks(df: DataFrame, html_col: str, out_col: str = "blocks") -> DataFrame:
    """Add ``array<struct<kind, context, is_section, items>>``, in document order."""
    parts = F.transform(F.split(mark_blocks(F.col(html_col)), GROUP), lambda g: F.split(g, LIST))
    df = with_computed(df, _groups=F.transform(parts, _group))
    df = with_computed(df, _before=_texts_before(F.col("_groups")))
    found = _blocks(F.col("_groups"), F.col("_before"))
    blocks = F.transform(F.transform(found, _classified), _with_header_position)
    return with_computed(df, **{out_col: F.transform(blocks, _items)}).drop("_groups", "_before")


def section_text(blocks: Column, html: Column) -> Column:
    """Items of requirement sections, else all items, else the whole text."""
    wanted = F.flatten(F.transform(F.filter(blocks, lambda b: b["is_section"]), lambda b: b["items"]))
    others = F.flatten(F.transform(F.filter(blocks, lambda b: ~b["is_section"]), lambda b: b["items"]))
    return (
        F.when(F.size(wanted) > 0, F.trim(F.array_join(wanted, "\n")))
        .when(F.size(others) > 0, F.trim(F.array_join(others, "\n")))
        .otherwise(normalize_text(plain_text(html, " ")))
    )


def with_requirement_section(df: DataFrame, html_col: str, out_col: str = "section") -> DataFrame:
    """Add the text that states the requirements of a description."""
    blocks = with_blocks(df, html_col, "_blocks")
    return with_computed(blocks, **{out_col: section_text(F.col("_blocks"), F.col(html_col))}).drop("_blocks")


def reduction_percent(plain: Column, section: Column) -> Column:
    """Share of the plain text, in percent, that the section leaves out."""
    return 100.0 * (F.length(plain) - F.length(section)) / F.nullif(F.length(plain), F.lit(0))
