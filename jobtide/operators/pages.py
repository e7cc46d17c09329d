"""Pages and descriptions: container selection, text, list entries, sections."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import DESCRIPTION_SELECTORS
from jobtide.functions.sections import (
    reduction_percent,
    with_blocks,
    with_requirement_section,
)
from jobtide.functions.text import CUT, HIDDEN_LT, INVISIBLE, RESERVED, plain_text, replace_each, strip, with_computed

_SELECTOR = re.compile(r"^([a-z][a-z0-9]*)(?:\.([\w-]+)|#([\w-]+)|\[([\w-]+)='([^']*)'\])?$")


# The rest of an opening tag; ">" may stand in quotes.  Possessive loops take a tag of any length
# without going deeper for each of its characters.
_PART = r"""(?:"[^"]*+"|'[^']*+'|[^>"'])"""
_REST = rf"{_PART}*+>"


def selector_pattern(selector: str) -> tuple[str, str]:
    """``(tag, opening-tag pattern)`` of ``tag``, ``tag.class``, ``tag#id`` or ``tag[attr='v']``.

    Of an attribute that stands twice in a tag the first counts.
    """
    parts = _SELECTOR.match(selector)
    if not parts:
        raise ValueError(f"Unsupported selector: {selector}")
    tag, css_class, element_id, attribute, value = parts.groups()
    wanted = re.escape(css_class or element_id or value or "")
    bare = rf"{wanted}(?=[\s>])"
    if css_class:
        name = "class"
        listed = r"""(?:(?!{1}[\s{0}])[^\s{0}]*+\s++)*+{1}(?:\s[^{0}]*+)?+"""
        values = rf"""(?:"{listed.format('"', wanted)}"|'{listed.format("'", wanted)}'|{bare})"""
    elif element_id or attribute:
        name = "id" if element_id else re.escape(attribute)
        values = rf"""(?:"{wanted}"|'{wanted}'|{bare})"""
    else:
        return tag, rf"(?i)<{tag}(?=[\s>]){_REST}"
    before = rf"(?:(?!\s{name}\s*+=){_PART})*+"
    return tag, rf"(?i)<{tag}(?=[\s>]){before}\s{name}\s*+=\s*+{values}{_REST}"


def with_main_container(
    pages: DataFrame, html_col: str, out_col: str = "container", selectors: Sequence[str] = DESCRIPTION_SELECTORS
) -> DataFrame:
    """Add the inner html of the first element any selector matches; null if none does.

    The element ends at the closing tag that balances its opening tag, or at the
    end of the page if it is never closed.  Tags in comments and scripts count for
    nothing.  The page is cut once, before every tag that a selector may ask for.
    """
    # A tag that is not one starts with a reserved character until the end.
    plain = F.translate(F.col(html_col), RESERVED, "")
    hidden = replace_each(plain, INVISIBLE, lambda m: F.translate(m, "<", HIDDEN_LT))
    patterns = [selector_pattern(s) for s in selectors]
    tags = "|".join(sorted({tag for tag, _ in patterns}))
    wanted = r"\A(?:" + "|".join(pattern.removeprefix("(?i)") for _, pattern in patterns) + ")"
    parts = F.split(hidden, rf"(?i)(?=<(?:{tags})[\s>])", -1)
    pages = with_computed(pages, _parts=parts)
    first = F.array_position(F.transform("_parts", lambda p: p.rlike(f"(?i){wanted}")), True)
    staged = with_computed(pages, _at=F.nullif(F.coalesce(first, F.lit(0)), F.lit(0)).cast("int"))
    opened = F.try_element_at("_parts", F.col("_at"))
    inner = F.regexp_replace(opened, rf"(?i)\A<(?:{tags}){_REST}", "")
    after = F.slice("_parts", F.col("_at") + 1, F.size("_parts"))
    tag = F.lower(F.regexp_extract(opened, r"\A<(\w+)", 1))
    close = F.concat(F.lit("(?i)</"), F.col("_tag"), F.lit(r"\s*>"))
    opens = F.concat(F.lit("(?i)<"), F.col("_tag"), F.lit(r"[\s>]"))
    staged = with_computed(staged, _tag=tag, _rest=F.concat(inner, F.array_join(after, "")))
    staged = with_computed(staged, _pieces=F.split("_rest", close))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("last"))

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.regexp_count(piece, opens) - 1
        seen = acc["seen"] + 1
        done = (acc["last"] == 0) & (depth == 0)
        return F.struct(
            depth.alias("depth"), seen.alias("seen"), F.when(done, seen).otherwise(acc["last"]).alias("last")
        )

    staged = staged.withColumn("_last", F.aggregate("_pieces", start, step)["last"])
    closed = F.array_join(F.slice("_pieces", F.lit(1), F.col("_last")), CUT)
    closed = F.replace(closed, F.lit(CUT), F.concat(F.lit("</"), F.col("_tag"), F.lit(">")))
    # Without a balancing tag every piece belongs to the element.
    value = F.when(F.col("_last") > 0, closed).otherwise(F.col("_rest"))
    shown = F.translate(strip(value), HIDDEN_LT, "<")
    return with_computed(staged, **{out_col: shown}).drop("_parts", "_at", "_tag", "_rest", "_pieces", "_last")


def page_text(pages: DataFrame, html_col: str, out_col: str = "plain_text") -> DataFrame:
    """Add the visible text, pieces stripped and put together without separator."""
    return with_computed(pages, **{out_col: plain_text(F.col(html_col))})


def list_items(pages: DataFrame, keys: Sequence[str], html_col: str) -> DataFrame:
    """One row ``(keys, block_pos, item_pos, item)`` per entry of every list."""
    blocks = with_blocks(pages.select(*keys, html_col), html_col).select(
        *keys, F.posexplode("blocks").alias("block_pos", "block")
    )
    return blocks.filter("block.kind = 'L'").select(
        *keys, "block_pos", F.posexplode("block.items").alias("item_pos", "item")
    )


def section_headers(pages: DataFrame, keys: Sequence[str], html_col: str) -> DataFrame:
    """One row ``(keys, block_pos, kind, context, is_section)`` per block."""
    blocks = with_blocks(pages.select(*keys, html_col), html_col)
    return blocks.select(*keys, F.posexplode("blocks").alias("block_pos", "block")).select(
        *keys, "block_pos", "block.kind", "block.context", "block.is_section"
    )


def section_items(pages: DataFrame, keys: Sequence[str], html_col: str) -> DataFrame:
    """One row ``(keys, block_pos, item_pos, is_section, item)`` per item of every block."""
    blocks = with_blocks(pages.select(*keys, html_col), html_col)
    return blocks.select(*keys, F.posexplode("blocks").alias("block_pos", "block")).select(
        *keys, "block_pos", F.col("block.is_section"), F.posexplode("block.items").alias("item_pos", "item")
    )


def text_reduction(pages: DataFrame, html_col: str, out_col: str = "reduction_pct") -> DataFrame:
    """Add how much of the plain text, in percent, the requirement section leaves out."""
    staged = with_requirement_section(pages, html_col, "_section")
    staged = staged.withColumn("_plain", plain_text(F.col(html_col), "\n"))
    reduction = reduction_percent(F.col("_plain"), F.col("_section"))
    return with_computed(staged, **{out_col: reduction}).drop("_section", "_plain")
