"""Titles to canonical roles.

Two forms of the same matching, chosen by the size of the taxonomy:

* a small taxonomy becomes one expression per row: no shuffle, no join;
* a large one becomes rows that are joined to the distinct titles.

Order of preference in both: whole alias, all alias words, keyword.  Within a
step the first role in taxonomy order wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import EXACT_MATCH, FLEXIBLE_MATCH, KEYWORD_MATCH, NO_MATCH
from jobtide.functions.text import WORD, with_computed
from jobtide.functions.titles import keyword_role, whole_word_pattern, with_clean_title
from jobtide.session import computed_once

MAX_INLINE_ALIASES = 300
# Aliases that may be broadcast to meet the distinct titles.
BROADCAST_ALIASES = 200_000
# Rows of one title that one copy of its match serves.
HOT_TITLE_ROWS = 1_000_000

# Shares over which rows without a title, which match nothing, are spread.
EMPTY_SHARES = 1024
BETWEEN_WORDS = r"(?<=[\p{L}\p{N}_])[^\p{L}\p{N}_]+(?=[\p{L}\p{N}_])"

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Role:
    name: str
    aliases: tuple[str, ...]
    search_term: tuple[str, ...] = ()


def taxonomy_frame(spark: SparkSession, roles: Sequence[Role]) -> DataFrame:
    rows = [(i + 1, r.name, list(r.aliases), list(r.search_term)) for i, r in enumerate(roles)]
    return spark.createDataFrame(
        rows, "position int, name string, aliases array<string>, search_term array<string>"
    )


def small_taxonomy(taxonomy: DataFrame, max_aliases: int = MAX_INLINE_ALIASES) -> list[Role] | None:
    """The roles, in order, if their aliases are few enough to become an expression.

    At most ``max_aliases + 1`` rows reach the driver, whatever the table holds.
    """
    rows = taxonomy.select("position", "name", F.explode_outer("aliases").alias("alias"), "search_term")
    head = rows.limit(max_aliases + 1).collect()
    if len(head) > max_aliases:
        return None
    roles: dict[tuple, list] = {}
    for row in head:
        roles.setdefault((row.position, row.name, tuple(row.search_term or ())), []).append(row.alias)
    return [Role(n, tuple(a for a in als if a), terms) for (_, n, terms), als in sorted(roles.items())]


def words_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def exact_role(title: Column, roles: Sequence[Role]) -> Column:
    """First role one of whose aliases stands in the title as whole words.

    Roles without aliases never match.
    """
    role = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in roles:
        if aliases := [a for a in r.aliases if a]:
            role = role.when(title.rlike(whole_word_pattern(aliases)), r.name)
    return role


def flexible_role(words: Column, roles: Sequence[Role]) -> Column:
    """First role one of whose aliases has all its words among ``words``."""
    role = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in roles:
        for alias in r.aliases:
            needed = list(dict.fromkeys(_WORD.findall(alias.lower())))
            if needed:
                hit = F.array_contains(words, needed[0])
                for word in needed[1:]:
                    hit = hit & F.array_contains(words, word)
                role = role.when(hit, r.name)
    return role


def _with_outcome(df: DataFrame) -> DataFrame:
    """Settle role and method; the keyword patterns run only on what is left."""
    role = F.coalesce("_exact", "_flexible")
    df = df.withColumn("_keyword", F.when(role.isNull(), keyword_role(F.col("cleaned_title"))))
    method = (
        F.when(F.col("_exact").isNotNull(), EXACT_MATCH)
        .when(F.col("_flexible").isNotNull(), FLEXIBLE_MATCH)
        .when(F.col("_keyword").isNotNull(), KEYWORD_MATCH)
        .otherwise(NO_MATCH)
    )
    return with_computed(
        df,
        cleaned_title=F.col("cleaned_title"),
        matched_role=F.coalesce("_exact", "_flexible", "_keyword"),
        match_method=method,
    )


def map_titles(df: DataFrame, taxonomy: Sequence[Role] | DataFrame, title_col: str = "title") -> DataFrame:
    """Add ``cleaned_title``, ``matched_role`` and ``match_method``; keep every row.

    Cleaning a title costs less than moving its row, so a small taxonomy is
    matched in place and no row is shuffled, however often a title repeats.
    """
    if isinstance(taxonomy, DataFrame):
        roles = small_taxonomy(taxonomy)
        if roles is None:
            return map_titles_by_join(df, taxonomy, title_col)
    else:
        roles = taxonomy
    staged = with_clean_title(df, title_col)
    staged = staged.withColumn("_exact", exact_role(F.col("cleaned_title"), roles))
    staged = staged.withColumn("_words", F.when(F.col("_exact").isNull(), words_of(F.col("cleaned_title"))))
    staged = staged.withColumn("_flexible", flexible_role(F.col("_words"), roles))
    return _with_outcome(staged).drop("_exact", "_words", "_flexible", "_keyword")


def tokens_of(text: Column) -> Column:
    """Words and what stands between them, in turn, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+|\W+"), F.lit(0))


def holds_tokens(tokens: Column, wanted: Column) -> Column:
    """Do ``wanted`` tokens stand in ``tokens`` as whole words?

    Tokens are maximal, so words that are equal begin and end where the title's do.  What is no
    word at an end of ``wanted`` must touch a word there: it may not be the title's own end.
    """
    n, m = F.size(tokens), F.size(wanted)
    is_word = lambda token: token.rlike(r"^(?U)\w")
    first, last = is_word(F.get(wanted, F.lit(0))), is_word(F.get(wanted, m - 1))
    starts = F.when((m > 0) & (m <= n), F.sequence(F.lit(1), n - m + 1)).otherwise(F.array().cast("array<int>"))
    return F.exists(
        starts, lambda i: (F.slice(tokens, i, m) == wanted) & (first | (i > 1)) & (last | (i + m - 1 < n))
    )


def alias_index(taxonomy: DataFrame) -> DataFrame:
    """One row per alias with its tokens, its words and the rarest of them as its join key."""
    aliases = taxonomy.select("position", "name", F.posexplode("aliases").alias("alias_position", "alias"))
    # An alias of symbols alone has no word; it is met as what stands between two words.
    aliases = aliases.filter("alias <> ''").withColumn("words", words_of(F.col("alias")))
    aliases = aliases.withColumn("tokens", tokens_of(F.col("alias")))
    symbols = aliases.filter(F.size("words") == 0).withColumn("rarest", F.col("alias"))
    aliases = aliases.filter(F.size("words") > 0)
    spelled = aliases.select("position", "alias_position", F.explode("words").alias("word"))
    usage = spelled.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        spelled.join(usage, "word")
        .groupBy("position", "alias_position")
        .agg(F.min(F.struct("n", "word"))["word"].alias("rarest"))
    )
    return aliases.join(rarest, ["position", "alias_position"]).unionByName(symbols)


def matched_by_join(titles: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """``(cleaned_title, exact, flexible)`` for distinct non-empty titles that match.

    A title meets an alias only through that alias's rarest word, never through
    words such as "engineer" that fill the table.  Containing the words is
    needed for the whole alias as well, so one join serves both steps.  A whole alias is
    told by slices of the title's tokens: no pattern is built for a row.
    """
    index = alias_index(taxonomy)
    if index.count() <= BROADCAST_ALIASES:
        index = F.broadcast(index)
    words = titles.withColumn("_words", words_of(F.col("cleaned_title")))
    words = words.withColumn("_tokens", tokens_of(F.col("cleaned_title")))
    between = F.array_distinct(F.regexp_extract_all(F.col("cleaned_title"), F.lit(BETWEEN_WORDS), F.lit(0)))
    spelled = words.select("cleaned_title", "_words", "_tokens", F.explode(F.array_union("_words", between)).alias("rarest"))
    met = spelled.join(index, "rarest").filter(F.size(F.array_except("words", "_words")) == 0)
    whole = holds_tokens(F.col("_tokens"), F.col("tokens"))
    ranked = F.struct("position", "alias_position", "name")
    best = met.groupBy("cleaned_title").agg(
        F.min(F.when(whole, ranked)).alias("_exact"), F.min(F.when(F.size("words") > 0, ranked)).alias("_flexible")
    )
    return best.select(
        "cleaned_title", F.col("_exact.name").alias("_exact"), F.col("_flexible.name").alias("_flexible")
    )


def map_titles_by_join(
    df: DataFrame, taxonomy: DataFrame, title_col: str = "title", hot_rows: int = HOT_TITLE_ROWS
) -> DataFrame:
    """``map_titles`` for a taxonomy of any size: clean and match distinct titles, join back.

    A title is cleaned once, however many rows have it.  A popular title may hold a third
    of the rows.  A title with more than ``hot_rows`` rows gets one copy of its match per
    ``hot_rows`` of them, and its rows are spread over the copies; other titles are joined
    as they are, and rows without a title are spread over shares that hold no match.  The
    list of hot titles is met only if there are any, and broadcast only if Spark finds it small.
    """
    title = F.col(title_col).cast("string")
    counted = df.filter(title.isNotNull()).groupBy(title.alias("_title")).agg(F.count(F.lit(1)).alias("_n"))
    cleaned = computed_once(with_clean_title(counted, "_title"))
    distinct = cleaned.filter("cleaned_title <> ''").select("cleaned_title").distinct()
    # Titles of which cleaning leaves nothing match nothing, and are not to meet in one place.
    nowhere = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("_title"), F.lit(EMPTY_SHARES)))
    met = cleaned.withColumn("_key", F.when(F.col("cleaned_title") == "", nowhere).otherwise(F.col("cleaned_title")))
    found = matched_by_join(distinct, taxonomy).withColumnRenamed("cleaned_title", "_key")
    copies = (F.col("_n") / hot_rows).cast("int") + 1
    matches = _with_outcome(met.join(found, "_key", "left")).select(
        "_title", "cleaned_title", "matched_role", "match_method", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_salt")
    )
    placed = df.drop("cleaned_title", "matched_role", "match_method").withColumn("_row", F.monotonically_increasing_id())
    placed = placed.withColumn("_title", title)
    share = F.lit(0)
    hot = cleaned.filter(F.col("_n") >= hot_rows).select("_title", copies.alias("_copies"))
    if not hot.isEmpty():
        away = F.concat(F.lit("\u0000"), F.pmod(F.col("_row"), F.lit(EMPTY_SHARES)))
        placed = placed.withColumn("_key", F.coalesce("_title", away))
        placed = placed.join(hot.withColumnRenamed("_title", "_key"), "_key", "left")
        share = F.pmod(F.col("_row"), F.coalesce("_copies", F.lit(1))).cast("int")
    # No match has a share below zero.
    untitled = (-1 - F.pmod(F.col("_row"), F.lit(EMPTY_SHARES))).cast("int")
    spread = placed.withColumn("_salt", F.when(F.col("_title").isNull(), untitled).otherwise(share))
    spread = spread.withColumn("_title", F.coalesce("_title", F.lit("")))
    return spread.join(matches, ["_title", "_salt"], "left").select(
        *df.columns,
        F.coalesce("cleaned_title", F.lit("")).alias("cleaned_title"),
        "matched_role",
        F.coalesce("match_method", F.lit(NO_MATCH)).alias("match_method"),
    )


def mapped_only(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("match_method") != NO_MATCH)


def unmapped_only(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("match_method") == NO_MATCH)
