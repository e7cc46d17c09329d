"""SimHash fingerprints of 128 bits, and the search for close ones.

Terms are pairs of neighbouring words (a lone word is its own term), weighted by
how often they occur.  A term's two hashes vote on 128 bits with its weight; a
bit is set if more than half of the weight says so.  The votes are sums in one
aggregation, two counters to a long: a Spark string is below 2 GB, so no counter
passes 2 ** 30.

Search: of ``(radius + 1) / 2`` blocks, one differs in at most one bit between
fingerprints within the radius.  Each block is the key of one permuted table, in
which every fingerprint has one entry; stated queries ask it for their own block
and for the block with each of its bits turned, by equality, and the whole
fingerprints verify.  So all within the radius are found.  Equal fingerprints are
one entry with a count.  The radius was measured: of the pairs of different texts
with four fifths of their five-word shingles in common (sf0.1, 48 pairs), 0.96 lie
within 17 bits, 0.90 within 15 and none within 3; unrelated texts differ in 40 or more.

The next document of each is found without a global sort of texts: ids are
range-partitioned, and the last of a range follows on to the first of the next
(one row per range).  Only then do texts move, once by their own id, and the
half that the edit needs once more.

Defined cases: a null text is empty; a text without words has fingerprint zero.
Rows without ``doc_id`` have no next document: the edited text is the first half
alone, and ``near_next`` is null.  Rows that repeat an id each get a result; as a
next document, the smallest of their texts counts.  Other columns are not read.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import SPACE_PATTERN, SPACES, kept, texts_of

BITS = 128
RADIUS = 17
QUERY_STEP = 100


def term_hashes(text: str) -> Column:
    """One hash per term of a text column, repeats included; null without words."""
    trimmed = F.trim(F.col(text), F.lit(SPACES))
    words = F.split(trimmed, SPACE_PATTERN + "+")
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.xxhash64(a, b),
    )
    return F.when(trimmed == "", F.lit(None)).when(F.size(words) == 1, F.array(F.xxhash64(words[0]))).otherwise(pairs)


def _votes() -> list[Column]:
    low, high = F.col("h"), F.col("g")
    one = F.lit(1).cast("long")
    return [
        F.sum(
            F.shiftright(low, b).bitwiseAND(one) + F.shiftleft(F.shiftright(high, b).bitwiseAND(one), 32)
        ).alias(f"v{b}")
        for b in range(64)
    ]


def _decided() -> tuple[Column, Column]:
    """The two halves of the fingerprint, from the votes and the weight of all terms."""
    halves = []
    for part in (lambda v: F.shiftright(v, 32), lambda v: v.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))):
        bits = [
            F.when(part(F.col(f"v{b}")) * 2 > F.col("weight"), F.lit((1 << b) - ((b == 63) << 64)).cast("long")).otherwise(
                F.lit(0).cast("long")
            )
            for b in range(64)
        ]
        while len(bits) > 1:  # as a balanced tree
            bits = [x.bitwiseOR(y) for x, y in zip(bits[::2], bits[1::2], strict=True)]
        halves.append(bits[0])
    return halves[0], halves[1]


def simhash(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, hi, lo``: one fingerprint per combination of keys, of its one text."""
    terms = texts.select(*keys, F.explode_outer(term_hashes(text)).alias("h")).withColumn(
        "g", F.when(F.col("h").isNotNull(), F.xxhash64("h"))
    )
    voted = terms.groupBy(*keys).agg(F.count("h").alias("weight"), *_votes())
    hi, lo = _decided()
    return voted.select(*keys, hi.alias("hi"), lo.alias("lo"))


def next_ids(texts: DataFrame) -> DataFrame:
    """``doc_id, n, next_id`` for every id; ``n``: code points of its longest text."""
    sizes = texts.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    ranged = kept(sizes.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()))
    firsts = ranged.groupBy("part").agg(F.min("doc_id").alias("first"))
    # One row per range.
    order = Window.orderBy("part")
    ends = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(order), F.min("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        ).alias("after"),
    )
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return (
        ranged.withColumn("inside", inside)
        .join(F.broadcast(ends), "part")
        .select("doc_id", "n", F.coalesce("inside", "after").alias("next_id"))
    )


def likeness(a_hi: str, a_lo: str, b_hi: str, b_lo: str) -> Column:
    """The cosine that the share of differing bits stands for; 0 at half of the bits and beyond."""
    differ = F.bit_count(F.col(a_hi).bitwiseXOR(F.col(b_hi))) + F.bit_count(F.col(a_lo).bitwiseXOR(F.col(b_lo)))
    return F.greatest(F.lit(0.0), F.cos(differ * F.lit(3.141592653589793 / BITS)))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, hi, lo, edited_hi, edited_lo, near_edited, near_next, next_id``.

    The edited text has the last half of its code points replaced by the next document's first.
    """
    texts = texts_of(docs)
    named = texts.filter("doc_id IS NOT NULL")
    follow = kept(next_ids(texts))
    wanted = follow.select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("prev_id"), F.floor(F.col("n") / 2).cast("int").alias("half")
    )
    heads = (
        named.join(wanted, "doc_id")
        .select(F.col("prev_id").alias("doc_id"), F.substring("text", F.lit(1), F.col("half")).alias("head"))
        .groupBy("doc_id")
        .agg(F.min("head").alias("head"))
    )

    def both(rows: DataFrame) -> DataFrame:
        half = F.floor(F.col("n_chars") / 2).cast("int")
        own = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
        edited = F.concat(own, F.substring("head", F.lit(1), half))
        two = (
            rows.select("doc_id", "text", "head", F.length("text").cast("long").alias("n_chars"))
            .select("doc_id", F.monotonically_increasing_id().alias("row"), "n_chars", "text", edited.alias("edited"))
            .withColumn("edited_sha256", F.sha2("edited", 256))
        )
        keys = ["doc_id", "row", "n_chars", "edited_sha256"]
        stacked = two.select(
            *keys,
            F.inline(
                F.array(
                    F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
                    F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("body")),
                )
            ),
        )
        side = lambda c, e: F.max(F.when(F.col("is_edited") == e, F.col(c)))
        return (
            simhash(stacked, [*keys, "is_edited"], "body")
            .groupBy(*keys)
            .agg(
                side("hi", False).alias("hi"),
                side("lo", False).alias("lo"),
                side("hi", True).alias("edited_hi"),
                side("lo", True).alias("edited_lo"),
            )
            .drop("row")
        )

    alone = texts.filter("doc_id IS NULL").withColumn("head", F.lit(""))
    prints = kept(both(named.join(heads, "doc_id")).unionByName(both(alone)))
    # An id that is repeated shows, as a next document, the print of its smallest half.
    nexts = prints.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("p"))
    nexts = nexts.select(F.col("doc_id").alias("next_id"), F.col("p.hi").alias("next_hi"), F.col("p.lo").alias("next_lo"))
    linked = follow.select("doc_id", "next_id").join(nexts, "next_id")
    return prints.join(linked, "doc_id", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "hi",
        "lo",
        "edited_hi",
        "edited_lo",
        likeness("hi", "lo", "edited_hi", "edited_lo").alias("near_edited"),
        F.when(F.col("next_id").isNotNull(), likeness("hi", "lo", "next_hi", "next_lo")).alias("near_next"),
        "next_id",
    )


def _halves(mask: int) -> tuple[int, int]:
    """A mask of all bits as two signed numbers, high and low."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(mask >> 64), signed(mask & (1 << 64) - 1)


def block_tables(radius: int = RADIUS) -> list[list[int]]:
    """The bits of the key of each permuted table."""
    n = (radius + 2) // 2
    edges = [BITS * i // n for i in range(n + 1)]
    return [list(range(a, z)) for a, z in zip(edges, edges[1:], strict=False)]


def _keyed(prints: DataFrame, radius: int, turned: bool) -> DataFrame:
    """One row per table with the key of its block; with ``turned`` also for each bit of the block, turned."""
    asked = []
    for t, bits in enumerate(block_tables(radius)):
        block = sum(1 << b for b in bits)
        for change in [0, *(1 << b for b in bits)] if turned else [0]:
            masks = (*_halves(block), *_halves(change))
            asked.append(F.struct(F.lit(t).alias("t"), *(F.lit(m).cast("long").alias(n) for m, n in zip(masks, "abxy", strict=True))))
    rows = prints.withColumn("m", F.explode(F.array(*asked)))
    half = lambda c, mask, change: F.col(c).bitwiseXOR(F.col(change)).bitwiseAND(F.col(mask))
    return rows.withColumn("key", F.xxhash64("m.t", half("hi", "m.a", "m.x"), half("lo", "m.b", "m.y"))).drop("m")


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``hi, lo, n_near`` for each distinct query print: rows of ``prints`` within the radius, equal ones too."""
    classes = prints.groupBy("hi", "lo").agg(F.count("*").alias("n"))
    asked = _keyed(queries.select("hi", "lo").distinct(), radius, turned=True)
    held = _keyed(classes, radius, turned=False).select("key", F.col("hi").alias("o_hi"), F.col("lo").alias("o_lo"), "n")
    differ = F.bit_count(F.col("hi").bitwiseXOR(F.col("o_hi"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("o_lo")))
    # Spark's estimate of the exploded questions is far too low: neither side may be broadcast on it.
    met = asked.join(held.hint("merge"), "key").filter(differ <= radius).dropDuplicates(["hi", "lo", "o_hi", "o_lo"])
    return met.groupBy("hi", "lo").agg(F.sum("n").alias("n_near"))


def with_near_counts(prints: DataFrame) -> DataFrame:
    """Adds ``n_near`` for the stated queries, ids divisible by 100: other rows within the radius."""
    prints = kept(prints)
    is_query = F.col("doc_id") % QUERY_STEP == 0
    found = near_counts(prints, prints.filter(is_query))
    asked = prints.filter(is_query).join(found, ["hi", "lo"]).select("doc_id", "hi", "lo", F.col("n_near") - 1)
    asked = asked.toDF("q_id", "q_hi", "q_lo", "n_near").distinct()
    same = (F.col("doc_id") == F.col("q_id")) & (F.col("hi") == F.col("q_hi")) & (F.col("lo") == F.col("q_lo"))
    return prints.join(asked, same, "left").drop("q_id", "q_hi", "q_lo")
