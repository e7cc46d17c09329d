"""Connected components by alternating large and small stars.

Each round is two joins on a node with its smallest neighbour, so a node with
very many links is never one group; the number of rounds grows with the
logarithm of a chain's length, not with the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node that is not its component's smallest.

    ``links``: columns ``a`` and ``b``, long, in any order, repeats and loops allowed.
    """
    stars = kept(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
        both = stars.union(stars.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        stars = kept(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
