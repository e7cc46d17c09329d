"""Exact dedup over an extendible-hash index in shared files.

Texts without white space are hashed to 64 bits.  The directory maps the leading
bits of a hash to a bucket: an overfull bucket splits in two, and the directory
doubles, until every bucket holds few enough distinct hashes.  Copies cannot be
split by their hash; a hash with very many rows gets overflow pages instead.
An owner task takes each (bucket, page), chains the rows whose hashes collide
and compares the bytes of their texts; the pages of one hash are then merged,
again by bytes.  The index is stored in the shared folder and every row looks up
its entry by hash and digest.

Sizes: a bucket or page holds ``max(MIN_CAPACITY, rows / MAX_BUCKETS)`` entries,
so directory and overflow table have a bounded number of rows at every input
size, and only these two are broadcast.

Defined cases: a null text is empty, and empty texts are equal.  Of equal texts
the longest original stays, then the smallest ``doc_id``; a row without
``doc_id`` stays only if no row as long has one (``keep_id`` is then null).  Rows
that repeat both id and text are all counted and all marked alike.  Other columns
are not read.  DataFrame functions only.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import SPACE_PATTERN, kept, texts_of, working_folder

MIN_CAPACITY = 512
MAX_BUCKETS = 1 << 16


def _keyed(docs: DataFrame) -> DataFrame:
    plain = texts_of(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.regexp_replace("text", SPACE_PATTERN + "+", "").alias("bytes"),
    )
    return plain.withColumn("hash", F.xxhash64("bytes"))


def entries(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, text_sha256``, one row per document, without its text."""
    return kept(_keyed(docs).select("doc_id", "hash", F.sha2("bytes", 256).alias("text_sha256")))


def _slot(hash_column, depth: int):
    return F.shiftrightunsigned(hash_column, 64 - depth)


def directory(hashes: DataFrame, capacity: int, depth: int) -> DataFrame:
    """``slot, bucket``: one row per slot in use of a directory of ``2 ** depth`` slots.

    ``hashes``: distinct ``hash``.  A bucket is a prefix; the shortest one that is not
    overfull is where splitting stopped.
    """
    slots = hashes.groupBy(_slot("hash", depth).alias("slot")).agg(F.count("*").alias("n"))
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d")).withColumn(
        "prefix", F.expr(f"shiftrightunsigned(slot, {depth} - d)")
    )
    filled = levels.groupBy("d", "prefix").agg(F.sum("n").alias("filled"))
    fits = levels.join(filled, ["d", "prefix"]).filter((F.col("filled") <= capacity) | (F.col("d") == depth))
    return fits.groupBy("slot").agg(F.min(F.struct("d", "prefix")).alias("bucket"))


def build_index(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``hash, text_sha256, keep_id, group_size`` of every distinct text, read from shared files.

    ``rows``: the result of :func:`entries`.
    """
    hashes = kept(rows.groupBy("hash").agg(F.count("*").alias("n_rows")))
    total = rows.count()
    capacity = max(MIN_CAPACITY, -(-total // MAX_BUCKETS))
    # Two levels beyond the mean fill, for hashes that are not spread evenly.
    depth = max(1, math.ceil(math.log2(max(total, 1) / capacity + 1)) + 2)
    # Bounded: 2 ** depth is at most 16 x MAX_BUCKETS slots, and at most MAX_BUCKETS hashes overflow.
    slots = F.broadcast(directory(hashes, capacity, depth))
    overflow = F.broadcast(
        hashes.filter(F.col("n_rows") > capacity).select(
            "hash", F.ceil(F.col("n_rows") / capacity).cast("long").alias("pages")
        )
    )
    page = F.expr("coalesce(pmod(xxhash64(doc_id, n_chars), pages), 0)")
    owned = (
        _keyed(docs)
        .withColumn("slot", _slot("hash", depth))
        .join(slots, "slot")
        .join(overflow, "hash", "left")
        .select("bucket", page.alias("page"), F.col("pages").isNotNull().alias("hot"), "hash", "bytes", "doc_id", "n_chars")
        .repartition("bucket", "page")
    )
    chained = owned.groupBy("bucket", "page", "hot", "hash", "bytes").agg(
        F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"))).alias("best"), F.count("*").alias("n")
    )
    path = f"{working_folder(docs.sparkSession)}/index-{uuid.uuid4().hex}"
    chained.select(
        "bucket",
        "page",
        "hash",
        F.sha2("bytes", 256).alias("text_sha256"),
        F.when(F.col("hot"), F.col("bytes")).alias("bytes"),
        "best",
        "n",
    ).write.parquet(path)
    pages = docs.sparkSession.read.parquet(path)
    return pages.groupBy("hash", "text_sha256", "bytes").agg(
        F.bitwise_not(F.max("best")["id"]).alias("keep_id"), F.sum("n").alias("group_size")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``."""
    rows = entries(docs)
    index = build_index(docs, rows).drop("bytes")
    return rows.join(index, ["hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
