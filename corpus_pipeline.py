"""Cleaning a corpus: quality, lines, near duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is stored as Parquet and is the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import line_dedup, packing, quality, simhash_dedup
from jobtide.llm.common import ship, table, working_folder
from jobtide.llm.queries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Every row is judged by its own text, null as empty: repeated rows, and rows without id, alike.
    Other columns of ``docs`` go.
    """
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, "lang", "source", "n_chars")
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by five documents or more stay in one; every row stays, if emptied, null texts as empty ones."""
    ship(spark)
    found = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), "lang", "source")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share four fifths of their five-word shingles one stays, and of what such links connect.

    The row with the smallest id stays, rows without id come last; of rows that repeat an id, or
    lack one, the smallest text.  Empty and null texts are one group.
    """
    ship(spark)
    return simhash_dedup.without_near_duplicates(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence; repeated rows are packed each, a null text is the end id alone."""
    ship(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{working_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Quality scores, XXH64 fingerprints and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None
