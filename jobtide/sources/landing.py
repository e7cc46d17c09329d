"""Landed posting files: one JSON posting per line, one folder per search term."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.schemas import POSTING_ENVELOPE, ROLE_TAXONOMY

LANDING = T.StructType([T.StructField("value", T.StringType()), T.StructField("search_term", T.StringType())])


def timestamp(value: datetime | Column) -> Column:
    """A zone-less time constant."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``path/search_term=<term>/*``, as ``(value, search_term)``."""
    return spark.read.schema(LANDING).text(path)


def land_postings(lines: DataFrame, source: str, as_of: datetime | Column) -> DataFrame:
    """JSON lines to posting rows; the whole line is kept as ``raw_json``."""
    envelope = lines.withColumn("_e", F.from_json("value", POSTING_ENVELOPE))
    return envelope.select(
        F.lit(source).alias("source"),
        F.col("_e.id").alias("source_job_id"),
        F.col("_e.created").alias("created_at"),
        F.col("search_term"),
        timestamp(as_of).alias("fetched_at"),
        F.col("_e.redirect_url").alias("redirect_url"),
        F.col("value").alias("raw_json"),
    )


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Role taxonomy from a JSON array of ``{name, aliases, search_term}``.

    ``position`` is the order in the file; the first role that matches wins.
    """
    roles = spark.read.schema(T.StructType([T.StructField("value", T.StringType())])).text(path, wholetext=True)
    parsed = F.from_json("value", T.ArrayType(ROLE_TAXONOMY))
    return roles.select(F.posexplode(parsed).alias("position", "role")).select(
        (F.col("position") + 1).alias("position"), "role.name", "role.aliases", "role.search_term"
    )
