"""Requirement lists to one row per item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import CERTIFICATION, TECHNICAL_CONCEPT, TECHNICAL_TOOL
from jobtide.functions.text import strip


def requirement_items(requirements: DataFrame) -> DataFrame:
    """``(source, source_job_id, item_type, item_value, item_value_norm)``.

    The three lists are stacked inside the row and unnested, so the table is
    read once.  An empty or null list gives no row, a null element one row.
    Requirements that carry the role of their job hand it on as ``role_title``.
    """
    kept = ["source", "source_job_id", *[c for c in ("role_title",) if c in requirements.columns]]
    lists = F.array(
        F.struct(F.lit(TECHNICAL_TOOL).alias("item_type"), F.col("technical_tools").alias("items")),
        F.struct(F.lit(TECHNICAL_CONCEPT).alias("item_type"), F.col("technical_concepts").alias("items")),
        F.struct(F.lit(CERTIFICATION).alias("item_type"), F.col("certifications").alias("items")),
    )
    return (
        requirements.select(*kept, F.inline(lists))
        .select(*kept, "item_type", F.explode("items").alias("item_value"))
        .withColumn("item_value_norm", F.lower(strip(F.col("item_value"))))
    )
