"""A batch into a base table: staged once, counted while it is written, what breaks a rule set apart.

The rows that a batch adds are staged under the batch's name before they are appended.  A
batch that is repeated, after a failure or on purpose, takes up what it had staged, appends
what is still missing and gives the same counts, so that whatever is built from its added
rows can be built again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.text import valid_json
from jobtide.operators.upsert import first_per_key, with_load_time
from jobtide.schemas import KEY, TABLES
from jobtide.session import folder_exists
from jobtide.sources import keyed

#: Columns that must be JSON.
JSON_COLUMNS = {"jobs_raw": "raw_json"}


@dataclass
class Added:
    """What a batch has added: the rows, as stored, and the counts of its write."""

    rows: DataFrame
    counts: dict[str, int]


def with_broken_rule(rows: DataFrame, table: str, arrival: Sequence[str]) -> DataFrame:
    """The columns of ``table`` in its types, those of ``arrival``, and ``broken_rule``: the first rule a row breaks.

    Values that do not fit a type are null; a row that breaks a rule keeps what it brought in ``brought``.
    """
    fields = [f for f in TABLES[table].fields if f.name in rows.columns]
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
    rules = [F.when(F.col(f.name).isNull(), f"{f.name} not null") for f in fields if not f.nullable]
    rules += [
        F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), f"{f.name} is {f.dataType.simpleString()}")
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    if table in JSON_COLUMNS:
        rules.append(F.when(~valid_json(F.col(JSON_COLUMNS[table])), f"{JSON_COLUMNS[table]} is JSON"))
    broken = F.coalesce(*rules, F.lit(None).cast("string")) if rules else F.lit(None).cast("string")
    brought = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    extra = [F.col(c) for c in arrival if c not in typed]
    return rows.select(
        *[c.alias(n) for n, c in typed.items()], *extra, broken.alias("broken_rule"), F.when(broken.isNotNull(), brought).alias("brought")
    )


def ingest(
    spark: SparkSession,
    folder: str,
    database: str,
    table: str,
    rows: DataFrame,
    batch: str,
    as_of: datetime | Column,
    arrival: Sequence[str],
    buckets: int,
    payload: str | None = None,
) -> Added:
    """Add to ``table`` of the store the rows whose key is new; rows without ``payload`` are missed, not added.

    Counts: ``candidates`` rows, of them ``missed`` and ``quarantined`` ones, and of the keys of
    the others those ``already_present`` and those ``inserted``.  ``rows`` is computed once.
    """
    name, work = keyed.table_name(database, table), f"{folder}/batches/{batch}/{table}"
    target = spark.table(name)
    if not folder_exists(spark, f"{work}/counts"):
        _stage(spark, table, rows, target, work, f"{folder}/quarantine/{table}/batch={batch}", as_of, arrival, payload)
    fields = [f for f in TABLES[table].fields]
    added = spark.read.schema(T.StructType(fields)).parquet(f"{work}/added")
    # Nothing of it is there yet unless this batch was broken off after its append.
    missing = added.join(keyed.held_keys(added, target), KEY, "left_anti")
    keyed.append(missing, name, table, buckets)
    spark.catalog.refreshTable(name)
    counts = json.loads(spark.read.text(f"{work}/counts").first()[0])
    return Added(added, counts)


def _stage(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    target: DataFrame,
    work: str,
    quarantine: str,
    as_of: datetime | Column,
    arrival: Sequence[str],
    payload: str | None,
) -> None:
    judged = with_broken_rule(with_load_time(rows, table, as_of), table, arrival)
    # A payload that is missing is no broken rule: such a row is counted and left out.
    missed = F.coalesce(F.col(payload), F.lit("")) == "" if payload else F.lit(False)
    judged = judged.withColumn("missed", missed & F.col("broken_rule").isNull())
    staged = Observation()
    judged.observe(
        staged,
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("missed").alias("missed"),
        F.count_if(F.col("broken_rule").isNotNull()).alias("quarantined"),
    ).write.mode("overwrite").parquet(f"{work}/staged")
    rows = spark.read.schema(judged.schema).parquet(f"{work}/staged")
    if staged.get["quarantined"]:
        rows.filter("broken_rule IS NOT NULL").select("broken_rule", "brought").write.mode("overwrite").parquet(quarantine)
    good = rows.filter("broken_rule IS NULL AND NOT missed")
    keys, inserted = Observation(), Observation()
    fresh = first_per_key(good, arrival).observe(keys, F.count(F.lit(1)).alias("n"))
    new = fresh.join(keyed.held_keys(good, target), KEY, "left_anti").observe(inserted, F.count(F.lit(1)).alias("n"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[table].fields if f.name not in new.columns]
    new.select("*", *missing).select(*TABLES[table].fieldNames()).write.mode("overwrite").parquet(f"{work}/added")
    counts = {**staged.get, "already_present": keys.get["n"] - inserted.get["n"], "inserted": inserted.get["n"]}
    # Last, so that it marks a batch that is staged in full.
    spark.createDataFrame([(json.dumps(counts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{work}/counts")


def quarantined(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``(batch, broken_rule, brought)``: rows of all batches that broke a rule, with what they brought as JSON."""
    schema = "broken_rule string, brought string, batch string"
    path = f"{folder}/quarantine/{table}"
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema).select("batch", "broken_rule", "brought")
    return spark.read.schema(schema).parquet(path).select("batch", "broken_rule", "brought")
