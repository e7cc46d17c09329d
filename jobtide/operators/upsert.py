"""Insert-if-absent on the key, table by table, with its audits.

Builders return the rows to append and write nothing.  ``append_new_rows`` and the
stream write, and both go through the builder of their table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.text import valid_json
from jobtide.schemas import DEFAULT_TIME, KEY, TABLES, required_columns
from jobtide.session import computed_once
from jobtide.sources.keyed import held_keys
from jobtide.sources.landing import timestamp

# A batch of at most this many keys is sent to every executor rather than
# shuffling the keys of the target.
BROADCAST_KEYS = 500_000


def first_per_key(batch: DataFrame, arrival: Sequence[str], keys: Sequence[str] = KEY) -> DataFrame:
    """Keep the row of every key that arrived first.

    Spark cuts ``row_number() = 1`` to one row per key and task before the
    shuffle, so a key that fills a third of the batch stays cheap.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in arrival])
    return batch.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def insert_if_absent(
    batch: DataFrame,
    target: DataFrame,
    arrival: Sequence[str],
    keys: Sequence[str] = KEY,
    few_keys: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is new: first of its key, and not in ``target``.

    With ``few_keys`` the batch keys are broadcast to find those the target
    holds, and only these hits are shuffled; otherwise both sides meet on the
    key, which needs no shuffle of the target where that is bucketed on it.
    """
    fresh = first_per_key(batch, arrival, keys)
    present = target.select(*keys)
    if few_keys:
        present = present.join(F.broadcast(batch.select(*keys).distinct()), list(keys), "left_semi")
    return fresh.join(present, list(keys), "left_anti")


def has_few_keys(batch: DataFrame, keys: Sequence[str] = KEY, limit: int = BROADCAST_KEYS) -> bool:
    """Does the batch hold at most ``limit`` distinct keys?  Counts, collects nothing."""
    return batch.select(*keys).distinct().count() <= limit


def with_load_time(rows: DataFrame, table: str, as_of: datetime | Column) -> DataFrame:
    """Fill the load-time column of ``table`` where a row brings none."""
    name = DEFAULT_TIME[table]
    now = timestamp(as_of)
    value = F.coalesce(F.col(name).cast("timestamp_ntz"), now) if name in rows.columns else now
    return rows.withColumn(name, value)


def _conform(rows: DataFrame, table: str, extra: Sequence[str]) -> DataFrame:
    """Columns of ``table`` in its types; a null in a required column is an error."""

    def typed_column(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{table}.{field.name} must not be null")))
        return value.alias(field.name)

    fields = [f for f in TABLES[table].fields if f.name in rows.columns]
    typed = [typed_column(f) for f in fields]
    return rows.select(*typed, *[c for c in extra if c not in TABLES[table].fieldNames()])


def _upsert(batch, target, table, as_of, arrival, few_keys):
    rows = _conform(with_load_time(batch, table, as_of), table, arrival)
    new = insert_if_absent(rows, target, arrival, few_keys=few_keys)
    return new.select(*[f.name for f in TABLES[table].fields if f.name in new.columns])


def upsert_postings(
    batch: DataFrame, target: DataFrame, as_of: datetime | Column, arrival: Sequence[str] = ("seq",), few_keys: bool = False
) -> DataFrame:
    """New rows for ``jobs_raw``.  A payload that is not JSON is an error."""
    bad = F.raise_error(F.concat(F.lit("raw_json is not JSON: "), F.col("raw_json")))
    checked = batch.withColumn("raw_json", F.when(valid_json(F.col("raw_json")), F.col("raw_json")).otherwise(bad))
    return _upsert(checked, target, "jobs_raw", as_of, list(arrival), few_keys)


def upsert_descriptions(
    batch: DataFrame, target: DataFrame, as_of: datetime | Column, arrival: Sequence[str] = ("seq",), few_keys: bool = False
) -> DataFrame:
    """New rows for ``descriptions_raw``; rows without a job id are left out."""
    named = batch.filter(F.col("source_job_id").isNotNull())
    return _upsert(named, target, "descriptions_raw", as_of, list(arrival), few_keys)


def upsert_jobs(
    batch: DataFrame, target: DataFrame, as_of: datetime | Column, arrival: Sequence[str], few_keys: bool = False
) -> DataFrame:
    """New rows for ``jobs``; the match method is kept with the row."""
    return _upsert(batch, target, "jobs", as_of, list(arrival), few_keys)


def upsert_requirements(
    batch: DataFrame, target: DataFrame, as_of: datetime | Column, arrival: Sequence[str], few_keys: bool = False
) -> DataFrame:
    """New rows for ``job_requirements``; seniority and status are kept with the row."""
    return _upsert(batch, target, "job_requirements", as_of, list(arrival), few_keys)


UPSERTS = {
    "jobs_raw": upsert_postings,
    "descriptions_raw": upsert_descriptions,
    "jobs": upsert_jobs,
    "job_requirements": upsert_requirements,
}


def new_rows(
    batch: DataFrame, target: DataFrame, table: str, as_of: datetime | Column, arrival: Sequence[str]
) -> DataFrame:
    """What a batch adds to a base table: checked, in the table's types, first of its key.

    The batch is computed once, to the checkpoint folder; of the target, the files are read
    that may hold keys of a small batch.
    """
    batch = computed_once(batch)
    return UPSERTS[table](batch, held_keys(batch, target), as_of, arrival)


def append_new_rows(
    batch: DataFrame, target: DataFrame, path: str, table: str, as_of: datetime | Column, arrival: Sequence[str]
) -> None:
    """Append the new rows of ``batch`` to the Parquet table at ``path``."""
    new_rows(batch, target, table, as_of, arrival).write.mode("append").parquet(path)


def constraint_violations(rows: DataFrame, table: str) -> DataFrame:
    """``(table_name, rule, n_rows)``: nulls per required column, surplus rows per key.

    One pass counts the nulls of each key's rows along with the rows, so hot keys
    are pre-aggregated and the table is shuffled once, as counts.
    """
    required = [c for c in required_columns(table) if c in rows.columns]
    per_key = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in required],
    )
    is_keyed = F.col("source").isNotNull() & F.col("source_job_id").isNotNull()
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(is_keyed, F.col("_rows") - 1)), F.lit(0)).alias("unique"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(c) for c in required],
    )
    rules = [F.struct(F.lit("unique key").alias("rule"), F.col("unique").alias("n_rows"))] + [
        F.struct(F.lit(f"{c} not null").alias("rule"), F.col(c).alias("n_rows")) for c in required
    ]
    return totals.select(F.lit(table).alias("table_name"), F.inline(F.array(*rules)))


def ingest_metrics(batch: DataFrame, target: DataFrame, payload: str) -> DataFrame:
    """``(candidates, missed, already_present, inserted)`` of one batch.

    Missed rows carry no ``payload``.  Rows are counted per key first, so the
    join with the target meets every key once.
    """
    per_key = batch.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.coalesce(F.col(payload), F.lit("")) == "").alias("_missed"),
    )
    known = target.select(*KEY).distinct().withColumn("_known", F.lit(True))
    joined = per_key.join(known, KEY, "left")
    loaded = F.col("_rows") > F.col("_missed")
    return joined.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("candidates"),
        F.coalesce(F.sum("_missed"), F.lit(0)).alias("missed"),
        F.count_if(loaded & F.col("_known")).alias("already_present"),
        F.count_if(loaded & F.col("_known").isNull()).alias("inserted"),
    )
