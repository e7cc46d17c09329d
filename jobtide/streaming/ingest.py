"""Incremental landing: a file stream that appends only new keys.

Uniqueness holds for ever, so it lives in the target table.  There is no
watermark and no stream state to grow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.operators.upsert import new_rows
from jobtide.schemas import KEY, TABLES
from jobtide.session import drop_folder, folder_bytes, folder_exists, folder_names, move_folder
from jobtide.sources.keyed import BLOOM

BATCH = "batch_id"
#: Folders of finished batches that lie side by side before some are put together.
MOST_FOLDERS = 16
#: Where a merge is prepared, and what says that it is complete; hidden from readers.
MERGED, READY = "_merged", "_merge_ready"


def read_target(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` as written so far, with the id of the batch of each row.

    Folders that are being put together are read once, from the old ones or from the new one.
    """
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    old = _merging(spark, path)
    if not old:
        return spark.read.schema(whole).parquet(path)
    folders = [f"{path}/{BATCH}={b}" for b in _batches(spark, path) if b not in old]
    moved = not folder_exists(spark, f"{path}/{MERGED}/{BATCH}={max(old)}")
    rows = spark.read.schema(schema).parquet(f"{path}/{BATCH}={max(old)}" if moved else f"{path}/{MERGED}/{BATCH}={max(old)}")
    rows = rows.withColumn(BATCH, F.lit(max(old)).cast("long"))
    if folders:
        rows = rows.unionByName(spark.read.option("basePath", path).schema(whole).parquet(*folders))
    return rows


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = (n.partition("=") for n in folder_names(spark, path))
    return sorted(int(b) for name, _, b in names if name == BATCH)


def _merging(spark: SparkSession, path: str) -> list[int]:
    """Ids of the folders that a complete, but not yet finished, merge replaces."""
    if not folder_exists(spark, f"{path}/{READY}/_SUCCESS"):
        return []
    return [int(r[0]) for r in spark.read.text(f"{path}/{READY}").collect()]


def _finish_merge(spark: SparkSession, path: str) -> None:
    """Put a complete merge in the place of its folders; broken off anywhere, it can be called again."""
    old = _merging(spark, path)
    if old:
        merged = f"{path}/{MERGED}/{BATCH}={max(old)}"
        if folder_exists(spark, merged):
            for b in old:
                drop_folder(spark, f"{path}/{BATCH}={b}")
            move_folder(spark, merged, f"{path}/{BATCH}={max(old)}")
    drop_folder(spark, f"{path}/{READY}")
    drop_folder(spark, f"{path}/{MERGED}")


def compact(spark: SparkSession, path: str, schema: T.StructType, before: int, most: int = MOST_FOLDERS) -> None:
    """Put folders of batches below ``before`` together, where there are more than ``most``.

    The latest ones are merged, and of the older ones those that are not much larger, so that a
    row is written anew a logarithmic number of times.  Batches below the one at hand are never
    replayed, so their folders are final.
    """
    _finish_merge(spark, path)
    batches = [b for b in _batches(spark, path) if b < before]
    if len(batches) <= most:
        return
    sizes = [folder_bytes(spark, f"{path}/{BATCH}={b}") for b in batches]
    first = len(batches) - most
    while first and sizes[first - 1] <= 2 * sum(sizes[first:]):
        first -= 1
    old = batches[first:]
    rows = spark.read.schema(schema).parquet(*[f"{path}/{BATCH}={b}" for b in old])
    placed = rows.repartition(*KEY).sortWithinPartitions(*KEY)
    placed.write.options(**BLOOM).mode("overwrite").parquet(f"{path}/{MERGED}/{BATCH}={old[-1]}")
    marks = spark.createDataFrame([(str(b),) for b in old], "value string")
    marks.coalesce(1).write.mode("overwrite").text(f"{path}/{READY}")
    _finish_merge(spark, path)


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    table: str,
    as_of: datetime | Column,
    arrival: Sequence[str],
    most: int = MOST_FOLDERS,
) -> None:
    """One micro-batch into the table at ``path``, as ``ingest_stream`` calls it."""
    spark, schema = batch.sparkSession, TABLES[table]
    compact(spark, path, schema, batch_id, most)
    try:
        target = read_target(spark, path, schema).filter(F.col(BATCH) != batch_id)
    except AnalysisException as error:  # the very first batch finds no folder
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = spark.createDataFrame([], schema)
    new = new_rows(batch, target, table, as_of, arrival)
    # Sorted, and with Bloom filters of the ids: a later batch finds its keys without reading all.
    placed = new.repartition(*KEY).sortWithinPartitions(*KEY)
    placed.write.options(**BLOOM).mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def ingest_stream(
    rows: DataFrame,
    path: str,
    table: str,
    as_of: datetime | Column,
    arrival: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
):
    """Start draining the stream ``rows`` into the base table ``table`` at ``path``.

    Each micro-batch owns the folder ``batch_id=<n>`` and overwrites it.  A batch
    that is replayed after a lost executor or driver compares itself only with
    the other batches, so it writes the same rows again and nothing twice.  Rows
    pass the checks of the table; one that fails stops the stream.  Folders of
    earlier batches are put together as they grow many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(prepare(batch), batch_id, path, table, as_of, arrival)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{path}_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
