"""What several operators share: tables, checkpoints, white space, Arrow helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import shared_folder

#: The characters ``[\x20\x09-\x0D]``, for Python and for Java patterns.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    with tempfile.NamedTemporaryFile(prefix=f"{package.name}-", suffix=".zip", delete=False) as file:
        with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
            for path in sorted(package.rglob("*.py")):
                archive.write(path, os.path.relpath(path, package.parent))
    context.addPyFile(file.name)


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls, and nothing else unless named."""
    # A cast of a long would leave an alias, for which Spark shuffles both sides of a self-join.
    doc_id = F.col("doc_id")
    return docs.select(
        doc_id if dict(docs.dtypes)["doc_id"] == "bigint" else doc_id.cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return texts_of(docs).agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def working_folder(spark: SparkSession) -> str:
    """The shared folder, also set as Spark's checkpoint folder where it is not yet."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def kept(frame: DataFrame) -> DataFrame:
    """The frame, computed once and stored in the shared folder, which outlives executors."""
    working_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to a table of its own in the shared folder."""
    path = f"{working_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def lower_ascii(column):
    """A-Z in lower case; other letters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(column) == F.length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, upper, upper.lower()))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def record_batch(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
