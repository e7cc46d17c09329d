"""Base tables bucketed and sorted on the key, with Bloom filters of the job ids.

Tables of one store have the same buckets, so they join, anti-join and de-duplicate on the
key without a shuffle.  A small batch finds the keys that a table holds by pushing its own
down to the files: row groups whose Bloom filter has none of them are not read, so what is
read follows the batch and not the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import KEY, TABLES

#: A batch of at most this many ids pushes them down; a larger one meets the table bucket by bucket.
MOST_PUSHED = 5_000
#: Of both key columns, the one that tells rows apart.
ID = KEY[1]
BLOOM = {f"parquet.bloom.filter.enabled#{ID}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_name(database: str, name: str) -> str:
    return f"{_quoted(database)}.{_quoted(name)}"


def register(
    spark: SparkSession, database: str, name: str, path: str, buckets: int, options: Mapping[str, str] | None = None
) -> None:
    """Make the table at ``path`` known; one that is known already stays as it is.  ``options``: of its Parquet writer."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in TABLES[name].fields)
    key = ", ".join(map(_quoted, KEY))
    shown = {**BLOOM, **(options or {})}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in shown.items())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(database, name)} ({columns}) USING parquet OPTIONS ({listed}) "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def append(rows: DataFrame, table: str, name: str, buckets: int) -> None:
    """Add rows to a registered table: one file per bucket."""
    placed = rows.select(*TABLES[name].fieldNames()).repartition(buckets, *KEY)
    placed.write.insertInto(table)


def pushed_ids(batch: DataFrame, most: int = MOST_PUSHED) -> list[str] | None:
    """The distinct job ids of a batch, or None if there are more than ``most``."""
    ids = [r[0] for r in batch.select(ID).filter(F.col(ID).isNotNull()).distinct().limit(most + 1).collect()]
    return ids if len(ids) <= most else None


def held_keys(batch: DataFrame, table: DataFrame, most: int = MOST_PUSHED) -> DataFrame:
    """Keys of ``table``: all that ``batch`` may share with it, and no more than it needs to read for that.

    ``batch`` should be stored: it is read once more.
    """
    ids = pushed_ids(batch, most)
    keys = table.select(*KEY)
    return keys if ids is None else keys.filter(F.col(ID).isin(ids))
