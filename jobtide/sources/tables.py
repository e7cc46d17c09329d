"""Reading, writing, naming and counting the base tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import CERTIFICATION, COUNTABLE_TABLES, TECHNICAL_CONCEPT, TECHNICAL_TOOL
from jobtide.operators.items import requirement_items
from jobtide.schemas import KEY, TABLES


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A base table from Parquet, with its declared schema (no inference)."""
    return spark.read.schema(TABLES[name]).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def save_bucketed(df: DataFrame, table: str, buckets: int, mode: str = "append") -> None:
    """Write a catalog table bucketed and sorted on the key.

    All base tables share the key, so tables written with the same number of
    buckets join, de-duplicate and anti-join on it without a shuffle.
    """
    df.write.mode(mode).format("parquet").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table)


def init_catalog(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None) -> list[str]:
    """Make every base table and the item view available to SQL by name.

    Names not given are created empty, names that already exist are kept, so
    calling it twice changes nothing.  The item view is replaced each time.
    """
    tables = dict(tables or {})
    for name, schema in TABLES.items():
        if name in tables:
            tables[name].createOrReplaceTempView(name)
        elif not spark.catalog.tableExists(name):
            spark.createDataFrame([], schema).createOrReplaceTempView(name)
    requirement_items(spark.table("job_requirements")).createOrReplaceTempView("job_requirement_items")
    return [*TABLES, "job_requirement_items"]


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``(table_name, n_rows)`` per relation; an unknown name is an error."""
    unknown = sorted(set(tables) - set(COUNTABLE_TABLES))
    if unknown:
        raise ValueError(f"Unsupported table name: {', '.join(unknown)}")
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def catalog_overview(spark: SparkSession) -> DataFrame:
    """``(schema_name, table_name, n_rows)`` of the known relations in the catalog."""
    present = {t.name for t in spark.catalog.listTables()}
    tables = {name: spark.table(name) for name in COUNTABLE_TABLES if name in present}
    schema_name = F.lit(spark.catalog.currentDatabase()).alias("schema_name")
    return table_counts(tables).select(schema_name, "table_name", "n_rows")


#: The item view in SQL, for users of the catalog: the same rows as ``requirement_items``.
ITEM_VIEW = """
SELECT source, source_job_id, item_type, item_value,
    lower(regexp_replace(item_value, r'(?U)^\\s+|(?<!\\s)\\s+$', '')) AS item_value_norm
FROM (
    SELECT source, source_job_id, inline(array(
        named_struct('item_type', '{tool}', 'items', technical_tools),
        named_struct('item_type', '{concept}', 'items', technical_concepts),
        named_struct('item_type', '{certification}', 'items', certifications)))
    FROM {requirements}
) LATERAL VIEW explode(items) AS item_value
"""


def create_item_view(spark: SparkSession, database: str) -> None:
    """A view of the items in a registered database; one that is there is replaced."""
    name = "`" + database.replace("`", "``") + "`"
    body = ITEM_VIEW.format(
        tool=TECHNICAL_TOOL, concept=TECHNICAL_CONCEPT, certification=CERTIFICATION, requirements=f"{name}.job_requirements"
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name}.job_requirement_items AS {body}")


def catalog_listing(spark: SparkSession, database: str) -> DataFrame:
    """``(table_name, kind, n_rows)`` of the known relations of a database; ``kind`` tells tables from views.

    Views of the session alone belong to no database and are not listed.
    """
    found = [t for t in spark.catalog.listTables(database) if not t.isTemporary and t.name in COUNTABLE_TABLES]
    kinds = {t.name: "view" if t.tableType == "VIEW" else "table" for t in found}
    counts = table_counts({name: spark.table(f"`{database}`.`{name}`") for name in kinds})
    kind = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))[F.col("table_name")]
    return counts.select("table_name", kind.alias("kind"), "n_rows")
