"""The pipeline with its results stored: land, curate, extract, each into its table.

A store is a folder of base tables, bucketed alike on their key (``sources/keyed.py``), with
rollups of what each batch has added.  Every step reads what the step before has stored, so
nothing is computed twice, and a batch that is repeated adds nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession

from jobtide.operators.requirements import Term
from jobtide.operators.roles import Role
from jobtide.plans import rollups
from jobtide.plans.ingest import Added, ingest
from jobtide.plans.pipeline import curated_jobs, job_requirements
from jobtide.schemas import KEY, TABLES
from jobtide.session import drop_folder, folder_exists
from jobtide.sources import keyed
from jobtide.sources.tables import create_item_view

#: Buckets of a new store; one that is there keeps its own.
BUCKETS = 16


@dataclass(frozen=True)
class Store:
    """The base tables under ``folder``, known to the catalog as ``database``."""

    spark: SparkSession
    folder: str
    database: str
    buckets: int

    def table(self, name: str) -> DataFrame:
        return self.spark.table(keyed.table_name(self.database, name))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def add(
        self,
        table: str,
        rows: DataFrame,
        batch: str,
        as_of: datetime | Column,
        arrival: Sequence[str],
        payload: str | None = None,
    ) -> Added:
        return ingest(
            self.spark, self.folder, self.database, table, rows, batch, as_of, arrival, self.buckets, payload
        )

    def forget(self, batch: str) -> None:
        """Drop what a finished batch has staged; it can be repeated no more."""
        drop_folder(self.spark, f"{self.folder}/batches/{batch}")


def open_store(spark: SparkSession, folder: str, database: str | None = None, buckets: int = BUCKETS) -> Store:
    """The store at ``folder``; tables that are not there yet are created empty.

    The number of buckets is written beside the tables, so every session reads them alike.
    """
    layout = f"{folder}/layout"
    if not folder_exists(spark, layout):
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("ignore").parquet(layout)
    buckets = spark.read.schema("buckets int").parquet(layout).first()[0]
    database = database or "store_" + hashlib.sha256(folder.encode()).hexdigest()[:12]
    for name in TABLES:
        keyed.register(spark, database, name, f"{folder}/{name}", buckets)
    return Store(spark, folder, database, buckets)


def register_store(spark: SparkSession, folder: str, database: str) -> None:
    """Make the stored tables, and the view of their items, known to the catalog, where they outlive the session."""
    open_store(spark, folder, database)
    create_item_view(spark, database)


def run_stored(
    spark: SparkSession,
    folder: str,
    postings: DataFrame,
    descriptions: DataFrame,
    taxonomy: Sequence[Role] | DataFrame,
    terms: Sequence[Term] | DataFrame,
    as_of: datetime | Column,
    arrival: Sequence[str] = ("seq",),
    batch: str | None = None,
) -> dict[str, DataFrame]:
    """Store a batch of postings and descriptions and all that follows from it; the tables as they are then.

    ``batch`` names it: under a name given before, the batch is repeated and adds nothing.
    """
    store, batch = open_store(spark, folder), batch or uuid4().hex
    added = {
        "jobs_raw": store.add("jobs_raw", postings, batch, as_of, arrival).rows,
        "descriptions_raw": store.add("descriptions_raw", descriptions, batch, as_of, ["redirect_url"]).rows,
    }
    now = store.tables()
    todo = now["jobs_raw"].join(now["jobs"].select(*KEY), KEY, "left_anti")  # in place: the buckets are the same
    jobs = curated_jobs(todo.select(*now["jobs_raw"].columns), now["descriptions_raw"], taxonomy)
    added["jobs"] = store.add("jobs", jobs, batch, as_of, ["posted_at"]).rows
    now = store.tables()
    requirements = job_requirements(now["jobs"], now["descriptions_raw"], terms, done=now["job_requirements"])
    added["job_requirements"] = store.add("job_requirements", requirements, batch, as_of, ["error"]).rows
    added["items"] = rollups.added_items(added["job_requirements"], roles_of(store, added))
    rollups.roll_up(folder, batch, added)
    return store.tables()


def roles_of(store: Store, added: dict[str, DataFrame]) -> DataFrame:
    """Key and role of the jobs that the added requirements belong to.

    These are jobs of the same batch; only where some are of earlier ones (a batch that was
    broken off between the two tables) are their keys looked up in the store.
    """
    jobs = added["jobs"].select(*KEY, "role_title")
    older = added["job_requirements"].select(*KEY).join(jobs, KEY, "left_anti")
    if older.isEmpty():
        return jobs
    held = store.table("jobs").select(*KEY, "role_title")
    ids = keyed.pushed_ids(older)
    held = held if ids is None else held.filter(held[keyed.ID].isin(ids))
    return jobs.unionByName(held.join(older, KEY, "left_semi"))
