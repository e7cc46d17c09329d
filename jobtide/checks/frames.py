"""The check tables as Spark DataFrames, each built from the one before."""

from __future__ import annotations

import zlib
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.checks import fixtures as X
from jobtide.operators.items import requirement_items
from jobtide.operators.requirements import terms_frame
from jobtide.operators.roles import taxonomy_frame
from jobtide.operators.upsert import first_per_key, with_load_time
from jobtide.plans import pipeline
from jobtide.plans.rollups import rolled_up
from jobtide.plans.store import open_store, run_stored
from jobtide.schemas import KEY
from jobtide.session import folder_bytes, shared_folder
from jobtide.sources.landing import timestamp

#: Bytes of a table's file that one task takes: the tasks grow in number with the table, not in size.
TASK_BYTES = 1 << 20

#: The store of each application and input.
_STORES: dict[tuple[str, str], str] = {}


class Frames:
    """Lazy tables over one folder of given Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tag = f"jt{zlib.crc32(self.sf_dir.encode()):08x}"

    @property
    def cores(self) -> int:
        return min(self.spark.sparkContext.defaultParallelism, 64)

    def tasks(self, name: str) -> int:
        """Into how many tasks a given table is to be dealt: one per core, and more where its file is large."""
        return max(self.cores, -(-folder_bytes(self.spark, f"{self.sf_dir}/{name}.parquet") // TASK_BYTES))

    def is_small(self, name: str) -> bool:
        """Is the table read by fewer tasks than it is to be dealt into?"""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").rdd.getNumPartitions() < self.tasks(name)

    def given(self, name: str) -> DataFrame:
        """A given table.  One small file would keep one core busy and the rest idle, and a few large ones a few."""
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return table.repartition(self.tasks(name)) if self.is_small(name) else table

    def derived(self, sql: str, source: str, frame: DataFrame) -> DataFrame:
        view = f"{self._tag}_{source}"
        frame.createOrReplaceTempView(view)
        return self.spark.sql(sql.replace(f"FROM {source}", f"FROM {view}"))

    @cached_property
    def store_folder(self) -> str:
        """A store that took the postings in two batches, of half of the keys and of all, the second one twice.

        One store per application and input: it is written to the shared folder, and questions read it there.
        """
        place = (self.spark.sparkContext.applicationId, self.sf_dir)
        if place not in _STORES:
            folder = f"{shared_folder(self.spark)}/store-{uuid4().hex}"
            half = F.pmod(F.xxhash64("source_job_id"), F.lit(2)) == 0
            for batch, part in (("half", half), ("all", F.lit(True)), ("all", F.lit(True))):
                postings, descriptions = self.postings.filter(part), self.descriptions.filter(part)
                run_stored(self.spark, folder, postings, descriptions, X.ROLES, X.TERMS, X.AS_OF, batch=batch)
            _STORES[place] = folder
        return _STORES[place]

    @property
    def stored(self) -> dict[str, DataFrame]:
        """The tables of that store."""
        return open_store(self.spark, self.store_folder).tables()

    def rolled_up(self, name: str) -> DataFrame:
        return rolled_up(self.spark, self.store_folder, name)

    @cached_property
    def postings(self) -> DataFrame:
        return self.derived(X.POSTINGS, "orders", self.given("orders"))

    @cached_property
    def jobs_raw(self) -> DataFrame:
        return with_load_time(first_per_key(self.postings, ["seq"]), "jobs_raw", X.AS_OF).drop("seq")

    @cached_property
    def landed(self) -> DataFrame:
        """``jobs_raw`` as an earlier run left it."""
        earlier = self.postings.filter(F.col("created_at") < timestamp(X.LANDED_UNTIL))
        return with_load_time(first_per_key(earlier, ["seq"]), "jobs_raw", X.AS_OF).drop("seq")

    @cached_property
    def spread_postings(self) -> DataFrame:
        """Postings placed by key.  A stated number of partitions keeps a small set spread."""
        if self.is_small("orders"):
            return self.postings.repartition(self.tasks("orders"), *KEY)
        return self.postings

    @cached_property
    def descriptions(self) -> DataFrame:
        keys = self.derived(X.SCRAPED_KEYS, "postings", self.spread_postings)
        return self.derived(X.DESCRIPTIONS, "scraped_keys", keys)

    @cached_property
    def responses(self) -> DataFrame:
        keys = self.derived(X.POSTING_KEYS, "postings", self.spread_postings)
        return self.derived(X.RESPONSES, "posting_keys", keys)

    @cached_property
    def job_pages(self) -> DataFrame:
        return self.derived(X.JOB_PAGES, "pages", self.given("pages"))

    @cached_property
    def lines(self) -> DataFrame:
        return self.derived(X.LINES, "documents", self.given("documents"))

    @cached_property
    def taxonomy(self) -> DataFrame:
        return taxonomy_frame(self.spark, X.ROLES)

    @cached_property
    def terms(self) -> DataFrame:
        return terms_frame(self.spark, X.TERMS)

    @cached_property
    def mapped(self) -> DataFrame:
        return pipeline.mapped_postings(self.jobs_raw, self.descriptions, X.ROLES)

    @cached_property
    def jobs(self) -> DataFrame:
        return pipeline.curated_jobs(self.jobs_raw, self.descriptions, X.ROLES)

    @cached_property
    def requirements(self) -> DataFrame:
        return pipeline.job_requirements(self.jobs, self.descriptions, X.TERMS)

    @cached_property
    def items(self) -> DataFrame:
        return requirement_items(self.requirements)

    @cached_property
    def role_requirements(self) -> DataFrame:
        """The same requirements, each with the role of its job."""
        return pipeline.job_requirements(self.jobs, self.descriptions, X.TERMS, also=["role_title"])

    @cached_property
    def role_items(self) -> DataFrame:
        """The same items, each with the role of its job."""
        return requirement_items(self.role_requirements)

    @cached_property
    def titles(self) -> DataFrame:
        """Every landed title, null where the payload names none."""
        return self.postings.select(*KEY, "seq", F.get_json_object("raw_json", "$.title").alias("title"))
