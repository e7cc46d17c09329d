"""Answers kept up to date by batch: what a batch adds is counted alone, and counts are merged when they are read.

A rollup is a table of partial aggregates, one folder per batch, overwritten if the batch is
repeated.  Its measures can be merged (sums, least values), so the merged rollup equals the
question asked of the whole tables, and no row of an earlier batch is read for it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators.analytics import MONTH_LABEL
from jobtide.operators.items import requirement_items
from jobtide.schemas import KEY

MERGES: Mapping[str, Callable[[str], Column]] = {"sum": F.sum, "min": F.min}


@dataclass(frozen=True)
class Rollup:
    """``source``: the table whose added rows are counted; ``group``: names and expressions; ``measures``: name, expression, merge."""

    source: str
    group: Mapping[str, str]
    measures: Mapping[str, tuple[str, str]]

    def partial(self, rows: DataFrame) -> DataFrame:
        keyed = rows.select("*", *[F.expr(e).alias(f"_{n}") for n, e in self.group.items()])
        found = keyed.groupBy(*[f"_{n}" for n in self.group]).agg(*[F.expr(e).alias(n) for n, (e, _) in self.measures.items()])
        return found.withColumnsRenamed({f"_{n}": n for n in self.group})

    def merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.group).agg(*[MERGES[merge](n).alias(n) for n, (_, merge) in self.measures.items()])


_COUNT = ("count(1)", "sum")
ROLLUPS = {
    "postings_by_month": Rollup(
        "jobs_raw",
        {"month_year": f"date_format(created_at, '{MONTH_LABEL}')"},
        {"n_postings": _COUNT, "first_created": ("min(created_at)", "min"), "first_fetch": ("min(fetched_at)", "min")},
    ),
    "role_distribution": Rollup("jobs", {"role_title": "role_title"}, {"n": _COUNT}),
    "match_method_distribution": Rollup("jobs", {"role_match_method": "role_match_method"}, {"n": _COUNT}),
    "mapped_by_month": Rollup("jobs", {"month": "date_format(posted_at, 'yyyy-MM')"}, {"n": _COUNT}),
    "extraction_status_counts": Rollup("job_requirements", {"extraction_status": "extraction_status"}, {"n": _COUNT}),
    "seniority_distribution": Rollup("job_requirements", {"seniority": "seniority"}, {"n": _COUNT}),
    # A job has one requirements row, so its items are all in one batch, and distinct jobs add up.
    "items_by_role": Rollup(
        "items",
        {"role_title": "role_title", "item_type": "item_type", "item": "item_value_norm"},
        {"n_items": _COUNT, "n_jobs": (f"count(DISTINCT {', '.join(KEY)})", "sum")},
    ),
    "tools_required": Rollup(
        "items", {"role_title": "role_title", "item": "item_value_norm"}, {"n_jobs": (f"count(DISTINCT {', '.join(KEY)})", "sum")}
    ),
}


def added_items(requirements: DataFrame, jobs: DataFrame) -> DataFrame:
    """Items of requirement rows, with the role of their job."""
    return requirement_items(requirements).join(jobs.select(*KEY, "role_title"), KEY)


def roll_up(folder: str, batch: str, added: Mapping[str, DataFrame]) -> None:
    """Count what a batch has added; ``added``: the rows by table, items included."""
    for name, rollup in ROLLUPS.items():
        if rollup.source in added:
            # A few rows per batch: one file.
            partial = rollup.partial(added[rollup.source]).coalesce(1)
            partial.write.mode("overwrite").parquet(f"{folder}/rollups/{name}/batch={batch}")


def rolled_up(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rollup as of now, over all batches."""
    return ROLLUPS[name].merged(spark.read.parquet(f"{folder}/rollups/{name}"))
