"""The pipeline as lazy plans: landed tables in, curated tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators.postings import posting_metadata
from jobtide.operators.requirements import Term, build_requirements, extraction_backlog, job_descriptions
from jobtide.operators.roles import Role, map_titles, mapped_only
from jobtide.schemas import DEFAULT_TIME, TABLES


def mapped_postings(
    jobs_raw: DataFrame, descriptions: DataFrame, taxonomy: Sequence[Role] | DataFrame
) -> DataFrame:
    """Metadata of described postings with their canonical role, failures included."""
    return map_titles(posting_metadata(jobs_raw, descriptions), taxonomy, "job_title")


def curated_jobs(
    jobs_raw: DataFrame, descriptions: DataFrame, taxonomy: Sequence[Role] | DataFrame
) -> DataFrame:
    """Rows for the ``jobs`` table: described postings whose title maps to a role."""
    found = {"role_title": "matched_role", "role_match_method": "match_method"}
    columns = [c for c in TABLES["jobs"].fieldNames() if c != DEFAULT_TIME["jobs"]]
    rows = mapped_only(mapped_postings(jobs_raw, descriptions, taxonomy))
    return rows.select(*[F.col(found.get(c, c)).alias(c) for c in columns])


def job_requirements(
    jobs: DataFrame,
    descriptions: DataFrame,
    terms: DataFrame | Sequence[Term],
    done: DataFrame | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Rows for the ``job_requirements`` table; jobs already validated in ``done`` are left out.

    ``also``: columns of the job to carry along, such as the role, which spares a later join.
    """
    todo = jobs if done is None else extraction_backlog(jobs, done)
    return build_requirements(job_descriptions(todo, descriptions), terms, also)
