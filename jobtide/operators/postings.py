"""Landed postings: search tasks, fetch predicates, payload projection, audits."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.fixed_values import EXCLUDED_TERMS, MAX_DAYS_OLD, MAX_PAGES, RESULTS_PER_PAGE
from jobtide.functions.text import WORD, WORD_WITH_HYPHENS, with_computed
from jobtide.schemas import KEY, POSTING_PAYLOAD
from jobtide.sources.landing import timestamp

SALTS = 64


def search_tasks(taxonomy: DataFrame) -> DataFrame:
    """One row ``(position, role_title, search_term)`` per role and search term."""
    return taxonomy.select(
        "position", F.col("name").alias("role_title"), F.explode("search_term").alias("search_term")
    )


def landed_per_task(taxonomy: DataFrame, postings: DataFrame) -> DataFrame:
    """Search tasks with the number of postings landed for each, zero included."""
    landed = postings.groupBy("search_term").agg(F.count(F.lit(1)).alias("n_landed"))
    return search_tasks(taxonomy).join(landed, "search_term", "left").fillna(0, ["n_landed"])


def without_excluded_terms(postings: DataFrame, title: Column, terms: Iterable[str] = EXCLUDED_TERMS) -> DataFrame:
    """Postings whose title holds none of the excluded words, alone or as a part of a hyphenated one."""
    lowered = F.lower(F.coalesce(title, F.lit("")))
    words = F.concat(*(F.regexp_extract_all(lowered, F.lit(p), F.lit(0)) for p in (WORD_WITH_HYPHENS, WORD)))
    return postings.filter(~F.arrays_overlap(words, F.array(*[F.lit(t) for t in terms])))


def recent_postings(postings: DataFrame, as_of: datetime | Column, max_days_old: int = MAX_DAYS_OLD) -> DataFrame:
    """Postings created at most ``max_days_old`` days before ``as_of``."""
    return postings.filter(F.col("created_at") >= timestamp(as_of) - F.make_dt_interval(F.lit(max_days_old)))


def cap_per_term(
    postings: DataFrame, per_term: int = RESULTS_PER_PAGE * MAX_PAGES, arrival: str = "seq"
) -> DataFrame:
    """The newest ``per_term`` postings of every search term.

    A term may hold most of the postings, so each of its salted shares is ranked
    first; only the leaders of the shares meet in the final ranking.
    """
    newest = [F.col("created_at").desc_nulls_last(), *[F.col(k) for k in KEY], F.col(arrival)]
    salted = postings.withColumn("_salt", F.pmod(F.xxhash64(*KEY, arrival), F.lit(SALTS)))
    for partition in (["search_term", "_salt"], ["search_term"]):
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*newest))
        salted = salted.withColumn("_rank", rank).filter(F.col("_rank") <= per_term).drop("_rank")
    return salted.drop("_salt")


def posting_fields(jobs_raw: DataFrame) -> DataFrame:
    """Fields of the payload as columns; the payload is parsed once per row.

    A salary that is present but no number is an error, as in a strict cast.
    """
    parsed = with_computed(jobs_raw, payload=F.from_json("raw_json", POSTING_PAYLOAD))
    return parsed.select(
        *KEY,
        F.col("payload.title").alias("job_title"),
        F.col("payload.company.display_name").alias("company"),
        F.col("payload.location.display_name").alias("location"),
        F.col("payload.salary_min").cast("double").alias("min_salary"),
        F.col("payload.salary_max").cast("double").alias("max_salary"),
        F.col("created_at").alias("posted_at"),
        "redirect_url",
    )


def posting_metadata(jobs_raw: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Metadata of postings that have a description and name a company."""
    fields = posting_fields(jobs_raw).filter(F.col("company").isNotNull())
    return fields.join(descriptions.select(*KEY), KEY)


def missing_descriptions(jobs_raw: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Postings with a url whose description was never stored."""
    wanted = jobs_raw.filter(F.col("redirect_url").isNotNull()).select("source_job_id", "source", "redirect_url")
    return wanted.join(descriptions.select(*KEY), KEY, "left_anti").distinct()


def cross_source_id_collisions(jobs_raw: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Job ids used by several sources, and what joining on the id alone would do.

    ``rows_by_id`` is the size of the id-only join and ``rows_by_key`` that of the
    join on both keys; both come from counts, the join itself is never built.
    """
    left = jobs_raw.groupBy("source_job_id", "source").agg(F.count(F.lit(1)).alias("_postings"))
    right = descriptions.groupBy("source_job_id", "source").agg(F.count(F.lit(1)).alias("_descriptions"))
    both = left.join(right, ["source_job_id", "source"], "full").fillna(0, ["_postings", "_descriptions"])
    return (
        both.groupBy("source_job_id")
        .agg(
            F.count_if(F.col("_postings") > 0).alias("n_sources"),
            (F.sum("_postings") * F.sum("_descriptions")).alias("rows_by_id"),
            F.sum(F.col("_postings") * F.col("_descriptions")).alias("rows_by_key"),
        )
        .filter(F.col("n_sources") > 1)
    )
