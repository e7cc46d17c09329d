"""Labour-market questions on the curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.fixed_values import CERTIFICATION, TECHNICAL_CONCEPT, TECHNICAL_TOOL
from jobtide.schemas import KEY
from jobtide.session import computed_once

MONTH_LABEL = "MMM-yy"


def with_role(items: DataFrame, jobs: DataFrame) -> DataFrame:
    """Items, or requirements, with the role of their job; such as carry it already are not joined."""
    if "role_title" in items.columns:
        return items
    return items.join(jobs.select(*KEY, "role_title"), KEY)


def items_by_role(items: DataFrame, jobs: DataFrame, item_type: str, name: str) -> DataFrame:
    """``(role_title, <name>, n_jobs)``: how often items of a type occur per role."""
    wanted = with_role(items.filter(F.col("item_type") == item_type), jobs)
    return wanted.groupBy("role_title", F.col("item_value_norm").alias(name)).agg(F.count(F.lit(1)).alias("n_jobs"))


def top_tools_by_role(items: DataFrame, jobs: DataFrame) -> DataFrame:
    counts = items_by_role(items, jobs, TECHNICAL_TOOL, "tool")
    return counts.orderBy("role_title", F.col("n_jobs").desc())


def top_concepts_by_role(items: DataFrame, jobs: DataFrame) -> DataFrame:
    counts = items_by_role(items, jobs, TECHNICAL_CONCEPT, "concept")
    return counts.orderBy("role_title", F.col("n_jobs").desc())


def topk_tools_by_role(items: DataFrame, jobs: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent tools of each role, ties by name."""
    best = Window.partitionBy("role_title").orderBy(F.col("n_jobs").desc(), F.col("tool"))
    counts = items_by_role(items, jobs, TECHNICAL_TOOL, "tool")
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def jobs_requiring_tool(items: DataFrame, jobs: DataFrame, tool: str) -> DataFrame:
    """``(role_title, n_jobs)``: jobs per role that ask for ``tool``, most first."""
    wanted = with_role(items.filter(F.col("item_value_norm") == tool), jobs)
    job_key = F.concat(F.col("source"), F.lit(":"), F.col("source_job_id"))
    return (
        wanted.groupBy("role_title")
        .agg(F.countDistinct(job_key).alias("n_jobs"))
        .orderBy(F.col("n_jobs").desc())
    )


def certification_demand(items: DataFrame, jobs: DataFrame) -> DataFrame:
    """``(role_title, certification, n_jobs, share)``; share of all jobs of the role."""
    demand = items_by_role(items, jobs, CERTIFICATION, "certification")
    totals = jobs.groupBy("role_title").agg(F.count(F.lit(1)).alias("_jobs"))
    return (
        demand.join(totals, "role_title")
        .withColumn("share", F.round(F.col("n_jobs") / F.col("_jobs"), 6))
        .drop("_jobs")
        .orderBy("role_title", F.col("n_jobs").desc())
    )


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values, most frequent first; null is a value too."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc())


def role_seniority(requirements: DataFrame, jobs: DataFrame) -> DataFrame:
    levels = with_role(requirements, jobs)
    return levels.groupBy("role_title", "seniority").agg(F.count(F.lit(1)).alias("n"))


def experience_by_role(requirements: DataFrame, jobs: DataFrame) -> DataFrame:
    """Years asked for per role; jobs that state none count only in ``n_jobs``."""
    years = with_role(requirements, jobs)
    return years.groupBy("role_title").agg(
        F.count(F.lit(1)).alias("n_jobs"),
        F.count("min_years").alias("n_stated"),
        F.min("min_years").alias("least_years"),
        F.max("max_years").alias("most_years"),
        F.round(F.avg("min_years"), 4).alias("mean_min_years"),
    )


def salary_by_role(jobs: DataFrame) -> DataFrame:
    """Salary range per role over the jobs that state one."""
    return jobs.groupBy("role_title").agg(
        F.count("min_salary").alias("n_stated"),
        F.min("min_salary").alias("lowest"),
        F.max("max_salary").alias("highest"),
        F.round(F.avg("min_salary"), 2).alias("mean_min_salary"),
        F.round(F.avg("max_salary"), 2).alias("mean_max_salary"),
    )


def postings_by_month(jobs_raw: DataFrame) -> DataFrame:
    """``(month_year, n_postings, first_created)`` in order of time."""
    return (
        jobs_raw.groupBy(F.date_format("created_at", MONTH_LABEL).alias("month_year"))
        .agg(F.count(F.lit(1)).alias("n_postings"), F.min("created_at").alias("first_created"))
        .orderBy("first_created")
    )


def first_fetch(jobs_raw: DataFrame) -> DataFrame:
    return jobs_raw.agg(F.min("fetched_at").alias("first_fetch"))


def postings_by_month_flagged(jobs_raw: DataFrame) -> DataFrame:
    """``postings_by_month`` with a mark on the month of the first fetch.

    The first fetch is taken from the monthly groups, so the table is read once.
    """
    months = jobs_raw.groupBy(F.date_format("created_at", MONTH_LABEL).alias("month_year")).agg(
        F.count(F.lit(1)).alias("n_postings"),
        F.min("created_at").alias("first_created"),
        F.min("fetched_at").alias("_fetched"),
    )
    first = months.agg(F.date_format(F.min("_fetched"), MONTH_LABEL)).scalar()
    flag = F.coalesce(F.col("month_year") == first, F.lit(False))
    return months.withColumn("has_first_fetch", flag).drop("_fetched").orderBy("first_created")


def mapped_by_month(jobs: DataFrame) -> DataFrame:
    """``(month, n)``: curated jobs per calendar month, in order of time."""
    month = F.date_format("posted_at", "yyyy-MM").alias("month")
    return jobs.groupBy(month).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


def unmapped_rate(mapped: DataFrame, no_match: str) -> DataFrame:
    """``(n_unmapped, n_titles, unmapped_pct)`` over all titles."""
    failed = F.count_if(F.col("match_method") == no_match)
    return mapped.agg(
        failed.alias("n_unmapped"),
        F.count(F.lit(1)).alias("n_titles"),
        F.round(100.0 * failed / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias("unmapped_pct"),
    )


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """``(bin, lower, upper, n)``: equal-width bins over the range, last edge closed.

    The values are computed once, as one narrow column, from which range and bins are read:
    what is shuffled are a row per task for the range and one per task and bin.  Empty bins
    are listed; if all values are equal they fall into bin 0.
    """
    values = computed_once(df.select(value.cast("double").alias("_v")).filter("_v is not null"))
    ends = values.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()

    def with_edges(frame: DataFrame) -> DataFrame:
        width = (F.col("_ends.high") - F.col("_ends.low")) / F.lit(float(bins))
        return frame.withColumn("_ends", ends).select("*", F.col("_ends.low").alias("_low"), width.alias("_width"))

    position = F.floor((F.col("_v") - F.col("_low")) / F.nullif(F.col("_width"), F.lit(0.0)))
    bin_of = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    per_bin = with_edges(values).groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = with_edges(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")))
    return grid.filter("_low is not null").join(per_bin, "bin", "left").select(
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("lower"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _item_role_sets(items: DataFrame, jobs: DataFrame) -> DataFrame:
    """``(item, roles)``: the sorted roles that require each item.

    Pairs of item and role are made distinct first; a set holds at most every
    role of the taxonomy, however often an item occurs.
    """
    named = with_role(items.filter(F.col("item_value_norm").isNotNull()), jobs)
    pairs = named.select(F.col("item_value_norm").alias("item"), "role_title").distinct()
    return pairs.groupBy("item").agg(F.array_sort(F.collect_set("role_title")).alias("roles"))


def role_similarity(items: DataFrame, jobs: DataFrame) -> DataFrame:
    """``(from_role, to_role, n_shared, n_union, jaccard)`` per ordered pair that shares items.

    Items with the same set of roles are counted together before the set is
    opened into pairs, so the work follows the number of distinct role sets.  The
    pair of a role with itself carries the number of its items.
    """
    sets = _item_role_sets(items, jobs).groupBy("roles").agg(F.count(F.lit(1)).alias("n"))
    pairs = (
        sets.select("roles", "n", F.explode("roles").alias("from_role"))
        .select("from_role", "n", F.explode("roles").alias("to_role"))
        .groupBy("from_role", "to_role")
        .agg(F.sum("n").alias("n_shared"))
    )
    own = F.max(F.when(F.col("from_role") == F.col("to_role"), F.col("n_shared")))
    sized = pairs.withColumn("_from", own.over(Window.partitionBy("from_role"))).withColumn(
        "_to", own.over(Window.partitionBy("to_role"))
    )
    union = F.col("_from") + F.col("_to") - F.col("n_shared")
    return sized.filter("from_role <> to_role").select(
        "from_role", "to_role", "n_shared", union.alias("n_union"), F.round(F.col("n_shared") / union, 6).alias("jaccard")
    )


def career_gap(items: DataFrame, jobs: DataFrame, from_role: str) -> DataFrame:
    """``(to_role, missing_item)``: what every other role asks for and ``from_role`` does not."""
    lacking = _item_role_sets(items, jobs).filter(~F.array_contains("roles", from_role))
    return lacking.select(F.explode("roles").alias("to_role"), F.col("item").alias("missing_item"))


def role_skill_gap(items: DataFrame, jobs: DataFrame) -> DataFrame:
    """``(from_role, to_role, missing_item)``: the gaps between all pairs of roles.

    The result has a row per pair of roles and item; ``career_gap`` answers for one start.
    The role sets, one row per item, are computed once: they are asked for all roles as well.
    """
    sets = computed_once(_item_role_sets(items, jobs))
    every_role = sets.select(F.explode("roles").alias("role")).agg(F.collect_set("role")).scalar()
    lacking = sets.withColumn("_without", F.array_except(every_role, F.col("roles")))
    return lacking.select("item", "roles", F.explode("_without").alias("from_role")).select(
        "from_role", F.explode("roles").alias("to_role"), F.col("item").alias("missing_item")
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order, so that a repeat gives the same rows."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def seeded_sample(df: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """``n`` rows drawn by the hash of seed and key: the same at any partitioning."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c) for c in key]))
    return df.withColumn("_draw", draw).orderBy("_draw", *key).limit(n).drop("_draw")
