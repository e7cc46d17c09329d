"""One Spark query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.checks import fixtures as X
from jobtide.checks.frames import Frames
from jobtide.fixed_values import DESCRIPTION_SELECTORS, NO_MATCH, TECHNICAL_TOOL
from jobtide.functions import requirements as req
from jobtide.functions import sections, titles
from jobtide.functions.text import normalize_text
from jobtide.operators import analytics, pages, postings, roles, upsert
from jobtide.operators import requirements as requirement_ops
from jobtide.operators.items import requirement_items
from jobtide.plans import ingest, pipeline, store
from jobtide.schemas import JOBS_RAW, KEY, TABLES
from jobtide.session import computed_once, shared_folder
from jobtide.sources import tables
from jobtide.sources.landing import land_postings
from jobtide.streaming.ingest import ingest_stream, read_target

Query = Callable[[Frames], DataFrame]
LISTS = list(req.LIST_FIELDS)
#: Micro-batches of the stream, and rows of one of their files.
STREAM_BATCHES, STREAM_FILE_ROWS = 4, 250_000


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    """Show arrays and times as text, so that any engine compares them alike."""
    for name in columns:
        kind = df.schema[name].dataType.typeName()
        df = df.withColumn(name, F.to_json(name) if kind == "array" else F.col(name).cast("string"))
    return df


def _land(f: Frames) -> DataFrame:
    lines = f.postings.select(F.col("raw_json").alias("value"), "search_term")
    return _texts(land_postings(lines, "BoardA", X.AS_OF), "fetched_at")


def _upsert_postings(f: Frames) -> DataFrame:
    new = upsert.upsert_postings(f.postings, f.landed, X.AS_OF)
    return _texts(new, "created_at", "fetched_at")


def _insert_if_absent(f: Frames) -> DataFrame:
    few = upsert.has_few_keys(f.postings)
    return upsert.insert_if_absent(f.postings, f.landed, ["seq"], few_keys=few).select(*KEY, "seq")


def _description_batch(f: Frames) -> DataFrame:
    """Every posting scraped again, in arrival order, with a null key for some."""
    job_id = F.when(F.col("redirect_url").isNotNull(), F.col("source_job_id"))
    return f.postings.select(
        "source", job_id.alias("source_job_id"), "redirect_url", "seq", F.col("raw_json").alias("html_description")
    )


def _upsert_descriptions(f: Frames) -> DataFrame:
    new = upsert.upsert_descriptions(_description_batch(f), f.descriptions, X.AS_OF)
    return _texts(new, "scraped_at")


def _earlier_jobs(f: Frames) -> DataFrame:
    return f.jobs.filter(F.col("posted_at") < F.lit(X.LANDED_UNTIL.isoformat(sep=" ")).cast("timestamp_ntz"))


def _upsert_jobs(f: Frames) -> DataFrame:
    new = upsert.upsert_jobs(f.jobs, _earlier_jobs(f), X.AS_OF, ["posted_at"])
    return _texts(new, "posted_at", "created_at")


def _upsert_requirements(f: Frames) -> DataFrame:
    known = f.requirements.filter(F.col("extraction_status") == "skipped")
    new = upsert.upsert_requirements(f.requirements, known, X.AS_OF, ["error"])
    return _texts(new, *LISTS, "extracted_at")


def _violations(f: Frames) -> DataFrame:
    loaded = upsert.with_load_time(_description_batch(f), "descriptions_raw", X.AS_OF)
    return upsert.constraint_violations(f.postings, "jobs_raw").unionByName(
        upsert.constraint_violations(loaded, "descriptions_raw")
    )


def _base_tables(f: Frames) -> dict[str, DataFrame]:
    return {
        "jobs_raw": f.jobs_raw,
        "descriptions_raw": f.descriptions,
        "jobs": f.jobs,
        "job_requirements": f.requirements,
        "job_requirement_items": f.items,
    }


def _table_counts(f: Frames) -> DataFrame:
    """Rows of all tables; jobs and requirements, from which other tables follow, are computed once."""
    jobs = computed_once(f.jobs)
    requirements = computed_once(pipeline.job_requirements(jobs, f.descriptions, X.TERMS))
    later = {"jobs": jobs, "job_requirements": requirements, "job_requirement_items": requirement_items(requirements)}
    return tables.table_counts({"jobs_raw": f.jobs_raw, "descriptions_raw": f.descriptions, **later})


def _catalog(f: Frames) -> DataFrame:
    known = _base_tables(f)
    known.pop("job_requirement_items")
    tables.init_catalog(f.spark, known)
    return tables.catalog_overview(f.spark)


def _stream(f: Frames) -> DataFrame:
    orders = f.spark.read.parquet(f"{f.sf_dir}/orders.parquet")
    path = f"{shared_folder(f.spark)}/stream-{uuid4().hex}"
    # Several files and micro-batches; postings of one key come in different ones.  A task sorts what
    # it reads, so larger batches have more files, not larger ones.
    files = -(-orders.count() // (STREAM_BATCHES * STREAM_FILE_ROWS)) or 1
    orders.repartition(STREAM_BATCHES * files, "o_orderkey").write.parquet(f"{path}_in")
    landed = f.spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", files).parquet(f"{path}_in")

    def prepare(batch: DataFrame) -> DataFrame:
        batch.createOrReplaceTempView("jt_stream_orders")
        sql = X.POSTINGS.replace("FROM orders", "FROM jt_stream_orders")
        return batch.sparkSession.sql(sql)

    ingest_stream(landed, path, "jobs_raw", X.AS_OF, ["seq"], prepare).awaitTermination()
    return read_target(f.spark, path, JOBS_RAW).select(*KEY)


def _init_catalog(f: Frames) -> DataFrame:
    """A filled store made known to the catalog, twice, and how many rows its tables hold there."""
    name = f"store_{uuid4().hex}"
    for _ in range(2):
        store.register_store(f.spark, f.store_folder, name)
    return tables.table_counts({t: f.spark.table(f"`{name}`.`{t}`") for t in TABLES})


def _catalog_listing(f: Frames) -> DataFrame:
    name = f"store_{uuid4().hex}"
    for _ in range(2):
        store.register_store(f.spark, f.store_folder, name)
    return tables.catalog_listing(f.spark, name)


def _ingested(f: Frames, rows: DataFrame, landed: DataFrame | None = None, payload: str | None = None):
    """The counts of a write into a new store, which holds the keys of ``landed`` already; and the store."""
    opened = store.open_store(f.spark, f"{shared_folder(f.spark)}/store-{uuid4().hex}")
    if landed is not None:
        opened.add("descriptions_raw", landed.select(*KEY, "redirect_url"), "landed", X.AS_OF, ["redirect_url"])
    added = opened.add("descriptions_raw", rows, "next", X.AS_OF, ["redirect_url"], payload)
    return added.counts, opened


def _ingest_counts(f: Frames) -> DataFrame:
    counts, _ = _ingested(f, f.descriptions, f.landed, "html_description")
    names = ("candidates", "missed", "already_present", "inserted")
    return f.spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


def _quarantined(f: Frames) -> DataFrame:
    _, opened = _ingested(f, _description_batch(f))
    broken = ingest.quarantined(f.spark, opened.folder, "descriptions_raw")
    brought = F.get_json_object("brought", "$.seq").cast("long")
    return broken.groupBy("broken_rule").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(brought).alias("seq_sum"))


def _metrics(f: Frames) -> DataFrame:
    return upsert.ingest_metrics(f.descriptions, f.landed, "html_description")


def _container(f: Frames) -> DataFrame:
    return pages.with_main_container(f.job_pages, "html", "container", DESCRIPTION_SELECTORS).select("page_id", "container")


def _headers(f: Frames) -> DataFrame:
    return pages.section_headers(f.descriptions, KEY, "html_description")


def _months(df: DataFrame) -> DataFrame:
    return _texts(df, "first_created")


def _match(step: str) -> Query:
    def run(f: Frames) -> DataFrame:
        staged = titles.with_clean_title(f.titles, "title")
        title = F.col("cleaned_title")
        role = {
            "exact": lambda: roles.exact_role(title, X.ROLES),
            "flexible": lambda: roles.flexible_role(roles.words_of(title), X.ROLES),
            "keyword": lambda: titles.keyword_role(title),
        }[step]()
        return staged.select("seq", "cleaned_title", role.alias("matched_role"))

    return run


def _title_step(step: Callable) -> Query:
    return lambda f: f.titles.select("seq", "title", step(F.col("title")).alias("result"))


def _histogram(df: DataFrame) -> DataFrame:
    return df.withColumn("lower", F.round("lower", 4)).withColumn("upper", F.round("upper", 4))


QUERIES: dict[str, Query] = {
    # the flagship
    "top_tools_by_role": lambda f: analytics.top_tools_by_role(f.role_items, f.jobs),
    # stored tables
    "init_catalog": _init_catalog,
    "catalog_listing": _catalog_listing,
    "stored_jobs": lambda f: _texts(f.stored["jobs"].drop("created_at"), "posted_at"),
    "stored_requirements": lambda f: _texts(f.stored["job_requirements"].drop("extracted_at"), *LISTS),
    "stored_top_tools": lambda f: analytics.top_tools_by_role(
        requirement_items(f.stored["job_requirements"]), f.stored["jobs"]
    ),
    # answers kept up to date by batch
    "rolled_up_months": lambda f: _months(f.rolled_up("postings_by_month").drop("first_fetch")),
    "rolled_up_first_fetch": lambda f: _texts(
        f.rolled_up("postings_by_month").agg(F.min("first_fetch").alias("first_fetch")), "first_fetch"
    ),
    "rolled_up_roles": lambda f: f.rolled_up("role_distribution"),
    "rolled_up_match_methods": lambda f: f.rolled_up("match_method_distribution"),
    "rolled_up_mapped_months": lambda f: f.rolled_up("mapped_by_month"),
    "rolled_up_extraction_status": lambda f: f.rolled_up("extraction_status_counts"),
    "rolled_up_seniority": lambda f: f.rolled_up("seniority_distribution"),
    "rolled_up_tools": lambda f: f.rolled_up("items_by_role").filter(F.col("item_type") == TECHNICAL_TOOL)
    .select("role_title", F.col("item").alias("tool"), F.col("n_items").alias("n_jobs")),
    "rolled_up_requiring_tool": lambda f: f.rolled_up("tools_required").filter("item = 'python'").drop("item"),
    # landing
    "land_postings": _land,
    "search_tasks": lambda f: postings.landed_per_task(f.taxonomy, f.postings),
    "exclude_terms": lambda f: postings.without_excluded_terms(f.titles, F.col("title")).select("seq", "title"),
    "recent_postings": lambda f: postings.recent_postings(f.postings, X.AS_OF, 365).select("seq", "source_job_id"),
    "cap_per_term": lambda f: postings.cap_per_term(f.postings).select("search_term", "seq"),
    # insert-if-absent and audits
    "insert_if_absent": _insert_if_absent,
    "upsert_postings": _upsert_postings,
    "upsert_descriptions": _upsert_descriptions,
    "upsert_jobs": _upsert_jobs,
    "upsert_requirements": _upsert_requirements,
    "constraint_violations": _violations,
    "table_counts": _table_counts,
    "catalog_overview": _catalog,
    "ingest_metrics": _metrics,
    "ingest_counts": _ingest_counts,
    "quarantined_rows": _quarantined,
    "stream_ingest_keys": _stream,
    # postings and joins
    "posting_metadata": lambda f: _texts(postings.posting_metadata(f.jobs_raw, f.descriptions), "posted_at"),
    "curated_jobs": lambda f: _texts(f.jobs, "posted_at"),
    "unmapped_titles": lambda f: roles.unmapped_only(f.mapped).select(*KEY, "job_title", "cleaned_title"),
    "job_descriptions": lambda f: requirement_ops.job_descriptions(f.jobs, f.descriptions),
    "missing_descriptions": lambda f: postings.missing_descriptions(f.jobs_raw, f.descriptions),
    "cross_source_id_collisions": lambda f: postings.cross_source_id_collisions(f.jobs_raw, f.descriptions),
    "extraction_backlog": lambda f: requirement_ops.extraction_backlog(
        f.jobs, requirement_ops.parse_responses(f.responses)
    ).select(*KEY, "job_title"),
    # titles
    "normalize_bilingual": _title_step(titles.normalize_bilingual),
    "remove_seniority": _title_step(lambda t: titles.remove_seniority(titles.normalize_bilingual(t))),
    "normalize_common_terms": _title_step(lambda t: titles.normalize_common_terms(F.lower(t))),
    "clean_job_title": lambda f: titles.with_clean_title(f.titles, "title", "result").select("seq", "title", "result"),
    "match_alias_exact": _match("exact"),
    "match_alias_flexible": _match("flexible"),
    "match_keywords": _match("keyword"),
    "map_titles": lambda f: roles.map_titles(f.titles, X.ROLES),
    "map_titles_by_join": lambda f: roles.map_titles_by_join(f.titles, f.taxonomy),
    "infer_seniority": lambda f: f.titles.select(
        "seq",
        titles.infer_seniority(
            F.col("title"), F.when(F.col("seq") % 3 > 0, (F.col("seq") % 8).cast("int"))
        ).alias("seniority"),
    ),
    # pages and sections
    "page_main_container": _container,
    "normalize_text": lambda f: f.lines.select("doc_id", normalize_text(F.col("line")).alias("result")),
    "page_plain_text": lambda f: pages.page_text(f.given("pages"), "html").select("page_id", "plain_text"),
    "page_list_items": lambda f: pages.list_items(f.given("pages"), ["page_id"], "html"),
    "section_headers": _headers,
    "is_skill_header": lambda f: f.lines.select("doc_id", sections.is_skill_header(F.col("line")).alias("result")),
    "strip_bullets": lambda f: f.lines.select(
        "doc_id", sections.is_bullet(F.col("line")).alias("is_bullet"), sections.strip_bullet(F.col("line")).alias("result")
    ),
    "section_items": lambda f: pages.section_items(f.descriptions, KEY, "html_description"),
    "given_section_headers": lambda f: pages.section_headers(f.given("pages"), ["page_id"], "html"),
    "given_section_items": lambda f: pages.section_items(f.given("pages"), ["page_id"], "html"),
    "requirement_section": lambda f: sections.with_requirement_section(f.descriptions, "html_description").select(
        *KEY, "section"
    ),
    "text_reduction": lambda f: pages.text_reduction(f.descriptions, "html_description").select(
        *KEY, F.round("reduction_pct", 6).alias("reduction_pct")
    ),
    # requirements
    "extract_terms": lambda f: _texts(
        requirement_ops.with_terms(f.lines, "line", f.terms).select("doc_id", *LISTS), *LISTS
    ),
    "extract_terms_by_join": lambda f: _texts(
        requirement_ops.with_terms_by_join(f.lines, "line", f.terms).select("doc_id", *LISTS), *LISTS
    ),
    "extract_years": lambda f: requirement_ops.with_years(f.lines, "line").select("doc_id", "min_years", "max_years"),
    "parse_responses": lambda f: _texts(requirement_ops.parse_responses(f.responses), *LISTS).drop("error"),
    "clean_requirement_lists": lambda f: f.responses.select(
        *KEY,
        F.to_json(
            req.clean_list(F.from_json(F.get_json_object("response", "$.technical_tools"), "array<string>"))
        ).alias("technical_tools"),
    ),
    "job_requirements": lambda f: _texts(f.requirements, *LISTS),
    "requirement_items": lambda f: f.items,
    # analytics
    "jobs_requiring_tool": lambda f: analytics.jobs_requiring_tool(f.role_items, f.jobs, "python"),
    "topk_tools_by_role": lambda f: analytics.topk_tools_by_role(f.role_items, f.jobs),
    "top_concepts_by_role": lambda f: analytics.top_concepts_by_role(f.role_items, f.jobs),
    "certification_demand": lambda f: analytics.certification_demand(f.role_items, f.jobs),
    "role_distribution": lambda f: analytics.distribution(f.jobs, "role_title"),
    "match_method_distribution": lambda f: analytics.distribution(f.jobs, "role_match_method"),
    "extraction_status_counts": lambda f: analytics.distribution(
        requirement_ops.parse_responses(f.responses), "extraction_status"
    ),
    "seniority_distribution": lambda f: analytics.distribution(f.requirements, "seniority"),
    "role_seniority": lambda f: analytics.role_seniority(f.role_requirements, f.jobs),
    "experience_by_role": lambda f: analytics.experience_by_role(f.role_requirements, f.jobs),
    "salary_by_role": lambda f: analytics.salary_by_role(f.jobs),
    "postings_by_month": lambda f: _months(analytics.postings_by_month(f.jobs_raw)),
    "postings_by_month_flagged": lambda f: _months(analytics.postings_by_month_flagged(f.jobs_raw)),
    "mapped_by_month": lambda f: analytics.mapped_by_month(f.jobs),
    "first_fetch": lambda f: _texts(analytics.first_fetch(f.jobs_raw), "first_fetch"),
    "unmapped_rate": lambda f: analytics.unmapped_rate(f.mapped, NO_MATCH),
    "length_histogram": lambda f: _histogram(
        analytics.histogram(
            pages.page_text(f.given("pages"), "html"), F.length("plain_text"), 20
        )
    ),
    "reduction_histogram": lambda f: _histogram(
        analytics.histogram(pages.text_reduction(f.descriptions, "html_description"), F.col("reduction_pct"), 100)
    ),
    "role_similarity": lambda f: analytics.role_similarity(f.role_items, f.jobs),
    "career_gap": lambda f: analytics.career_gap(f.role_items, f.jobs, "data analyst"),
    "role_skill_gap": lambda f: analytics.role_skill_gap(f.role_items, f.jobs),
    # first rows and samples
    "limit_jobs": lambda f: analytics.first_rows(f.jobs, 10, *KEY).select(*KEY, "job_title"),
    "sample_unmapped": lambda f: analytics.seeded_sample(
        roles.unmapped_only(f.mapped), 20, 42, *KEY
    ).select(*KEY, "job_title"),
}


def as_driver_query(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Frames(spark, sf_dir))
