from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobtide.operators import postings as P
from jobtide.operators import upsert as U
from jobtide.schemas import JOBS_RAW, KEY

AS_OF = datetime(2024, 1, 31)
COLUMNS = "source string, source_job_id string, created_at string, search_term string, redirect_url string, raw_json string, seq long"


def batch(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def posting(key, seq, raw="{}", source="A"):
    return (source, key, "2024-01-02T03:04:05Z", "t", None, raw, seq)


def empty(spark):
    return spark.createDataFrame([], JOBS_RAW)


@pytest.mark.parametrize("few_keys", [False, True])
def test_first_of_key_wins_and_known_keys_stay_out(spark, few_keys):
    rows = [posting("1", 5, '{"v":2}'), posting("1", 4, '{"v":1}'), posting("2", 1), posting("1", 9, "{}", "B")]
    target = U.upsert_postings(batch(spark, [posting("2", 0)]), empty(spark), AS_OF)
    new = U.upsert_postings(batch(spark, rows), target, AS_OF, few_keys=few_keys)
    assert sorted((r.source, r.source_job_id, r.raw_json) for r in new.collect()) == [("A", "1", '{"v":1}'), ("B", "1", "{}")]
    assert new.schema.names == JOBS_RAW.names


def test_inserting_twice_is_inserting_once(spark, tmp_path):
    path = str(tmp_path / "t")
    empty(spark).write.parquet(path)
    rows = batch(spark, [posting(str(i % 7), i) for i in range(20)])
    loaded = U.with_load_time(rows, "jobs_raw", AS_OF).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    for _ in range(2):
        U.append_new_rows(loaded, spark.read.schema(JOBS_RAW).parquet(path), path, "jobs_raw", AS_OF, ["seq"])
    assert spark.read.schema(JOBS_RAW).parquet(path).count() == 7


@pytest.mark.parametrize("bad", [posting("1", 1, "{oops"), posting("1", 1, '{"a":1} trailing'), posting(None, 1)])
def test_a_writer_refuses_what_its_table_refuses(spark, tmp_path, bad):
    path = str(tmp_path / "t")
    empty(spark).write.parquet(path)
    target = spark.read.schema(JOBS_RAW).parquet(path)
    with pytest.raises(Exception, match="not JSON|must not be null"):
        U.append_new_rows(batch(spark, [bad]), target, path, "jobs_raw", AS_OF, ["seq"])
    assert spark.read.schema(JOBS_RAW).parquet(path).count() == 0


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A key that fills a third of a batch reaches the reducers as one row per task."""
    rows = spark.range(0, 90_000, numPartitions=8).select(
        F.lit("A").alias("source"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source_job_id"),
        F.col("id").alias("seq"),
    )
    first = U.first_per_key(rows, ["seq"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert first.count() == 60_001
    assert first.filter("source_job_id = 'hot'").first().seq == 0


def test_defaults_and_times(spark):
    row = U.upsert_postings(batch(spark, [posting("1", 1)]), empty(spark), AS_OF).first()
    assert row.created_at == datetime(2024, 1, 2, 3, 4, 5) and row.fetched_at == AS_OF


def test_bad_payload_and_nulls_are_errors(spark):
    with pytest.raises(PySparkException, match="raw_json is not JSON"):
        U.upsert_postings(batch(spark, [posting("1", 1, "{oops")]), empty(spark), AS_OF).collect()
    with pytest.raises(PySparkException, match="source must not be null"):
        U.upsert_postings(batch(spark, [posting("1", 1, "{}", None)]), empty(spark), AS_OF).collect()


def test_descriptions_without_id_are_left_out(spark):
    rows = spark.createDataFrame(
        [("A", None, "u", "<p>", 1), ("A", "1", "u", "<p>", 2)],
        "source string, source_job_id string, redirect_url string, html_description string, seq long",
    )
    target = U.upsert_descriptions(rows.limit(0), rows.limit(0), AS_OF)
    assert [r.source_job_id for r in U.upsert_descriptions(rows, target, AS_OF).collect()] == ["1"]


def test_violations(spark):
    rows = batch(spark, [posting("1", 1), posting("1", 2), posting("1", 3), ("A", None, None, "t", None, "{}", 4)])
    found = {r.rule: r.n_rows for r in U.constraint_violations(rows, "jobs_raw").collect()}
    assert found["unique key"] == 2 and found["source_job_id not null"] == 1 and found["created_at not null"] == 1
    assert found["raw_json not null"] == 0


def test_metrics(spark):
    rows = spark.createDataFrame(
        [("A", "1", "x"), ("A", "1", "x"), ("A", "2", ""), ("A", "3", None), ("A", "4", "x")],
        "source string, source_job_id string, html string",
    )
    target = spark.createDataFrame([("A", "4")], "source string, source_job_id string")
    assert tuple(U.ingest_metrics(rows, target, "html").first()) == (5, 2, 1, 1)


def test_cap_per_term_with_one_hot_term(spark):
    """The salted ranking gives exactly the newest rows of a term that holds most of them."""
    rows = spark.range(20_000).select(
        F.lit("A").alias("source"),
        F.col("id").cast("string").alias("source_job_id"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise("rare").alias("search_term"),
        F.timestamp_seconds(F.col("id") * 7919 % 20_000).alias("created_at"),
        F.col("id").alias("seq"),
    )
    got = {(r.search_term, r.seq) for r in P.cap_per_term(rows, 50).collect()}
    local = sorted(((i * 7919 % 20_000, i) for i in range(20_000)), reverse=True)
    expected = {("hot", i) for _, i in [x for x in local if x[1] % 10 > 0][:50]}
    expected |= {("rare", i) for _, i in [x for x in local if x[1] % 10 == 0][:50]}
    assert got == expected


def test_excluded_words_are_whole_words(spark):
    titles = ["Head of Data", "Headless Engineer", "Co-Founder", "founder", "Vice-President", "VP-Engineering", "Product-Manager", "Head-of-Data", "VP, Data", "Data Manager", "Co-op", None]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    kept = [r.title for r in P.without_excluded_terms(df, F.col("title")).collect()]
    assert kept == ["Headless Engineer", "Co-op", None]


def test_collisions_equal_the_real_joins(frames):
    raw, descriptions = frames.jobs_raw, frames.descriptions
    audit = P.cross_source_id_collisions(raw, descriptions)
    ids = audit.select("source_job_id")
    by_id = raw.join(descriptions, "source_job_id").join(ids, "source_job_id", "left_semi").count()
    by_key = raw.join(descriptions, KEY).join(ids, "source_job_id", "left_semi").count()
    assert audit.count() > 0
    assert audit.agg(F.sum("rows_by_id"), F.sum("rows_by_key")).first() == (by_id, by_key)


def test_missing_descriptions_is_an_anti_join(frames):
    plan = P.missing_descriptions(frames.jobs_raw, frames.descriptions)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftOuter" not in plan


def test_bad_salary_is_an_error(spark):
    row = ("A", "1", datetime(2024, 1, 1), None, '{"title":"x","company":{"display_name":"c"},"salary_min":"lots"}')
    df = spark.createDataFrame([row], "source string, source_job_id string, created_at timestamp_ntz, redirect_url string, raw_json string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        P.posting_fields(df).collect()


def test_payload_is_parsed_once(frames):
    plan = P.posting_metadata(frames.jobs_raw, frames.descriptions)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
