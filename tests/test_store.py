"""The stored pipeline: tables that meet in place, lookups that read what they need, batches that can be repeated."""

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobtide.checks import fixtures as X
from jobtide.operators.upsert import first_per_key, ingest_metrics
from jobtide.plans import ingest, rollups, store
from jobtide.schemas import KEY, TABLES
from jobtide.session import drop_folder, folder_exists
from jobtide.sources import keyed

AS_OF = datetime(2024, 1, 31)
POSTING = "source string, source_job_id string, created_at string, search_term string, redirect_url string, raw_json string, seq long"
PAGE = "source string, source_job_id string, redirect_url string, html_description string"


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path / "store")


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def postings(spark, ids, more=()):
    rows = [("A", f"{i:09d}", "2024-01-02T03:04:05", "t", None, '{"n": 1}', i) for i in ids]
    return spark.createDataFrame([*rows, *more], POSTING)


def shown_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_meet_without_a_shuffle(spark, folder, no_broadcast):
    opened = store.open_store(spark, folder, buckets=4)
    opened.add("jobs_raw", postings(spark, range(100)), "1", AS_OF, ["seq"])
    opened.add("jobs_raw", postings(spark, range(50, 150)), "2", AS_OF, ["seq"])  # several files per bucket
    pages = spark.createDataFrame([("A", f"{i:09d}", None, "<p>x</p>") for i in range(0, 150, 3)], PAGE)
    opened.add("descriptions_raw", pages, "1", AS_OF, ["redirect_url"])
    raw, described = opened.table("jobs_raw"), opened.table("descriptions_raw")
    inner, anti = raw.join(described, KEY), raw.join(described, KEY, "left_anti")
    first = first_per_key(raw, ["created_at"])
    for df, n in ((inner, 50), (anti, 100), (first, 150), (raw.select(*KEY).distinct(), 150)):
        assert "Exchange" not in shown_plan(df), shown_plan(df)
        assert df.count() == n


def test_a_store_keeps_its_buckets(spark, folder):
    store.open_store(spark, folder, buckets=4)
    assert store.open_store(spark, folder, "another_name", buckets=32).buckets == 4
    assert spark.sql("DESCRIBE EXTENDED another_name.jobs").filter("col_name = 'Num Buckets'").first()[1] == "4"


def scanned_rows(df):
    """Rows that the file scans of an executed query have given."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "FileSourceScanExec":
                found += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("n", [20_000, 80_000])
def test_a_small_batch_reads_few_row_groups(spark, folder, n):
    """Ids that are not held are ruled out by Bloom filters, whatever the table's size; min and max would not do."""
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.page.row.count.limit": "1000"}
    keyed.register(spark, f"db_{n}", "jobs_raw", folder, 4, small)
    table = keyed.table_name(f"db_{n}", "jobs_raw")
    rows = spark.range(n, numPartitions=4).select(
        F.lit("A").alias("source"),
        F.sha2(F.col("id").cast("string"), 256).alias("source_job_id"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
        F.lit("t").alias("search_term"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("fetched_at"),
        F.lit(None).cast("string").alias("redirect_url"),
        F.lit("{}").alias("raw_json"),
    )
    keyed.append(rows, table, "jobs_raw", 4)
    unknown = [(F.sha2(F.lit(f"new {i}"), 256)) for i in range(20)]
    batch = spark.range(1).select(F.lit("A").alias("source"), F.explode(F.array(*unknown)).alias("source_job_id"))
    held = keyed.held_keys(batch, spark.table(table))
    assert held.count() == 0
    assert scanned_rows(held) < 3_000  # a false positive costs a row group at most
    known = rows.select(*KEY).filter(F.col("source_job_id") == rows.first()[1])
    held = keyed.held_keys(known, spark.table(table))
    assert held.count() == 1 and scanned_rows(held) < 6_000


def test_large_batches_take_all_keys(spark, folder):
    opened = store.open_store(spark, folder, buckets=2)
    opened.add("jobs_raw", postings(spark, range(30)), "1", AS_OF, ["seq"])
    batch = postings(spark, range(20, 60)).select(*KEY)
    all_keys = keyed.held_keys(batch, opened.table("jobs_raw"), most=10)
    some = keyed.held_keys(batch, opened.table("jobs_raw"), most=100)
    assert all_keys.count() == 30 and some.count() == 10
    for held in (all_keys, some):
        assert batch.join(held, KEY, "left_anti").count() == 30


def test_counts_of_the_write_equal_the_audit(spark, folder):
    opened = store.open_store(spark, folder, buckets=2)
    opened.add("descriptions_raw", spark.createDataFrame([("A", "1", "u", "x"), ("A", "2", "u", "x")], PAGE), "1", AS_OF, ["redirect_url"])
    before = opened.table("descriptions_raw").select(*KEY).collect()
    rows = [("A", "1", "u", "x"), ("A", "3", "u", "x"), ("A", "3", "v", "y"), ("A", "4", "u", None), ("A", "5", "u", ""), ("B", "1", "u", "x")]
    batch = spark.createDataFrame(rows, PAGE)
    counts = opened.add("descriptions_raw", batch, "2", AS_OF, ["redirect_url"], "html_description").counts
    target = spark.createDataFrame(before, "source string, source_job_id string")
    assert ingest_metrics(batch, target, "html_description").first().asDict() == {k: v for k, v in counts.items() if k != "quarantined"}
    assert counts["quarantined"] == 0


def test_a_batch_is_read_once(spark, folder):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(x):
        read.add(1)
        return x

    opened = store.open_store(spark, folder, buckets=2)
    batch = postings(spark, range(40)).withColumn("seq", noted.asNondeterministic()("seq"))
    opened.add("jobs_raw", batch, "1", AS_OF, ["seq"])
    assert read.value == 40


def test_rows_that_break_a_rule_are_set_apart(spark, folder):
    opened = store.open_store(spark, folder, buckets=2)
    bad = [
        ("A", None, "2024-01-02T03:04:05", "t", None, "{}", 100),
        ("A", "x", "yesterday", "t", None, "{}", 101),
        ("A", "y", "2024-01-02T03:04:05", "t", None, "{oops", 102),
        ("A", "z", None, None, None, "{oops", 103),
    ]
    for _ in range(2):  # repeated, it is the same
        counts = opened.add("jobs_raw", postings(spark, range(5), bad), "1", AS_OF, ["seq"]).counts
        assert counts == {"candidates": 9, "missed": 0, "quarantined": 4, "already_present": 0, "inserted": 5}
        rows = ingest.quarantined(spark, folder, "jobs_raw").collect()
        assert {(r.broken_rule, json.loads(r.brought)["seq"]) for r in rows} == {
            ("source_job_id not null", 100),
            ("created_at is timestamp_ntz", 101),
            ("raw_json is JSON", 102),
            ("created_at not null", 103),
        }
        assert len(rows) == 4
    assert opened.table("jobs_raw").count() == 5
    assert ingest.quarantined(spark, folder, "jobs").count() == 0


@pytest.mark.parametrize("stop", ["append", "roll_up"])
def test_a_batch_broken_off_is_taken_up(spark, folder, frames, monkeypatch, stop):
    """A run that dies after staging, or before its rollups, gives the same tables and rollups when repeated."""
    part = F.pmod(F.xxhash64("source_job_id"), F.lit(40)) == 0
    given = (frames.postings.filter(part), frames.descriptions.filter(part), X.ROLES, X.TERMS, X.AS_OF)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed if stop == "append" else rollups, stop, broken)
        with pytest.raises(RuntimeError, match="lost"):
            store.run_stored(spark, folder, *given, batch="b")
    tables = store.run_stored(spark, folder, *given, batch="b")
    whole = store.run_stored(spark, f"{folder}_2", *given, batch="b")
    for name in TABLES:
        n = tables[name].count()
        assert n and n == whole[name].count() == tables[name].select(*KEY).distinct().count()
    for name in rollups.ROLLUPS:
        got, want = (sorted(map(str, rollups.rolled_up(spark, f, name).collect())) for f in (folder, f"{folder}_2"))
        assert got == want and got


def test_a_rollup_reads_its_own_batch_only(spark, folder):
    opened = store.open_store(spark, folder, buckets=2)
    added = opened.add("jobs_raw", postings(spark, range(10)), "1", AS_OF, ["seq"]).rows
    rollups.roll_up(folder, "1", {"jobs_raw": added})
    added = opened.add("jobs_raw", postings(spark, range(5, 30)), "2", AS_OF, ["seq"]).rows
    partial = rollups.ROLLUPS["postings_by_month"].partial(added)
    files = {re.sub(r".*/store/", "", f) for f in partial.inputFiles()}
    assert files and all(f.startswith("batches/2/") for f in files)
    rollups.roll_up(folder, "2", {"jobs_raw": added})
    (month,) = rollups.rolled_up(spark, folder, "postings_by_month").collect()
    assert (month.month_year, month.n_postings) == ("Jan-24", 30)


def test_what_a_batch_staged_can_be_dropped(spark, folder):
    opened = store.open_store(spark, folder, buckets=2)
    opened.add("jobs_raw", postings(spark, range(3)), "1", AS_OF, ["seq"])
    assert folder_exists(spark, f"{folder}/batches/1")
    opened.forget("1")
    assert not folder_exists(spark, f"{folder}/batches/1") and opened.table("jobs_raw").count() == 3
    drop_folder(spark, folder)
    assert not folder_exists(spark, folder)


def test_the_item_view_gives_the_items(spark, frames):
    from jobtide.operators.items import requirement_items

    store.register_store(spark, frames.store_folder, "item_view_db")
    view = spark.table("item_view_db.job_requirement_items")
    items = requirement_items(frames.stored["job_requirements"])
    assert view.columns == items.columns and items.count() > 0
    assert view.exceptAll(items).count() == 0 and items.exceptAll(view).count() == 0
