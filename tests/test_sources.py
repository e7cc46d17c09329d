import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobtide import session
from jobtide.checks.fixtures import ROLES
from jobtide.operators.roles import small_taxonomy
from jobtide.operators.upsert import insert_if_absent, with_load_time
from jobtide.plans import pipeline
from jobtide.schemas import JOBS_RAW, KEY, TABLES
from jobtide.sources import landing, tables
from jobtide.streaming.ingest import ingest_stream, read_target

AS_OF = datetime(2024, 1, 31)


def test_landing_files(spark, tmp_path):
    folder = tmp_path / "search_term=data engineer"
    folder.mkdir()
    records = [{"id": "7", "created": "2024-01-02T03:04:05Z", "title": "Élève"}, {"id": 8, "redirect_url": "u"}]
    (folder / "page1.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    rows = landing.land_postings(landing.read_landing(spark, str(tmp_path)), "Board", AS_OF).orderBy("source_job_id").collect()
    assert [(r.source_job_id, r.created_at, r.redirect_url, r.search_term) for r in rows] == [
        ("7", "2024-01-02T03:04:05Z", None, "data engineer"),
        ("8", None, "u", "data engineer"),
    ]
    assert json.loads(rows[0].raw_json) == records[0] and rows[0].fetched_at == AS_OF


def test_taxonomy_file(spark, tmp_path):
    path = tmp_path / "roles.json"
    roles = [{"name": r.name, "aliases": list(r.aliases), "search_term": list(r.search_term)} for r in ROLES]
    path.write_text(json.dumps(roles, indent=2))
    assert small_taxonomy(landing.read_taxonomy(spark, str(path))) == list(ROLES)


def test_counts_refuse_unknown_names(spark):
    with pytest.raises(ValueError, match="Unsupported table name"):
        tables.table_counts({"users": spark.range(1)})


def test_catalog_is_idempotent(spark):
    for name in [*TABLES, "job_requirement_items"]:
        spark.catalog.dropTempView(name)
    tables.init_catalog(spark)
    one = spark.createDataFrame([("A", "1", ["x"], None, None)], "source string, source_job_id string, technical_tools array<string>, technical_concepts array<string>, certifications array<string>")
    tables.init_catalog(spark, {"job_requirements": one})
    tables.init_catalog(spark)
    counts = {r.table_name: r.n_rows for r in tables.catalog_overview(spark).collect()}
    assert counts == {"jobs_raw": 0, "descriptions_raw": 0, "jobs": 0, "job_requirements": 1, "job_requirement_items": 1}
    assert spark.table("jobs_raw").schema == JOBS_RAW
    for name in counts:
        spark.catalog.dropTempView(name)


def test_bucketed_tables_join_without_shuffle(spark, frames):
    tables.save_bucketed(frames.jobs_raw, "t_jobs_raw", 8, "overwrite")
    tables.save_bucketed(frames.descriptions, "t_descriptions", 8, "overwrite")
    joined = spark.table("t_jobs_raw").join(spark.table("t_descriptions").select(*KEY), KEY)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        new = insert_if_absent(spark.table("t_jobs_raw"), spark.table("t_descriptions"), ["fetched_at"])
        assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE t_jobs_raw")
        spark.sql("DROP TABLE t_descriptions")


def test_metadata_does_not_read_descriptions(spark, frames, tmp_path):
    """Only the keys of the description table are scanned for the posting metadata."""
    path = str(tmp_path / "d")
    frames.descriptions.write.parquet(path)
    plan = pipeline.mapped_postings(frames.jobs_raw, spark.read.parquet(path), ROLES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string,source_job_id:string>" in text


def test_pipeline_skips_validated_jobs(frames):
    done = frames.requirements
    rest = pipeline.job_requirements(frames.jobs, frames.descriptions, frames.terms, done)
    assert {r.extraction_status for r in rest.collect()} == {"skipped"}


def test_shared_folder_refuses_a_cluster(spark, monkeypatch):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)


def _landed_files(spark, frames, folder, n):
    rows = with_load_time(frames.postings, "jobs_raw", AS_OF)
    rows.repartitionByRange(n, "seq").write.parquet(folder)
    return rows


def test_stream_lands_every_key_once_over_many_batches(spark, frames, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "table")
    rows = _landed_files(spark, frames, folder, 5)
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    ingest_stream(stream(), path, "jobs_raw", AS_OF, ["seq"]).awaitTermination()
    table = read_target(spark, path, JOBS_RAW)
    assert table.select("batch_id").distinct().count() == 3
    keys = rows.select(*KEY).distinct().count()
    assert table.count() == keys == table.select(*KEY).distinct().count()
    # A second run with nothing new, then one with files already known.
    ingest_stream(stream(), path, "jobs_raw", AS_OF, ["seq"]).awaitTermination()
    rows.limit(100).write.mode("append").parquet(folder)
    ingest_stream(stream(), path, "jobs_raw", AS_OF, ["seq"]).awaitTermination()
    assert read_target(spark, path, JOBS_RAW).count() == keys


def test_replayed_batch_writes_the_same_rows(spark, frames, tmp_path):
    """A batch that runs again after a crash replaces its own output."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "table")
    rows = _landed_files(spark, frames, folder, 3)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest_stream(stream, path, "jobs_raw", AS_OF, ["seq"]).awaitTermination()
    before = read_target(spark, path, JOBS_RAW).select(*KEY, "batch_id").collect()
    # Forget that the last batch was committed, as if the driver had died just then.
    commits = tmp_path / "table_checkpoint" / "commits"
    for name in ("2", ".2.crc"):
        target = commits / name
        if target.exists():
            target.unlink()
    again = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest_stream(again, path, "jobs_raw", AS_OF, ["seq"]).awaitTermination()
    after = read_target(spark, path, JOBS_RAW).select(*KEY, "batch_id").collect()
    assert sorted(before) == sorted(after)
