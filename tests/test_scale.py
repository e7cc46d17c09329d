"""Work that is dealt by the size of the input."""

from pyspark.sql import functions as F

from jobtide.checks import frames as frames_module
from jobtide.checks import queries
from jobtide.checks.frames import Frames
from jobtide.session import folder_names, shared_folder


def test_a_larger_file_is_dealt_into_more_tasks_not_larger_ones(spark, sf_dir, monkeypatch):
    few = Frames(spark, sf_dir)
    rows = few.given("pages").count()
    monkeypatch.setattr(frames_module, "TASK_BYTES", 4 << 10)
    many = Frames(spark, sf_dir)
    assert many.given("pages").rdd.getNumPartitions() > many.cores
    assert many.given("pages").count() == rows
    assert many.spread_postings.rdd.getNumPartitions() > many.cores
    assert many.descriptions.exceptAll(few.descriptions).isEmpty()


def test_a_larger_stream_has_more_files_in_as_many_batches(spark, sf_dir, monkeypatch):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", -(-orders // 20))
    known = set(folder_names(spark, shared_folder(spark)))
    keys = queries._stream(Frames(spark, sf_dir))
    (path,) = [n for n in set(folder_names(spark, shared_folder(spark))) - known if n.endswith("_in")]
    files = [n for n in folder_names(spark, f"{shared_folder(spark)}/{path}") if n.endswith(".parquet")]
    assert len(files) == 20
    batches = [n for n in folder_names(spark, f"{shared_folder(spark)}/{path.removesuffix('_in')}") if n.startswith("batch_id")]
    assert len(batches) == queries.STREAM_BATCHES
    expected = Frames(spark, sf_dir).postings.select("source", "source_job_id").distinct()
    assert keys.count() == expected.count() and keys.exceptAll(expected).isEmpty()


def test_roles_of_requirements_are_not_derived_again(frames):
    from jobtide.operators import analytics

    carried = frames.role_requirements
    for ask in (analytics.role_seniority, analytics.experience_by_role):
        nothing = frames.jobs.filter(F.lit(False))
        assert ask(carried, nothing).exceptAll(ask(frames.requirements, frames.jobs)).isEmpty()
        assert ask(carried, nothing).count() == ask(frames.requirements, frames.jobs).count() > 0
