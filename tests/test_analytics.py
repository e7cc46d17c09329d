import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from jobtide.operators import analytics as A
from jobtide.operators.pages import text_reduction


@pytest.fixture(scope="module")
def tables(spark):
    """Jobs of three roles, one of which holds most rows, and their items."""
    roles = ["hot"] * 80 + ["mid"] * 15 + ["small"] * 5
    jobs = [("S", str(i), r) for i, r in enumerate(roles)]
    items = [("S", str(i), "technical_tool", f"t{(i * i) % 11 if r == 'hot' else i % 4}") for i, r in enumerate(roles)]
    items += [("S", str(i), "technical_tool", "t0") for i in range(0, 100, 2)]
    jobs_df = spark.createDataFrame(jobs, "source string, source_job_id string, role_title string")
    items_df = spark.createDataFrame(items, "source string, source_job_id string, item_type string, item_value_norm string")
    return jobs, items, jobs_df, items_df


def _sets(jobs, items):
    role = {j[1]: j[2] for j in jobs}
    sets = {}
    for _, job, _, item in items:
        sets.setdefault(role[job], set()).add(item)
    return sets


def test_counts_keep_the_hot_role_whole(tables):
    jobs, items, jobs_df, items_df = tables
    rows = A.top_tools_by_role(items_df, jobs_df).collect()
    assert sum(r.n_jobs for r in rows) == len(items)
    assert [(r.role_title, -r.n_jobs) for r in rows] == sorted((r.role_title, -r.n_jobs) for r in rows)


def test_distinct_jobs(tables):
    jobs, items, jobs_df, items_df = tables
    role = {j[1]: j[2] for j in jobs}
    expected = {}
    for job in {i[1] for i in items if i[3] == "t0"}:
        expected[role[job]] = expected.get(role[job], 0) + 1
    assert {r.role_title: r.n_jobs for r in A.jobs_requiring_tool(items_df, jobs_df, "t0").collect()} == expected


def test_similarity_and_gap_equal_brute_force(tables):
    jobs, items, jobs_df, items_df = tables
    sets = _sets(jobs, items)
    expected = {
        (a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in permutations(sets, 2) if sets[a] & sets[b]
    }
    got = {(r.from_role, r.to_role): (r.n_shared, r.n_union) for r in A.role_similarity(items_df, jobs_df).collect()}
    assert got == expected
    gap = {tuple(r) for r in A.role_skill_gap(items_df, jobs_df).collect()}
    assert gap == {(a, b, i) for a, b in permutations(sets, 2) for i in sets[b] - sets[a]}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 10, 10]] + [(None,)], "v double")
    rows = A.histogram(df, F.col("v"), 5).orderBy("bin").collect()
    assert [(r.bin, r.lower, r.upper, r.n) for r in rows] == [(0, 0, 2, 2), (1, 2, 4, 2), (2, 4, 6, 2), (3, 6, 8, 0), (4, 8, 10, 2)]


def test_histogram_of_equal_values_and_of_nothing(spark):
    same = spark.createDataFrame([(3.0,)] * 4, "v double")
    assert [r.n for r in A.histogram(same, F.col("v"), 3).orderBy("bin").collect()] == [4, 0, 0]
    assert A.histogram(same.limit(0), F.col("v"), 3).collect() == []


def test_histogram_computes_the_value_once(frames):
    """The stored values feed both the range and the bins; a task shuffles one row per bin at most."""
    df = A.histogram(text_reduction(frames.descriptions, "html_description"), F.col("reduction_pct"), 100)
    rows = df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # No page is read any more, and all scans are of the one column.
    assert "html_description" not in final and "regexp" not in final
    scans = set(re.findall(r"Scan ExistingRDD\[([^\]]*)\]", final))
    assert scans and all(x.startswith("_v#") and "," not in x for x in scans)
    # Counted per task before the shuffle: as many rows as tasks and bins, however many values differ.
    assert "partial_count(1)" in final
    assert sum(r.n for r in rows) == text_reduction(frames.descriptions, "html_description").filter("reduction_pct IS NOT NULL").count()



def test_null_is_a_value(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    assert [tuple(r) for r in A.distribution(df, "v").collect()] == [(None, 2), ("a", 1)]


def test_sample_is_the_same_at_any_partitioning(spark):
    df = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    one = [r.id for r in A.seeded_sample(df.repartition(1), 20, 42, "k").collect()]
    assert one == [r.id for r in A.seeded_sample(df.repartition(50), 20, 42, "k").collect()]
    assert one != [r.id for r in A.seeded_sample(df, 20, 43, "k").collect()] and len(set(one)) == 20
