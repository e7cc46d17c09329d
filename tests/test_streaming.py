"""Folders of micro-batches: bounded in number, the same rows at every point of a merge."""

from datetime import datetime

import pytest

from jobtide.schemas import JOBS_RAW, KEY
from jobtide.session import folder_names
from jobtide.streaming import ingest as S

AS_OF = datetime(2024, 1, 31)
POSTING = "source string, source_job_id string, created_at string, search_term string, redirect_url string, raw_json string, seq long"


def rows(spark, ids):
    found = [("A", str(i), "2024-01-02T03:04:05", "t", None, '{"n": 1}', i) for i in ids]
    return spark.createDataFrame(found, POSTING).coalesce(1)


def keys(spark, path):
    return sorted(int(r.source_job_id) for r in S.read_target(spark, path, JOBS_RAW).select(*KEY).collect())


def batch(spark, path, n, ids, most=4):
    S.write_batch(rows(spark, ids), n, path, "jobs_raw", AS_OF, ["seq"], most)


def test_folders_stay_few(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(30):
        batch(spark, path, n, range(3 * n, 3 * n + 6))  # half of each batch is known
        assert len([x for x in folder_names(spark, path) if x.startswith("batch_id=")]) <= 4 + 6
    assert keys(spark, path) == list(range(3 * 29 + 6))
    batch(spark, path, 29, range(3 * 29, 3 * 29 + 6))  # replayed
    assert keys(spark, path) == list(range(3 * 29 + 6))


@pytest.mark.parametrize("stop", ["drop_folder", "move_folder"])
@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_merge_broken_off_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, stop, after):
    path = str(tmp_path / "t")
    for n in range(5):
        batch(spark, path, n, range(2 * n, 2 * n + 3))
    whole, calls = list(range(11)), []
    real = getattr(S, stop)

    def breaking(spark, folder, *more):
        if "batch_id=" in folder:
            calls.append(folder)
            if len(calls) > after:
                raise OSError("lost")
        return real(spark, folder, *more)

    with monkeypatch.context() as m:
        m.setattr(S, stop, breaking)
        try:
            S.compact(spark, path, JOBS_RAW, 5)
            S.compact(spark, path, JOBS_RAW, 5, most=2)
        except OSError:
            pass
        assert keys(spark, path) == whole
    assert keys(spark, path) == whole
    batch(spark, path, 5, range(12))
    assert keys(spark, path) == list(range(12))
    S.compact(spark, path, JOBS_RAW, 6, most=1)
    assert keys(spark, path) == list(range(12))
    assert not [x for x in folder_names(spark, path) if x.startswith("_merge")]
