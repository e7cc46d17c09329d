"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "jobtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Only semantics are pinned here (UTC, ANSI, AQE).  Sizes such as the number
    of shuffle partitions belong to the cluster; AQE coalesces from there.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for stream checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``.  Where that is unset, a local master
    (tests) gets a fresh temporary folder; a cluster is refused, because a
    folder of one machine would be lost with it.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="jobtide-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def computed_once(frame: DataFrame) -> DataFrame:
    """The frame, computed now and kept in the checkpoint folder, which outlives executors."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint()


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Is there such a folder, on whatever file system it names?"""
    files, path = _path(spark, folder)
    return files.exists(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all tables in it, such as that of a run; one that is not there is no error."""
    files, path = _path(spark, folder)
    files.delete(path, True)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    files, path = _path(spark, folder)
    return [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []


def folder_bytes(spark: SparkSession, folder: str) -> int:
    files, path = _path(spark, folder)
    return files.getContentSummary(path).getLength()


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Give a folder another name; there must be none of that name."""
    files, path = _path(spark, folder)
    if not files.rename(path, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not move {folder} to {to}")
