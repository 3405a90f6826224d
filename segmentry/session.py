"""Session helpers: defaults for tests, and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("segmentry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SEGMENTRY_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else a temporary one in local mode."""
    context = spark.sparkContext
    setting = "spark.checkpoint.dir"
    folder = spark.conf.get(setting, None) or context.getConf().get(setting) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="segmentry-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


_work_folders: list[str] = []


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """Inside the block all written tables lie in one folder of the shared one, which is removed at its end.

    Keep what is to stay by writing it elsewhere before the block ends: frames that were cut inside read these tables.
    """
    path = fresh_path(spark, "work")
    _work_folders.append(path)
    try:
        yield path
    finally:
        _work_folders.remove(path)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder, or under the innermost work folder."""
    base = _work_folders[-1] if _work_folders else shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Spark settings inside the block; `__` in a name stands for a dot."""
    values = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def cut(df: DataFrame, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Write the rows once to the shared folder (or to the path) and go on from there.

    Lost executors then cost nothing that was computed before, and later steps read only the columns (and
    with `partition_by` the folders) they need.
    """
    path = path or fresh_path(df.sparkSession, "cut")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def cut_clean(df: DataFrame, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """`cut` whose shuffle files go as soon as the rows are written, not when the driver collects its garbage."""
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return cut(df, partition_by, path)
