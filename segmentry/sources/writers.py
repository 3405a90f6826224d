"""Writers: CSV and parquet unloads, one folder per key, numbered batches, and the run log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _csv(df: DataFrame):
    """Quotes are doubled, breaks and spaces stay as they are, empty text is quoted and NULL is \\N: all can be read back."""
    options = {
        "header": True, "escape": '"', "nullValue": "\\N", "emptyValue": '""', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    return df.write.mode("overwrite").options(**options)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, a file per task; what was there is replaced."""
    _csv(df).csv(path)


def unload_csv(df: DataFrame, path: str) -> None:
    """Uncompressed CSV for a warehouse."""
    _csv(df).option("compression", "none").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Materialise a model as a catalogue table, replacing an earlier one; `path` places its files."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def split_by_key(df: DataFrame, path: str, key: str) -> None:
    """One folder per key value. Rows of a key are brought together in parts of a size, so a large key is written by
    many tasks and a small one in few files."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)


def write_batches(df: DataFrame, path: str, batch: str = "batch") -> None:
    """One folder, with one file, per numbered batch. Batches are small by construction."""
    df.repartition(F.col(batch)).write.mode("overwrite").option("header", True).option("escape", '"').partitionBy(
        batch
    ).csv(path)


def reset(df: DataFrame, path: str) -> None:
    """Empty a written dataset before a rerun; its schema stays readable."""
    df.limit(0).write.mode("overwrite").parquet(path)


_VERSIONS = "kind string, replaced array<string>, version string"


def runs_folder(path: str, experiment: str) -> str:
    return f"{path}/experiment={quote(experiment, safe='')}"


def run_versions(spark: SparkSession, path: str, experiment: str) -> DataFrame:
    """The versions of an experiment: `version`, `kind` (append, replace), `replaced` (versions merged into it)."""
    return spark.read.schema(_VERSIONS).parquet(f"{runs_folder(path, experiment)}/_versions")


def _commit(runs: DataFrame, path: str, experiment: str, version: str, kind: str, replaced: Sequence[str] = ()) -> None:
    """Write the rows into a folder of their own, then make them count by a row in a second folder of its own: writers
    that share a folder would share, and remove, each other's unfinished files."""
    folder = runs_folder(path, experiment)
    runs.write.parquet(f"{folder}/version={version}")
    row = runs.sparkSession.createDataFrame([(kind, list(replaced))], "kind string, replaced array<string>").coalesce(1)
    row.write.parquet(f"{folder}/_versions/version={version}")


def _new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def append_runs(runs: DataFrame, path: str, experiment: str) -> None:
    """Add runs (parameters, metrics, or metrics by step) to the log of an experiment.

    A log is only ever added to: each call writes a version of its own, so writers at the same time lose nothing, and
    a reader sees a version whole or not at all. Versions are ordered by the clock of the writer.
    """
    _commit(runs, path, experiment, _new_version(), "append")


def replace_runs(runs: DataFrame, path: str, experiment: str) -> None:
    """A version that hides all earlier ones of the experiment; other experiments in the log are kept."""
    _commit(runs, path, experiment, _new_version(), "replace")


def live_versions(versions: DataFrame) -> DataFrame:
    """`version` of the versions that count: from the last replacement on, and not merged into another."""
    every = versions.groupBy(F.lit(1).alias("log")).agg(
        F.collect_list("version").alias("every"), F.flatten(F.collect_list("replaced")).alias("merged"),
        F.max(F.when(F.col("kind") == "replace", F.col("version"))).alias("last"),
    )
    counts = "filter(every, v -> (last IS NULL OR v >= last) AND NOT array_contains(merged, v))"
    return every.select(F.explode(F.expr(counts)).alias("version"))


def compact_runs(spark: SparkSession, path: str, experiment: str) -> int:
    """Merge the live versions of an experiment into one with few files; versions written meanwhile stay beside it.

    The merged version takes the place of the newest one it holds. Returns the number of versions merged.
    """
    versions = run_versions(spark, path, experiment)
    live = sorted(row.version for row in live_versions(versions).collect())  # one row per call of a writer
    if len(live) < 2:
        return 0
    kinds = {row.kind for row in versions.filter(F.col("version").isin(live)).select("kind").collect()}
    folder = runs_folder(path, experiment)
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{folder}/version={v}" for v in live])
    kind = "replace" if "replace" in kinds else "append"
    _commit(rows.hint("rebalance"), path, experiment, f"{live[-1]}+{uuid.uuid4().hex[:8]}", kind, live)
    return len(live)


def vacuum_runs(spark: SparkSession, path: str, experiment: str) -> int:
    """Delete the rows of versions that no longer count. Only when no reader of an older state is left. Returns how many."""
    versions = run_versions(spark, path, experiment)
    dead = versions.select("version").join(live_versions(versions), "version", "left_anti")
    removed = 0
    for row in dead.collect():  # one row per call of a writer
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{runs_folder(path, experiment)}/version={row.version}")
        removed += place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return removed


def log_rows(
    rows: DataFrame, keys: Sequence[str], metrics: Sequence[str] = (), texts: Sequence[str] = (), step: str | None = None
) -> DataFrame:
    """Rows of any table in the one shape of the run log: `run`, `metric`, `step`, `value`, `text`."""
    number, word = F.lit(None).cast("double"), F.lit(None).cast("string")
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), word.alias("text")) for m in metrics]
    pairs += [F.struct(F.lit(t).alias("metric"), number.alias("value"), F.col(t).cast("string").alias("text")) for t in texts]
    at = F.col(step).cast("int") if step else F.lit(None).cast("int")
    return rows.select(F.concat_ws("/", *keys).alias("run"), at.alias("step"), F.inline(F.array(*pairs)))


def unpivot_metrics(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long run log: one row per metric."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return runs.select(*keys, F.inline(F.array(*pairs)))
