"""Readers for raw files, intermediate files, tables and the run log."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry.functions.text import base_name
from segmentry.operators.clean import keep_columns
from segmentry.sources.split_csv import csv_rows, text_lines
from segmentry.sources.writers import live_versions, run_versions, runs_folder, write_csv

_BAD_LINE = "_bad_line"


def _csv(spark: SparkSession, pattern: str | None, check_header: bool, multi_line: bool):
    reader = (
        spark.read.option("header", True).option("escape", '"').option("nullValue", "\\N")
        .option("columnPruning", False)
        .option("enforceSchema", not check_header).option("multiLine", multi_line)
    )
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _parse_all(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Make every column needed, so a bad cell is seen whatever a query selects. The test holds for all rows."""
    return df.filter(F.xxhash64(*schema.names) >= F.lit(-(2**63)))


def _without_halves(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Mark lines with an odd number of quotes in a cell: halves of a cell with a line break look like that."""
    texts = [F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema.fields if isinstance(f.dataType, T.StringType)]
    odd = [F.length(F.regexp_replace(t, '[^"]', "")) % 2 == 1 for t in texts]
    is_half = reduce(lambda a, b: a | b, odd, F.lit(False))
    line = F.to_csv(F.struct(*schema.names), {"escape": '"', "nullValue": "\\N"})
    return lines.withColumn(_BAD_LINE, F.coalesce(F.col(_BAD_LINE), F.when(is_half, line)))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _is_data(schema: T.StructType, check_header: bool) -> Column:
    """True for rows that are no header; a header with other names ends the read."""
    names = [f.name.lower() for f in schema.fields]
    cells = F.from_csv(
        F.regexp_replace("value", "^\ufeff", ""), ", ".join(f"c{i} string" for i in range(len(names))) + ", rest string",
        {"escape": '"', "columnNameOfCorruptRecord": "rest"},
    )
    fits = cells["rest"].isNull()
    for i, name in enumerate(names):
        fits = fits & F.lower(cells[f"c{i}"]).eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit(f"CSV header does not conform to the schema ({', '.join(schema.names)}): "), F.col("value")))
    return F.when(~F.col("is_first"), True).when(fits if check_header else F.lit(True), False).otherwise(wrong.cast("boolean"))


def _parsed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str | None, check_header: bool, mode: str,
    marked: bool, extra: Sequence[str] = (),
) -> DataFrame:
    """Rows of split files, parsed once each: what a query selects or filters out stays behind the generator."""
    rows = csv_rows(spark, path, pattern).filter(_is_data(schema, check_header))
    options = {"escape": '"', "nullValue": "\\N", "multiLine": "true", "mode": mode, "columnNameOfCorruptRecord": _BAD_LINE}
    ddl = _ddl(_marked_schema(schema) if marked else schema)
    return rows.select(*extra, F.inline(F.array(F.from_csv("value", ddl, options))))


def _marked_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BAD_LINE, T.StringType())])


def read_marked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str | None = None,
    check_header: bool = True, multi_line: bool | None = None,
) -> DataFrame:
    """All rows; those that do not fit the schema carry their text in `_bad_line`.

    Columns match by position. `check_header` fails the read if a file's header names differ from the
    schema, instead of loading shifted columns. Files are split over tasks, and quoted line breaks are part of their
    cell (see `split_csv`). With `multi_line=True` Spark's own reader takes each file in one task; with
    `multi_line=False` every line is a row, and a line with an odd number of quotes in a cell is a bad line.
    """
    if multi_line is None:
        return _parsed(spark, path, schema, pattern, check_header, "PERMISSIVE", True)
    lines = (
        _csv(spark, pattern, check_header, multi_line).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_LINE).schema(_marked_schema(schema)).csv(path)
    )
    if not multi_line:
        lines = _without_halves(lines, schema)
    return _parse_all(lines, schema)


def read_lenient(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """Rows that fit the schema; bad lines are skipped."""
    return read_marked(spark, path, schema, **options).filter(F.col(_BAD_LINE).isNull()).drop(_BAD_LINE)


def read_rejects(
    spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str | None = None,
    check_header: bool = True, multi_line: bool | None = None,
) -> DataFrame:
    """The lines that `read_lenient` skips: file, text, and the columns that could be parsed."""
    if multi_line is None:
        rows = _parsed(spark, path, schema, pattern, check_header, "PERMISSIVE", True, ["file_name"])
    else:
        rows = read_marked(spark, path, schema, pattern, check_header, multi_line).withColumn("file_name", F.col("_metadata.file_name"))
    return rows.filter(F.col(_BAD_LINE).isNotNull()).select(F.col("file_name").alias("file"), F.col(_BAD_LINE).alias("line"), *schema.names)


def read_strict(
    spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str | None = None,
    check_header: bool = True, multi_line: bool | None = None,
) -> DataFrame:
    """Fails on the first line that does not fit the schema."""
    if multi_line is None:
        return _parsed(spark, path, schema, pattern, check_header, "FAILFAST", False)
    rows = _csv(spark, pattern, check_header, multi_line).option("mode", "FAILFAST").schema(schema).csv(path)
    return _parse_all(rows, schema)


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    """File name without folder and extension of every row."""
    return df.withColumn(out, base_name(F.col("_metadata.file_path")))


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select([F.col(f"`{c}`") for c in columns]) if columns else df


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with the names of the first file's header line, all columns as text, split over tasks.

    The header must be one line without quoted commas.
    """
    header = text_lines(spark, path).select("value").first()
    names = header.value.removeprefix("\ufeff").rstrip("\r").split(",") if header else []
    schema = T.StructType([T.StructField(name.strip('"'), T.StringType()) for name in names])
    return read_marked(spark, path, schema, check_header=False).drop(_BAD_LINE)


@dataclass(frozen=True)
class Source:
    """One named input table."""

    path: str
    kind: str = "parquet"
    schema: T.StructType | None = None


def load_source(spark: SparkSession, source: Source) -> DataFrame:
    if source.kind == "csv":
        return read_lenient(spark, source.path, source.schema)
    return spark.read.parquet(source.path)


def register_sources(spark: SparkSession, sources: Mapping[str, Source]) -> None:
    """Make every source available as a view of its name."""
    for name, source in sources.items():
        load_source(spark, source).createOrReplaceTempView(name)


def intake_files(
    spark: SparkSession, folder: str, names: Sequence[str], out_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Copy the listed CSV files to `out_dir`, keeping the wanted columns. One status row per file.

    A file that is missing, of another kind, or fails does not stop the others.
    """
    rows = []
    for name in names:
        stem, kind = os.path.splitext(os.path.basename(name))
        if kind != ".csv":
            rows.append((name, "unsupported", 0))
            continue
        try:
            raw = read_texts(spark, f"{folder}/{name}")
            kept = keep_columns(raw, columns) if columns else raw
            write_csv(kept, f"{out_dir}/{stem}")
            rows.append((name, "copied", len(kept.columns)))
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            rows.append((name, "missing" if missing else "failed", 0))
        except PySparkException:
            rows.append((name, "failed", 0))
    return spark.createDataFrame(rows, "file string, status string, n_columns int")


def read_runs(spark: SparkSession, path: str, experiment: str) -> DataFrame:
    """Runs of one experiment that count now; only the folders of its live versions are read."""
    live = F.broadcast(live_versions(run_versions(spark, path, experiment)))  # one row per call of a writer
    rows = spark.read.option("mergeSchema", True).parquet(runs_folder(path, experiment))
    return rows.join(live, "version", "left_semi").drop("version")
