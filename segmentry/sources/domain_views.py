"""The campaign domain expressed over the benchmark tables `part` and `lineitem`, for tests and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.config import INDUSTRIES

# The last word of a part name decides its industry, in the order of the industry list.
LAST_WORDS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
WORD_HINTS = {industry: [f"{word}$"] for industry, word in zip(INDUSTRIES, LAST_WORDS)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FIRST_START = 1_719_792_000  # 2024-07-01 00:00:00 UTC


def _after_first_start(days: Column, hours: Column) -> Column:
    return F.timestamp_seconds(days * 86_400 + hours * 3_600 + _FIRST_START)


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    day, hour = key % 60 * 7, key * 5 % 24
    rejoin = F.when(size % 3 == 0, "NONE").when(size % 3 == 1, "ADS_CODE_DAILY_UPDATE").otherwise("REJOINABLE")
    return table(spark, sf_dir, "part").select(
        key.alias("ADS_IDX"),
        key.alias("SCH_IDX"),
        F.col("p_name").alias("ADS_NAME"),
        F.col("p_brand").alias("ADS_SUMMARY"),
        F.col("p_type").alias("ADS_SAVE_WAY"),
        _after_first_start(day, hour).alias("ADS_SDATE"),
        _after_first_start(day + size - 3, hour).alias("ADS_EDATE"),
        (size % 10).cast("long").alias("ADS_OS_TYPE"),
        rejoin.alias("ADS_REJOIN_TYPE"),
        (size % 7 * 100).cast("long").alias("ADS_CONTRACT_PRICE"),
    )


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    goal = (
        F.when(size == 13, F.lit(None)).when(size % 7 == 1, 99_999_999).when(size % 7 == 2, 9_999_999)
        .when(size % 7 == 3, 0).otherwise(size * 10)
    )
    return table(spark, sf_dir, "part").select(
        key.alias("SCH_IDX"),
        key.alias("ADS_IDX"),
        F.when(size % 4 != 0, F.col("p_brand")).alias("MDA_IDX_ARR"),
        goal.cast("long").alias("SCH_CLK_NUM"),
        F.when(size != 17, size).cast("long").alias("SCH_TURN_NUM"),
        F.when(size % 2 == 0, "CPA").otherwise("CPC").alias("SCH_TYPE"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("RPT_TIME_DATE"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(F.lit(0), (order % 24).cast("int")))
        .alias("RPT_TIME_TIME"),
        F.col("l_partkey").alias("ADS_IDX"),
        F.col("l_suppkey").alias("MDA_IDX"),
        F.col("l_quantity").cast("long").alias("RPT_TIME_CLK"),
        F.col("l_linenumber").cast("long").alias("RPT_TIME_TURN"),
        F.floor("l_extendedprice").alias("RPT_TIME_ACOST"),
        (order % 100 * 10).alias("RPT_TIME_COST"),
        (order % 1000 * 60).alias("RPT_TIME_EARN"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    return (
        table(spark, sf_dir, "part").select(kind).distinct().filter(kind != "PROMO")
        .select(kind.alias("ADS_SAVE_WAY"), F.concat(F.lit("SHAPE_"), kind).alias("ADS_SHAPE"))
    )


def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.element_at(F.split("p_name", " "), -1)
    by_word = F.create_map(*[F.lit(x) for pair in zip(LAST_WORDS, INDUSTRIES) for x in pair])
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("NAME"), F.try_element_at(by_word, word).alias("INDUSTRY")
    ).distinct()


def answer_texts(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    """Answers of a make-believe classifier: proper lines mixed with every kind of line the parsers meet."""
    key, name, kind = F.col("p_partkey"), F.col("p_name"), F.col("p_type")
    pick = F.col("p_size") % 9
    line = (
        F.when(pick == 0, F.lit("--- | --- | ---"))
        .when(pick == 1, F.lit("ADS_IDX | NAME | INDUSTRY"))
        .when(pick == 2, F.concat_ws(" | ", key.cast("string"), name))
        .when(pick == 3, F.concat_ws(" | ", F.concat(F.lit("no "), key.cast("string")), name, kind))
        .when(pick == 4, F.concat_ws(" | ", key.cast("string"), name, kind, F.lit("sure")))
        .when(pick == 5, F.concat(key.cast("string"), F.lit(" | "), name, F.lit(" |  ")))
        .otherwise(F.concat_ws(" | ", key.cast("string"), name, kind))
    )
    rows = table(spark, sf_dir, "part").select(F.floor(key / size).alias("batch"), key.alias("k"), line.alias("line"))
    lines = F.array_join(F.sort_array(F.collect_list(F.struct("k", "line")))["line"], "\n")
    return rows.groupBy("batch").agg(lines.alias("answer"))
