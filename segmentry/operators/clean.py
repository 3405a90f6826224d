"""Cleaning of the three raw tables: rename, derive, filter. One scan each, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.config import CleanRules
from segmentry.functions.scalar import cap_sentinel, code_map, daypart, quarter_label, rounded_ratio


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL in the columns, as plain tests that reach the file scan."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(f"`{name}`").isNotNull() for name in columns]))


def clean_campaigns(raw: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    start = F.col("ADS_SDATE")
    return raw.filter(
        (start <= F.col("ADS_EDATE")) & (start >= F.lit(rules.first_start)) & (F.col("ADS_CONTRACT_PRICE") != 0)
    ).select(
        F.col("ADS_IDX").alias("KEY"),
        F.col("SCH_IDX").alias("SCH_KEY"),
        F.col("ADS_NAME").alias("NAME"),
        F.col("ADS_SAVE_WAY").alias("SAVE_WAY"),
        F.col("ADS_SUMMARY").alias("GUIDE"),
        code_map(F.col("ADS_OS_TYPE"), rules.os_codes).alias("OS_TYPE"),
        F.col("ADS_REJOIN_TYPE").alias("REJOIN_TYPE"),
        F.col("ADS_CONTRACT_PRICE").alias("CONTRACT_PRICE"),
        start.alias("START_DATE"),
        F.col("ADS_EDATE").alias("END_DATE"),
        quarter_label(start).alias("START_QUARTER"),
        daypart(start).alias("START_TIME"),
    )


def clean_schedules(raw: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    goal = F.col("SCH_CLK_NUM")
    return (
        require(raw, ["SCH_CLK_NUM", "SCH_TURN_NUM"])
        .filter(goal != rules.dropped_goal)
        .select(
            F.col("ADS_IDX").alias("KEY"),
            F.col("SCH_IDX").alias("SCH_KEY"),
            F.col("SCH_TYPE").alias("RPT_TYPE"),
            F.coalesce(F.col("MDA_IDX_ARR"), F.lit(rules.all_media)).alias("MDA_ARR"),
            cap_sentinel(goal, rules.unlimited_from, rules.unlimited_goal).alias("TURN_GOAL"),
            F.col("SCH_TURN_NUM").alias("TURN_REAL"),
        )
    )


def clean_reports(raw: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    clicks, turns, cost = F.col("RPT_TIME_CLK"), F.col("RPT_TIME_TURN"), F.col("RPT_TIME_ACOST")
    return (
        require(raw, ["RPT_TIME_CLK", "RPT_TIME_TURN"])
        .filter((clicks >= turns) & (cost >= F.col("RPT_TIME_EARN")))
        .select(
            F.col("ADS_IDX").alias("KEY"),
            F.col("MDA_IDX").alias("MDA"),
            F.col("RPT_TIME_DATE").alias("DATE"),
            F.col("RPT_TIME_TIME").alias("TIME"),
            clicks.alias("TIME_CLK"),
            turns.alias("TIME_TURN"),
            cost.alias("ADV_COST"),
            F.col("RPT_TIME_COST").alias("REWARD_COST"),
            F.col("RPT_TIME_EARN").alias("MDA_COST"),
            rounded_ratio(turns, clicks, 2, exact_decimal=rules.exact_decimal).alias("CVR"),
            rounded_ratio(turns, cost, 4, 1000, rules.exact_decimal).alias("1000_W_EFFICIENCY"),
        )
    )


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist; keep all when none does. Names match in any letter case."""
    present = {name.lower(): name for name in df.columns}
    found = [present[name.lower()] for name in wanted if name.lower() in present]
    return df.select(found or df.columns)


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def cast_columns(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    return df.withColumns({name: F.col(f"`{name}`").cast(kind) for name in columns})
