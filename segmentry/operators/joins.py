"""Joins of campaigns, shapes, schedules, reports and industries.

The dimension side is assembled first, so the reports are joined (and at worst shuffled) once. Adaptive execution
broadcasts a side whose real size is small and otherwise splits hot campaigns; building a plan starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.config import (
    FINAL_COLUMNS, FLOAT_COLUMNS, REQUIRED_CAMPAIGN, REQUIRED_REPORT, REQUIRED_SCHEDULE, CleanRules,
)
from segmentry.functions.scalar import limit_type, safe_ratio
from segmentry.operators.clean import cast_columns, require

def with_shape(campaigns: DataFrame, shapes: DataFrame) -> DataFrame:
    """Add SHAPE by SAVE_WAY. Campaigns without a shape are dropped, repeated shapes multiply rows."""
    lookup = shapes.select(F.col("ADS_SAVE_WAY").alias("SAVE_WAY"), F.col("ADS_SHAPE").alias("SHAPE"))
    return campaigns.join(lookup, "SAVE_WAY").select(*campaigns.columns, "SHAPE")


def campaign_dimension(campaigns: DataFrame, schedules: DataFrame, shapes: DataFrame) -> DataFrame:
    """Everything known about a campaign, ready for one join with the reports.

    Left joins whose right side must not be NULL afterwards keep the rows of inner joins, and inner joins
    may be taken in any order.
    """
    schedule = require(schedules, REQUIRED_SCHEDULE).select(
        "SCH_KEY", "RPT_TYPE", "MDA_ARR", "TURN_GOAL", "TURN_REAL"
    )
    shaped = with_shape(require(campaigns, REQUIRED_CAMPAIGN), shapes)
    return shaped.join(schedule, "SCH_KEY").select(
        *campaigns.columns, "SHAPE", "RPT_TYPE", "MDA_ARR", "TURN_GOAL", "TURN_REAL"
    )


def analytics(reports: DataFrame, dimension: DataFrame) -> DataFrame:
    """Reports with their campaign, schedule and shape; rows with a missing required value are dropped."""
    facts = require(reports, REQUIRED_REPORT)
    return facts.join(dimension, "KEY").select(*reports.columns, *[c for c in dimension.columns if c != "KEY"])


def with_industry(dimension: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add INDUSTRY by NAME to a table that has NAME (campaigns, or the analytics table itself)."""
    return dimension.join(mapping.select("NAME", "INDUSTRY"), "NAME").select(*dimension.columns, "INDUSTRY")


def mapped_analytics(table: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Attainment and limit type from the goal, which is then dropped."""
    goal = F.col("TURN_GOAL")
    return table.withColumns(
        {
            "ATS": safe_ratio(F.col("TURN_REAL"), goal, rules.exact_decimal),
            "LIMIT_TYPE": limit_type(goal, rules.unlimited_goal),
        }
    ).drop("TURN_GOAL", "TURN_REAL")


def final_table(mapped: DataFrame) -> DataFrame:
    """The 28 output columns, measures as double."""
    return cast_columns(mapped.select(FINAL_COLUMNS), FLOAT_COLUMNS, "double")


def newest_first(table: DataFrame) -> DataFrame:
    """Output order of the analytics tables; use it in front of a sink only.

    The input partition is the last sort key, so rows of one busy hour can be sorted by many tasks.
    """
    return (
        table.withColumn("_part", F.spark_partition_id())
        .orderBy(F.desc_nulls_first("DATE"), F.desc_nulls_first("TIME"), "_part")
        .drop("_part")
    )
