"""Raw tables to the final analytics table, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.config import CleanRules
from segmentry.operators.classify import Classifier, cascade, finalize_mapping
from segmentry.operators.clean import clean_campaigns, clean_reports, clean_schedules
from segmentry.operators.joins import (
    analytics, campaign_dimension, final_table, mapped_analytics, with_industry,
)


def dimension_table(
    campaigns: DataFrame, schedules: DataFrame, shapes: DataFrame, rules: CleanRules = CleanRules()
) -> DataFrame:
    return campaign_dimension(clean_campaigns(campaigns, rules), clean_schedules(schedules, rules), shapes)


def analytics_table(
    campaigns: DataFrame, schedules: DataFrame, reports: DataFrame, shapes: DataFrame, rules: CleanRules = CleanRules()
) -> DataFrame:
    return analytics(clean_reports(reports, rules), dimension_table(campaigns, schedules, shapes, rules))


def mapped_table(
    campaigns: DataFrame, schedules: DataFrame, reports: DataFrame, shapes: DataFrame, mapping: DataFrame,
    rules: CleanRules = CleanRules(),
) -> DataFrame:
    """Analytics with industry, attainment and limit type. The industry joins the campaigns, not the reports."""
    dimension = with_industry(dimension_table(campaigns, schedules, shapes, rules), mapping)
    return mapped_analytics(analytics(clean_reports(reports, rules), dimension), rules)


def final_analytics(
    campaigns: DataFrame, schedules: DataFrame, reports: DataFrame, shapes: DataFrame, mapping: DataFrame,
    rules: CleanRules = CleanRules(),
) -> DataFrame:
    return final_table(mapped_table(campaigns, schedules, reports, shapes, mapping, rules))


def industry_mapping(analytics_rows: DataFrame, classifiers: Sequence[Classifier], size: int = 100) -> DataFrame:
    """Industry of every campaign name that the classifiers could place, after at most three rounds."""
    names = analytics_rows.select("NAME").filter(F.col("NAME").isNotNull())
    return finalize_mapping(cascade(names, classifiers, size))
