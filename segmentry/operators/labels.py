"""Segment labels: which factors to keep, the numbered product of their categories, the label of a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def factor_decisions(results: DataFrame, min_results: int = 3, strict_effect: bool = True) -> DataFrame:
    """Per factor: is it kept? Every test must reject and, if strict, no effect may be very small.

    The original compares the effect label in another letter case and so never drops a factor for it;
    `strict_effect=False` gives that result.
    """
    impact = F.upper("JUDGEMENT_EFFECT_SIZE") != "VERY SMALL" if strict_effect else F.lit(True)
    return results.groupBy("IV").agg(
        F.count(F.lit(1)).alias("n_results"),
        F.bool_and(F.col("JUDGEMENT") == "REJECT").alias("all_rejected"),
        F.bool_and(impact).alias("all_impactful"),
    ).withColumn(
        "kept", (F.col("n_results") >= min_results) & F.col("all_rejected") & F.col("all_impactful")
    )


def kept_levels(decisions: DataFrame, levels: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Category lists of the kept factors, in the order of `levels`. One row per factor reaches the driver."""
    kept = {row.IV for row in decisions.filter("kept").select("IV").collect()}
    return {factor: list(values) for factor, values in levels.items() if factor in kept}


def _strides(levels: Mapping[str, Sequence[str]]) -> dict[str, int]:
    strides, step = {}, 1
    for factor in reversed(list(levels)):
        strides[factor] = step
        step *= len(levels[factor])
    return strides


def label_map(spark: SparkSession, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """All combinations of categories with their label; the last factor varies fastest."""
    total = 1
    for values in levels.values():
        total *= len(values)
    strides = _strides(levels)
    label = F.col("id")
    columns = [
        F.element_at(
            F.array(*map(F.lit, values)), (F.floor(label / strides[factor]) % len(values) + 1).cast("int")
        ).alias(factor)
        for factor, values in levels.items()
    ]
    return spark.range(total).select(*columns, label.alias("MASTER_LABEL"))


def label_of(levels: Mapping[str, Sequence[str]]) -> Column:
    """Label by arithmetic on the position of each category: no join. An unlisted category gives NULL."""

    def digit(factor: str, values: Sequence[str]) -> Column:
        position = F.array_position(F.array(*map(F.lit, values)), F.col(factor))
        return F.when(position > 0, position - 1)

    strides = _strides(levels)
    terms = [digit(factor, values) * strides[factor] for factor, values in levels.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(0).cast("long"))


def attach_label(facts: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    return facts.withColumn("MASTER_LABEL", label_of(levels))
