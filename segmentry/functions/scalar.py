"""Column expressions used by the cleaning, testing and ranking steps. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_map(code: Column, labels: Mapping[str, Sequence[int]]) -> Column:
    """Label of a code; codes that no label lists give NULL."""
    return reduce(
        lambda expr, item: expr.when(code.isin(list(item[1])), F.lit(item[0])), labels.items(), F
    )


def quarter_label(moment: Column) -> Column:
    return F.concat(F.quarter(moment).cast("string"), F.lit("Q"))


def daypart(moment: Column) -> Column:
    hour = F.hour(moment)
    return (
        F.when(hour <= 5, "EARLY MORNING").when(hour <= 11, "MORNING")
        .when(hour <= 17, "AFTERNOON").when(hour <= 23, "EVENING")
    )


def cap_sentinel(value: Column, threshold: int, capped: int) -> Column:
    return F.when(value >= threshold, F.lit(capped).cast("long")).otherwise(value)


def safe_ratio(top: Column, bottom: Column, exact_decimal: bool = False) -> Column:
    """top / bottom, NULL for a zero denominator. `exact_decimal` keeps six decimals as fixed-point SQL does."""
    if exact_decimal:
        top, bottom = top.cast("decimal(38,0)"), bottom.cast("decimal(38,0)")
    return F.try_divide(top, bottom)


def rounded_ratio(
    top: Column, bottom: Column, digits: int, factor: int = 1, exact_decimal: bool = False
) -> Column:
    ratio = safe_ratio(top, bottom, exact_decimal)
    return F.round(ratio * factor if factor != 1 else ratio, digits)


def limit_type(goal: Column, unlimited_goal: int) -> Column:
    return F.when(goal == unlimited_goal, "UNLIMITED").when(goal != unlimited_goal, "LIMITED")


def effect_label(effect: Column) -> Column:
    return (
        F.when(effect.isNull(), F.lit(None).cast("string"))
        .when(effect < 0.01, "Very small").when(effect < 0.06, "Small")
        .when(effect < 0.14, "Medium").otherwise("Big")
    )


def replace_values(value: Column, replacements: Mapping[str, str]) -> Column:
    """Replace listed values, keep all others."""
    pairs = [F.lit(part) for item in replacements.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[value], value)


def holdout(columns: Sequence[Column], folds: int = 5) -> Column:
    """True for one row in `folds`, decided by the row's keys alone, so a rerun splits the same way."""
    return F.pmod(F.xxhash64(*columns), F.lit(folds)) == 0


def weighted_score(weights: Mapping[str, float], suffix: str = "_scaled") -> Column:
    return reduce(lambda a, b: a + b, [F.col(name + suffix) * weight for name, weight in weights.items()])
