"""Shapiro-Wilk weights and statistic (Royston 1995) for values that were already counted per distinct value.

All on columns. A run of equal values needs the sum of the weights over its ranks. The outermost `ENDS` normal scores
of a sample are added up; the sums in between follow from the integral of the normal quantile function with two
Euler-Maclaurin terms, which agrees with the single scores to nine digits, whatever the size of the sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENDS = 24

# Polynomial coefficients of Royston (1995), lowest power first.
_LAST = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
_NEXT_TO_LAST = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SMALL_MEAN = (0.544, -0.39978, 0.025054, -6.714e-4)
_SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
_LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)
_SMALL_BOUND = (-2.273, 0.459)

# Rational approximation of the normal quantile (Wichura 1988), lowest power first.
_CENTRE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457,
     67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867,
     39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
_NEAR_TAIL = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590,
     0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_FAR_TAIL = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 7.86869131145613259100e-4,
     1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _poly(coefficients: Sequence[float], x: Column) -> Column:
    return reduce(lambda value, c: value * x + c, reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def _ratio(parts: tuple[Sequence[float], Sequence[float]], x: Column) -> Column:
    return _poly(parts[0], x) / _poly(parts[1], x)


def with_quantile(df: DataFrame, p: Column, out: str) -> DataFrame:
    """Add the standard normal quantile of a probability between 0 and 1."""
    away, root = F.col("_away"), F.col("_root")
    tail = F.when(root <= 5, _ratio(_NEAR_TAIL, root - 1.6)).otherwise(_ratio(_FAR_TAIL, root - 5))
    return (
        df.withColumn("_p", p).withColumn("_away", F.col("_p") - 0.5)
        .withColumn("_root", F.sqrt(-F.ln(F.least(F.col("_p"), 1 - F.col("_p")))))
        .withColumn(out, F.when(F.abs(away) <= 0.425, away * _ratio(_CENTRE, 0.180625 - away * away)).otherwise(F.signum(away) * tail))
        .drop("_p", "_away", "_root")
    )


def _density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def _place(rank: Column, n: Column) -> Column:
    """Probability at which the expected value of a rank lies."""
    return (rank - 0.375) / (n + 0.25)


def _score_integral(z: Column, n: Column) -> Column:
    """Sum of the scores of all ranks up to a bound between two ranks whose quantile is z, up to a constant."""
    step = 1 / ((n + 0.25) * _density(z))
    return -(n + 0.25) * _density(z) - step / 24 + 7 / 5760 * (1 + 2 * z * z) * step * step * step


def score_table(sizes: DataFrame) -> DataFrame:
    """Per sample size `size` (4 or more): prefix sums of the outer scores, and what turns scores into weights."""
    n = F.col("size")
    ends = F.least(F.lit(ENDS), F.floor(n / 2)).cast("int")
    ranks = sizes.select("size").distinct().filter("size > 3").select("size", ends.alias("ends"))
    single = with_quantile(ranks.select("*", F.explode(F.sequence(F.lit(1), "ends")).alias("rank")), _place(F.col("rank"), n), "score")
    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"])
    table = single.groupBy("size", "ends").agg(scores.alias("scores"))
    table = with_quantile(table, _place(F.col("ends") + 0.5, n), "edge")
    edge, big = F.col("edge"), n + 0.25
    step = 1 / (big * _density(edge))
    outer = 2 * F.aggregate("scores", F.lit(0.0), lambda total, s: total + s * s)
    middle = (
        n - 2 * F.col("ends") + 2 * big * edge * _density(edge) + edge * step / 6
        - 7 / 1440 * edge * (4 + 2 * edge * edge) * step * step * step
    )
    prefix = F.transform(
        F.sequence(F.lit(0), "ends"), lambda i: F.aggregate(F.slice("scores", 1, i), F.lit(0.0), lambda total, s: total + s)
    )
    table = table.withColumn("squares", outer + F.when(n > 2 * F.col("ends") + 1, middle).otherwise(0.0))
    first, second, squares = F.col("scores")[0], F.col("scores")[1], F.col("squares")
    u, has_second = 1 / F.sqrt(n.cast("double")), n > 5
    last = _poly(_LAST, u) - first / F.sqrt(squares)
    next_to_last = F.when(has_second, _poly(_NEXT_TO_LAST, u) - second / F.sqrt(squares))
    table = table.withColumn("last", last).withColumn("next", next_to_last)
    outside = 2 * first * first + F.when(has_second, 2 * second * second).otherwise(0.0)
    left = 1 - 2 * F.col("last") * F.col("last") - F.when(has_second, 2 * F.col("next") * F.col("next")).otherwise(0.0)
    table = table.withColumn("scale", F.sqrt((squares - outside) / left))
    return table.select(
        "size", "ends", "scale", prefix.alias("prefix"), _score_integral(edge, n).alias("from_edge"),
        (F.col("last") + first / F.col("scale")).alias("gap_1"),
        F.when(has_second, F.col("next") + second / F.col("scale")).otherwise(0.0).alias("gap_2"),
    )


def with_weight(placed: DataFrame, before: str, count: str, out: str) -> DataFrame:
    """Add the summed weights of the ranks before+1 .. before+count of a sample of `size`; zero for samples under four."""
    n, begin, end = F.col("size"), F.col(before), F.col(before) + F.col(count)
    columns = placed.columns
    # One row per sample size.
    table = placed.join(score_table(placed), "size", "left")
    for name, rank in ("_begin", begin), ("_end", end):
        inner = F.col(f"{name}_rank")  # the scores are antisymmetric
        table = with_quantile(
            table.withColumn(f"{name}_rank", F.least(rank, n - rank)), _place(F.greatest(inner, F.lit(1)) + 0.5, n), f"{name}_z"
        )
        total = F.when(inner <= F.col("ends"), F.get("prefix", inner.cast("int"))).otherwise(
            F.get("prefix", F.col("ends")) + _score_integral(F.col(f"{name}_z"), n) - F.col("from_edge")
        )
        table = table.withColumn(name, total)
    weight = (F.col("_end") - F.col("_begin")) / F.col("scale")
    for rank in 1, 2:
        gap = F.col(f"gap_{rank}")
        weight = weight - F.when((begin < rank) & (end >= rank), gap).otherwise(0.0)
        weight = weight + F.when((begin < n + 1 - rank) & (end >= n + 1 - rank), gap).otherwise(0.0)
    return table.withColumn(out, F.coalesce(weight, F.lit(0.0))).select(*columns, out)


def shapiro_z(w: Column, n: Column) -> Column:
    """Standard normal value of W for samples of 4 or more; large values speak against normality."""
    size, y = n.cast("double"), F.log1p(-w)
    x, bound = F.ln(size), _poly(_SMALL_BOUND, size)
    small = (-F.ln(bound - y) - _poly(_SMALL_MEAN, size)) / F.exp(_poly(_SMALL_LOG_SD, size))
    large = (y - _poly(_LARGE_MEAN, x)) / F.exp(_poly(_LARGE_LOG_SD, x))
    impossible = F.lit(float("inf"))
    return F.when(w >= 1, -impossible).when(n > 11, large).when(y >= bound, impossible).otherwise(small)
