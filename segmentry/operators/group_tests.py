"""Do the levels of a factor differ in a measure? Normality, equal variances, three tests, effect sizes.

All factor x measure tests run together. One pass over the facts counts equal values; everything after it
works on these counts, which are as many as there are distinct values, not as there are rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions.normality import shapiro_z, with_weight
from segmentry.functions.scalar import effect_label
from segmentry.functions.special import chi2_p, f_p, normal_p
from segmentry.operators.ordering import running_total, weighted_points
from segmentry.session import cut

TEST = ["factor", "measure"]
GROUP = ["factor", "measure", "level"]


def _unpivot(names: Sequence[str], name_as: str, value_as: str, kind: str) -> Column:
    pairs = [
        F.struct(F.lit(name).alias(name_as), F.col(f"`{name}`").cast(kind).alias(value_as)) for name in names
    ]
    return F.inline(F.array(*pairs))


def value_counts(facts: DataFrame, factors: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(factor, level, measure, value) -> n, checkpointed. Levels and values that are NULL are counted too.

    The facts are first merged over all factors and the value (in each task, before the shuffle); only the
    merged rows are repeated per factor.
    """
    merged = (
        facts.select(*factors, _unpivot(measures, "measure", "value", "double"))
        .groupBy(*factors, "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    by_factor = merged.select("measure", "value", "n", _unpivot(factors, "factor", "level", "string"))
    return cut(by_factor.groupBy(*GROUP, "value").agg(F.sum("n").alias("n")))


def _valid(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("level").isNotNull() & F.col("value").isNotNull())


def sized_counts(counts: DataFrame) -> DataFrame:
    """Valid value counts with the size and the mean of their level.

    A level of one repeated value has exactly that mean, and so no spread.
    """
    valid = _valid(counts)
    low, high = F.min("value"), F.max("value")
    weighted = F.sum(F.col("n") * F.col("value")) / F.sum("n")
    levels = valid.groupBy(*GROUP).agg(
        F.sum("n").alias("size"), F.when(low == high, low).otherwise(weighted).alias("mean")
    )
    return valid.join(levels, GROUP)


def group_moments(sized: DataFrame) -> DataFrame:
    """Per level: size, mean, and the sums of the second to fourth powers around the mean."""
    n, away = F.col("n"), F.col("value") - F.col("mean")
    return sized.groupBy(*GROUP).agg(
        F.first("size").alias("size"),
        F.first("mean").alias("mean"),
        F.sum(n * away * away).alias("ss"),
        F.sum(n * away * away * away).alias("cubes"),
        F.sum(n * away * away * away * away).alias("quartics"),
    )


def positions(sized: DataFrame, points: Sequence | None = None) -> DataFrame:
    """Sized counts with the number of smaller values in the same level (`before`), stored for reuse."""
    points = weighted_points(sized, "value") if points is None else points
    return cut(running_total(sized, GROUP, "value", "n", points))


def median_distances(placed: DataFrame) -> DataFrame:
    """Per level: size, exact median, and the sums of the distances from it and of their squares."""
    low, high = F.floor((F.col("size") + 1) / 2), F.floor(F.col("size") / 2) + 1
    end, value, n = F.col("before") + F.col("n"), F.col("value"), F.col("n")
    middle = [
        F.max(F.when((F.col("before") < at) & (end >= at), value)) for at in (low, high)
    ]
    medians = placed.groupBy(*GROUP).agg(((middle[0] + middle[1]) / 2).alias("median"))
    distance = F.abs(value - F.col("median"))
    return placed.join(medians, GROUP).groupBy(*GROUP).agg(
        F.first("size").alias("size"),
        F.first("median").alias("median"),
        F.sum(n * distance).alias("distance"),
        F.sum(n * distance * distance).alias("distance_ss"),
    )


def _one_way(moments: DataFrame, mean: Column, ss: Column) -> DataFrame:
    """F statistic of one-way ANOVA from group sizes, means and sums of squares."""
    groups = moments.select(*TEST, "size", mean.alias("m"), ss.alias("ss"))
    overall = groups.groupBy(*TEST).agg((F.sum(F.col("size") * F.col("m")) / F.sum("size")).alias("grand"))
    off = F.col("m") - F.col("grand")
    # One row per test, and the tests are a parameter list.
    sums = groups.join(F.broadcast(overall), TEST).groupBy(*TEST).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("size").alias("n"),
        F.sum(F.col("size") * off * off).alias("ss_between"),
        F.sum("ss").alias("ss_within"),
    )
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    between = F.try_divide(F.col("ss_between"), df1)
    within = F.try_divide(F.col("ss_within"), df2)
    return sums.withColumns(
        {
            "df1": df1.cast("double"),
            "df2": df2.cast("double"),
            "F": F.try_divide(between, within),
            "np2": F.try_divide(F.col("ss_between"), F.col("ss_between") + F.col("ss_within")),
        }
    )


def anova(moments: DataFrame) -> DataFrame:
    """One-way ANOVA with partial eta squared."""
    table = _one_way(moments, F.col("mean"), F.col("ss"))
    return table.withColumn("p_value", f_p(F.col("F"), F.col("df1"), F.col("df2")))


def levene(distances: DataFrame) -> DataFrame:
    """Levene's test around the median: one-way ANOVA of the distances from it."""
    size, total = F.col("size"), F.col("distance")
    ss = F.greatest(F.col("distance_ss") - total * total / size, F.lit(0.0))
    table = _one_way(distances, total / size, ss).withColumnRenamed("F", "W")
    return table.withColumn("p_value", f_p(F.col("W"), F.col("df1"), F.col("df2"))).drop("np2")


def welch(moments: DataFrame) -> DataFrame:
    """Welch's ANOVA, for unequal variances. NULL when a level has no variance."""
    variance = F.try_divide(F.col("ss"), F.col("size") - 1)
    groups = moments.select(*TEST, "size", "mean", F.try_divide(F.col("size"), variance).alias("w"))
    overall = groups.groupBy(*TEST).agg(
        F.sum("w").alias("w_sum"), F.sum(F.col("w") * F.col("mean")).alias("wm_sum")
    )
    off = F.col("mean") - F.col("wm_sum") / F.col("w_sum")
    share = 1 - F.col("w") / F.col("w_sum")
    sums = groups.join(F.broadcast(overall), TEST).groupBy(*TEST).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("size").alias("n"),
        F.bool_and(F.col("w").isNotNull()).alias("usable"),
        F.sum(F.col("w") * off * off).alias("between"),
        F.sum(share * share / (F.col("size") - 1)).alias("lam"),
    )
    k = F.col("k").cast("double")
    top = F.try_divide(F.col("between"), k - 1)
    statistic = top / (1 + 2 * (k - 2) * F.col("lam") / (k * k - 1))
    return sums.select(
        *TEST, "k", "n",
        (k - 1).alias("df1"),
        F.when(F.col("usable"), F.try_divide(k * k - 1, 3 * F.col("lam"))).alias("df2"),
        F.when(F.col("usable") & (k > 1), statistic).alias("F"),
    ).withColumn("p_value", f_p(F.col("F"), F.col("df1"), F.col("df2")))


def average_ranks(counts: DataFrame, points: Sequence | None = None) -> DataFrame:
    """Value counts with the average rank of the value among all values of the test."""
    valid = _valid(counts)
    ranked = running_total(valid, TEST, "value", "n", weighted_points(valid, "value") if points is None else points)
    return ranked.withColumn("rank", F.col("before") + (F.col("tied") + 1) / 2)


def kruskal(counts: DataFrame, ranks: DataFrame | None = None) -> DataFrame:
    """Kruskal-Wallis H, corrected for ties."""
    ranks = average_ranks(counts) if ranks is None else ranks
    # One row per test, and the tests are a parameter list.
    sizes = F.broadcast(_valid(counts).groupBy(*TEST).agg(F.sum("n").cast("double").alias("total")))
    tied, n = F.col("tied").cast("double"), F.col("n")
    by_level = ranks.join(sizes, TEST).groupBy(*GROUP).agg(
        F.sum("n").alias("size"),
        F.first("total").alias("total"),
        F.sum(n * (F.col("rank") - (F.col("total") + 1) / 2)).alias("off"),
        F.sum(n * (tied * tied - 1)).alias("ties"),
    )
    total = F.col("total")
    raw = 12 / (total * (total + 1)) * F.col("spread")
    correction = 1 - F.col("ties") / (total * total * total - total)
    return (
        by_level.groupBy(*TEST)
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("size").alias("n"),
            F.first("total").alias("total"),
            F.sum(F.col("off") * F.col("off") / F.col("size")).alias("spread"),
            F.sum("ties").alias("ties"),
        )
        .select(
            *TEST, "k", "n",
            (F.col("k") - 1).cast("double").alias("df"),
            F.when(F.col("k") > 1, F.try_divide(raw, correction)).alias("H"),
        )
        .withColumn("p_value", chi2_p(F.col("H"), F.col("df")))
    )


def _verdict(table: DataFrame, p_value: Column, is_normal: Column) -> DataFrame:
    """Levels under four values cannot be tested and count as not normal."""
    testable = F.col("size") > 3
    return table.withColumns(
        {
            "statistic": F.when(testable, F.col("statistic")),
            "p_value": F.when(testable, p_value),
            "normal": testable & is_normal,
        }
    )


def shapiro(placed: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk test per level.

    It follows the published approximation, which was fitted up to 5,000 values and is extrapolated beyond.
    """
    away = F.col("value") - F.col("mean")
    weighted = with_weight(placed.select(*GROUP, "n", "size", "before", away.alias("away")), "before", "n", "weight")
    fit = F.sum(F.col("weight") * F.col("away"))
    spread = F.sum(F.col("n") * F.col("away") * F.col("away"))
    # A level of one repeated value fits perfectly.
    statistic = F.when(spread > 0, F.least(fit * fit / F.nullif(spread, F.lit(0.0)), F.lit(1.0))).otherwise(1.0)
    table = weighted.groupBy(*GROUP).agg(F.first("size").alias("size"), statistic.alias("statistic"))
    table = table.withColumn("z", F.when(F.col("size") > 3, shapiro_z(F.col("statistic"), F.col("size"))))
    critical = NormalDist().inv_cdf(1 - alpha)  # the verdict needs no tail probability
    return _verdict(table, normal_p(F.col("z")), F.col("z") < critical).drop("z")


def jarque_bera(moments: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera test per level, for levels of any size."""
    size, variance = F.col("size"), F.col("ss") / F.col("size")
    skew = F.try_divide(F.col("cubes") / size, F.pow(variance, 1.5))
    excess = F.try_divide(F.col("quartics") / size, variance * variance) - 3
    statistic = size / 6 * (skew * skew + excess * excess / 4)
    table = moments.select(*GROUP, "size", F.coalesce(statistic, F.lit(0.0)).alias("statistic"))
    p_value = F.exp(-F.col("statistic") / 2)
    return _verdict(table, p_value, p_value > alpha)


def effect_sizes(kruskal_table: DataFrame, welch_table: DataFrame, anova_table: DataFrame) -> DataFrame:
    """Epsilon, omega and eta squared per test, with the valid rows as n."""
    h, f, d, n = F.col("H"), F.col("wF"), F.col("wdf1"), F.col("n")
    gain = d * (f - 1)
    return (
        kruskal_table.select(*TEST, "n", "H")
        .join(welch_table.select(*TEST, F.col("F").alias("wF"), F.col("df1").alias("wdf1")), TEST)
        .join(anova_table.select(*TEST, "np2"), TEST)
        .select(
            *TEST, "n",
            F.try_divide(h, n - 1).alias("epsilon_squared"),
            F.greatest(F.try_divide(gain, gain + n), F.lit(0.0)).alias("omega_squared"),
            F.col("np2").alias("eta_squared"),
        )
    )


def run_all_tests(
    facts: DataFrame,
    factors: Sequence[str],
    measures: Sequence[str],
    alpha: float = 0.05,
    count_nulls: bool = False,
    normality: str = "shapiro",
) -> DataFrame:
    """One result per factor and measure; the test is chosen by normality and equality of variances.

    `count_nulls` lets rows with a missing level or value count in the effect sizes, as the original does.
    """
    if normality not in ("shapiro", "jarque_bera"):
        raise ValueError(f"unknown normality test: {normality}")
    counts = value_counts(facts, factors, measures)
    points = weighted_points(_valid(counts), "value")
    placed = positions(sized_counts(counts), points)
    moments = group_moments(placed)
    by_level = shapiro(placed, alpha) if normality == "shapiro" else jarque_bera(moments, alpha)
    normal = by_level.groupBy(*TEST).agg(F.bool_and("normal").alias("is_normal"))
    equal = levene(median_distances(placed)).select(*TEST, (F.col("p_value") > 0.05).alias("is_equal"))
    n_rows = (counts if count_nulls else _valid(counts)).groupBy(*TEST).agg(F.sum("n").alias("rows"))
    ranks = average_ranks(counts, points)
    table = (
        kruskal(counts, ranks).select(*TEST, "H", F.col("p_value").alias("p_k"))
        .join(
            welch(moments).select(
                *TEST, F.col("F").alias("w_f"), F.col("df1").alias("w_df"), F.col("p_value").alias("p_w")
            ), TEST,
        )
        .join(anova(moments).select(*TEST, "np2", F.col("p_value").alias("p_a")), TEST)
        .join(normal, TEST)
        .join(equal, TEST)
        .join(n_rows, TEST)
    )
    gain = F.col("w_df") * (F.col("w_f") - 1)
    picked = F.when(~F.col("is_normal"), "K").when(~F.coalesce(F.col("is_equal"), F.lit(False)), "W").otherwise("A")

    def by_method(k, w, a):
        return F.when(F.col("picked") == "K", k).when(F.col("picked") == "W", w).otherwise(a)

    p_value = by_method(F.col("p_k"), F.col("p_w"), F.col("p_a"))
    effect = by_method(
        F.try_divide(F.col("H"), F.col("rows") - 1),
        F.greatest(F.try_divide(gain, gain + F.col("rows")), F.lit(0.0)),
        F.col("np2"),
    )
    return table.withColumn("picked", picked).select(
        F.col("factor").alias("IV"),
        F.col("measure").alias("DV"),
        by_method(F.lit("Kruskal-Wallis"), F.lit("Welch's ANOVA"), F.lit("One-way ANOVA")).alias("METHOD"),
        by_method(F.lit("epsilon_squared"), F.lit("omega_squared"), F.lit("eta_squared")).alias("EFFECT_SIZE_TYPE"),
        F.when(p_value < alpha, "REJECT").otherwise("FAIL TO REJECT").alias("JUDGEMENT"),
        effect_label(effect).alias("JUDGEMENT_EFFECT_SIZE"),
        p_value.alias("p_value"),
        effect.alias("effect_size"),
    )
