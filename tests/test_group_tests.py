import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from segmentry.functions import normality as N
from segmentry.operators import group_tests as G

# Small samples worked by hand below with plain formulas.
SAMPLES = {
    "a": [6.9, 5.4, 5.8, 4.6, 4.0, 5.4],
    "b": [8.3, 6.8, 7.8, 9.2, 6.5],
    "c": [8.0, 10.5, 8.1, 6.9, 9.3, 9.3, 8.1],
}


def facts(spark, samples, extra=()):
    rows = [(level, float(v)) for level, values in samples.items() for v in values] + list(extra)
    return spark.createDataFrame(rows, "g string, y double")


def counts(spark, samples, extra=()):
    return G.value_counts(facts(spark, samples, extra), ["g"], ["y"])


def placed(table):
    return G.positions(G.sized_counts(table))


def moments_of(table):
    return G.group_moments(G.sized_counts(table))


def median(values):
    s, n = sorted(values), len(values)
    return (s[(n - 1) // 2] + s[n // 2]) / 2


def plain_anova(samples):
    values = [v for vs in samples.values() for v in vs]
    grand, n, k = sum(values) / len(values), len(values), len(samples)
    means = {g: sum(vs) / len(vs) for g, vs in samples.items()}
    between = sum(len(vs) * (means[g] - grand) ** 2 for g, vs in samples.items())
    within = sum((v - means[g]) ** 2 for g, vs in samples.items() for v in vs)
    return (between / (k - 1)) / (within / (n - k)), between / (between + within)


def plain_kruskal(samples):
    values = sorted(v for vs in samples.values() for v in vs)
    n = len(values)
    rank = {v: sum(1 for w in values if w < v) + (values.count(v) + 1) / 2 for v in set(values)}
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in vs) ** 2 / len(vs) for vs in samples.values()) - 3 * (n + 1)
    return h / (1 - sum(values.count(v) ** 3 - values.count(v) for v in set(values)) / (n**3 - n))


def plain_welch(samples):
    k = len(samples)
    stats = []
    for vs in samples.values():
        m = sum(vs) / len(vs)
        stats.append((len(vs), m, len(vs) / (sum((v - m) ** 2 for v in vs) / (len(vs) - 1))))
    total = sum(w for _, _, w in stats)
    centre = sum(w * m for _, m, w in stats) / total
    a = sum(w * (m - centre) ** 2 for _, m, w in stats) / (k - 1)
    lam = sum((1 - w / total) ** 2 / (n - 1) for n, _, w in stats)
    return a / (1 + 2 * (k - 2) * lam / (k * k - 1)), (k * k - 1) / (3 * lam)


def test_the_four_statistics(spark):
    table = counts(spark, SAMPLES)
    moments = moments_of(table)
    f, np2 = plain_anova(SAMPLES)
    row = G.anova(moments).first()
    assert (row.F, row.np2) == (pytest.approx(f), pytest.approx(np2))
    away = {g: [abs(v - median(vs)) for v in vs] for g, vs in SAMPLES.items()}
    assert G.levene(G.median_distances(placed(table))).first().W == pytest.approx(plain_anova(away)[0])
    f, df2 = plain_welch(SAMPLES)
    row = G.welch(moments).first()
    assert (row.F, row.df2) == (pytest.approx(f), pytest.approx(df2))
    row = G.kruskal(table).first()
    assert row.H == pytest.approx(plain_kruskal(SAMPLES))
    assert row.p_value == pytest.approx(math.exp(-row.H / 2))  # two degrees of freedom


@pytest.mark.parametrize("seed", range(3))
def test_random_samples_with_many_ties(spark, seed):
    rng = random.Random(seed)
    samples = {g: [float(rng.randint(0, 6 + i)) for _ in range(rng.randint(5, 60))] for i, g in enumerate("abcd")}
    samples["a"] += [3.0] * 200  # a third of all rows is one value of one level
    table = counts(spark, samples)
    moments = moments_of(table)
    assert G.kruskal(table).first().H == pytest.approx(plain_kruskal(samples))
    assert G.anova(moments).first().F == pytest.approx(plain_anova(samples)[0])
    assert G.welch(moments).first().F == pytest.approx(plain_welch(samples)[0])
    assert {r.level: r.median for r in G.median_distances(placed(table)).collect()} == {g: median(vs) for g, vs in samples.items()}


def test_results_do_not_depend_on_row_order(spark):
    rows = facts(spark, SAMPLES)
    one = G.run_all_tests(rows, ["g"], ["y"]).first()
    two = G.run_all_tests(rows.orderBy(F.rand(3)).repartition(5), ["g"], ["y"]).first()
    assert one.METHOD == two.METHOD and one.p_value == pytest.approx(two.p_value)
    assert 0 <= one.p_value <= 1


def test_known_shapiro_wilk_value(spark):
    sample = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    row = G.shapiro(placed(counts(spark, {"x": sample, "y": [1, 2, 3]}))).orderBy("level").collect()
    assert (row[0].statistic, row[0].p_value) == (pytest.approx(0.78881, abs=1e-5), pytest.approx(0.006704, abs=1e-6))
    assert not row[0].normal
    assert row[1].statistic is None and row[1].normal is False  # too few values to test


def exact_weights(n):
    """Weights from all normal scores, one by one."""
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    total, u = sum(x * x for x in m), 1 / math.sqrt(n)
    poly = lambda c: sum(x * u**i for i, x in enumerate(c))
    last, near = poly(N._LAST) - m[0] / math.sqrt(total), poly(N._NEXT_TO_LAST) - m[1] / math.sqrt(total)
    if n > 5:
        scale = math.sqrt((total - 2 * m[0] ** 2 - 2 * m[1] ** 2) / (1 - 2 * last**2 - 2 * near**2))
        return [-last, -near, *[x / scale for x in m[2:-2]], near, last]
    scale = math.sqrt((total - 2 * m[0] ** 2) / (1 - 2 * last**2))
    return [-last, *[x / scale for x in m[1:-1]], last]


@pytest.mark.parametrize("n", [4, 5, 6, 11, 12, 47, 48, 49, 50, 51, 1500, 5001])
def test_shapiro_weights_equal_the_single_scores(spark, n):
    expected = exact_weights(n)
    ranks = spark.range(n).select(F.lit(n).cast("long").alias("size"), F.col("id").alias("before"), F.lit(1).cast("long").alias("n"))
    single = [r.w for r in N.with_weight(ranks, "before", "n", "w").orderBy("before").collect()]
    assert single == pytest.approx(expected, abs=1e-9) and sum(w * w for w in single) == pytest.approx(1, abs=1e-9)
    runs = spark.createDataFrame([(n, b, c) for b, c in ((0, n), (1, n - 3), (n // 3, n // 2), (0, 1))], "size long, before long, n long")
    got = {(r.before, r.n): r.w for r in N.with_weight(runs, "before", "n", "w").collect()}
    assert all(w == pytest.approx(sum(expected[b : b + c]), abs=1e-8) for (b, c), w in got.items())


def test_quantile_equals_the_library_one(spark):
    ps = [1e-12, 1e-6, 0.001, 0.07, 0.075, 0.3, 0.5, 0.6, 0.925, 0.93, 0.9999, 1 - 1e-9]
    rows = N.with_quantile(spark.createDataFrame([(p,) for p in ps], "p double"), F.col("p"), "z").collect()
    assert all(r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-13, abs=1e-15) for r in rows)


def test_normal_samples_are_mostly_accepted(spark):
    rng = random.Random(5)
    samples = {f"s{i}": [rng.gauss(3, 2) for _ in range(60)] for i in range(300)}
    rejected = G.shapiro(placed(counts(spark, samples))).filter("not normal").count()
    assert 3 <= rejected <= 30


def test_no_python_in_the_plans(spark):
    """Ranks, moments, normality, tests and their tail probabilities are all columns."""
    table = counts(spark, {"a": [1.0, 2.0, 4.0, 4.0, 9.0], "b": [1.0, 2.0, 3.0, 4.0]})
    for frame in (G.shapiro(placed(table)), G.run_all_tests(facts(spark, SAMPLES), ["g"], ["y"])):
        assert "Python" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_constant_level_is_normal_and_has_no_welch_test(spark):
    table = counts(spark, {"a": [0.1] * 7, "b": [1.0, 2.0, 3.0, 4.0]})
    moments = moments_of(table)
    normal = {r.level: (r.statistic, r.normal) for r in G.shapiro(placed(table)).collect()}
    assert normal["a"] == (1.0, True)
    assert G.welch(moments).first().F is None
    assert {r.level: r.ss for r in moments.collect()}["a"] == 0


def normal_scores(n, mean, sd):
    return [mean + sd * NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]


@pytest.mark.parametrize(
    "samples, method, effect",
    [
        ({"a": normal_scores(40, 0, 1), "b": normal_scores(40, 2, 1)}, "One-way ANOVA", "eta_squared"),
        ({"a": normal_scores(40, 0, 1), "b": normal_scores(40, 2, 9)}, "Welch's ANOVA", "omega_squared"),
        ({"a": [0.0] * 30 + [9.0], "b": normal_scores(40, 2, 1)}, "Kruskal-Wallis", "epsilon_squared"),
    ],
)
def test_method_choice(spark, samples, method, effect):
    row = G.run_all_tests(facts(spark, samples), ["g"], ["y"]).first()
    assert (row.METHOD, row.EFFECT_SIZE_TYPE) == (method, effect)
    assert row.JUDGEMENT == ("REJECT" if row.p_value < 0.05 else "FAIL TO REJECT")


def test_effect_size_counts_missing_rows_on_request(spark):
    samples = {"a": [0.0] * 30 + [9.0], "b": normal_scores(40, 2, 1)}
    extra = [("a", None)] * 20 + [(None, 1.0)] * 9
    rows = facts(spark, samples, extra)
    h = plain_kruskal(samples)
    assert G.run_all_tests(rows, ["g"], ["y"]).first().effect_size == pytest.approx(h / 70)
    assert G.run_all_tests(rows, ["g"], ["y"], count_nulls=True).first().effect_size == pytest.approx(h / 99)


def test_jarque_bera(spark):
    values = [1.0, 2.0, 2.0, 3.0, 9.0, 4.0]
    row = G.jarque_bera(moments_of(counts(spark, {"a": values}))).first()
    n, m = len(values), sum(values) / 6
    m2, m3, m4 = (sum((v - m) ** p for v in values) / n for p in (2, 3, 4))
    expected = n / 6 * (m3**2 / m2**3 + (m4 / m2**2 - 3) ** 2 / 4)
    assert row.statistic == pytest.approx(expected) and row.p_value == pytest.approx(math.exp(-expected / 2))


def test_single_level_gives_no_result(spark):
    table = counts(spark, {"a": [1.0, 2.0, 3.0, 4.0]})
    assert G.kruskal(table).first().H is None
    assert G.anova(moments_of(table)).first().F is None
