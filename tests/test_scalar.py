import datetime as dt
import math

import plain_tails
import pytest
from pyspark.sql import functions as F

from segmentry import config as C
from segmentry.functions import scalar, special, text


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in rows.select("i", expr(F.col("v")).alias("r")).orderBy("i").collect()]


def test_code_map_leaves_unknown_codes_empty(spark):
    got = column(spark, [1, 2, 3, 7, 8, 0, 4, None], "long", lambda c: scalar.code_map(c, C.OS_CODES))
    assert got == ["IOS", "ANDROID", "ANDROID", "WEB", "ANDROID", None, None, None]


def test_quarters_and_dayparts_at_their_edges(spark):
    days = [dt.datetime(2025, m, d) for m, d in [(1, 1), (3, 31), (4, 1), (6, 30), (7, 1), (9, 30), (10, 1), (12, 31)]]
    assert column(spark, days, "timestamp", scalar.quarter_label) == ["1Q", "1Q", "2Q", "2Q", "3Q", "3Q", "4Q", "4Q"]
    hours = [dt.datetime(2025, 1, 1, h, 59) for h in (0, 5, 6, 11, 12, 17, 18, 23)]
    assert column(spark, hours, "timestamp", scalar.daypart) == [
        "EARLY MORNING", "EARLY MORNING", "MORNING", "MORNING", "AFTERNOON", "AFTERNOON", "EVENING", "EVENING"
    ]
    assert column(spark, [None], "timestamp", scalar.daypart) == [None]


def test_sentinel_and_limit_type(spark):
    goals = [99_999_998, 99_999_999, 100_000_000, 9_999_999, 100_000, 5, None]
    capped = column(spark, goals, "long", lambda c: scalar.cap_sentinel(c, 99_999_999, 100_000))
    assert capped == [99_999_998, 100_000, 100_000, 9_999_999, 100_000, 5, None]
    assert column(spark, [100_000, 7, None], "long", lambda c: scalar.limit_type(c, 100_000)) == [
        "UNLIMITED", "LIMITED", None
    ]


def test_ratio_of_zero_denominator_is_null(spark):
    rows = spark.createDataFrame([(3, 4), (3, 0), (None, 4), (2, 3)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    got = rows.select(scalar.safe_ratio(a, b).alias("r"), scalar.rounded_ratio(a, b, 2).alias("q")).collect()
    assert [tuple(r) for r in got] == [(0.75, 0.75), (None, None), (None, None), (2 / 3, 0.67)]


def test_exact_decimal_ratio_keeps_six_decimals(spark):
    rows = spark.createDataFrame([(2, 3), (1, 7)], "a long, b long")
    got = rows.select(scalar.rounded_ratio(F.col("a"), F.col("b"), 4, 1000, True).cast("double").alias("r")).collect()
    assert [r.r for r in got] == [666.667, 142.857]


def test_effect_labels_at_their_edges(spark):
    got = column(spark, [0.0099, 0.01, 0.0599, 0.06, 0.1399, 0.14, None], "double", scalar.effect_label)
    assert got == ["Very small", "Small", "Small", "Medium", "Medium", "Big", None]


def test_replace_keeps_unlisted_values(spark):
    got = column(spark, ["쇼핑", "게임", None], "string", lambda c: scalar.replace_values(c, C.INDUSTRY_SYNONYMS))
    assert got == ["커머스/유통", "게임", None]


def test_holdout_depends_on_the_keys_only(spark):
    rows = spark.range(5000).withColumn("flag", scalar.holdout([F.col("id")]))
    again = spark.range(5000).repartition(7).withColumn("flag", scalar.holdout([F.col("id")]))
    assert rows.exceptAll(again).isEmpty()
    assert 0.17 < rows.filter("flag").count() / 5000 < 0.23


def test_text_helpers(spark):
    assert column(spark, [" \t a b \n"], "string", text.strip) == ["a b"]
    assert column(spark, ["a|b||", "", "x"], "string", text.separators) == [3, 0, 0]
    assert column(spark, ["12", "", "1a", "-1"], "string", text.all_digits) == [True, False, False, False]
    assert column(spark, ["/x/y.d/a.tar.CSV", "/x/plain"], "string", text.extension) == [".csv", ""]
    assert column(spark, ["/x/y.d/a_b.csv", "/x/plain"], "string", text.base_name) == ["a_b", "plain"]


@pytest.mark.parametrize(
    "got, expected",
    [
        (plain_tails.f_tail(5, 2, 100), 0.0085185512795),
        (plain_tails.chi2_tail(3.841458820694124, 1), 0.05),
        (plain_tails.chi2_tail(18.307038053275146, 10), 0.05),
        (plain_tails.normal_tail(1.6448536269514722), 0.05),
        (plain_tails.f_tail(0, 2, 10), 1.0),
        (plain_tails.chi2_tail(2.0, 2), math.exp(-1)),
        (plain_tails.chi2_tail(60.0, 2), math.exp(-30)),
    ],
)
def test_tail_probabilities(got, expected):
    assert got == pytest.approx(expected, rel=1e-10)


def test_tails_fall_as_the_statistic_grows():
    for df in (1, 3, 30):
        tails = [plain_tails.chi2_tail(x / 4, df) for x in range(1, 400)]
        assert tails == sorted(tails, reverse=True)
        assert all(0 <= t <= 1 for t in tails)


def test_p_value_columns_pass_nulls(spark):
    rows = spark.createDataFrame([(2.0, 2.0), (None, 2.0)], "s double, d double")
    got = [r.p for r in rows.select(special.chi2_p(F.col("s"), F.col("d")).alias("p")).collect()]
    assert got == [pytest.approx(math.exp(-1)), None]


def test_tail_columns_equal_the_plain_ones(spark):
    """Small, large and extreme parameters, where the sides of the functions meet, and infinities."""
    cases = [(s, d1, d2) for s in (0.0, 1e-9, 0.3, 0.99, 1.0, 1.01, 2.5, 7.0, 40.0, 900.0) for d1 in (1.0, 2.0, 7.0) for d2 in (1.0, 3.5, 60.0, 4e3, 6e5)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s double, a double, b double").select(
        "i", special.f_p(F.col("s"), F.col("a"), F.col("b")).alias("f"), special.chi2_p(F.col("s"), F.col("a")).alias("c"),
        special.chi2_p(F.col("s") * F.col("b"), F.col("b")).alias("g"), special.normal_p(F.col("s") - 2).alias("z"),
    )
    for r in rows.collect():
        s, a, b = cases[r.i]
        assert r.f == pytest.approx(plain_tails.f_tail(s, a, b), rel=2e-6, abs=1e-300), (s, a, b)  # the plain one loses digits near 1
        assert r.c == pytest.approx(plain_tails.chi2_tail(s, a), rel=1e-9, abs=1e-300), (s, a)
        assert r.g == pytest.approx(plain_tails.chi2_tail(s * b, b), rel=1e-6, abs=1e-12), (s, b)
        assert r.z == pytest.approx(plain_tails.normal_tail(s - 2), rel=1e-9, abs=1e-300), s


def test_tails_at_infinity_and_log_gamma(spark):
    inf = F.lit(float("inf"))
    row = spark.range(1).select(
        special.f_p(inf, F.lit(2.0), F.lit(9.0)).alias("f"), special.normal_p(inf).alias("high"), special.normal_p(-inf).alias("low"),
        *[special.log_gamma(F.lit(x)).alias(str(i)) for i, x in enumerate((0.5, 1.0, 3.5, 200.0, 3e5))],
    ).first()
    assert row[:3] == (0.0, 0.0, 1.0)
    assert row[3:] == pytest.approx([math.lgamma(x) for x in (0.5, 1.0, 3.5, 200.0, 3e5)], rel=1e-13, abs=1e-13)
