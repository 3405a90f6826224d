import itertools
import random

import pytest
from pyspark.sql import functions as F

from segmentry import config as C
from segmentry.operators import labels, rank

LEVELS = {k: C.FACTOR_LEVELS[k] for k in ["OS_TYPE", "START_QUARTER", "LIMIT_TYPE"]}


def test_label_map_is_the_row_major_product(spark):
    got = labels.label_map(spark, LEVELS).orderBy("MASTER_LABEL").collect()
    expected = list(itertools.product(*LEVELS.values()))
    assert [tuple(r)[:3] for r in got] == expected
    assert [r.MASTER_LABEL for r in got] == list(range(len(expected)))


def test_label_by_arithmetic_equals_the_map(spark):
    table = labels.label_map(spark, C.FACTOR_LEVELS)
    assert table.count() == 576
    assert labels.attach_label(table.withColumnRenamed("MASTER_LABEL", "expected"), C.FACTOR_LEVELS).filter(
        "MASTER_LABEL is null or MASTER_LABEL <> expected"
    ).isEmpty()


def test_unlisted_category_has_no_label(spark):
    df = spark.createDataFrame([("WEB", "1Q", "LIMITED"), ("TV", "1Q", "LIMITED"), (None, "1Q", "LIMITED")], list(LEVELS))
    assert [r.MASTER_LABEL for r in labels.attach_label(df, LEVELS).collect()] == [1, None, None]


def test_no_factor_gives_one_label(spark):
    assert [r.MASTER_LABEL for r in labels.attach_label(spark.range(2), {}).collect()] == [0, 0]
    assert [tuple(r) for r in labels.label_map(spark, {}).collect()] == [(0,)]


RESULTS = [
    *[("INDUSTRY", "REJECT", "Small")] * 3,
    *[("OS_TYPE", "REJECT", "Big")] * 2, ("OS_TYPE", "FAIL TO REJECT", "Big"),
    *[("LIMIT_TYPE", "REJECT", "Big")] * 2,
    *[("START_QUARTER", "REJECT", "Small")] * 2, ("START_QUARTER", "REJECT", "Very small"),
]


@pytest.mark.parametrize("strict, kept", [(True, ["INDUSTRY"]), (False, ["INDUSTRY", "START_QUARTER"])])
def test_factor_selection(spark, strict, kept):
    results = spark.createDataFrame(RESULTS, "IV string, JUDGEMENT string, JUDGEMENT_EFFECT_SIZE string")
    decisions = labels.factor_decisions(results, strict_effect=strict)
    assert list(labels.kept_levels(decisions, C.FACTOR_LEVELS)) == kept


def predictions(spark, rows):
    return spark.createDataFrame(
        rows, "GMM_CLUSTER int, SHAPE string, MDA string, START_TIME string, Pred_CVR double, Pred_EFF double, Pred_ATS double"
    )


def test_scaling_is_per_cluster_and_constants_give_zero(spark):
    rows = [(0, "s", "1", "t", 0.0, 5.0, 1.0), (0, "s", "2", "t", 1.0, 5.0, 2.0), (0, "s", "3", "t", 4.0, 5.0, 3.0),
            (1, "s", "1", "t", 9.0, 1.0, 1.0)]
    got = rank.scale_0_100(predictions(spark, rows)).orderBy("GMM_CLUSTER", "MDA").collect()
    assert [(r.CVR_scaled, r.EFF_scaled, r.ATS_scaled) for r in got] == [
        (0, 0, 0), (25, 0, 50), (100, 0, 100), (0, 0, 0)
    ]


def test_scores_ranks_and_ties(spark):
    rng = random.Random(2)
    rows = [
        (c, f"s{i % 3}", str(i), "t", rng.choice([0.0, 0.5, 1.0]), rng.random(), rng.random())
        for c, n in ((0, 40), (1, 4)) for i in range(n)
    ] + [(2, "s", str(i), "t", 1.0, 1.0, 1.0) for i in range(12)]
    top = rank.top_conditions(rank.scale_0_100(predictions(spark, rows)))
    for (cluster, goal), group in itertools.groupby(
        sorted(top.collect(), key=lambda r: (r.GMM_CLUSTER, r.goal, r.Rank)), key=lambda r: (r.GMM_CLUSTER, r.goal)
    ):
        group = list(group)
        assert [r.Rank for r in group] == list(range(1, {0: 10, 1: 4, 2: 10}[cluster] + 1))
        assert [r.score for r in group] == sorted((r.score for r in group), reverse=True)
        w = C.GOALS[goal]
        assert all(
            r.score == pytest.approx(r.CVR_scaled * w["CVR"] + r.EFF_scaled * w["EFF"] + r.ATS_scaled * w["ATS"])
            and 0 <= r.score <= 100 + 1e-9 for r in group
        )
        if cluster == 2:
            assert [r.MDA for r in group] == sorted(str(i) for i in range(12))[:10]


def test_master_table_labels_every_goal(spark):
    rows = [(0, "s", str(i), "t", float(i), float(-i), 0.0) for i in range(3)]
    master = rank.master_table(rank.top_conditions(rank.scale_0_100(predictions(spark, rows))))
    assert {r.Metric_Type: r["count"] for r in master.groupBy("Metric_Type").count().collect()} == {
        "이익": 3, "비용": 3, "안정성": 3
    }
    assert master.columns == [
        "GMM_CLUSTER", "SHAPE", "MDA", "START_TIME", "Pred_CVR", "Pred_EFF", "Pred_ATS", "CVR_scaled", "EFF_scaled",
        "ATS_scaled", "score", "Rank", "Metric_Type",
    ]


def test_nothing_in_nothing_out(spark):
    assert rank.top_conditions(rank.scale_0_100(predictions(spark, []))).count() == 0


def test_conditions_are_distinct_text_and_clustered(spark):
    df = spark.createDataFrame(
        [(0, "s", 5, "t"), (0, "s", 5, "t"), (1, "s", 5, "t"), (None, "s", 5, "t")],
        "GMM_CLUSTER int, SHAPE string, MDA long, START_TIME string",
    )
    assert sorted(tuple(r) for r in rank.distinct_conditions(df).collect()) == [(0, "s", "5", "t"), (1, "s", "5", "t")]
