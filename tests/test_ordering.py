import random

import pytest
from pyspark.sql import functions as F

from segmentry.operators import ordering


@pytest.mark.parametrize("seed", range(4))
def test_running_total_against_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("ab"), rng.choice([0.0, -1.5, rng.gauss(0, 5)]), rng.randint(1, 9)) for _ in range(300)
    ] + [("a", 0.25, 1000)] * 100
    df = spark.createDataFrame(rows, "k string, v double, w long")
    got = ordering.running_total(df, ["k"], "v", "w", ordering.split_points(df, "v", 7)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.before == sum(w for k, v, w in rows if k == r.k and v < r.v)
        assert r.tied == sum(w for k, v, w in rows if k == r.k and v == r.v)


def test_split_points_do_not_depend_on_partitions(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).alias("v"))
    points = ordering.split_points(df, "v", 16)
    assert points == ordering.split_points(df.repartition(13), "v", 16)
    sizes = ordering.with_piece(df.distinct(), "v", points, "p").groupBy("p").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 5000 / 16 * 2.5


def test_weighted_points_part_rows_evenly_on_skewed_values(spark):
    """The lowest tenth of 2,000 values has nine tenths of the rows, none more than a piece."""
    copies = F.when(F.col("id") < 200, 162).otherwise(2)
    df = spark.range(2000).select((F.col("id") * F.col("id") / 7).alias("v"), F.explode(F.sequence(F.lit(1), copies)).alias("c"))
    points = ordering.weighted_points(df, "v", 16)
    sizes = sorted(r["count"] for r in ordering.with_piece(df, "v", points, "p").groupBy("p").count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    distinct = ordering.with_piece(df, "v", ordering.split_points(df, "v", 16), "p").groupBy("p").count().collect()
    assert max(r["count"] for r in distinct) > 4 * sizes[-1]


def test_weighted_points_of_nothing_and_of_one_value(spark):
    assert ordering.weighted_points(spark.createDataFrame([(None,)], "v double"), "v", 4) == []
    assert ordering.weighted_points(spark.range(9).select(F.lit(2.0).alias("v")), "v", 4) == [2.0]
    assert ordering.weighted_points(spark.range(9), "id", 1) == []


@pytest.mark.parametrize("n_points", [0, 1, 2, 3, 7, 8, 9, 100])
def test_piece_is_the_number_of_points_not_above(spark, n_points):
    points = [i * 3 for i in range(n_points)]
    got = ordering.with_piece(spark.range(-2, 320), "id", points, "p").collect()
    assert all(r.p == sum(1 for x in points if x <= r.id) for r in got)


def test_split_points_of_nothing(spark):
    empty = spark.createDataFrame([], "NAME string")
    assert ordering.split_points(empty, "NAME", 4) == []
    assert ordering.dense_ids(empty, "NAME", "id").count() == 0


def test_dense_ids_are_1_to_n_in_name_order(spark):
    names = [f"{p}{i}" for i in range(700) for p in ("[정답입력]", "a ", "Z")] * 2 + [None]
    df = spark.createDataFrame([(n,) for n in names], "NAME string")
    got = {r.NAME: r.id for r in ordering.dense_ids(df, "NAME", "id").collect()}
    expected = sorted({n for n in names if n}, key=lambda n: n.encode())
    assert got == {n: i + 1 for i, n in enumerate(expected)}


def test_batches_are_full_except_the_last(spark):
    batches = ordering.batch_numbers(ordering.dense_ids(spark.range(250), "id", "n"), "n", 100)
    sizes = {r.batch: r["count"] for r in batches.groupBy("batch").count().collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}


def test_keep_first_and_last_with_hot_copies(spark):
    rows = [("hot", 1, "x")] * 500 + [("hot", 2, "y"), ("hot", 0, None), ("b", 5, "z"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    last = {tuple(r) for r in ordering.keep_last(df, ["k"], ["o"]).collect()}
    first = {tuple(r) for r in ordering.keep_first(df, ["k"], ["o"]).collect()}
    assert last == {("hot", 2, "y"), ("b", 5, "z"), (None, 2, "m")}
    assert first == {("hot", 0, None), ("b", 5, "z"), (None, 1, "n")}


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("g"), F.col("id"), (F.col("id") % 10).alias("s"))
    top = ordering.top_per_group(df, ["g"], [F.desc("s"), F.asc("id")], 4)
    assert [r.id for r in top.filter("g").orderBy("Rank").collect()] == [9, 39, 69, 99]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
