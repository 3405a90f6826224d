import re

import pytest
from pyspark.sql import functions as F

from segmentry.sources.keyed import Keyed, hot_keys


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed"))
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("KEY"), F.col("id").alias("v"))
    facts = facts.unionByName(facts.limit(5).withColumn("KEY", F.lit(None).cast("long")))
    dimension = spark.range(500).select(F.col("id").alias("KEY"), (F.col("id") % 5).alias("kind")).filter("KEY % 11 <> 3")
    return facts, dimension, Keyed.store(facts, "keyed_facts", "KEY", 8, path), Keyed.store(dimension, "keyed_dimension", "KEY", 8, path, hot=[])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_kept_apart(spark, stored):
    facts, _, kept, dimension = stored
    assert hot_keys(facts, "KEY", 8) == [7] and kept.hot_values == [7] and dimension.hot_values == []
    assert kept.hot.count() == facts.filter("KEY = 7").count() and kept.even.filter("KEY = 7").isEmpty()
    assert sorted(map(str, kept.rows().collect())) == sorted(map(str, facts.collect()))


def test_join_and_sums_by_key_need_no_shuffle_of_the_facts(spark, stored):
    facts, dimension, kept, kept_dimension = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = kept.join(kept_dimension)
        assert "SortMergeJoin" in plan(joined.even) and "Exchange" not in plan(joined.even)
        sums = joined.map(lambda df: df.filter("v % 2 = 0")).aggregate(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
        assert "Exchange" not in re.split("Union", plan(joined.even.groupBy("KEY").agg(F.sum("v"))))[0]
        assert plan(sums).count("Exchange hashpartitioning") == 1  # the partial sums of the hot keys
        expected = facts.join(dimension, "KEY").filter("v % 2 = 0").groupBy("KEY").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
        assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, expected.collect()))
        again = Keyed.open(spark, "keyed_facts", "KEY").join(Keyed.open(spark, "keyed_dimension", "KEY"))
        assert again.rows().count() == facts.join(dimension, "KEY").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_empty_facts(spark, tmp_path):
    kept = Keyed.store(spark.range(0).withColumnRenamed("id", "KEY"), "keyed_none", "KEY", 4, str(tmp_path))
    assert kept.rows().isEmpty() and kept.join(kept).rows().isEmpty()
