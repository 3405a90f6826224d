"""Every query with SQL next to it gives the SQL's rows; every other one gives rows."""

import pytest

import __spark_entry__ as spark_entry
import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).take(1)


@pytest.mark.parametrize("name", ["analytics_final", "segment_summary", "label_means", "clean_reports"])
def test_building_a_plan_starts_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"plan-{name}", name)
    try:
        frame = QUERIES[name](spark, SF)
        built = [j for j in tracker.getJobIdsForGroup(f"plan-{name}") if "parquet at" not in spark.sparkContext._jsc.sc().statusStore().job(j).name()]
        assert built == []
        assert frame.columns
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["INDUSTRY", "OS_TYPE", "START_QUARTER", "n", "avg_cvr", "avg_efficiency", "avg_ats"]
    assert frame.count() == 30
