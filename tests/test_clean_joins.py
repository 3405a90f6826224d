import datetime as dt

import pytest
from pyspark.sql import functions as F

from segmentry import config as C
from segmentry.operators import clean, joins
from segmentry.plans import campaign_table

DAY = dt.datetime(2025, 2, 3, 6)


def campaign(key, name="n", way="W", start=DAY, end=DAY, os=1, rejoin="NONE", price=10, sch=None):
    return (key, sch or key, name, f"guide {key}", way, start, end, os, price, rejoin)


CAMPAIGN = (
    "ADS_IDX long, SCH_IDX long, ADS_NAME string, ADS_SUMMARY string, ADS_SAVE_WAY string, ADS_SDATE timestamp, "
    "ADS_EDATE timestamp, ADS_OS_TYPE long, ADS_CONTRACT_PRICE long, ADS_REJOIN_TYPE string"
)
SCHEDULE = "SCH_IDX long, ADS_IDX long, MDA_IDX_ARR string, SCH_CLK_NUM long, SCH_TURN_NUM long, SCH_TYPE string"
REPORT = (
    "RPT_TIME_DATE date, RPT_TIME_TIME timestamp, ADS_IDX long, MDA_IDX long, RPT_TIME_CLK long, RPT_TIME_TURN long, "
    "RPT_TIME_ACOST long, RPT_TIME_COST long, RPT_TIME_EARN long"
)


def report(key, clk=10, turn=4, acost=100, earn=50, media=1, hour=0):
    return (dt.date(2025, 3, 1), dt.datetime(2025, 3, 1, hour), key, media, clk, turn, acost, 5, earn)


def test_campaign_filters(spark):
    first = dt.datetime(2024, 7, 27)
    rows = [
        campaign(1),
        campaign(2, start=DAY, end=DAY - dt.timedelta(seconds=1)),
        campaign(3, start=first, end=first),
        campaign(4, start=first - dt.timedelta(seconds=1)),
        campaign(5, price=0),
        campaign(6, price=None),
        campaign(7, end=None),
    ]
    got = clean.clean_campaigns(spark.createDataFrame(rows, CAMPAIGN))
    assert sorted(r.KEY for r in got.collect()) == [1, 3]
    row = got.filter("KEY = 1").first()
    assert (row.OS_TYPE, row.START_QUARTER, row.START_TIME, row.GUIDE) == ("IOS", "1Q", "MORNING", "guide 1")


def test_schedule_rules(spark):
    rows = [
        (1, 1, None, 99_999_999, 5, "CPA"), (2, 2, "[1]", 9_999_999, 5, "CPA"), (3, 3, "[2]", 10, None, "CPC"),
        (4, 4, "[3]", None, 5, "CPC"), (5, 5, "[4]", 0, 5, "CPC"), (6, 6, "[5]", 100_000_000, 5, "CPC"),
    ]
    got = clean.clean_schedules(spark.createDataFrame(rows, SCHEDULE)).orderBy("KEY").collect()
    assert [(r.KEY, r.MDA_ARR, r.TURN_GOAL) for r in got] == [(1, "ALL", 100_000), (5, "[4]", 0), (6, "[5]", 100_000)]


def test_report_filters_and_ratios(spark):
    rows = [
        report(1, 3, 2, 7, 7), report(2, 3, 4), report(3, acost=10, earn=11), report(4, clk=None), report(5, turn=None),
        report(6, 0, 0, 0, 0), report(7, acost=None),
    ]
    got = clean.clean_reports(spark.createDataFrame(rows, REPORT)).orderBy("KEY").collect()
    assert [(r.KEY, r.CVR, r["1000_W_EFFICIENCY"]) for r in got] == [(1, 0.67, 285.7143), (6, None, None)]


def test_column_subset_falls_back_to_all(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert clean.keep_columns(df, ["b", "z"]).columns == ["B"]
    assert clean.keep_columns(df, ["y", "z"]).columns == ["a", "B"]


def test_positional_rename_checks_the_count(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.rename_by_position(df, ["x", "y"]).first().y == 2
    with pytest.raises(ValueError):
        clean.rename_by_position(df, ["x"])


def tables(spark, hot=400):
    """One campaign holds most reports; a shape and a schedule repeat, so joins fan out; some keys match nothing."""
    campaigns = [
        campaign(1, "a", "W1"), campaign(2, "b", "W2"), campaign(3, "c", "none"), campaign(4, "d", "W1", os=9),
        campaign(5, "e", "W1", sch=77), campaign(6, None, "W1"), campaign(7, "g", "W1", rejoin=None),
    ]
    schedules = [
        (1, 1, None, 10, 5, "CPA"), (1, 9, "[1]", 99_999_999, 3, "CPC"), (2, 2, "[2]", 0, 5, "CPA"),
        (5, 5, "[3]", 10, 5, "CPA"), (7, 7, "[3]", 10, 5, "CPA"), (2, 2, "[9]", 20, 5, None),
    ]
    shapes = [("W1", "S1"), ("W1", "S1b"), ("W2", "S2")]
    reports = [report(1, media=i % 3, hour=i % 24) for i in range(hot)]
    reports += [report(key, media=key) for key in range(2, 10)] + [report(2, acost=0, earn=0), report(None)]
    mapping = [("a", "게임"), ("b", "서비스"), ("zz", "게임")]
    return (
        spark.createDataFrame(campaigns, CAMPAIGN), spark.createDataFrame(schedules, SCHEDULE),
        spark.createDataFrame(reports, REPORT), spark.createDataFrame(shapes, "ADS_SAVE_WAY string, ADS_SHAPE string"),
        spark.createDataFrame(mapping, "NAME string, INDUSTRY string"),
    )


def literal_joins(campaigns, schedules, reports, shapes):
    """Left joins and the filter afterwards, in the order in which the result is defined."""
    shaped = joins.with_shape(clean.clean_campaigns(campaigns), shapes)
    schedule = clean.clean_schedules(schedules).drop("KEY")
    joined = clean.clean_reports(reports).join(shaped, "KEY", "left").join(schedule, "SCH_KEY", "left")
    return joined.dropna(subset=C.REQUIRED_REPORT + C.REQUIRED_CAMPAIGN + C.REQUIRED_SCHEDULE)


def test_analytics_equals_the_literal_joins(spark):
    campaigns, schedules, reports, shapes, _ = tables(spark)
    dimension = campaign_table.dimension_table(campaigns, schedules, shapes)
    got = joins.analytics(clean.clean_reports(reports), dimension)
    expected = literal_joins(campaigns, schedules, reports, shapes).select(got.columns)
    assert got.count() == 400 * 4 + 1
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_industry_on_campaigns_equals_industry_on_the_table(spark):
    campaigns, schedules, reports, shapes, mapping = tables(spark, 30)
    got = campaign_table.mapped_table(campaigns, schedules, reports, shapes, mapping)
    table = campaign_table.analytics_table(campaigns, schedules, reports, shapes)
    late = joins.mapped_analytics(joins.with_industry(table, mapping)).select(got.columns)
    assert got.exceptAll(late).isEmpty() and late.exceptAll(got).isEmpty()
    assert {(r.KEY, r.LIMIT_TYPE, r.ATS) for r in got.collect()} == {
        (1, "LIMITED", 0.5), (1, "UNLIMITED", 3 / 100_000), (2, "LIMITED", None)
    }


def test_final_table_has_the_fixed_columns(spark):
    got = campaign_table.final_analytics(*tables(spark, 3))
    assert got.columns == C.FINAL_COLUMNS
    assert all(dict(got.dtypes)[c] == "double" for c in C.FLOAT_COLUMNS)


def test_a_hot_campaign_is_split_when_the_dimension_is_too_large(spark):
    """Two thirds of the reports belong to one campaign; adaptive execution cuts its partition up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keys = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id")).alias("KEY"),
            *[F.lit(1).cast("long").alias(c) for c in ["TIME_CLK", "TIME_TURN", "ADV_COST", "1000_W_EFFICIENCY"]],
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dimension = spark.range(60_000).select(F.col("id").alias("KEY"), F.col("id").alias("x"))
        got = joins.analytics(keys, dimension)
        assert len(got.collect()) == 60_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_newest_first_spreads_one_hour_over_tasks(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("KEY"), F.lit(dt.date(2025, 1, 1)).alias("DATE"),
        F.when(F.col("id") < 20, F.lit(None)).otherwise(F.lit(DAY)).cast("timestamp").alias("TIME"),
    )
    ordered = joins.newest_first(rows)
    first = [r.KEY for r in ordered.limit(20).collect()]
    assert sorted(first) == list(range(20))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in joins.newest_first(rows).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 20_000 and max(sizes) < 15_000
