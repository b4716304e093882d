from strider.operators import stats

ROWS = [("010317", 0, 0), ("010317", 10, 0), ("010317", 20, 1), ("020317", 30, 8),
        ("020317", 40, None), (None, 50, 1)]
SCHEMA = "date string, Time long, CoarseLabel int"


def test_dataset_composition_golden(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [tuple(r) for r in stats.dataset_activity_stats(df, detailed=True)
           .select("CoarseLabel", "Count", "Percentage", "Activity", "TotalTime").collect()]
    assert got == [(None, 0, 0.0, "Unknown", "0.0 seconds"), (0, 2, 33.33, "Still", "0.02 seconds"),
                   (1, 2, 33.33, "Walking", "0.02 seconds"), (8, 1, 16.67, "Unknown", "0.01 seconds")]
    assert stats.dataset_activity_stats(df).columns == ["Activity", "TotalTime", "Percentage"]


def test_daily_composition_golden(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [tuple(r) for r in stats.daily_activity_stats(df, detailed=True)
           .select("date", "CoarseLabel", "Count", "TotalInstances", "Percentage").collect()]
    assert got == [("010317", 0, 2, 3, 66.67), ("010317", 1, 1, 3, 33.33),
                   ("020317", None, 0, 2, 0.0), ("020317", 8, 1, 2, 50.0)]


def test_range_stats_and_empty_range(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = stats.range_activity_stats(df, 0, 20).collect()
    assert [(r.Activity, r.Percentage) for r in got] == [("Still", 66.67), ("Walking", 33.33)]
    assert stats.range_activity_stats(df, 10_000, 20_000).count() == 0
    assert stats.total_time(df.where("Time > 1000")).count() == 0


def test_total_time_and_day_lookup(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    row = stats.total_time(df).first()
    assert (row.TotalCount, row.TotalTimeMs, row.TotalTime) == (6, 60, "0.06 seconds")
    daily = stats.daily_activity_stats(df, detailed=True)
    assert stats.stats_for_date(daily, "020317", exclude=("Count",)).count() == 2
    assert stats.stats_for_date(daily, None).count() == 0
    assert [r.date for r in stats.distinct_dates(df).collect()] == ["010317", "020317"]


def test_composition_plan_is_one_scan_without_join(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "user_id % 9 AS CoarseLabel", "cast(ts as date) AS date")
    plan = stats.daily_activity_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("FileScan") == 1
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_percentages_sum_to_100_on_test_tables(spark):
    import __spark_entry__ as entry
    rows = entry.queries()["dataset_activity_stats"](spark, "/root/testdata/sf0.01").collect()
    assert abs(sum(r.Percentage for r in rows) - 100.0) <= 0.005 * len(rows) + 1e-9
    daily = entry.queries()["daily_activity_stats"](spark, "/root/testdata/sf0.01").toPandas()
    sums = daily.groupby("date").Percentage.sum()
    assert ((sums - 100.0).abs() <= 0.005 * 9 + 1e-9).all()
