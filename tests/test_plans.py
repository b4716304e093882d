"""Physical-plan properties of the registered queries."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF")
# Queries whose plans are fully built before execution (models run jobs while building).
PLAN_ONLY = ["dataset_activity_stats", "daily_activity_stats", "range_activity_stats",
             "dataset_total_time", "daily_stats_for_date", "distinct_dates", "expectation_checks",
             "clean_motion", "standardize_dates", "parse_sensor_lines", "top_rows",
             "label_motion_join", "motion_magnitudes", "half_hour_features", "ordinal_date",
             "scaled_features", "location_zscores", "location_sequences", "histogram_50",
             "predicted_route", "route_json", "next_location_lookup", "half_hour_grid",
             "nearby_top_k", "classification_metrics", "vote_fold"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_ONLY)
def test_no_python_and_no_repeated_subqueries(spark, key):
    plan = plan_of(entry.queries()[key](spark, SF))
    assert not PYTHON_NODES.search(plan), key
    assert len(set(re.findall(r"Subquery subquery#(\d+)", plan))) <= 1, key


def test_column_pruning_reaches_scan(spark):
    plan = plan_of(entry.queries()["dataset_activity_stats"](spark, SF))
    assert re.search(r"ReadSchema: struct<user_id:bigint>", plan)


def test_large_join_is_sort_merge(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.queries()["label_motion_join"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_sequences_never_window_a_whole_key(spark):
    plan = plan_of(entry.queries()["location_sequences"](spark, SF))
    windows = [line for line in plan.split("\n") if "Window [" in line and "lag(" in line]
    assert windows and all("_blk" in line for line in windows)


def test_no_cross_products_anywhere(spark):
    for key in PLAN_ONLY:
        plan = plan_of(entry.queries()[key](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_filters_reach_storage_on_written_tables(spark, tmp_path):
    """On a day-partitioned label table, day lookups prune folders and time ranges
    become Parquet row-group filters."""
    from strider.operators import stats
    from strider.sources import sinks
    from strider.sources.bindings import Tables
    from strider.sources.sensor_files import read_sensor_table
    from strider.schemas import LABEL_COLUMNS
    path = str(tmp_path / "Label")
    sinks.write_table(Tables(spark, SF).labels.select(*LABEL_COLUMNS, "date"), path, mode="overwrite")
    table = read_sensor_table(spark, path, "Label")
    ranged = plan_of(stats.range_activity_stats(table, 1704866400000))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(Time,1704866400000\)", ranged)
    assert re.search(r"ReadSchema: struct<Time:bigint,CoarseLabel:int>", ranged)
    daily = stats.daily_activity_stats(table.where("date = '150124'"))
    plan = plan_of(daily)
    assert re.search(r"PartitionFilters: \[[^\]]*\(date#\d+ = 150124\)", plan)
    direct = stats.daily_activity_stats(Tables(spark, SF).labels.where("date = '150124'"))
    assert daily.count() > 0 and daily.exceptAll(direct).count() == 0


def test_bucketed_tables_join_without_shuffle(spark):
    """Day-partitioned tables bucketed on Time join on (date, Time) with no exchange."""
    from strider.operators.clean import clean_motion
    from strider.operators.features import label_motion_join
    from strider.sources import sinks
    from strider.sources.bindings import Tables
    t = Tables(spark, SF)
    sinks.save_bucketed(t.labels, "bucketed_labels", ["Time"], 8)
    sinks.save_bucketed(clean_motion(t.motion), "bucketed_motion", ["Time"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        joined = label_motion_join(spark.table("bucketed_labels"), spark.table("bucketed_motion"))
        plan = plan_of(joined)
        rows = joined.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows == label_motion_join(t.labels, clean_motion(t.motion)).count()


def test_bucketed_table_has_one_file_per_day_and_bucket(spark):
    from strider.sources import sinks
    from strider.sources.bindings import Tables
    labels = Tables(spark, SF).labels.repartition(6)
    sinks.save_bucketed(labels, "few_files", ["Time"], 4)
    table = spark.table("few_files")
    assert table.count() == labels.count()
    assert len(table.inputFiles()) <= 4 * labels.select("date").distinct().count()
