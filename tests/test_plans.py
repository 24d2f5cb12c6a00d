"""Physical-plan properties the scale design relies on."""

import re

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()  # the final adaptive plan belongs to this execution
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_word_count_aggregates_before_the_shuffle(spark):
    plan = _plan(spark, "word_count")
    assert "partial_count" in plan or "partial_sum" in plan
    assert plan.count("hashpartitioning(word") == 1


def test_sensor_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "rolling_max")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_rolling_shuffles_data_once(spark):
    plan = _plan(spark, "rolling_max")
    # no hot key at this size: the bucket is a constant, folded away; one data exchange
    assert len(re.findall(r"hashpartitioning\(id#\d+", plan)) == 1
    assert "Subquery" not in plan


def test_batch_sessions_avoid_single_task_merging(spark):
    plan = _plan(spark, "session_count")
    assert "MergingSessions" not in plan
    assert "Window" in plan


def test_global_watermark_scan_is_partitioned(spark):
    plan = _plan(spark, "late_side_output")
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # no window over data rows without its bucket
    assert windows and all("_b#" in w.split("windowspecdefinition(")[1] for w in windows)


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "union_all")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan or "EqualTo(event_type,click)" in plan


def test_no_nested_loop_joins(spark):
    for name in ("late_side_output", "allowed_lateness_sum", "rolling_max", "session_count", "count_sliding_sum"):
        assert "NestedLoopJoin" not in _plan(spark, name), name


def test_evictors_scan_once_and_sliding_windows_aggregate_panes_first(spark):
    for name in ("evict_time_sum", "evict_delta_sum"):
        assert _plan(spark, name).count("FileScan") == 1
    plan = _plan(spark, "sliding_sum")
    # from the scan upwards: pane aggregates, then the copies into windows
    assert plan.rindex("partial_sum") > plan.rindex("Expand")


def test_a_hot_window_is_evicted_in_several_tasks(spark):
    from pyspark.sql import functions as F

    from eddyline.operators import evictors
    from eddyline.operators.prefix import assign_buckets

    df = spark.range(10_000).select(
        F.when(F.col("id") % 5 != 0, 0).otherwise(F.col("id")).alias("w"), F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq")
    )
    b = assign_buckets(df, ["w"], ["ts"])
    assert b.df.where("w = 0").select("_b").distinct().count() >= 3
    kept = evictors.evict_time(df, ["w"], "ts", "100 seconds")
    assert kept.where("w = 0").count() == sum(1 for i in range(9900, 10_000) if i % 5)
    last = evictors.evict_delta(df, ["w"], "seq", "seq", lambda a, x: a - x, 50)
    assert last.where("w = 0").count() == sum(1 for i in range(9950, 10_000) if i % 5)
