"""Bounds of the rules on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.operators import arrivals as arr
from tallykeep.operators import rules


def test_threshold_includes_both_ends(spark):
    bounds = spark.createDataFrame(
        [("a", 4, 9), ("b", 4, 9), ("c", 4, 9), ("d", 4, 9), ("e", 0, 1), ("f", None, 1)],
        "object_name string, min_value bigint, max_value bigint",
    )
    profile = spark.createDataFrame(
        [("a", 3), ("b", 4), ("c", 9), ("d", 10), ("f", 1)], "object_name string, row_count bigint"
    )
    assert rows(rules.threshold_check(bounds, profile), "object_name", "status") == [
        ("a", "Failed"), ("b", "Passed"), ("c", "Passed"), ("d", "Failed"), ("e", "Passed"), ("f", "Error"),
    ]


def _arrival(spark, expected, arrived, buffer=30):
    day = dt.datetime(2024, 5, 1)
    meta = spark.createDataFrame(
        [("f", day + expected, buffer)], "file_name string, expected_time timestamp, buffer_minutes int"
    )
    seen = spark.createDataFrame([("f", day + arrived)], "file_name string, arrival_time timestamp")
    return meta, seen


def H(hours, minutes=0, seconds=0):
    return dt.timedelta(hours=hours, minutes=minutes, seconds=seconds)


@pytest.mark.parametrize("arrived, status, window", [
    (H(9, 29, 59), "Delay", "Failed"),
    (H(9, 30), "On Time", "Failed"),
    (H(9, 30, 1), "On Time", "Passed"),
    (H(10), "On Time", "Passed"),
    (H(10, 0, 1), "Delay", "Passed"),
    (H(10, 29, 59), "Delay", "Passed"),
    (H(10, 30), "Delay", "Failed"),
])
def test_arrival_bounds(spark, arrived, status, window):
    frames = _arrival(spark, H(10), arrived)
    for by_clock in (True, False):
        assert rows(rules.arrival_status(*frames, by_clock=by_clock), "status") == [(status,)]
        assert rows(rules.arrival_window_check(*frames, by_clock=by_clock), "status") == [(window,)]


def test_window_over_midnight_needs_timestamps(spark):
    frames = _arrival(spark, H(0, 10), H(0, 5))
    assert rows(rules.arrival_window_check(*frames), "status") == [("Failed",)]
    assert rows(rules.arrival_window_check(*frames, by_clock=False), "status") == [("Passed",)]


def test_without_buffer_only_the_exact_time_is_on_time(spark):
    frames = _arrival(spark, H(10), H(10), buffer=0)
    assert rows(rules.arrival_status(*frames), "status") == [("On Time",)]
    assert rows(rules.arrival_window_check(*frames), "status") == [("Failed",)]


def test_no_arrival_is_an_error(spark):
    meta, seen = _arrival(spark, H(10), H(10))
    none = seen.where(F.lit(False))
    assert rows(rules.arrival_status(meta, none), "status") == [("Error",)]
    sized = meta.withColumn("expected_file_size", F.lit(1))
    assert rows(rules.file_size_check(sized, none.withColumn("audit_file_size", F.lit(1))), "status") == [("Error",)]


def test_audit_filters_drop_missing_names(spark):
    log = spark.createDataFrame([("a", "Post-x"), ("b", "Pre"), ("c", None), ("d", "post")], "file_name string, product_name string")
    assert rows(arr.pre_audit(log), "file_name") == [("b",), ("d",)]
    assert rows(arr.post_audit(log), "file_name") == [("a",)]


def test_first_arrival_breaks_ties_and_puts_missing_times_last(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("a", t, 5), ("a", t, 3), ("a", None, 1), ("b", None, 9)],
        "file_name string, file_arrival_time timestamp, event_id bigint",
    )
    assert rows(arr.first_arrivals(log, ["event_id"])) == [("a", 3, 3), ("b", 1, 9)]


def test_balance_is_cut_toward_zero_and_needs_its_metadata(spark):
    control = spark.createDataFrame([("a", 2), ("b", -2), ("c", 3)], "object_name string, control_balance bigint")
    profile = spark.createDataFrame([("a", "2.99"), ("b", "-2.99"), ("c", "2.99")], "object_name string, b string")
    profile = profile.select("object_name", F.col("b").cast("decimal(38,8)").alias("balance"))
    assert rows(rules.balance_control_check(control, profile), "object_name", "status") == [
        ("a", "Passed"), ("b", "Passed"), ("c", "Failed")
    ]
    known = spark.createDataFrame([("a", "a")], "object_name string, metadata_name string")
    assert rows(rules.balance_control_check(control, profile, known), "object_name", "status") == [
        ("a", "Passed"), ("b", "Error"), ("c", "Error")
    ]


def test_keyed_counts_keep_keys_of_either_store(spark):
    from tallykeep.operators.reconcile import keyed_counts, total_counts
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (3,)], "k int")
    checked = rules.egress_count_check(keyed_counts(left, right, "k"), "k")
    assert rows(checked) == [(1, 2, 1, "Failed"), (2, 1, 0, "Failed"), (3, 0, 1, "Failed")]
    assert rows(total_counts(left, right)) == [(3, 2)]
    assert rows(total_counts(left, right.where("false"))) == [(3, 0)]


def test_assignments_are_dealt_out_before_repeats_are_dropped(spark):
    from tallykeep.operators.assignment import assigned_rules
    few = spark.range(0, 3000, 1, 1).selectExpr("id % 100 as job_id", "'Pre' as validation_type", "cast(id % 6 as int) as rule_id")
    numbered = assigned_rules(few, limit=2)
    assert rows(numbered.groupBy("rn").count()) == [(1, 100), (2, 100)]
    plan = numbered._jdf.queryExecution().sparkPlan().toString()
    # The lowest step that holds different rows comes after they are dealt out by what they are and where they come from.
    assert "_from" in plan and plan.rindex("HashAggregate") < plan.rindex("Exchange hashpartitioning(job_id")
