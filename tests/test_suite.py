"""The suite on a few jobs: assignment, order, stop and the logs."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tallykeep import schemas
from tallykeep.operators.assignment import assigned_rules, rule_lists
from tallykeep.operators.rules import RULES
from tallykeep.plans import suite


def logged_at():
    return F.lit("2024-02-01 06:30:00.123").cast("timestamp")


MEASURES = (
    "job_id bigint, object_name string, object_path string, object_path_post string, object_type string, "
    "row_count bigint, text_size bigint, control_count bigint, min_value bigint, max_value bigint, match_count bigint"
)


def jobs(spark):
    return spark.createDataFrame([
        (1, "a", "/a", "/a", "File", 3, 30, 3, 1, 9, 1),
        (2, "b", "/b", "/b", "NASFile", 3, 30, 4, 1, 2, None),
        (3, "c", "/c", "/c", "File", None, None, 0, 0, 1, 1),
        (4, "d", "/d", "/d", "File", 3, 30, None, 1, 9, 1),
        (5, " ", "/e", "/e", "File", 3, 30, 3, 1, 9, 1),
        (6, "f", None, "", "SQLTable", 3, 30, 3, 1, 9, 1),
        (7, "g", "", "", "File", 3, 30, 3, 1, 9, 1),
        (8, "h", "/h", "/h", "Tape", 3, 30, 3, 1, 9, 1),
        (9, "i", "/i", "/i", "File", 3, 30, 3, 1, 9, 1),
    ], MEASURES)


def assignment(spark, rules=(4, 3, 1, 0), job_ids=range(1, 9)):
    return spark.createDataFrame(
        [(j, "Pre", r) for j in job_ids for r in rules] + [(1, "Post", 8)], schemas.RULE_ASSIGNMENT
    )


def test_summary(spark):
    found = {r.job_id: r for r in suite.suite_summary(suite.run_suite(jobs(spark), assignment(spark), "Pre")).collect()}
    assert found[1].summary == (
        "Zero FileSize Validation Passed | CountValidation passed | ThresholdValidation passed | FileNameValidation passed"
    )
    assert (found[1].rules_run, found[1].rules_failed, found[1].aborted) == (4, 0, False)
    assert found[2].summary == (
        "Zero FileSize Validation Passed | CountValidation Failed | ThresholdValidation Failed | FileNameValidation Failed"
    )
    assert (found[2].rules_run, found[2].rules_failed, found[2].aborted) == (4, 3, False)
    # An empty object stops its job after rule 0.
    assert (found[3].rules_run, found[3].aborted, found[3].summary) == (1, True, "Zero FileSize Validation Failed")
    # An error stops its job and is its summary.
    assert (found[4].rules_run, found[4].aborted, found[4].summary) == (
        1, True, "Error Message : no value for control_count"
    )
    blank = "Error Message : ObjectName or Path is blank in Pre Validation Wrapper Function"
    assert [(found[j].rules_run, found[j].aborted, found[j].summary) for j in (5, 7)] == [(0, True, blank)] * 2
    assert found[6].rules_run == 4 and not found[6].aborted
    assert found[8].summary == "Error Message : no value for object_type"
    assert (found[9].rules_run, found[9].aborted, found[9].summary) == (0, False, "")


def test_log_has_the_labels_of_the_object_type(spark):
    ran = suite.run_suite(jobs(spark), assignment(spark), "Pre")
    log = suite.rule_execution_log(ran, logged_at(), "me")
    assert log.columns == [c.split()[0] for c in schemas.RULE_EXECUTION_LOG.split(", ")]
    assert rows(log.where("job_id = 2 and rule_id = 1")) == [(
        2, 1, "4", "3", "Source Count", "Target Count", "Audit Table", "NAS Drive", "Failed",
        dt.datetime(2024, 2, 1, 6, 30, 0, 123000), "me", "b",
    )]
    assert rows(log.groupBy("job_id").count()) == [(1, 4), (2, 4), (3, 1), (4, 1), (6, 4)]
    assert rows(log.where("job_id = 6"), "source_name", "target_name") == [
        ("Audit Table", "Azure SQL Server")] * 3 + [("SQL Table", "ADL RAW layer")]


def test_validation_and_error_logs(spark):
    ran = suite.run_suite(jobs(spark), assignment(spark), "Pre")
    lines = rows(suite.validation_log(ran, logged_at()).where("job_id = 4"))
    stamp = "2024-02-01 06:30:00.123 "
    assert lines == [
        (4, 1, "INFO", stamp + "Zero FileSize Validation Passed"),
        (4, 2, "ERROR", stamp + "Error Occured Error Message : no value for control_count"),
        (4, 3, "ERROR", stamp + "Error Message : no value for control_count"),
    ]
    errors = suite.error_log(ran, logged_at())
    assert errors.columns == [c.split()[0] for c in schemas.ERROR_LOG.split(", ")]
    assert rows(errors, "object_run_id", "error_code") == [
        ("4", "RULE_1"), ("5", "BLANK_OBJECT"), ("7", "BLANK_OBJECT"), ("8", "RULE_0")
    ]
    assert errors.select("error_id").distinct().count() == 4


def test_rules_without_their_measures_are_errors(spark):
    ran = suite.run_suite(jobs(spark).where("job_id = 1"), assignment(spark, rules=(10, 11)), "Pre")
    assert rows(suite.suite_summary(ran), "aborted", "summary") == [
        (True, "Error Message : no value for egress_source_count, egress_target_count")
    ]


def test_post_suite_runs_only_its_rules(spark):
    measures = jobs(spark).selectExpr("*", "control_count as post_control_count", "row_count as post_row_count")
    both = assignment(spark).union(spark.createDataFrame([(1, "Post", 8), (2, "Post", 8), (7, "Post", 8)], schemas.RULE_ASSIGNMENT))
    ran = suite.run_suite(measures, both, "Post")
    found = dict(rows(suite.suite_summary(ran), "job_id", "summary"))
    assert found[1] == "CountValidation Post File Processing passed"
    assert found[2] == "CountValidation Post File Processing Failed"
    assert found[7] == "Error Message : ObjectName or Path is blank in Post Wrapper Function"
    assert found[6] == ""


def test_all_rules_together(spark):
    t = dt.datetime(2024, 1, 1, 10)
    extra = {
        "balance": "cast(10.5 as decimal(38,8))", "control_balance": "10L", "metadata_name": "object_name",
        "audit_file_size": "5L", "expected_file_size": "6L", "arrival_time": f"timestamp'{t}'",
        "expected_time": f"timestamp'{t}'", "buffer_minutes": "15", "egress_source_count": "3L",
        "egress_target_count": "3L", "digest": "'d'", "is_duplicate": "true",
    }
    measures = jobs(spark).where("job_id = 1").withColumns({k: F.expr(v) for k, v in extra.items()})
    log = suite.rule_execution_log(
        suite.run_suite(measures, assignment(spark, rules=range(12)), "Pre"), logged_at(), "me"
    )
    statuses = dict(rows(log, "rule_id", "rule_run_status"))
    assert statuses == {
        0: "Passed", 1: "Passed", 2: "Passed", 3: "Passed", 4: "Passed", 5: "Failed", 6: "On Time", 7: "Passed",
        10: "Passed", 11: "Failed",
    }
    values = {r.rule_id: (r.source_value, r.target_value) for r in log.collect()}
    assert values[3] == ("MinValue = 1 and MaxValue = 9", "3")
    assert values[6] == ("10:00:00", "Postive_Buffer_Time = 10:15:00 and Negative_Buffer_Time = 09:45:00")
    assert values[11] == ("Check_sum = d", "Check_sum = d")


def test_a_job_may_have_any_number_of_rules(spark):
    many = spark.range(60).selectExpr("1L as job_id", "'Pre' as validation_type", "cast(id as int) as rule_id")
    repeated = spark.range(60).selectExpr("2L as job_id", "'Pre' as validation_type", "cast(id / 59 as int) as rule_id")
    both = many.union(repeated).repartition(6)
    counts = assigned_rules(both).groupBy("job_id").agg(F.count("*").alias("n"), F.max("rule_id").alias("most"))
    assert rows(counts) == [(1, 60, 59), (2, 2, 1)]
    assert rows(rule_lists(both, "Pre")) == [(1, list(range(60))), (2, [0, 1])]
    assert rows(rule_lists(both, "Pre", 3)) == [(1, [0, 1, 2]), (2, [0, 1])]


def test_control_totals_at_the_positions_of_each_job(spark):
    df = spark.createDataFrame(
        [(1, "CNT=0003;BAL=0000006", 4, 8, 13, 20), (2, "0042|17", 0, 4, 5, 7)],
        "job_id int, meta_string string, count_start int, count_end int, balance_start int, balance_end int",
    )
    assert rows(suite.add_control_totals(df), "job_id", "control_count", "control_balance") == [(1, 3, 6), (2, 42, 17)]


def test_rule_ids_are_in_order():
    assert [r.rule_id for r in RULES] == list(range(12))


def test_jobs_without_an_object_are_spread(spark):
    jobs = spark.range(2000).selectExpr("id as job_id", "case when id % 10 > 0 then '' else 'o' || id end as object_name")
    part = spark.range(2000).selectExpr("'o' || id as object_name", "id as row_count")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = suite.gather_measures(jobs, [part])
        sizes = found.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
        assert found.columns == ["object_name", "job_id", "row_count"]
        assert sum(sizes) == 2000 and max(sizes) < 500
        assert found.where("row_count is not null").count() == 200 and found.where("object_name = ''").count() == 1800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
