"""Whole runs from argument files: formats, control places, missing objects and both stages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep import schemas
from tallykeep.plans.suite import rule_execution_log, suite_summary
from tallykeep.plans import validate as validate_module
from tallykeep.plans.validate import validate
from tallykeep.sources import read_job_args

HEAD = (
    "JobId,ObjectPath,ObjectName,BalanceAmountColumn,ObjectType,ObjectPath_PostProcessing,FileType,Metadata_place,"
    "Metadata_column,Manifest_file_url,HeadCount_value_start_index,HeadCount_value_end_index,"
    "BalanceAmount_value_start_index,BalanceAmount_value_end_index,Post_Metadata_place,Post_FileType\n"
)


@pytest.fixture(scope="module")
def landing(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("landing")
    for folder in ("csv", "csv2", "json", "head", "foot", "man"):
        (root / folder).mkdir()
    (root / "csv" / "a.csv").write_text("id,amt\n1,1.5\n2,2.25\n3,x\n")
    (root / "csv" / "empty.csv").write_text("")
    (root / "csv2" / "other.csv").write_text("amt,name,more\n5,a,b\n")
    (root / "json" / "j.json").write_text('{"id": 1, "amt": "4"}\n{"id": 2, "amt": "5"}\n')
    (root / "head" / "h.csv").write_text("id,amt,CNT=0003;BAL=0000003\n1,1,\n2,2,\n")
    (root / "foot" / "f.csv").write_text("id,amt,note\n1,1,\n2,2,CNT=0002;BAL=0000003\n")
    for name, count, amount in (("a", 3, 3), ("e", 0, 0), ("o", 1, 5), ("j", 2, 8), ("p", 4, 6), ("t", 2, 30)):
        (root / "man" / f"{name}.txt").write_text(f"CNT={count:04d};BAL={amount:07d}\n")
    spark.createDataFrame([(i, float(i)) for i in range(4)], "id int, amt double").repartition(3).write.parquet(
        str(root / "parquet" / "p")
    )
    jobs = [
        (1, "csv/a.csv", "a.csv", "amt", "File", "csv", "File", "", "a"),
        (2, "csv/empty.csv", "empty.csv", "amt", "File", "csv", "File", "", "e"),
        (3, "csv2/other.csv", "other.csv", "amt", "NASFile", "csv", "File", "", "o"),
        (4, "json/j.json", "j.json", "amt", "NASFile", "json", "File", "", "j"),
        (5, "parquet/p", "p", "amt", "File", "parquet", "File", "", "p"),
        (6, "head/h.csv", "h.csv", "", "File", "csv", "Header", "2", ""),
        (7, "foot/f.csv", "f.csv", "amt", "File", "csv", "Footer", "", ""),
        (8, "csv/missing.csv", "missing.csv", "amt", "File", "csv", "File", "", "a"),
        (9, "", "t", "amt", "SQLTable", "", "File", "", "t"),
        (10, "", "none", "amt", "File", "csv", "File", "", ""),
    ]
    lines = []
    for job, path, name, balance, kind, fmt, place, column, man in jobs:
        full = str(root / path) if path else ""
        manifest = str(root / "man" / f"{man}.txt") if man else ""
        lines.append(f"{job},{full},{name},{balance},{kind},{full},{fmt},{place},{column},{manifest},4,8,13,20,SQLQUERY,{fmt}")
    (root / "args.csv").write_text(HEAD + "\n".join(lines) + "\n")
    return str(root)


def assigned(spark, rules, stage="Pre"):
    return spark.createDataFrame([(j, stage, r) for j in range(1, 11) for r in rules], schemas.RULE_ASSIGNMENT)


def metadata(spark):
    day = dt.datetime(2024, 1, 1, 10)
    names = ["a.csv", "empty.csv", "other.csv", "j.json", "p", "h.csv", "f.csv", "missing.csv", "t"]
    return spark.createDataFrame(
        [(i, i, n, "amt", 1, 3, 20, day, 30) for i, n in enumerate(names)], schemas.FILE_METADATA
    )


def test_counts_and_amounts_of_every_kind_of_object(spark, landing):
    table = spark.createDataFrame([(1, "10"), (2, "20")], "id int, amt string")
    ran = validate(
        spark, read_job_args(spark, f"{landing}/args.csv"), assigned(spark, [0, 1, 2, 3]),
        file_metadata=metadata(spark), tables={"t": table},
    )
    log = rule_execution_log(ran, F.lit("2024-02-01").cast("timestamp"), "me").collect()
    found = {(r.job_id, r.rule_id): (r.source_value, r.target_value, r.rule_run_status) for r in log}
    bounds = "MinValue = 1 and MaxValue = 3"
    for job, count, amount, rows_status, size in (
        (1, "3", "3", "Passed", "Passed"), (3, "1", "5", "Passed", "Passed"), (4, "2", "9", "Passed", "Passed"),
        (5, "4", "6", "Passed", "Failed"), (6, "3", "3", "Passed", "Passed"), (7, "2", "3", "Passed", "Passed"),
        (9, "2", "30", "Passed", "Passed"),
    ):
        assert found[job, 1] == (count, count, rows_status), job
        assert found[job, 2][1:] == (amount, "Failed" if job == 4 else "Passed"), job
        assert found[job, 3] == (bounds, count, size), job
    # Empty and missing objects fail rule 0 and stop there; a job without a path runs nothing.
    for job in (2, 8):
        assert [k for k in found if k[0] == job] == [(job, 0)]
        assert found[job, 0] == ("0", "0", "Failed")
    assert not [k for k in found if k[0] == 10]


def test_arrivals_and_duplicates(spark, landing):
    day = dt.datetime(2024, 1, 1, 9, 45)
    audit = spark.createDataFrame(
        [("sales", "a.csv", 20, day, None, None), ("Post-sales", "p", 20, day, None, None),
         ("sales", "j.json", 21, day + dt.timedelta(hours=2), None, None)], schemas.AUDIT_LOG
    )
    args = read_job_args(spark, f"{landing}/args.csv").where("job_id in (1, 4, 5)")
    rules = assigned(spark, [4, 5, 6, 7, 11])
    empty = spark.createDataFrame([], schemas.CHECKSUM_REGISTRY)
    ran = validate(spark, args, rules, audit_log=audit, file_metadata=metadata(spark), registry=empty)
    log = rule_execution_log(ran, F.lit("2024-02-01").cast("timestamp"), "me")
    assert rows(log, "job_id", "rule_id", "rule_run_status") == sorted([
        (1, 4, "Passed"), (1, 5, "Passed"), (1, 6, "On Time"), (1, 7, "Passed"), (1, 11, "Passed"),
        (4, 4, "Passed"), (4, 5, "Failed"), (4, 6, "Delay"), (4, 7, "Failed"), (4, 11, "Passed"),
        (5, 4, "Failed"),
    ], key=repr)
    assert dict(rows(suite_summary(ran), "job_id", "summary"))[5] == (
        "Error Message : no value for audit_file_size"
    )
    digest = log.where("job_id = 1 and rule_id = 11").first().target_value.removeprefix("Check_sum = ")
    known = spark.createDataFrame([("before", digest, day, "me")], schemas.CHECKSUM_REGISTRY)
    again = validate(spark, args, assigned(spark, [11]), registry=known)
    log = rule_execution_log(again, F.lit("2024-02-01").cast("timestamp"), "me")
    assert rows(log, "job_id", "rule_run_status") == [(1, "Failed"), (4, "Passed"), (5, "Passed")]


def test_after_processing_with_totals_from_a_query(spark, landing):
    args = read_job_args(spark, f"{landing}/args.csv").where("job_id in (1, 5, 7)")
    control = spark.createDataFrame(
        [(1, 3, 3), (5, 4, 7)], "job_id bigint, control_count bigint, control_balance bigint"
    )
    ran = validate(
        spark, args, assigned(spark, [8, 9], "Post"), validation_type="Post",
        query_control=control, file_metadata=metadata(spark),
    )
    assert dict(rows(suite_summary(ran), "job_id", "summary")) == {
        1: "CountValidation Post File Processing passed | BalanceAmountValidation Post File Processing passed",
        5: "CountValidation Post File Processing passed | BalanceAmountValidation Post File Processing Failed",
        7: "Error Message : no value for post_control_count",
    }


def test_an_object_inside_the_folder_of_another(spark, landing, tmp_path):
    (tmp_path / "args.csv").write_text(
        "JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place,BalanceAmountColumn\n"
        f"1,{landing}/csv,folder,File,csv,File,amt\n2,{landing}/csv/a.csv,a.csv,File,csv,File,amt\n"
        f"3,{landing}/csv/a.csv,again,File,csv,File,id\n"
    )
    bounds = spark.createDataFrame([(1, "folder", 3, 3), (2, "a.csv", 3, 3), (3, "again", 3, 3)],
                                   "file_id bigint, file_name string, min_value bigint, max_value bigint")
    bounds = bounds.selectExpr(
        "*", "1L as file_size", "timestamp'2024-01-01' as file_expected_time", "1 as file_buffer_time"
    )
    ran = validate(spark, read_job_args(spark, str(tmp_path / "args.csv")), assigned(spark, [3]), file_metadata=bounds)
    assert rows(suite_summary(ran), "job_id", "summary") == [(j, "ThresholdValidation passed") for j in (1, 2, 3)]


def _jobs(spark, tmp_path, lines, columns="JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place,BalanceAmountColumn"):
    (tmp_path / "jobs.csv").write_text(columns + "\n" + "\n".join(lines) + "\n")
    return read_job_args(spark, str(tmp_path / "jobs.csv"))


def _values(spark, jobs, rules=(1, 2), **given):
    ran = validate(spark, jobs, assigned(spark, rules, given.pop("stage", "Pre")), **given)
    log = rule_execution_log(ran, F.lit("2024-02-01").cast("timestamp"), "me").collect()
    return {(r.job_id, r.rule_id): (r.target_value, r.rule_run_status) for r in log}, ran


def test_files_of_one_folder_with_other_columns(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,amt\n1,10\n2,20\n")
    (folder / "b.csv").write_text('amt,"the, region",id\n5,"x, ""y""",7\n')
    (folder / "c.csv").write_text("id,region,amt\r\n1,n,4\r\n\r\n")
    (tmp_path / "deep" / "dt=1").mkdir(parents=True)
    (tmp_path / "deep" / "dt=1" / "x.csv").write_text("amt\n6\n7\n")
    jobs = _jobs(spark, tmp_path, [
        f"1,{folder},all,File,csv,File,amt", f"2,{folder}/a.csv,a,File,csv,File,amt",
        f"3,{folder}/b.csv,b,File,csv,File,amt", f"4,{folder}/[ac].csv,some,File,csv,File,amt",
        f"5,{tmp_path}/deep,deep,File,csv,File,amt", f"6,{tmp_path}/none*,none,File,csv,File,amt",
    ])
    bounds = spark.createDataFrame(
        [(i, i, n, "amt", 1, 9, 20, dt.datetime(2024, 1, 1), 30)
         for i, n in enumerate(("all", "a", "b", "some", "deep", "none"))], schemas.FILE_METADATA)
    found, _ = _values(spark, jobs, (3,), file_metadata=bounds)
    assert {j: v[0] for (j, _), v in found.items()} == {1: "4", 2: "2", 3: "1", 4: "3", 5: "2", 6: "0"}
    places = validate_module.matched_paths(spark, [str(folder), f"{folder}/[ac].csv"])
    rows_, looked, _, _ = validate_module.object_rows(
        spark, [(1, places[str(folder)][0], "csv", False, "amt", None)]
        + [(2, p, "csv", False, "amt", None) for p in places[f"{folder}/[ac].csv"]], [])
    sums = validate_module.object_measures(rows_, looked, ordered=False)
    assert rows(sums, "job_id", F.col("balance").cast("int")) == [(1, 39), (2, 34)]


def test_jobs_that_can_not_be_read_do_not_stop_the_others(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amt\n1,10\n")
    jobs = _jobs(spark, tmp_path, [
        f"1,{tmp_path}/a.csv,a,File,csv,File,amt", f"2,{tmp_path}/a.csv,b,File,xlsx,File,amt",
        f"3,{tmp_path}/a.csv,c,File,,File,amt", "4,,,File,csv,File,amt",
    ])
    _, ran = _values(spark, jobs, (0,))
    found = {r.job_id: (r.aborted, r.summary) for r in suite_summary(ran).collect() if r.job_id < 5}
    assert found[1] == (False, "Zero FileSize Validation Passed")
    for job in (2, 3):
        assert found[job][0] and found[job][1].startswith("Error Message : no value for ")
    assert found[4][0] and "blank" in found[4][1]


def test_ordered_and_unordered_duplicates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n2\n")
    (tmp_path / "b.csv").write_text("id\n2\n1\n")
    jobs = _jobs(spark, tmp_path, [f"{i},{tmp_path}/{n}.csv,{n},File,csv,File,id" for i, n in ((1, "a"), (2, "b"))])
    empty = spark.createDataFrame([], schemas.CHECKSUM_REGISTRY)
    found, ran = _values(spark, jobs, (11,), registry=empty)
    assert [v[1] for _, v in sorted(found.items())] == ["Passed", "Passed"]
    entries = validate_module.registration(ran, F.lit("2024-02-01").cast("timestamp"), "me")
    assert rows(entries, "file_name") == [("a",), ("b",)]
    again, _ = _values(spark, jobs, (11,), registry=spark.createDataFrame(entries.collect(), schemas.CHECKSUM_REGISTRY))
    assert [v[1] for _, v in sorted(again.items())] == ["Failed", "Failed"]
    loose, _ = _values(spark, jobs, (11,), registry=empty, digest="unordered")
    assert [v[1] for _, v in sorted(loose.items())] == ["Passed", "Failed"]


def test_totals_from_queries_and_egress_and_audit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amt\n1,10\n2,20\n")
    columns = ("JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place,BalanceAmountColumn,"
               "Sql_query_recordcount,Sql_query_balanceamount")
    jobs = _jobs(spark, tmp_path, [
        f"1,{tmp_path}/a.csv,a,File,csv,SQLQUERY,amt,select 2,select 31",
        f"2,{tmp_path}/a.csv,b,File,csv,Audit,amt,,",
    ], columns)
    day = dt.datetime(2024, 1, 1, 9)
    audit = spark.createDataFrame([("sales", "b", 1, day, 2, 30)], "product_name string, file_name string, "
                                  "file_size bigint, file_arrival_time timestamp, file_count bigint, file_balance_amount int")
    meta = spark.createDataFrame(
        [(i, i, n, "amt", 1, 9, 20, day, 30) for i, n in enumerate("ab")], schemas.FILE_METADATA)
    asked = []

    def run_query(text):
        asked.append(text)
        return spark.sql(text)

    targets = spark.createDataFrame([("a", 2), ("b", 3)], "object_name string, egress_target_count bigint")
    found, _ = _values(spark, jobs, (1, 2, 10), run_query=run_query, audit_log=audit, file_metadata=meta,
                       egress_targets=targets)
    assert sorted(asked) == ["select 2", "select 31"]
    assert {k: v[1] for k, v in found.items()} == {
        (1, 1): "Passed", (1, 2): "Failed", (1, 10): "Passed", (2, 1): "Passed", (2, 2): "Passed", (2, 10): "Failed"}


def test_footer_of_a_folder_is_that_of_its_last_file(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-0.csv").write_text("id,note\n1,CNT=0001\n")
    (folder / "part-1.csv").write_text("id,note\n" + "2,\n" * 500 + "3,CNT=0502\n")
    (folder / "part-2.csv").write_text("id,more,note\n4,x,CNT=0503\n")
    columns = ("JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place,HeadCount_value_start_index,"
               "HeadCount_value_end_index")
    jobs = _jobs(spark, tmp_path, [f"1,{folder},p,File,csv,Footer,4,8"], columns)
    found, _ = _values(spark, jobs, (1,))
    assert found == {(1, 1): ("503", "Passed")}
    less, _ = _values(spark, jobs, (1,), exclude_control_row=True)
    assert less == {(1, 1): ("502", "Failed")}


def test_the_plan_has_as_many_scans_for_many_folders(spark, tmp_path):
    import time
    for i in range(300):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "x.csv").write_text(f"id,amt\n1,{i}\n")
    scans = []
    for many in (10, 300):
        jobs = _jobs(spark, tmp_path, [f"{i},{tmp_path}/f{i},n{i},File,csv,Footer,amt" for i in range(many)])
        began = time.perf_counter()
        ran = validate(spark, jobs, assigned(spark, (0,)))
        plan = ran._jdf.queryExecution().optimizedPlan().toString()
        assert time.perf_counter() - began < 20
        scans.append(plan.count("Relation [value"))
    assert scans[0] == scans[1]


def test_an_object_that_cannot_be_read_is_an_error_of_its_job_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"no parquet")
    spark.range(3).write.parquet(str(tmp_path / "split"))
    spark.createDataFrame([("x",)], "id string").write.mode("append").parquet(str(tmp_path / "split"))
    (tmp_path / "args.csv").write_text(
        "JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place\n"
        f"1,{tmp_path}/good,good,File,parquet,File\n2,{tmp_path}/bad,bad,File,parquet,File\n"
        f"3,nosuchscheme://x/y,lost,File,parquet,File\n4,{tmp_path}/split,split,File,parquet,File\n5,{tmp_path}/none,none,File,parquet,File\n")
    ran = validate(spark, read_job_args(spark, str(tmp_path / "args.csv")), assigned(spark, [0]))
    unread = "Error Message : no value for text_size"
    assert dict(rows(suite_summary(ran), "job_id", "summary")) == {
        1: "Zero FileSize Validation Passed", 2: unread, 3: unread, 4: unread, 5: "Zero FileSize Validation Failed"}


def test_objects_of_many_schemas_keep_their_own_width(spark, tmp_path):
    lines = []
    for i in range(30):
        spark.range(2).selectExpr("id as amt", *[f"id as c{i}_{j}" for j in range(i % 3 + 1)]).coalesce(1).write.parquet(str(tmp_path / f"t+ {i}"))
        lines.append(f"{i},{tmp_path}/t+ {i},t{i},File,parquet,File,amt\n")
    (tmp_path / "args.csv").write_text("JobId,ObjectPath,ObjectName,ObjectType,FileType,Metadata_place,BalanceAmountColumn\n" + "".join(lines))
    wanted = [(i, f"{tmp_path}/t+ {i}", "parquet", False, "amt", None) for i in range(30)]
    places = validate_module.matched_paths(spark, [w[1] for w in wanted])
    found, _, _, _ = validate_module.object_rows(spark, [(i, places[p][0], *rest) for i, p, *rest in wanted], [])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Each scan has the columns of its own schema.
    assert max(line.count("#") for line in plan.splitlines() if "Relation" in line) <= 6
    bounds = spark.createDataFrame([(i, f"t{i}", 2, 2) for i in range(30)], "file_id bigint, file_name string, min_value bigint, max_value bigint")
    bounds = bounds.selectExpr("*", "1L as file_size", "timestamp'2024-01-01' as file_expected_time", "1 as file_buffer_time")
    rules = spark.createDataFrame([(i, "Pre", 3) for i in range(30)], schemas.RULE_ASSIGNMENT)
    ran = validate(spark, read_job_args(spark, str(tmp_path / "args.csv")), rules, file_metadata=bounds)
    assert rows(suite_summary(ran), "summary") == [("ThresholdValidation passed",)] * 30


def _with_registry(spark, tmp_path, kinds, digest):
    """Objects of these kinds validated with rule 11: what was found, and the results."""
    lines = []
    for i, kind in enumerate(kinds, 1):
        frame = spark.range(50).select("id", (F.col("id") * 2).alias("amt")).coalesce(1)
        path = f"{tmp_path}/{kind}{i}"
        frame.write.csv(path, header=True) if kind == "csv" else getattr(frame.write, kind)(path)
        lines.append(f"{i},{path},{kind}{i},File,{kind},File,amt")
    empty = spark.createDataFrame([], schemas.CHECKSUM_REGISTRY)
    return _values(spark, _jobs(spark, tmp_path, lines), (11,), registry=empty, digest=digest)


def _rows_of(spark, tmp_path, kind):
    """Rows of an object of one file, and the frame of what is asked of it."""
    spark.range(50).select("id", (F.col("id") * 2).alias("amt")).coalesce(1).write.option("header", True).format(kind).save(f"{tmp_path}/o")
    place = validate_module.matched_paths(spark, [f"{tmp_path}/o"])[f"{tmp_path}/o"][0]
    found, looked, _, _ = validate_module.object_rows(spark, [(1, place, kind, False, "amt", None)], [])
    return found, looked


@pytest.fixture
def no_small_side(spark):
    """No join is broadcast for the size of a side alone, as where files are large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_large_parquet_file_do_not_meet_in_one_task(spark, tmp_path, no_small_side):
    found, looked = _rows_of(spark, tmp_path, "parquet")
    assert "hashpartitioning(file" not in _plan(found)
    assert rows(validate_module.object_measures(found, looked, ordered=False), "row_count", F.col("balance").cast("int")) == [(50, 2450)]


def test_objects_are_read_once_with_a_registry(spark, tmp_path):
    found, ran = _with_registry(spark, tmp_path, ["parquet"], "unordered")
    assert found[1, 11][1] == "Passed"
    assert "Relation [id" not in ran._jdf.queryExecution().optimizedPlan().toString()


def test_files_too_many_to_broadcast_give_the_same(spark, tmp_path, monkeypatch):
    from tallykeep.sources import objects
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    few, _ = _with_registry(spark, tmp_path / "a", ["parquet", "csv", "json"], "unordered")
    monkeypatch.setattr(objects, "FEW_FILES", 0)
    many, _ = _with_registry(spark, tmp_path / "b", ["parquet", "csv", "json"], "unordered")
    assert few == many and len(few) == 3


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_rows_of_a_large_text_file_do_not_meet_in_one_task(spark, tmp_path, kind, no_small_side):
    found, looked = _rows_of(spark, tmp_path, kind)
    assert "hashpartitioning(file" not in _plan(found)
    assert rows(validate_module.object_measures(found, looked, ordered=False), "row_count", F.col("balance").cast("int")) == [(50, 2450)]


def test_the_ordered_digest_reads_rows_no_more_often_than_it_must(spark, tmp_path):
    found, looked = _rows_of(spark, tmp_path, "json")
    plan = validate_module.object_measures(found, looked, ordered=True)._jdf.queryExecution().optimizedPlan().toString()
    once = found._jdf.queryExecution().optimizedPlan().toString().count("Relation [value")
    # For the sums, for the digests and for the number of rows in each bucket.
    assert plan.count("Relation [value") == 3 * once
