"""Run statistics: start, finish, lookup of the batch and job run, and repeated writes."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tallykeep import schemas
from tallykeep.plans import runs

T = dt.datetime(2024, 3, 1, 8, 0, 0, 123456)


def at(seconds, micros=0):
    return T + dt.timedelta(seconds=seconds, microseconds=micros)


def batches(spark, data=(("b1", 0), ("b2", 10))):
    return runs.start_batches(spark.createDataFrame(
        [(b, "s", at(s)) for b, s in data], "batch_id string, source_id string, batch_start_time timestamp"
    ))


def names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def test_batch_start(spark):
    started = batches(spark)
    assert started.columns == names(schemas.BATCH_RUNS)
    assert rows(started, "batch_id", "batch_start_time", "batch_end_time", "status") == [
        ("b1", T.replace(microsecond=123000), None, "Started"),
        ("b2", at(10).replace(microsecond=123000), None, "Started"),
    ]
    ids = rows(started, "execution_run_id")
    assert all(i.startswith("202403010800") for (i,) in ids)
    assert rows(batches(spark), "execution_run_id") == ids


def test_batch_finish_takes_the_first_end_and_all_started_rows(spark):
    started = batches(spark, (("b1", 0), ("b1", 5), ("b2", 10)))
    ends = spark.createDataFrame(
        [("b1", at(60), "Completed"), ("b1", at(90), "Failed"), ("b3", at(1), "Completed")],
        "batch_id string, batch_end_time timestamp, status string",
    )
    finished = runs.finish_batches(started, ends)
    end = at(60).replace(microsecond=123000)
    assert rows(finished, "batch_id", "batch_end_time", "status") == [
        ("b1", end, "Completed"), ("b1", end, "Completed"), ("b2", None, "Started"),
    ]
    # A batch that is not started any more is left as it is.
    again = runs.finish_batches(finished, ends.withColumn("status", F.lit("Late")))
    assert rows(again) == rows(finished)


JOB_STARTS = (
    "job_id bigint, job_name string, source_system string, source_path string, target_system string, "
    "target_path string, source_count bigint, target_count bigint, job_start_time timestamp"
)


def job_starts(spark, ids):
    return spark.createDataFrame(
        [(j, f"job {j}", "s", f"/p{j}", "t", "/t", None, None, at(j)) for j in ids], JOB_STARTS
    )


def test_jobs(spark):
    started_batches = batches(spark, (("b1", 0), ("b1", 5), ("b2", 10)))
    ended = runs.finish_batches(started_batches, spark.createDataFrame(
        [("b2", at(99), "Completed")], "batch_id string, batch_end_time timestamp, status string"))
    metadata = spark.createDataFrame([(1, "b1"), (2, "b1"), (3, "b2")], schemas.JOB_METADATA)
    started = runs.start_jobs(job_starts(spark, [1, 2, 3, 4]), metadata, ended)
    assert started.columns == names(schemas.JOB_RUNS)
    latest = [r.execution_run_id for r in started_batches.orderBy("batch_start_time").collect() if r.batch_id == "b1"][-1]
    # Job 3 has no started batch and job 4 no batch at all.
    assert rows(started, "job_id", "execution_run_id", "reject_count", "status") == [
        (1, latest, 0, "Started"), (2, latest, 0, "Started")
    ]
    ends = spark.createDataFrame(
        [(at(1), "/p1", at(4, -999), 10, None, "Completed", 7), (at(2), "/other", at(9), 1, 1, "Completed", 1)],
        "job_start_time timestamp, source_path string, job_end_time timestamp, source_count bigint, "
        "target_count bigint, status string, measured_target_count bigint",
    )
    finished = runs.finish_jobs(started, ends)
    assert finished.columns == names(schemas.JOB_RUNS)
    assert rows(finished, "job_id", "source_count", "target_count", "reject_count", "duration_in_seconds", "status") == [
        (1, 10, 7, 3, 2, "Completed"), (2, None, None, 0, None, "Started"),
    ]
    unknown = ends.drop("measured_target_count")
    assert rows(runs.finish_jobs(started, unknown).where("job_id = 1"), "target_count", "reject_count") == [(0, 10)]


def test_duration_is_cut_toward_zero(spark):
    df = spark.createDataFrame([(at(0), at(-1, -500_000)), (at(0), at(1, 999_999))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(runs.elapsed_seconds(F.col("a"), F.col("b"))).collect()] == [-1, 1]


def test_files(spark):
    metadata = spark.createDataFrame([(1, "b1")], schemas.JOB_METADATA)
    job_runs = runs.start_jobs(job_starts(spark, [1]), metadata, batches(spark))
    file_meta = spark.createDataFrame([(11, 1), (12, 1), (13, 2)], "file_id bigint, job_id bigint")
    starts = spark.createDataFrame(
        [(f, None, None, at(0)) for f in (11, 12, 13)],
        "file_id bigint, source_count bigint, target_count bigint, load_start_time timestamp",
    )
    for hot_rows in (1, 1_000_000):
        started = runs.start_files(starts, file_meta, job_runs, hot_rows=hot_rows)
        assert started.columns == names(schemas.FILE_RUNS)
        job = job_runs.first()
        assert rows(started, "file_id", "job_run_id", "execution_run_id") == [
            (f, job.job_run_id, job.execution_run_id) for f in (11, 12)
        ]
    by_key = spark.createDataFrame(
        [(11, at(0), at(30), 5, 4, "Completed")],
        "file_id bigint, load_start_time timestamp, load_end_time timestamp, source_count bigint, "
        "target_count bigint, status string",
    )
    finished = rows(runs.finish_files(started, by_key), "file_id", "source_count", "duration_in_seconds", "status")
    assert finished == [(11, 5, 30, "Completed"), (12, None, None, "Started")]
    run = started.where("file_id = 11").select("file_run_id")
    by_run = by_key.drop("file_id", "load_start_time").crossJoin(run)
    assert rows(runs.finish_files(started, by_run), "file_id", "source_count", "duration_in_seconds", "status") == finished
    lineage = runs.run_lineage(file_meta, metadata, batches(spark))
    assert rows(lineage, "file_id", "job_id", "batch_id") == [(11, 1, "b1"), (12, 1, "b1")]


def test_a_job_of_two_batches_has_one_run(spark):
    both = spark.createDataFrame([(1, "b1"), (1, "b2")], schemas.JOB_METADATA)
    starts = spark.createDataFrame([("b1", "s", at(0)), ("b2", "s", at(5))], "batch_id string, source_id string, batch_start_time timestamp")
    batch_runs = runs.start_batches(starts)
    started = runs.start_jobs(job_starts(spark, [1]), both, batch_runs)
    last = batch_runs.where("batch_id = 'b2'").first().execution_run_id
    assert rows(started, "job_id", "execution_run_id") == [(1, last)]


def test_run_ids_are_not_moved_by_file(spark, capsys):
    job_runs = runs.start_jobs(job_starts(spark, [1, 2]), spark.createDataFrame([(1, "b1"), (2, "b2")], schemas.JOB_METADATA), batches(spark))
    # File 12 is listed under both jobs, of which job 2 started last.
    file_meta = spark.createDataFrame([(11, 1), (12, 1), (12, 2), (13, 3)], "file_id bigint, job_id bigint")
    starts = spark.createDataFrame(
        [(f, None, None, at(0)) for f in (11, 12, 13)],
        "file_id bigint, source_count bigint, target_count bigint, load_start_time timestamp")
    started = runs.start_files(starts, file_meta, job_runs)
    started.explain("formatted")
    steps = [x for x in capsys.readouterr().out.split("\n\n") if "hashpartitioning(file_id" in x or "Keys [1]: [file_id" in x]
    assert steps and not any("_run_id" in x.replace("file_run_id", "") for x in steps)
    ids = {r.job_id: (r.job_run_id, r.execution_run_id) for r in job_runs.collect()}
    assert rows(started, "file_id", "job_run_id", "execution_run_id") == [(11, *ids[1]), (12, *ids[2])]
    assert rows(runs.file_lineage(file_meta, job_runs), "file_id", "job_id", "job_run_id", "execution_run_id") == [
        (11, 1, *ids[1]), (12, 2, *ids[2])]
    ends = spark.createDataFrame(
        [(11, at(0), at(30), 5, 4, "Completed")],
        "file_id bigint, load_start_time timestamp, load_end_time timestamp, source_count bigint, target_count bigint, status string")
    assert rows(runs.start_files(starts, file_meta, job_runs, ends=ends)) == rows(runs.finish_files(started, ends))
