"""Run statistics of batches, their jobs and the files of the jobs.

A run is started and later finished. Starts and ends come in as DataFrames, any number of
them at once. Run ids are digests of what identifies a run, so that a repeated write brings
the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallykeep.operators.lookup import lookup_join

STARTED = "Started"

FILE_RUN_COLUMNS = [
    "file_run_id", "execution_run_id", "job_run_id", "file_id", "load_start_time", "source_count", "target_count",
    "load_end_time", "duration_in_seconds", "status",
]


def run_id(*parts: Column) -> Column:
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, cut toward zero."""
    return F.timestamp_diff("SECOND", start, end)


def _millis(ts: str) -> Column:
    """A time as the run tables keep it, without digits past the millisecond."""
    return F.date_trunc("MILLISECOND", F.col(ts))


def _no_time() -> Column:
    return F.lit(None).cast("timestamp")


def _updated(matched: Column, new: Column, old: str) -> Column:
    return F.when(matched, new).otherwise(F.col(old)).alias(old)


# -- batches ---------------------------------------------------------------------------------


def start_batches(starts: DataFrame) -> DataFrame:
    """Started rows from ``(batch_id, source_id, batch_start_time)``."""
    start = _millis("batch_start_time")
    identity = run_id(F.col("batch_id"), F.col("source_id"), F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSS"))
    return starts.select(
        F.concat(F.date_format(start, "yyyyMMddHHmmss"), F.lit("-"), identity).alias("execution_run_id"),
        F.col("batch_id").cast("string").alias("batch_id"),
        F.col("source_id").cast("string").alias("source_id"),
        start.cast("timestamp").alias("batch_start_time"),
        _no_time().alias("batch_end_time"),
        F.lit(STARTED).alias("status"),
    )


def finish_batches(runs: DataFrame, ends: DataFrame, *, hot_rows: int | None = None) -> DataFrame:
    """``runs`` with all started rows of the ended batches finished.

    ``ends`` is ``(batch_id, batch_end_time, status)``. The first end of a batch counts, as
    its rows are no longer started after that.
    """
    ending = ends.select(
        F.col("batch_id").cast("string").alias("batch_id"),
        _millis("batch_end_time").cast("timestamp").alias("_end"),
        F.col("status").alias("_status"),
    ).groupBy("batch_id").agg(F.min(F.struct("_end", "_status")).alias("_ending"))
    found = lookup_join(runs, ending, "batch_id", "execution_run_id", hot_rows=hot_rows)
    matched = (F.col("status") == STARTED) & F.col("_ending").isNotNull()
    return found.select(
        "execution_run_id", "batch_id", "source_id", "batch_start_time",
        _updated(matched, F.col("_ending._end"), "batch_end_time"),
        _updated(matched, F.col("_ending._status"), "status"),
    )


def _latest_started(runs: DataFrame, key: str, time: str, kept: list[str]) -> DataFrame:
    return (
        runs.where(F.col("status") == STARTED)
        .groupBy(key)
        .agg(F.max(F.struct(F.col(time).alias("_time"), *kept)).alias("_run"))
        .select(key, *[F.col(f"_run.{c}").alias(c) for c in kept])
    )


def _one_each(rows: DataFrame, key: str, time: str, kept: list[str]) -> DataFrame:
    """The row with the latest time of every key; ties go to the largest of the other columns."""
    return rows.groupBy(key).agg(F.max(F.struct(time, *kept)).alias("_last")).select(
        key, *[F.col(f"_last.{c}").alias(c) for c in (time, *kept)])


# -- jobs ------------------------------------------------------------------------------------


def job_lineage(job_metadata: DataFrame, batch_runs: DataFrame, *, hot_rows: int | None = None) -> DataFrame:
    """``(job_id, batch_id, execution_run_id)`` of jobs whose batch has a started run, one row per job.

    The latest started run of a batch is taken, and of a job listed under several batches the one whose batch
    started last. A batch may hold very many of the jobs.
    """
    started = _latest_started(batch_runs, "batch_id", "batch_start_time", ["batch_start_time", "execution_run_id"])
    jobs = job_metadata.select("job_id", F.col("batch_id").cast("string").alias("batch_id"))
    found = lookup_join(jobs, started, "batch_id", "job_id", how="inner", hot_rows=hot_rows)
    return _one_each(found, "job_id", "batch_start_time", ["execution_run_id", "batch_id"]).select(
        "job_id", "batch_id", "execution_run_id")


def start_jobs(
    starts: DataFrame, job_metadata: DataFrame, batch_runs: DataFrame, *, hot_rows: int | None = None
) -> DataFrame:
    """Started rows from ``(job_id, job_name, source_system, source_path, target_system,
    target_path, source_count, target_count, job_start_time)``.

    A job whose batch has no started run gets no row.
    """
    start = _millis("job_start_time")
    named = starts.withColumn(
        "job_run_id",
        run_id(F.col("job_id"), F.col("source_path"), F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSS")),
    )
    lineage = job_lineage(job_metadata, batch_runs, hot_rows=hot_rows).drop("batch_id")
    return lookup_join(named, lineage, "job_id", "job_run_id", how="inner", hot_rows=hot_rows).select(
        "job_run_id", "execution_run_id", "job_id", "job_name",
        "source_system", "source_path", "target_system", "target_path",
        F.col("source_count").cast("bigint").alias("source_count"),
        F.col("target_count").cast("bigint").alias("target_count"),
        F.lit(0).cast("bigint").alias("reject_count"),
        start.cast("timestamp").alias("job_start_time"),
        _no_time().alias("job_end_time"),
        F.lit(None).cast("bigint").alias("duration_in_seconds"),
        F.lit(STARTED).alias("status"),
    )


def _counts(ends: DataFrame, name: str) -> Column:
    """The count given, else the measured one when there is one, else 0."""
    measured = f"measured_{name}"
    options = [F.col(name)] + ([F.col(measured)] if measured in ends.columns else [])
    return F.coalesce(*[c.cast("bigint") for c in options], F.lit(0).cast("bigint"))


def _last_ends(ends: DataFrame, keys: list[str], end: str) -> DataFrame:
    """One end per run: updates do not look at the status, so the last one stays."""
    return ends.groupBy(*keys).agg(
        F.max(F.struct(end, "source_count", "target_count", "status")).alias("_e")
    )


def finish_jobs(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """``runs`` with ended jobs finished, matched by start time and source path.

    ``ends`` is ``(job_start_time, source_path, job_end_time, source_count, target_count,
    status)`` and may have ``measured_source_count`` and ``measured_target_count``, used where
    a count is missing.
    """
    given = ends.select(
        _millis("job_start_time").cast("timestamp").alias("job_start_time"),
        "source_path",
        _millis("job_end_time").cast("timestamp").alias("job_end_time"),
        _counts(ends, "source_count").alias("source_count"),
        _counts(ends, "target_count").alias("target_count"),
        "status",
    )
    keys = ["job_start_time", "source_path"]
    # The keys name a run, so they are as many as the runs and none is hot.
    found = runs.join(_last_ends(given, keys, "job_end_time"), keys, "left")
    matched = F.col("_e").isNotNull()
    return found.select(
        "job_run_id", "execution_run_id", "job_id", "job_name",
        "source_system", "source_path", "target_system", "target_path",
        _updated(matched, F.col("_e.source_count"), "source_count"),
        _updated(matched, F.col("_e.target_count"), "target_count"),
        _updated(matched, F.col("_e.source_count") - F.col("_e.target_count"), "reject_count"),
        "job_start_time",
        _updated(matched, F.col("_e.job_end_time"), "job_end_time"),
        _updated(
            matched, elapsed_seconds(F.col("job_start_time"), F.col("_e.job_end_time")), "duration_in_seconds"
        ),
        _updated(matched, F.col("_e.status"), "status"),
    )


# -- files -----------------------------------------------------------------------------------


def _file_jobs(file_metadata: DataFrame, started: DataFrame, hot_rows: int | None) -> DataFrame:
    """``(file_id, job_id)`` of files whose job has a started run, one row per file: of several jobs the one that started last,
    of those the largest. Run ids, by far the longest columns, stay out of it."""
    times = started.select("job_id", "job_start_time")
    found = lookup_join(file_metadata.select("file_id", "job_id"), times, "job_id", "file_id", how="inner", hot_rows=hot_rows)
    return _one_each(found, "file_id", "job_start_time", ["job_id"]).select("file_id", "job_id")


def _started_jobs(job_runs: DataFrame) -> DataFrame:
    return _latest_started(job_runs, "job_id", "job_start_time", ["job_start_time", "execution_run_id", "job_run_id"])


def file_lineage(file_metadata: DataFrame, job_runs: DataFrame, *, hot_rows: int | None = None) -> DataFrame:
    """``(file_id, job_id, execution_run_id, job_run_id)`` of files whose job has a started run, one row per file."""
    started = _started_jobs(job_runs)
    files = _file_jobs(file_metadata, started, hot_rows)
    return lookup_join(
        files, started.select("job_id", "execution_run_id", "job_run_id"), "job_id", "file_id", how="inner", hot_rows=hot_rows)


def run_lineage(
    file_metadata: DataFrame, job_metadata: DataFrame, batch_runs: DataFrame, *, hot_rows: int | None = None
) -> DataFrame:
    """``(file_id, job_id, batch_id, execution_run_id)``: file to job to started batch run."""
    jobs = job_lineage(job_metadata, batch_runs, hot_rows=hot_rows)
    files = file_metadata.select("file_id", "job_id")
    return lookup_join(files, jobs, "job_id", "file_id", how="inner", hot_rows=hot_rows)


def start_files(
    starts: DataFrame, file_metadata: DataFrame, job_runs: DataFrame, *, ends: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Started rows from ``(file_id, source_count, target_count, load_start_time)``.

    With ``ends``, as ``finish_files`` takes them, the runs that have ended by now are finished. The ids of the job's run are
    looked up last, so that no other step moves them.
    """
    start = _millis("load_start_time")
    named = starts.withColumn(
        "file_run_id", run_id(F.col("file_id"), F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    started = _started_jobs(job_runs)
    files = _file_jobs(file_metadata, started, hot_rows)
    rows = lookup_join(named, files, "file_id", "file_run_id", how="inner", hot_rows=hot_rows).select(
        "file_run_id", "job_id", "file_id",
        start.cast("timestamp").alias("load_start_time"),
        F.col("source_count").cast("bigint").alias("source_count"),
        F.col("target_count").cast("bigint").alias("target_count"),
        _no_time().alias("load_end_time"),
        F.lit(None).cast("bigint").alias("duration_in_seconds"),
        F.lit(STARTED).alias("status"),
    )
    if ends is not None:
        rows = _finished(rows, ends)
    ids = started.select("job_id", "execution_run_id", "job_run_id")
    return lookup_join(rows, ids, "job_id", "file_run_id", how="inner", hot_rows=hot_rows).select(*FILE_RUN_COLUMNS)


def _finished(runs: DataFrame, ends: DataFrame) -> DataFrame:
    by_run = "file_run_id" in ends.columns
    keys = ["file_run_id"] if by_run else ["load_start_time", "file_id"]
    matching = [
        F.col("file_run_id") if by_run else _millis("load_start_time").cast("timestamp").alias("load_start_time")
    ] + ([] if by_run else [F.col("file_id")])
    given = ends.select(
        *matching,
        _millis("load_end_time").cast("timestamp").alias("load_end_time"),
        _counts(ends, "source_count").alias("source_count"),
        _counts(ends, "target_count").alias("target_count"),
        "status",
    )
    found = runs.join(_last_ends(given, keys, "load_end_time"), keys, "left")
    matched = F.col("_e").isNotNull()
    new = {c: F.col(f"_e.{c}") for c in ("source_count", "target_count", "load_end_time", "status")}
    new["duration_in_seconds"] = elapsed_seconds(F.col("load_start_time"), F.col("_e.load_end_time"))
    return found.select(*[_updated(matched, new[c], c) if c in new else F.col(c) for c in runs.columns])


def finish_files(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """``runs`` with ended loads finished.

    ``ends`` has ``load_end_time, source_count, target_count, status`` and either the
    ``file_run_id`` or ``load_start_time`` and ``file_id`` of the run.
    """
    return _finished(runs, ends).select(*FILE_RUN_COLUMNS)
