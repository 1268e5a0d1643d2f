"""What changed since the last run: listings of files held against each other, so that only changed objects are validated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallykeep.sources.objects import _of_roots, matched_paths

NEW, GONE, CHANGED, SAME = "New", "Gone", "Changed", "Same"


def listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``(file, length, modified)`` of all files below the roots, which are not read. Paths and globs without a file have none."""
    found = matched_paths(spark, roots)
    there = sorted({place for places in found.values() for place in places or ()})
    if not there:
        return spark.createDataFrame([], "file string, length bigint, modified timestamp")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
    return listed.select(F.replace("path", F.lit(":///"), F.lit(":/")).alias("file"), "length", F.col("modificationTime").alias("modified"))


def listing_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """``(file, state)`` of every file of two listings; a file is the same if its length and time are. Files are listed once each."""
    a, b = before.alias("a"), now.alias("b")
    same = F.col("a.length").eqNullSafe(F.col("b.length")) & F.col("a.modified").eqNullSafe(F.col("b.modified"))
    state = F.when(F.col("a.file").isNull(), NEW).when(F.col("b.file").isNull(), GONE).when(same, SAME).otherwise(CHANGED)
    return a.join(b, F.col("a.file") == F.col("b.file"), "full").select(F.coalesce("a.file", "b.file").alias("file"), state.alias("state"))


def changed_roots(changes: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``(root)`` rows that are, or have below them, a file that isn't the same."""
    return _of_roots(changes.where(F.col("state") != SAME), roots.select("root", F.col("root").alias("_root"))).select(
        F.col("_root").alias("root")).distinct()


def revalidated(
    spark: SparkSession, jobs: DataFrame, before: DataFrame, last_results: DataFrame, run: Callable[[DataFrame], DataFrame],
    *, path: str = "object_path",
) -> tuple[DataFrame, DataFrame]:
    """Results of all jobs, of which only those with changed objects are ``run``, and the listing to keep for the next time.

    ``run`` takes the jobs to validate and gives results with a ``job_id``; the others keep theirs of ``last_results``. A job
    that has no result yet is run. Paths that can't be looked up count as changed. The job settings are on the driver, the
    listings are not.
    """
    settings = jobs.select("job_id", path).collect()
    places = matched_paths(spark, [j[path] for j in settings if j[path]])
    now = listing(spark, [p for p in places if places[p]])
    rooted = spark.createDataFrame(
        [(j.job_id, root) for j in settings if j[path] for root in [*(places[j[path]] or ()), j[path]]], "job_id bigint, root string")
    touched = rooted.join(changed_roots(listing_changes(before, now), rooted), "root", "left_semi").select("job_id")
    unknown = [j.job_id for j in settings if not j[path] or not places[j[path]]]
    without = jobs.select("job_id").join(last_results, "job_id", "left_anti")
    again = touched.union(without).union(spark.createDataFrame([(i,) for i in unknown], "job_id bigint")).distinct()
    carried = last_results.join(again, "job_id", "left_anti").join(jobs.select("job_id"), "job_id", "left_semi")
    return carried.unionByName(run(jobs.join(again, "job_id", "left_semi")).select(carried.columns)), now
