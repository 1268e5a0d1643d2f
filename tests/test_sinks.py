"""Repeated appends and versions of a table."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.operators.digests import new_digests
from tallykeep.sinks import (
    VersionConflict, append_once, append_registry, latest_snapshot, read_snapshot, update_open_runs, vacuum_snapshots, write_snapshot,
)


def test_append_adds_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, None, "x")], "job_id int, rule string, v string")
    append_once(first, path, ["job_id", "rule"])
    append_once(first, path, ["job_id", "rule"])
    assert rows(spark.read.parquet(path), "job_id", "rule") == rows(first, "job_id", "rule")
    more = spark.createDataFrame([(1, "a", "y"), (3, "c", "y"), (3, "c", "y")], "job_id int, rule string, v string")
    append_once(more, path, ["job_id", "rule"])
    assert rows(spark.read.parquet(path).where("v = 'y'")) == [(3, "c", "y")]


def test_append_with_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    data = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, day string")
    append_once(data, path, ["id", "day"], partition_by=["day"])
    append_once(data, path, ["id", "day"], partition_by=["day"], existing_where=F.col("day") >= "2024-01-01")
    assert spark.read.parquet(path).count() == 2


def test_failed_append_raises(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    with pytest.raises(Exception):
        append_once(spark.range(3).toDF("id"), str(blocked / "log"), ["id"])


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert latest_snapshot(spark, root) is None and read_snapshot(spark, root) is None
    assert write_snapshot(spark.range(3), root) == 1
    table = read_snapshot(spark, root)
    assert write_snapshot(table.where("id > 0"), root) == 2
    assert rows(read_snapshot(spark, root)) == [(1,), (2,)]
    # A version without its end mark is not read, and passed over by the next one.
    (tmp_path / "runs" / "version=3").mkdir()
    assert latest_snapshot(spark, root) == 2
    assert write_snapshot(spark.range(1), root) == 4
    assert rows(read_snapshot(spark, root)) == [(0,)]


def test_closed_runs_are_written_once(spark, tmp_path):
    root = str(tmp_path / "runs")
    open_runs = spark.sql("select id as run_id, cast(null as timestamp) as load_end_time from range(4)")
    write_snapshot(open_runs, f"{root}/open")

    def finish(first):
        return lambda df: df.withColumn("load_end_time", F.expr(f"if(run_id < {first}, timestamp'2024-01-02', null)"))

    for first, left in ((2, [(2,), (3,)]), (2, [(2,), (3,)]), (3, [(3,)])):
        update_open_runs(spark, root, finish(first))
        assert rows(read_snapshot(spark, f"{root}/open"), "run_id") == left
    closed = spark.read.parquet(f"{root}/closed")
    assert rows(closed, "run_id", F.col("end_day").cast("string")) == [(i, "2024-01-02") for i in range(3)]


def test_of_writers_that_begin_together_one_wins(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert write_snapshot(spark.range(1), root, base=0) == 1

    def write(i):
        try:
            return write_snapshot(spark.range(i + 2), root, base=1)
        except VersionConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(write, range(4)))
    won = [i for i, v in enumerate(found) if v is not None]
    assert len(won) == 1
    assert read_snapshot(spark, root).count() == won[0] + 2
    with pytest.raises(VersionConflict):
        write_snapshot(spark.range(9), root, base=1)
    assert read_snapshot(spark, root).count() == won[0] + 2


def test_claims_of_failed_and_dead_writers(spark, tmp_path):
    root = str(tmp_path / "runs")
    with pytest.raises(Exception):
        write_snapshot(spark.range(1).select(F.raise_error(F.lit("no"))), root)
    assert write_snapshot(spark.range(2), root) == 2
    (tmp_path / "runs" / "_claims" / "3").write_text("")
    with pytest.raises(VersionConflict):
        write_snapshot(spark.range(3), root)
    assert write_snapshot(spark.range(3), root, abandoned_after=0) == 4
    assert read_snapshot(spark, root).count() == 3


def test_vacuum_leaves_readers_their_version(spark, tmp_path):
    root = str(tmp_path / "runs")
    for i in range(1, 5):
        write_snapshot(spark.range(i), root)
    held = spark.read.parquet(f"{root}/version=3")
    assert vacuum_snapshots(spark, root) == []
    assert sorted(vacuum_snapshots(spark, root, keep=2, older_than=0)) == [1, 2]
    assert held.count() == 3 and read_snapshot(spark, root).count() == 4
    assert write_snapshot(spark.range(5), root) == 5


def test_a_bucketed_registry_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "registry")
    entries = spark.range(300).selectExpr("sha2(cast(id as string), 256) as digest", "id as first_id")
    for part in ("id < 100", "id >= 100"):
        append_registry(entries.where(part.replace("id", "first_id")), "known_digests", path, buckets=8)
    arrived = spark.range(290, 310).selectExpr("sha2(cast(id as string), 256) as digest", "id").union(
        spark.range(295, 305).selectExpr("sha2(cast(id as string), 256) as digest", "id + 1000 as id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = new_digests(arrived, spark.table("known_digests"), "id")
        assert rows(found, "first_id") == [(i,) for i in range(300, 310)]
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        scan = plan[:plan.index("known_digests")].splitlines()
        above = plan[:plan.index("FileScan parquet spark_catalog.default.known_digests")]
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        lines, now = above.splitlines(), 10**6
        chain = []
        for line in reversed(lines):
            if depth(line) < now:
                now = depth(line)
                chain.append(line.strip(" :+-"))
        assert scan and not any(x.startswith("Exchange") for x in chain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE known_digests")
