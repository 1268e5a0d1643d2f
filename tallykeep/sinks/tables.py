"""Writing logs, registries and run tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _list_names(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(folder)]


def append_once(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    partition_by: Sequence[str] = (),
    existing_where: Column | None = None,
) -> None:
    """Append the rows whose keys the table at ``path`` does not have yet.

    Writing the same rows again adds nothing, so a job can be repeated after a failure. Rows
    that share their keys are written once. Of a table with partitions only those are looked at that the rows go
    to, and ``existing_where`` narrows that further. A failed write raises.
    """
    spark = rows.sparkSession
    new = rows.dropDuplicates(list(keys))
    if any(not name.startswith(("_", ".")) for name in _list_names(spark, path)):
        known = spark.read.schema(rows.schema).parquet(path)
        if partition_by:
            touched = new.select(*partition_by).distinct()
            known = known.join(touched, list(partition_by), "left_semi")
        if existing_where is not None:
            known = known.where(existing_where)
        new = new.alias("new").join(
            known.select(*keys).alias("known"),
            reduce(and_, [F.col(f"new.{k}").eqNullSafe(F.col(f"known.{k}")) for k in keys]),
            "left_anti",
        )
    writer = new.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_jdbc(rows: DataFrame, url: str, table: str, *, batch_size: int = 10_000, options: dict[str, str] | None = None) -> None:
    """Append to a database table in batches. Credentials come in through ``options``."""
    (
        rows.write.format("jdbc").mode("append")
        .options(**(options or {}), url=url, dbtable=table, batchsize=str(batch_size))
        .save()
    )


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = map(re.compile(r"version=(\d+)$").match, _list_names(spark, root))
    return sorted((int(m.group(1)) for m in names if m), reverse=True)


def latest_snapshot(spark: SparkSession, root: str) -> int | None:
    """The newest complete version under ``root``, or None."""
    for version in _versions(spark, root):
        if "_SUCCESS" in _list_names(spark, f"{root}/version={version}"):
            return version
    return None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    version = latest_snapshot(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/version={version}")


class VersionConflict(RuntimeError):
    """Another writer has claimed the next version, or written one since."""


def _claim(spark: SparkSession, root: str, version: int, abandoned_after: int) -> None:
    """Claim a version by creating its file, which file systems let one of several writers do."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{root}/_claims")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    complete = latest_snapshot(spark, root) or 0
    now = spark._jvm.System.currentTimeMillis()
    for entry in fs.listStatus(folder):
        number = int(entry.getPath().getName())
        if complete < number < version and now - entry.getModificationTime() < abandoned_after * 1000:
            raise VersionConflict(f"version {number} of {root} is being written")
    mine = fs.makeQualified(path(f"{root}/_claims/{version}"))
    try:
        if fs.getScheme() == "file":  # whose create looks first and then writes
            won = spark._jvm.java.io.File(mine.toUri().getPath()).createNewFile()
        else:
            fs.create(mine, False).close()
            won = True
    except Py4JJavaError as error:
        raise VersionConflict(f"version {version} of {root} can't be claimed") from error
    if not won:
        raise VersionConflict(f"version {version} of {root} is claimed by another writer")


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_snapshot(rows: DataFrame, root: str, *, base: int | None = None, abandoned_after: int = 86_400) -> int:
    """Write a new version of a table that is updated as a whole, and return its number.

    Readers keep the version before until the new one is complete, so ``rows`` may be computed from it. A writer first
    claims its version by creating a file, which of several writers only one can; the others get a ``VersionConflict``.
    With ``base``, the version that ``rows`` are computed from (0 for none), it is also a conflict if there is a newer
    one. A write that fails gives its claim up; claims of writers that died hold for ``abandoned_after`` seconds.
    """
    spark = rows.sparkSession
    claims = [int(n) for n in _list_names(spark, f"{root}/_claims")]
    version = max([*_versions(spark, root), *claims], default=0) + 1
    _claim(spark, root, version, abandoned_after)
    try:
        if base is not None and (latest_snapshot(spark, root) or 0) != base:
            raise VersionConflict(f"{root} has a version after {base}")
        rows.write.mode("error").parquet(f"{root}/version={version}")
    except BaseException:
        _delete(spark, f"{root}/_claims/{version}")
        raise
    return version


def vacuum_snapshots(spark: SparkSession, root: str, *, keep: int = 2, older_than: int = 86_400) -> list[int]:
    """Delete versions before the ``keep`` newest complete ones, and those that failed before them, and return their numbers.

    Versions written less than ``older_than`` seconds ago stay, so that readers that began with one can end.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    complete = [v for v in _versions(spark, root) if "_SUCCESS" in _list_names(spark, f"{root}/version={v}")]
    if len(complete) < keep or keep < 1:
        return []
    gone = []
    now = spark._jvm.System.currentTimeMillis()
    for version in _versions(spark, root):
        folder = path(f"{root}/version={version}")
        status = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder)
        if version < complete[keep - 1] and now - status.getModificationTime() >= older_than * 1000:
            _delete(spark, f"{root}/version={version}")
            _delete(spark, f"{root}/_claims/{version}")
            gone.append(version)
    return gone


def update_open_runs(spark: SparkSession, root: str, finish: Callable[[DataFrame], DataFrame]) -> None:
    """Finish runs of a run table without writing its history again.

    ``root/open`` holds versions of the runs that have not ended, ``root/closed`` all others by day of their end.
    ``finish`` takes the open runs and gives them back, some with an end; those move to the closed ones, once each.
    """
    base = latest_snapshot(spark, f"{root}/open")
    if base is None:
        return
    runs = spark.read.parquet(f"{root}/open/version={base}")
    done = finish(runs)
    key, end = done.columns[0], next(c for c in done.columns if c.endswith("_end_time"))
    ended = done.where(F.col(end).isNotNull()).withColumn("end_day", F.to_date(end))
    append_once(ended, f"{root}/closed", [key], partition_by=["end_day"])
    # Only what is closed by now leaves the open runs, so a failure in between loses nothing.
    write_snapshot(done.where(F.col(end).isNull()), f"{root}/open", base=base)


def append_registry(entries: DataFrame, table: str, path: str, *, key: str = "digest", buckets: int = 256) -> None:
    """Append entries to a registry that is a table bucketed by ``key``, and make it if it isn't there.

    What arrives is dealt to the buckets, and each bucket is read where it lies: the registry itself, which may have 10^9
    entries, is not shuffled to be looked up. ``table`` is its name in the catalog, ``path`` the folder of its files.
    """
    spark = entries.sparkSession
    mode = "append" if spark.catalog.tableExists(table) else "error"
    # One task a bucket writes one file for it.
    dealt = entries.repartition(buckets, key)
    dealt.write.mode(mode).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
