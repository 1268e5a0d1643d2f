"""Readers for landed objects and for their control metadata.

All readers take a path, a glob or a list of them, and key the rows by the object they
came from, so one plan covers any number of objects. Mounted network shares are read like
any other path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallykeep.functions import slice_long
from tallykeep.sources.objects import first_and_last, last_cell, matched_paths, parquet_last_cells

POSITION = ["block_start", "row_seq"]


def _object_name(key: str) -> Column:
    if key == "file":
        return F.col("_metadata.file_name")
    if key == "folder":
        return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    if key == "path":
        return F.col("_metadata.file_path")
    raise ValueError(f"object key is file, folder or path, not {key!r}")


def read_objects(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    *,
    header: bool = True,
    schema=None,
    key: str = "file",
    position: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of all objects under ``paths`` with their ``object_name``.

    ``key`` says what one object is: a ``file``, a ``folder`` of part files, or the full
    ``path``. ``position`` adds two columns that order the rows of a file: the start of the
    split they were read from, and a counter that rises inside the split.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**(options or {})).load(paths)
    columns = [_object_name(key).alias("object_name")]
    if position:
        columns += [
            F.col("_metadata.file_block_start").alias(POSITION[0]),
            F.monotonically_increasing_id().alias(POSITION[1]),
        ]
    return df.select("*", *columns)


def read_listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Size and arrival time of files, without reading them. Empty files are not listed."""
    return (
        spark.read.format("binaryFile").load(paths)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_arrival_time"),
        )
    )


def _by_object(edges: DataFrame, key: str, cell: Column, *, first: bool) -> DataFrame:
    """One cell per object: of several files, that of the first or last by path."""
    if key == "file":
        name = F.element_at(F.split("file", "/"), -1)
    elif key == "folder":
        name = F.element_at(F.split("file", "/"), -2)
    elif key == "path":
        name = F.col("file")
    else:
        raise ValueError(f"object key is file, folder or path, not {key!r}")
    pick = F.min_by if first else F.max_by
    named = edges.select(name.alias("object_name"), "file", cell.alias("cell"))
    return named.groupBy("object_name").agg(pick("cell", "file").alias("meta_string"))


def _found(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files and folders that paths and globs stand for; a path that stands for none is left as it is, to be reported."""
    found = matched_paths(spark, paths)
    return [root for path in paths for root in found[path] or [path]]


def read_manifests(spark: SparkSession, paths: str | Sequence[str], *, key: str = "file") -> DataFrame:
    """The first line of every manifest: ``(object_name, meta_string)``."""
    edges = first_and_last(spark, _found(spark, [paths] if isinstance(paths, str) else list(paths)), as_csv=False)
    return _by_object(edges, key, F.col("first_line"), first=True)


def control_cells(
    spark: SparkSession, paths: str | Sequence[str], fmt: str, place: str, *, key: str = "file"
) -> DataFrame:
    """The control cell kept inside the objects: ``(object_name, meta_string)``.

    ``Header``: last cell of the first line of an object. ``Footer``: last cell of its last line. Every line is taken
    apart by itself, so the files of one object may have different columns; quoted cells of csv may go over line ends.
    """
    if place not in ("Header", "Footer"):
        raise ValueError(f"control cells are in the Header or the Footer, not {place!r}")
    roots = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        edges, kind = parquet_last_cells(spark, roots), "text"
    else:
        edges, kind = first_and_last(spark, _found(spark, roots), as_csv=fmt == "csv"), fmt
    line = F.col("first_line" if place == "Header" else "last_line")
    return _by_object(edges, key, last_cell(F.lit(kind), line), first=place == "Header")


def manifest_control(
    meta: DataFrame, count_slice: tuple, balance_slice: tuple, meta_column: str = "meta_string"
) -> DataFrame:
    """``(object_name, control_count, control_balance)`` from the control strings.

    A slice is ``(start, end)`` as ints or as names of columns of ``meta``.
    """
    return meta.select(
        "object_name",
        slice_long(meta_column, *count_slice).alias("control_count"),
        slice_long(meta_column, *balance_slice).alias("control_balance"),
    )


def read_control(
    spark: SparkSession,
    place: str,
    paths: str | Sequence[str],
    count_slice: tuple,
    balance_slice: tuple,
    *,
    fmt: str = "csv",
    key: str = "file",
) -> DataFrame:
    """Control totals from a manifest file (``File``), a ``Header`` or a ``Footer``."""
    if place == "File":
        meta = read_manifests(spark, paths, key=key)
    else:
        meta = control_cells(spark, paths, fmt, place, key=key)
    return manifest_control(meta, count_slice, balance_slice)
