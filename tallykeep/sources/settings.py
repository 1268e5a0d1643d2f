"""Job arguments and the key,value parameter file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallykeep.functions import first_comma_split
from tallykeep.schemas import JOB_ARGUMENT_COLUMNS
from tallykeep.sources.files import read_objects


def read_job_args(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One typed row per job. Columns a file does not have are null; credentials are not read."""
    raw = spark.read.option("header", True).csv(paths)
    return raw.select(*[
        (F.col(f"`{given}`") if given in raw.columns else F.lit(None)).try_cast(dtype).alias(name)
        for given, (name, dtype) in JOB_ARGUMENT_COLUMNS.items()
    ])


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a parameter file as ``(pos, value)``, ``pos`` rising in file order."""
    lines = read_objects(spark, path, "text", position=True)
    return lines.select(F.struct("block_start", "row_seq").alias("pos"), "value")


def param_lookup(requested: DataFrame, lines: DataFrame) -> DataFrame:
    """``(param_key, param_value)`` for every requested key.

    The first line that carries the key wins, the value is all after its first comma, and a
    key without a line or without a value gets ''.
    """
    key, value = first_comma_split("value")
    first_lines = (
        lines.select("pos", key.alias("param_key"), value.alias("param_value"))
        .groupBy("param_key")
        .agg(F.min_by("param_value", "pos").alias("param_value"))
    )
    return (
        requested.select("param_key")
        .join(first_lines, "param_key", "left")
        .select("param_key", F.coalesce("param_value", F.lit("")).alias("param_value"))
    )
