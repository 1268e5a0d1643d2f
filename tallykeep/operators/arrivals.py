"""The log of arrived files: filters, first arrival and name matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Product names that start so belong to the time after processing (fixed value).
POST_PREFIX = "Post%"


def pre_audit(audit_log: DataFrame) -> DataFrame:
    """Arrivals before processing. A missing product name passes neither filter."""
    return audit_log.where(~F.col("product_name").like(POST_PREFIX))


def post_audit(audit_log: DataFrame) -> DataFrame:
    return audit_log.where(F.col("product_name").like(POST_PREFIX))


def first_arrivals(
    audit_log: DataFrame,
    kept: Sequence[str],
    *,
    key: str = "file_name",
    time: str = "file_arrival_time",
    tie_break: str = "event_id",
) -> DataFrame:
    """``kept`` of the earliest log row of every file, and how many rows the file has.

    One row per file and task is shuffled, so a file with very many arrivals costs no more
    than another. Rows without an arrival time come last.
    """
    order = F.struct(F.col(time).isNull(), F.col(time), F.col(tie_break))
    return (
        audit_log.groupBy(key)
        .agg(F.min_by(F.struct(*kept), order).alias("_first"), F.count("*").alias("match_count"))
        .select(key, "match_count", *[F.col(f"_first.{c}").alias(c) for c in kept])
    )


def name_matches(audit_log: DataFrame, key: str = "file_name") -> DataFrame:
    return audit_log.groupBy(key).agg(F.count("*").alias("match_count"))
