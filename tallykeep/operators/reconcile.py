"""Counts of two stores, matched by key or as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keyed_counts(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``(key, source_count, target_count)``; a key only one store has counts 0 in the other."""
    left = source.groupBy(key).agg(F.count("*").alias("source_count"))
    right = target.groupBy(key).agg(F.count("*").alias("target_count"))
    zero = F.lit(0).cast("bigint")
    return left.join(right, key, "full").select(
        key,
        F.coalesce("source_count", zero).alias("source_count"),
        F.coalesce("target_count", zero).alias("target_count"),
    )


def total_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with the two whole counts."""
    counted = [
        frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("store"), "n")
        for name, frame in (("source", source), ("target", target))
    ]
    both = counted[0].unionByName(counted[1])
    return both.agg(*[
        F.max(F.when(F.col("store") == name, F.col("n"))).alias(f"{name}_count")
        for name in ("source", "target")
    ])
