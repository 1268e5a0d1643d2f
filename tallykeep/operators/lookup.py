"""Many rows looked up in a table with one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

# Rows without a key match nothing and are spread over so many parts.
SPREAD = 1_000_000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: str | Sequence[str],
    row_id: str,
    *,
    how: str = "left",
    hot_rows: int | None = None,
) -> DataFrame:
    """``rows`` joined to the at most one ``lookup`` row of their keys.

    Every row is kept (``how='left'``) or every row with a match is (``how='inner'``). As a key has one lookup row,
    adaptive execution can split the rows of a hot key as it meets them, which reads ``rows`` once. Where it is off,
    ``hot_rows`` counts the keys first, which reads ``rows`` twice: the rows of a key with at least so many are split
    over parts of about that size, by ``row_id``, and its lookup row is repeated for each part.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in lookup.columns if c not in keys]
    if hot_rows is None:
        return rows.join(lookup, keys, how).select(*rows.columns, *values)
    hot = (
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    split_rows = rows.join(hot, keys, "left").withColumn(
        "_part", F.pmod(F.xxhash64(row_id), F.when(no_key, SPREAD).otherwise(parts)).cast("int")
    )
    repeated = lookup.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return split_rows.join(repeated.drop("_parts"), [*keys, "_part"], how).select(*rows.columns, *values)
