"""What is measured about every object, in one pass over its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallykeep.functions import as_money, row_text
from tallykeep.operators.digests import SUM_COLUMNS, content_sums, content_text


def object_profile(
    rows: DataFrame,
    *,
    key: str | Sequence[str] = "object_name",
    balance: str | None = None,
    text_columns: Sequence[str] | None = None,
    with_text: bool = False,
    with_digest: bool = False,
) -> DataFrame:
    """Row count, and on request balance, text size and unordered digest, of every object.

    All measures are sums, so each task adds up its own rows first and only one row per
    object and task is shuffled, however large one object is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = text_columns or [c for c in rows.columns if c not in keys]
    measures = [F.count("*").alias("row_count")]
    if balance is not None:
        measures.append(F.sum(as_money(balance)).alias("balance"))
    if with_text:
        measures.append(F.sum(F.length(row_text(rows, columns)).cast("bigint")).alias("text_size"))
    if not with_digest:
        return rows.groupBy(*keys).agg(*measures)
    summed = rows.groupBy(*keys).agg(*measures, *content_sums(rows, columns))
    return summed.withColumn("digest", content_text()).drop(*SUM_COLUMNS)


def first_last_cell(rows: DataFrame, cell: str, order: str, *, key: str = "object_name") -> DataFrame:
    """The cell of the first and of the last row of every object by ``order``."""
    return rows.groupBy(key).agg(
        F.min_by(cell, order).alias("first_value"),
        F.max_by(cell, order).alias("last_value"),
    )
