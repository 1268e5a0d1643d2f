"""Daily states: what is measured of an object, kept by day and added up, so that a run reads only the days that are new.

A state has a row for every object and day with sums, extremes and the first arrival. States of any days add up to that of
all of them, in any order, so a run over years of files reads the stored state and the rows of the newest days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallykeep.functions import as_money, row_text
from tallykeep.operators.digests import SUM_COLUMNS, content_text, hash_sums
from tallykeep.sinks.tables import latest_snapshot, read_snapshot, write_snapshot

_ADDED = ["row_count", "balance", "text_size", *SUM_COLUMNS]


def daily_state(rows: DataFrame, key: str, time: str, columns: Sequence[str], *, balance: str | None = None) -> DataFrame:
    """The state of rows: ``(key, day, row_count, balance, text_size, sums, first_time, last_time)``.

    ``columns`` are those that the text size and the content's sums are of. Rows without an object or time are in no state.
    """
    amount = F.lit(None).cast("decimal(28,8)") if balance is None else as_money(balance)
    text = row_text(rows, columns)
    return rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, F.to_date(time).alias("day")).agg(
        F.count("*").alias("row_count"), F.sum(amount).cast("decimal(38,8)").alias("balance"),
        F.sum(F.length(text).cast("bigint")).alias("text_size"), *hash_sums(text),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def _merged(states: DataFrame, keys: list[str | Column]) -> DataFrame:
    return states.groupBy(*keys).agg(
        *[F.sum(c).cast(states.schema[c].dataType).alias(c) for c in _ADDED],
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def merge_states(*states: DataFrame, key: str) -> DataFrame:
    """One state of several, which may have rows of the same object and day."""
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    return _merged(whole, [key, "day"])


def profile_of_states(states: DataFrame, key: str) -> DataFrame:
    """``(key, row_count, balance, text_size, digest, first_time, last_time)`` of every object, over all days of a state.

    The digest is the unordered one of ``object_profile``.
    """
    return _merged(states, [key]).withColumn("digest", content_text()).drop(*SUM_COLUMNS)


def days_of(rows: DataFrame, time: str, after: Column) -> DataFrame:
    """Rows of the days after a day. On a scan this is a filter that leaves out files and row groups of earlier days."""
    return rows.where(F.col(time) >= F.date_add(after, 1).cast(rows.schema[time].dataType))


def advance_state(
    spark: SparkSession, root: str, rows: DataFrame, key: str, time: str, columns: Sequence[str], *, balance: str | None = None,
) -> DataFrame:
    """Bring the stored state up to date with the days after its last one, store it and give it back.

    The last day of the state is read again, as it may not have been over; its row in the state is replaced. A state that isn't
    there yet is made of all rows. Rows that come later for days before that are not seen; ``merge_states`` adds them.
    """
    base = latest_snapshot(spark, root)
    if base is None:
        write_snapshot(daily_state(rows, key, time, columns, balance=balance), root, base=0)
    else:
        known = read_snapshot(spark, root)
        last = known.agg(F.max("day")).first()[0]
        if last is not None:
            known, rows = known.where(F.col("day") < F.lit(last)), days_of(rows, time, F.date_sub(F.lit(last), 1))
        write_snapshot(merge_states(known, daily_state(rows, key, time, columns, balance=balance), key=key), root, base=base)
    return read_snapshot(spark, root)
