"""Recurring deliveries: which of the expected files of many days came, when, and which arrivals nobody expected.

A schedule says from which day to which a file is due every so many days, at what time, and how far off it may be. Arrivals
are matched to due times by an interval join in bins: a due window lies in the few bins it touches, an arrival in one,
so both meet by equality of file and bin. Windows are points in time, so they may reach over midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EARLY, ON_TIME, LATE, MISSING, UNEXPECTED = "Early", "On Time", "Late", "Missing", "Unexpected"

_US = 1_000_000


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def due_times(schedule: DataFrame) -> DataFrame:
    """``(file_name, due_time, early_minutes, late_minutes)`` of every delivery of a schedule.

    ``schedule`` is ``(file_name, first_day, last_day, every_days, due_clock, early_minutes, late_minutes)``; ``due_clock``
    is like '23:50:00'. A schedule without a day, or that repeats in less than a day, has no deliveries.
    """
    days = F.sequence("first_day", "last_day", F.make_dt_interval("every_days"))
    usable = (F.col("every_days") > 0) & (F.col("first_day") <= F.col("last_day")) & F.col("due_clock").isNotNull()
    due = F.to_timestamp(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" "), F.col("due_clock")))
    return schedule.where(usable).withColumn("day", F.explode(days)).select(
        "file_name", due.alias("due_time"), "early_minutes", "late_minutes").where(F.col("due_time").isNotNull())


def arrival_calendar(due: DataFrame, arrivals: DataFrame, *, window_minutes: int = 720, bin_minutes: int = 1440) -> DataFrame:
    """``(file_name, due_time, arrival_time, arrivals, status)`` of every due time, and of arrivals that no window holds.

    ``due`` is as ``due_times`` gives it, ``arrivals`` is ``(file_name, arrival_time)``. A window reaches ``window_minutes`` to
    both sides of its due time, the earlier side included. The first arrival in it counts: ``On Time`` within the early and
    late minutes, both included, ``Early`` or ``Late`` beyond, ``Missing`` if there is none; ``arrivals`` says how many there
    are. Due times of a file that are closer than their windows are wide share the arrivals between them. Rows
    without a file or a time are left out; ``Unexpected`` arrivals have no due time and are counted by file.
    """
    reach, width = window_minutes * 60 * _US, bin_minutes * 60 * _US
    bins = F.sequence(F.floor((F.col("_due") - reach) / width), F.floor((F.col("_due") + reach) / width))
    wanted = due.where(F.col("file_name").isNotNull() & F.col("due_time").isNotNull()).withColumn("_due", _micros("due_time"))
    seen = arrivals.where(F.col("file_name").isNotNull() & F.col("arrival_time").isNotNull()).select(
        "file_name", "arrival_time", _micros("arrival_time").alias("_at"))
    # A file with very many arrivals is brought to one row per point in time before they meet.
    seen = seen.groupBy("file_name", "arrival_time", "_at").agg(F.count("*").alias("_n"))
    seen = seen.withColumn("_bin", F.floor(F.col("_at") / width))
    held = wanted.withColumn("_bin", F.explode(bins)).join(seen, ["file_name", "_bin"]).where(
        (F.col("_at") >= F.col("_due") - reach) & (F.col("_at") < F.col("_due") + reach))
    keys = ["file_name", "due_time"]
    first = held.groupBy(*keys).agg(F.min("arrival_time").alias("arrival_time"), F.sum("_n").alias("arrivals"))
    early = F.col("_due") - F.coalesce("early_minutes", F.lit(0)).cast("bigint") * (60 * _US)
    late = F.col("_due") + F.coalesce("late_minutes", F.lit(0)).cast("bigint") * (60 * _US)
    at = F.unix_micros(F.col("arrival_time").cast("timestamp"))
    status = (F.when(at.isNull(), MISSING).when(at < early, EARLY).when(at > late, LATE).otherwise(ON_TIME))
    expected = wanted.join(first, keys, "left").select(
        "file_name", F.col("due_time").cast("timestamp").alias("due_time"), F.col("arrival_time").cast("timestamp").alias("arrival_time"),
        F.coalesce("arrivals", F.lit(0)).cast("bigint").alias("arrivals"), status.alias("status"))
    used = held.select("file_name", "_at").distinct()
    others = seen.join(used, ["file_name", "_at"], "left_anti").groupBy("file_name").agg(
        F.min("arrival_time").alias("arrival_time"), F.sum("_n").alias("arrivals"))
    return expected.unionByName(others.select(
        "file_name", F.lit(None).cast("timestamp").alias("due_time"), F.col("arrival_time").cast("timestamp").alias("arrival_time"),
        "arrivals", F.lit(UNEXPECTED).alias("status")))
