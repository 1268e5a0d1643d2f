"""Differences of stores, delivery calendars, stored digest trees and daily states."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.operators import calendar, daily, trees
from tallykeep.operators.differences import differing_keys, differing_ranges, _hashed
from tallykeep.operators.profile import object_profile


# -- differences


def store(spark, found):
    return spark.createDataFrame(found, "k long, v string, w int")


def plain_differences(a, b):
    sides = [collections.defaultdict(collections.Counter) for _ in range(2)]
    for side, found in zip(sides, (a, b)):
        for k, *v in found:
            side[k][tuple(v)] += 1
    out = []
    for k in {*sides[0], *sides[1]}:
        x, y = sides[0][k], sides[1][k]
        if x != y:
            kind = "Missing" if not y else "Extra" if not x else "Changed"
            out.append((k, sum(x.values()), sum(y.values()), kind))
    return sorted(out, key=repr)


def test_differing_keys_of_two_stores(spark):
    made = random.Random(2)
    a = [(i, made.choice(["x", None, ""]), i % 5) for i in range(3000)] + [(None, "n", 1), (7, "again", 1), (7, "again", 1)]
    b = [r for r in a if r[0] not in (3, 40)] + [(5000, "new", 1), (None, "n", 1)]
    b = [(k, "other", w) if k == 99 else (k, v, None) if k == 100 else (k, v, w) for k, v, w in b]
    b.remove((7, "again", 1))
    made.shuffle(b)
    got = rows(differing_keys(store(spark, a), store(spark, b), ["k"]), "k", "source_rows", "target_rows", "difference")
    assert got == plain_differences(a, b) and len(got) == 7
    few = differing_keys(store(spark, a), store(spark, b), ["k"], round_bits=(1, 2))
    assert rows(few, "k", "source_rows", "target_rows", "difference") == got
    nothing = store(spark, [])
    assert differing_keys(store(spark, a), store(spark, a[::-1]), ["k"]).collect() == []
    assert differing_keys(nothing, nothing, ["k"]).collect() == []
    assert differing_keys(store(spark, [(1, "x", 1)]), nothing, ["k"]).first().difference == "Missing"


def test_only_ranges_that_differ_are_moved(spark):
    a = [(i, "x", 1) for i in range(20000)]
    sides = [_hashed(store(spark, s), ["k"], ["k", "v", "w"]) for s in (a, [(k, "y" if k in (5, 6) else v, w) for k, v, w in a])]
    coarse = differing_ranges(*sides, 12).collect()
    assert 1 <= len(coarse) <= 2 and sum(r.source_rows for r in coarse) < 100
    fine = differing_ranges(*sides, 28).collect()
    assert len(fine) == 2 and sum(r.source_rows for r in fine) < 5


# -- calendar


def test_deliveries_over_midnight_early_late_missing_and_unexpected(spark):
    day = dt.date(2024, 2, 27)
    schedule = spark.createDataFrame(
        [("a", day, day + dt.timedelta(days=4), 2, "23:50:00", 30, 60), ("b", day, day, 1, "06:00:00", None, None),
         ("never", day, day - dt.timedelta(days=1), 1, "06:00:00", 1, 1), ("odd", day, day, 0, "06:00:00", 1, 1)],
        "file_name string, first_day date, last_day date, every_days int, due_clock string, early_minutes int, late_minutes int")
    at = lambda d, h, m: dt.datetime(2024, 2, d, h, m) if d < 30 else dt.datetime(2024, 3, d - 29, h, m)
    seen = spark.createDataFrame(
        [("a", at(28, 0, 50)), ("a", at(28, 0, 50)), ("a", at(29, 22, 0)), ("a", at(30, 0, 30)), ("a", at(20, 1, 1)), ("b", at(27, 6, 1)),
         ("c", at(27, 6, 0)), ("c", at(26, 6, 0)), (None, at(27, 6, 0)), ("b", None)], "file_name string, arrival_time timestamp")
    due = calendar.due_times(schedule)
    assert due.count() == 4
    got = calendar.arrival_calendar(due, seen)
    assert rows(got, "file_name", "due_time", "arrival_time", "arrivals", "status") == sorted([
        ("a", at(27, 23, 50), at(28, 0, 50), 2, "On Time"), ("a", at(29, 23, 50), at(29, 22, 0), 2, "Early"),
        ("a", dt.datetime(2024, 3, 2, 23, 50), None, 0, "Missing"), ("b", at(27, 6, 0), at(27, 6, 1), 1, "Late"),
        ("a", None, at(20, 1, 1), 1, "Unexpected"), ("c", None, at(26, 6, 0), 2, "Unexpected")], key=repr)
    for bins in (60, 100000):
        assert rows(calendar.arrival_calendar(due, seen, bin_minutes=bins)) == rows(got)
    assert calendar.arrival_calendar(due.where("false"), seen.where("false")).collect() == []


def test_a_delivery_of_many_days_is_matched_by_bins(spark):
    schedule = spark.createDataFrame([("f", dt.date(2000, 1, 1), dt.date(2020, 1, 1), 1, "12:00:00", 5, 5)],
                                     "file_name string, first_day date, last_day date, every_days int, due_clock string, early_minutes int, late_minutes int")
    due = calendar.due_times(schedule)
    seen = due.select("file_name", F.expr("due_time + interval 3 minutes").alias("arrival_time"))
    held = calendar.arrival_calendar(due, seen)
    assert rows(held.groupBy("status").count()) == [("On Time", due.count())]


# -- trees


def chunks(spark, found, bits=2, stored=None):
    df = spark.createDataFrame(found, "name string, at long, v string")
    return trees.chunk_digests(df, "name", "at", F.shiftright("at", 3), ["at", "v"], chunk_bits=bits, stored=stored)


def test_first_chunk_that_differs(spark):
    same = [("same", i, "x") for i in range(9)]
    before = same + [("grown", i, "x") for i in range(6)] + [("changed", i, "x") for i in range(12)] + [("cut", i, "x") for i in range(9)] + [("gone", 1, "x")]
    after = same + [("grown", i, "x") for i in range(11)] + [("changed", i, "y" if i == 5 else "x") for i in range(12)] \
        + [("cut", i, "x") for i in range(7)] + [("new", 1, "x"), (None, 1, "x"), ("new", None, "x")]
    got = trees.first_differences(chunks(spark, before), chunks(spark, after), "name", chunk_bits=2)
    assert rows(got) == sorted([
        ("same", 9, 9, None, 9, "Same"), ("grown", 6, 11, 1, 4, "Grown"), ("changed", 12, 12, 1, 4, "Changed"),
        ("cut", 9, 7, 1, 4, "Changed"), ("gone", 1, 0, 0, 0, "Gone"), ("new", 0, 1, 0, 0, "New")], key=repr)
    empty = chunks(spark, [])
    assert trees.first_differences(empty, empty, "name").collect() == []


@pytest.mark.parametrize("first", [0, 1, 4, 5, 8, 11])
def test_growth_hashes_only_the_rows_after_the_full_chunks(spark, first):
    found = [("a", i, f"v{i}") for i in range(11)] + [("b", i, "w") for i in range(3)]
    stored = chunks(spark, [r for r in found if r[1] < first])
    whole = chunks(spark, found)
    # Rows of full chunks aren't looked at again: other content there makes no difference.
    full = first // 4 * 4
    grown = chunks(spark, [(n, i, "not read" if n == "a" and i < full else v) for n, i, v in found], stored=stored)
    assert rows(grown) == rows(whole)
    assert rows(trees.digest_of_chunks(grown, "name")) == rows(trees.digest_of_chunks(whole, "name"))


# -- daily states


def test_states_add_up_and_read_only_new_days(spark, tmp_path):
    made = random.Random(5)
    found = [(made.choice("abc"), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=made.randint(0, 14 * 1440 - 1)), str(made.randint(-5, 99)), i)
             for i in range(600)] + [("d", dt.datetime(2024, 1, 14, 5), None, 600), (None, dt.datetime(2024, 1, 2), "1", 601), ("a", None, "1", 602)]
    events = spark.createDataFrame(found, "name string, ts timestamp, amt string, id int")
    root, data = str(tmp_path / "state"), str(tmp_path / "events")
    usable = events.where("name is not null and ts is not null")
    usable.withColumn("day", F.to_date("ts")).repartition("day").sortWithinPartitions("ts").write.partitionBy("day").parquet(data)
    full = object_profile(usable, key="name", balance="amt", text_columns=["id", "amt"], with_text=True, with_digest=True)
    arguments = {"key": "name", "time": "ts", "columns": ["id", "amt"], "balance": "amt"}
    for until in (3, 3, 4, 9, 14):
        now = events.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days=until)))
        state = daily.advance_state(spark, root, now, **arguments)
        wanted = daily.profile_of_states(daily.daily_state(now, **arguments), "name")
        assert rows(daily.profile_of_states(state, "name")) == rows(wanted)
    got = daily.profile_of_states(state, "name").select("name", "row_count", "balance", "text_size", "digest")
    assert rows(got) == rows(full.select("name", "row_count", "balance", "text_size", "digest"))
    later = daily.days_of(spark.read.parquet(data), "ts", F.lit(dt.date(2024, 1, 12)))
    assert later.select(F.to_date("ts")).distinct().count() == 2
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in later._jdf.queryExecution().executedPlan().toString()
    halves = [daily.daily_state(events.where(f"id % 2 = {i}"), **arguments) for i in (0, 1)]
    assert rows(daily.merge_states(*halves, key="name")) == rows(daily.daily_state(events, **arguments))
