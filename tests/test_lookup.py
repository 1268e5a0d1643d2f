"""The lookup join is whole and right when a key is hot, missing or unknown."""

import pytest

from conftest import rows
from tallykeep.operators.lookup import lookup_join


@pytest.mark.parametrize("hot_rows", [1, 5, 1_000_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_against_a_plain_join(spark, hot_rows, how):
    data = [(i, 0 if i % 3 else i % 7) for i in range(200)] + [(1000 + i, None) for i in range(20)] + [(2000, 99)]
    left = spark.createDataFrame(data, "id bigint, k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in (0, 1, 2, 3, 5, 50)], "k int, v string")
    found = lookup_join(left, right, "k", "id", how=how, hot_rows=hot_rows)
    assert found.columns == ["id", "k", "v"]
    assert rows(found) == rows(left.join(right, "k", how).select("id", "k", "v"))


def test_several_keys(spark):
    left = spark.createDataFrame([(i, i % 2, "a" if i % 3 else None) for i in range(30)], "id bigint, k int, m string")
    right = spark.createDataFrame([(0, "a", 1), (1, "a", 2)], "k int, m string, v int")
    found = lookup_join(left, right, ["k", "m"], "id", hot_rows=4)
    assert rows(found) == rows(left.join(right, ["k", "m"], "left").select("id", "k", "m", "v"))


def test_hot_rows_are_spread(spark):
    left = spark.range(4000).selectExpr("id", "0 as k")
    right = spark.createDataFrame([(0, "v")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup_join(left, right, "k", "id", hot_rows=100)
        sizes = [n for n in found.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 4000 and max(sizes) < 2000
