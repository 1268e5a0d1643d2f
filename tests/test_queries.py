"""Every registered query against its SQL on the same tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.oracle import ORACLES
from checks.queries import QUERIES
from compare import connect, duck_rows, spark_rows

ROOT = "/root/testdata"
SCALES = os.environ.get("CHECK_SCALES", "sf0.001").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="the given tables are not here")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, name, scale):
    sf_dir = f"{ROOT}/{scale}"
    found = spark_rows(entry.queries()[name](spark, sf_dir))
    wanted = duck_rows(connect(sf_dir), entry.oracle_sql()[name])
    spark.catalog.clearCache()
    assert found == wanted
    assert found[1]


def test_entry_gives_a_result_for_every_object(spark):
    result = entry.entry(spark)
    assert result.columns == ["object_name", "source_value", "target_value", "status"]
    assert result.count() > 0


@pytest.mark.parametrize("name", ["suite_results", "content_digest", "job_run_stats", "duplicate_content_check"])
def test_result_does_not_depend_on_partitions_or_join_kind(spark, name):
    sf_dir = f"{ROOT}/sf0.001"
    first = spark_rows(entry.queries()[name](spark, sf_dir))
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert spark_rows(entry.queries()[name](spark, sf_dir)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.catalog.clearCache()
