"""Relational sources over JDBC. Credentials come in through ``options``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_options(url: str, query: str, options: dict[str, str] | None = None) -> dict[str, str]:
    """Options for a query the database runs itself, such as a control total or a count."""
    return {**(options or {}), "url": url, "query": query}


def table_options(
    url: str,
    table: str,
    *,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    fetch_size: int = 10_000,
    options: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for a whole table, read over ``num_partitions`` connections at once."""
    if num_partitions < 1 or upper_bound <= lower_bound:
        raise ValueError("a parallel read needs lower_bound < upper_bound and a partition")
    return {
        **(options or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
    }


def read_query(spark: SparkSession, url: str, query: str, options=None) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, query, options)).load()


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(url, table, **kwargs)).load()
