"""Which rules a job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Repeats of one assignment are dealt to so many tasks at most before they are dropped.
SPREAD = 64


def assigned_rules(assignment: DataFrame, validation_type: str | None = None, limit: int | None = None) -> DataFrame:
    """The rule ids of every job and stage, each once and numbered from 1; only the lowest ``limit`` if there is one.

    Rows are dealt out before repeated ones are dropped: a table of few, long splits would hold all of its different rows
    in the memory of the few tasks that read it. A job with very many assignment rows, even equal ones, does not load one task.
    """
    groups = ["job_id", "validation_type"]
    if validation_type is not None:
        assignment = assignment.where(F.col("validation_type") == validation_type)
        groups = ["job_id"]
    by_rule = Window.partitionBy(*groups).orderBy("rule_id")
    columns = ["job_id", "validation_type", "rule_id"]
    dealt = assignment.select(*columns, F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("_from")).repartition(*columns, "_from")
    numbered = (
        dealt.select(*columns).distinct()
        .withColumn("rn", F.row_number().over(by_rule).cast("bigint"))
    )
    return numbered if limit is None else numbered.where(F.col("rn") <= limit)


def rule_lists(assignment: DataFrame, validation_type: str, limit: int | None = None) -> DataFrame:
    """``(job_id, rule_ids)``, the ids sorted and each once; at most ``limit`` per job if there is one."""
    if limit is None:
        rules = assignment.where(F.col("validation_type") == validation_type).groupBy("job_id")
        return rules.agg(F.sort_array(F.collect_set("rule_id")).alias("rule_ids"))
    return (
        assigned_rules(assignment, validation_type, limit)
        .groupBy("job_id")
        .agg(F.sort_array(F.collect_list("rule_id")).alias("rule_ids"))
    )
