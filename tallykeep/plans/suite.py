"""All assigned rules of all jobs in one plan, and the logs that come out of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallykeep.functions import is_blank, slice_long
from tallykeep.operators.assignment import rule_lists
from tallykeep.operators.rules import AUDIT_LABELS, ERROR, FAILED, PASSED, POST, PRE, RULES, TITLES, Rule

# Result text of a job whose object is not configured, by stage (fixed values).
BLANK_OBJECT = {
    PRE: "Error Message : ObjectName or Path is blank in Pre Validation Wrapper Function",
    POST: "Error Message : ObjectName or Path is blank in Post Wrapper Function",
}
# Fixed value: what a line of the validation log begins with when a rule ended in an error.
ERROR_LINE = "Error Occured "
SEPARATOR = " | "

KNOWN_TYPE = f"coalesce(object_type in ({', '.join(map(repr, AUDIT_LABELS))}), false)"


def blank_object(validation_type: str) -> Column:
    """True for jobs without an object name, or without a path unless the object is a table."""
    path = "object_path_post" if validation_type == POST else "object_path"
    not_a_table = F.coalesce(F.col("object_type") != "SQLTable", F.lit(True))
    return is_blank("object_name") | (is_blank(path) & not_a_table)


def blank_object_guard(job_args: DataFrame, validation_type: str = PRE) -> DataFrame:
    return job_args.select(
        "job_id", F.when(blank_object(validation_type), ERROR).otherwise(PASSED).alias("status")
    )


def gather_measures(jobs: DataFrame, parts: Sequence[DataFrame], key: str = "object_name") -> DataFrame:
    """``jobs`` with the measures of their object. Every part has one row per ``key``.

    All joins are on the same key, so the growing left side is shuffled once. Jobs with a blank or null name,
    which would meet in one task, are joined by a text that no object has, each by its own.
    """
    if not parts:
        return jobs
    if dict(jobs.dtypes)[key] != "string":
        for part in parts:
            jobs = jobs.join(part, key, "left")
        return jobs
    nobody = F.concat(F.lit("\0"), F.xxhash64(*jobs.columns).cast("string"))
    keyed = jobs.withColumn("_own", F.col(key)).withColumn(key, F.when(is_blank(key), nobody).otherwise(F.col(key)))
    for part in parts:
        keyed = keyed.join(part, key, "left")
    return keyed.withColumn(key, F.col("_own")).drop("_own")


def add_control_totals(measures: DataFrame, meta: str = "meta_string", prefix: str = "") -> DataFrame:
    """Control count and amount cut from the control string at the positions of each job."""
    return measures.withColumns({
        f"{prefix}control_count": slice_long(meta, "count_start", "count_end"),
        f"{prefix}control_balance": slice_long(meta, "balance_start", "balance_end"),
    })


def rule_labels(spark: SparkSession) -> DataFrame:
    """What the log says about each rule and object type: a fixed table of 36 rows."""
    rows = []
    for rule in RULES:
        for object_type in AUDIT_LABELS:
            names = rule.labels if isinstance(rule.labels, tuple) else rule.labels[object_type]
            texts = ", ".join(f"'{t}'" for t in (object_type, *TITLES[rule.rule_id][2:], *names))
            rows.append(f"({rule.rule_id}, {texts})")
    return spark.sql(
        f"select * from values {', '.join(rows)} as labels"
        "(rule_id, object_type, source_value_type, target_value_type, source_name, target_name)"
    )


def _judged(rule: Rule, available: set[str]) -> list[str]:
    """Source value, target value and status of one rule as columns of their own."""
    if any(name not in available for name in (*rule.required, *rule.optional)):
        found = ["cast(null as string)", "cast(null as string)", f"'{ERROR}'"]
    else:
        status = rule.status
        if isinstance(rule.labels, dict):
            status = f"if({KNOWN_TYPE}, {status}, '{ERROR}')"
        found = [f"cast({rule.source} as string)", f"cast({rule.target} as string)", status]
    return [f"{sql} as _{name}_{rule.rule_id}" for name, sql in zip(("source", "target", "status"), found)]


def _result(rule: Rule, available: set[str]) -> str:
    absent = [n for n in (*rule.required, *rule.optional) if n not in available]
    if absent:
        missing = f"'{', '.join(absent)}'"
    else:
        gaps = [f"if({name} is null, '{name}', null)" for name in rule.required]
        if isinstance(rule.labels, dict):
            gaps.insert(0, f"if({KNOWN_TYPE}, null, 'object_type')")
        missing = f"concat_ws(', ', {', '.join(gaps)})" if gaps else "''"
    n = rule.rule_id
    return f"""named_struct(
        'rule_id', {n}, 'source_value', _source_{n}, 'target_value', _target_{n}, 'status', _status_{n},
        'text', case _status_{n} when '{ERROR}' then 'Error Message : no value for ' || {missing}
                when '{FAILED}' then '{rule.failed_text}' else '{rule.passed_text}' end)"""


def run_suite(
    measures: DataFrame, assignment: DataFrame, validation_type: str | Sequence[str], *, limit: int | None = None
) -> DataFrame:
    """The results of the rules every job ran, one row per job and rule.

    ``measures`` has one row per job: its arguments and the measures of its object. All rules
    of the stage, or of several stages at once, are expressions over that row; those assigned to the job are
    unfolded into rows, up to and with the first one of a stage that ends the run (an error, or an empty object). The
    rows of a job stay where the job is, so neither the order of the rules nor the stop needs
    another shuffle. A job that ran no rule of a stage has one row without a ``rule_id``.
    """
    stages = [validation_type] if isinstance(validation_type, str) else list(validation_type)
    available = set(measures.columns)
    stage_rules = [r for r in RULES if r.stage in stages]
    lists = None
    for name in stages:
        one = rule_lists(assignment, name, limit).withColumnRenamed("rule_ids", f"_ids_{name}")
        lists = one if lists is None else lists.join(one, "job_id", "full")
    by_stage = [
        (F.lit(name).alias("validation_type"), F.col(f"_ids_{name}").alias("rule_ids"), blank_object(name).alias("is_blank"))
        for name in stages
    ]
    assigned = measures.join(lists, "job_id", "left")
    if len(stages) == 1:
        assigned = assigned.select("*", *by_stage[0])
    else:
        assigned = assigned.select("*", F.explode(F.array(*[F.struct(*c) for c in by_stage])).alias("_stage")).select("*", "_stage.*")
    judged = assigned.selectExpr("*", *[sql for r in stage_rules for sql in _judged(r, available)])
    outcomes = ", ".join(_result(r, available) for r in stage_rules)
    results = judged.selectExpr(
        "job_id", "object_name", "object_type", "is_blank", "validation_type",
        f"inline_outer(filter(array({outcomes}), r -> not is_blank and array_contains(rule_ids, r.rule_id)))",
    )
    earlier = Window.partitionBy("job_id", "validation_type").orderBy("rule_id").rowsBetween(
        Window.unboundedPreceding, -1)
    stops = (F.col("status") == ERROR) | ((F.col("rule_id") == 0) & (F.col("status") == FAILED))
    return (
        results.withColumn("stops", stops)
        .withColumn("_stopped", F.max("stops").over(earlier))
        .where(~F.coalesce("_stopped", F.lit(False)))
        .drop("_stopped")
    )


def rule_execution_log(suite: DataFrame, created_time: Column, created_by: str) -> DataFrame:
    """One row per rule that came to a result. Rules in error are in the error log instead."""
    labels = F.broadcast(rule_labels(suite.sparkSession))
    return suite.where(F.col("status") != ERROR).join(labels, ["rule_id", "object_type"], "left").select(
        "job_id", "rule_id", "source_value", "target_value",
        "source_value_type", "target_value_type", "source_name", "target_name",
        F.col("status").alias("rule_run_status"),
        created_time.alias("created_time"), F.lit(created_by).alias("created_by"),
        "object_name",
    )


def _blank_text() -> Column:
    text = F.lit(None).cast("string")
    for stage, message in BLANK_OBJECT.items():
        text = F.when(F.col("validation_type") == stage, message).otherwise(text)
    return text


def _by_job(suite: DataFrame, *more: Column) -> DataFrame:
    """One row per job. The rows of a job are together already, so nothing is shuffled."""
    in_order = F.expr(f"listagg(text, '{SEPARATOR}') within group (order by rule_id)")
    return (
        suite.groupBy("job_id", "is_blank", "validation_type")
        .agg(
            F.count_if(F.col("status") != ERROR).alias("rules_run"),
            F.count_if(F.col("status") == FAILED).alias("rules_failed"),
            F.coalesce(F.max("stops"), F.lit(False)).alias("_stopped"),
            F.max(F.when(F.col("status") == ERROR, F.col("text"))).alias("_error_text"),
            in_order.alias("_texts"),
            *more,
        )
        .withColumn(
            "summary",
            F.when(F.col("is_blank"), _blank_text())
            .otherwise(F.coalesce("_error_text", "_texts", F.lit(""))),
        )
    )


def suite_summary(suite: DataFrame) -> DataFrame:
    """``(job_id, rules_run, rules_failed, aborted, summary)``, one row per job.

    The summary of a job that ended in an error is the error text, as it is for a job
    without an object; else it is the texts of its rules in order.
    """
    return _by_job(suite).select(
        "job_id", "rules_run", "rules_failed",
        (F.col("is_blank") | F.col("_stopped")).alias("aborted"),
        "summary",
    )


def validation_log(suite: DataFrame, logged_at: Column) -> DataFrame:
    """``(job_id, seq, level, line)``: a line per rule that ran, then the summary line."""
    stamp = F.date_format(logged_at, "yyyy-MM-dd HH:mm:ss.SSS")
    in_error = F.col("status") == ERROR
    line = F.when(F.col("rule_id").isNotNull(), F.struct(
        "rule_id",
        F.when(in_error, "ERROR").otherwise("INFO").alias("level"),
        F.when(in_error, F.concat(F.lit(ERROR_LINE), F.col("text"))).otherwise(F.col("text")).alias("text"),
    ))
    jobs = _by_job(suite, F.sort_array(F.collect_list(line)).alias("_lines"))
    last = F.struct(
        F.lit(None).cast("int").alias("rule_id"),
        F.when(F.col("is_blank") | F.col("_error_text").isNotNull(), "ERROR").otherwise("INFO").alias("level"),
        F.col("summary").alias("text"),
    )
    return jobs.select("job_id", F.posexplode(F.concat("_lines", F.array(last))).alias("pos", "entry")).select(
        "job_id",
        (F.col("pos") + 1).cast("int").alias("seq"),
        F.col("entry.level").alias("level"),
        F.concat(stamp, F.lit(" "), F.col("entry.text")).alias("line"),
    )


def error_log(suite: DataFrame, created_date: Column) -> DataFrame:
    """One row per job that ended in an error: the rule that ended it, or the blank object.

    ``suite`` may carry the ``execution_run_id`` of the job's run.
    """
    known_run = F.col("execution_run_id") if "execution_run_id" in suite.columns else F.lit(None).cast("string")
    rule = F.col("rule_id").cast("string")
    return suite.where(F.col("is_blank") | (F.col("status") == ERROR)).select(
        known_run.alias("execution_run_id"),
        F.when(F.col("is_blank"), "BLANK_OBJECT").otherwise(F.concat(F.lit("RULE_"), rule)).alias("error_code"),
        F.sha2(F.concat_ws(
            "|", F.col("job_id").cast("string"), F.col("validation_type"),
            F.coalesce(rule, F.lit("blank")), F.date_format(created_date, "yyyy-MM-dd HH:mm:ss.SSS"),
        ), 256).alias("error_id"),
        F.when(F.col("is_blank"), _blank_text()).otherwise(F.col("text")).alias("error_message"),
        F.lit("Validation").alias("error_type"),
        "object_name",
        F.col("job_id").cast("string").alias("object_run_id"),
        created_date.alias("created_date"),
    )
