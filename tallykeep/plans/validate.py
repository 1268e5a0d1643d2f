"""From job arguments to suite results: reads the objects of all jobs and runs their rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tallykeep.functions import as_money, row_text, slice_long
from tallykeep.operators.arrivals import first_arrivals, pre_audit
from tallykeep.operators.digests import SUM_COLUMNS, content_sums, content_text, flag_duplicates
from tallykeep.operators.rules import CHECKSUM, PASSED, POST, PRE
from tallykeep.plans.suite import blank_object, gather_measures, run_suite
from tallykeep.sources.objects import (
    FORMATS, LINE_FORMATS, SIZES, edge_cells, edge_lines, lines_of, matched_paths, object_measures, object_rows,
    parquet_last_cells, whole_digest,
)

TABLE = "SQLTable"
ORDERED, UNORDERED = "ordered", "unordered"


def _wanted(jobs: Sequence[Row], places: dict[str, list[str]]) -> list[tuple]:
    """``(job_id, root, kind, headerless, balance_name, position)`` of every place of every job's object."""
    return [
        (j.job_id, root, j.file_type, j.place == "Header", j.balance_amount_column,
         j.metadata_column if j.place == "Header" and j.file_type == "csv" else None)
        for j in jobs if j.path for root in places[j.path] or ()
    ]


def _union(frames: Sequence[DataFrame | None]) -> DataFrame | None:
    whole = None
    for frame in frames:
        if frame is not None:
            whole = frame if whole is None else whole.unionByName(frame, allowMissingColumns=True)
    return whole


def table_measures(spark: SparkSession, jobs: Sequence[Row], tables: dict[str, DataFrame]) -> DataFrame | None:
    """Measures of objects that are tables. A table is read once for all jobs that name it with one balance column."""
    asked: dict[tuple[str, str | None], list[int]] = {}
    for job in jobs:
        if job.object_name in tables:
            asked.setdefault((job.object_name, job.balance_amount_column), []).append(job.job_id)
    parts = []
    for (name, balance), ids in asked.items():
        rows = tables[name]
        amount = as_money(F.col(f"`{balance}`")) if balance in rows.columns else F.lit(None).cast("decimal(28,8)")
        sums = rows.agg(
            F.count("*").alias("row_count"), F.sum(amount).alias("balance"),
            F.sum(F.length(row_text(rows)).cast("bigint")).alias("text_size"), *content_sums(rows, rows.columns))
        ids_of = F.explode(F.array(*[F.lit(i).cast("bigint") for i in ids])).alias("job_id")
        parts.append(sums.where("row_count > 0").select(ids_of, *SIZES, *SUM_COLUMNS))
    return _union(parts)


def control_strings(
    spark: SparkSession, jobs: Sequence[Row], places: dict[str, list[str]], edges: DataFrame | None
) -> DataFrame:
    """``(job_id, meta_string)`` from manifests and from header and footer cells."""
    found = [spark.createDataFrame([], "job_id bigint, meta_string string")]
    asked = [(j.job_id, root, "text", "File") for j in jobs if j.place == "File" and j.manifest_file_url
             for root in places[j.manifest_file_url] or ()]
    inside = [(j.job_id, root, j.file_type, j.place) for j in jobs
              if j.place in ("Header", "Footer") and j.path and j.object_type != TABLE for root in places[j.path] or ()]
    asked += [a for a in inside if a[2] in LINE_FORMATS]
    if edges is not None and asked:
        found.append(edge_cells(edges, asked, spark))
    columnar = [a for a in inside if a[2] == "parquet"]
    if columnar:
        cells = parquet_last_cells(spark, [a[1] for a in columnar])
        found.append(edge_cells(cells, [(j, root, "text", place) for j, root, _, place in columnar], spark))
    return _union(found)


def asked_totals(
    spark: SparkSession, jobs: Sequence[Row], run_query: Callable[[str], DataFrame]
) -> DataFrame:
    """``(job_id, control_count, control_balance)`` from the jobs' own queries, each run once, 16 at a time.

    A query gives one value, the first cell of its first row.
    """
    texts = sorted({q for j in jobs if j.place == "SQLQUERY" for q in (j.count_query, j.balance_query) if q})

    def ask(text: str) -> int | None:
        row = run_query(text).first()
        return None if row is None or row[0] is None else int(row[0])

    with ThreadPoolExecutor(16) as pool:
        values = dict(zip(texts, pool.map(ask, texts)))
    rows = [(j.job_id, values.get(j.count_query), values.get(j.balance_query)) for j in jobs if j.place == "SQLQUERY"]
    return spark.createDataFrame(rows, "job_id bigint, control_count bigint, control_balance bigint")


def expectations(file_metadata: DataFrame) -> DataFrame:
    """One row per file name: its metadata row with the lowest file id."""
    kept = F.struct(
        "min_value", "max_value", F.col("file_size").alias("expected_file_size"),
        F.col("file_expected_time").alias("expected_time"), F.col("file_buffer_time").alias("buffer_minutes"),
        F.col("file_name").alias("metadata_name"),
    )
    return (
        file_metadata.groupBy(F.col("file_name").alias("object_name"))
        .agg(F.min_by(kept, "file_id").alias("_m")).select("object_name", "_m.*")
    )


def arrival_measures(audit_log: DataFrame) -> DataFrame:
    first = first_arrivals(pre_audit(audit_log), ["file_size", "file_arrival_time"], tie_break="file_size")
    return first.withColumnsRenamed(
        {"file_name": "object_name", "file_size": "audit_file_size", "file_arrival_time": "arrival_time"}
    )


def audit_totals(audit_log: DataFrame) -> DataFrame:
    """``(object_name, audit_count, audit_balance)`` of the first arrival of every object."""
    first = first_arrivals(pre_audit(audit_log), ["file_count", "file_balance_amount"], tie_break="file_count")
    return first.select(
        F.col("file_name").alias("object_name"), F.col("file_count").cast("bigint").alias("audit_count"),
        F.col("file_balance_amount").cast("bigint").alias("audit_balance"))


def registration(results: DataFrame, created_time: Column, created_by: str) -> DataFrame:
    """Rows to append to the checksum registry: the content that rule 11 found to be new."""
    return results.where((F.col("rule_id") == 11) & (F.col("status") == PASSED)).select(
        F.col("object_name").alias("file_name"),
        F.replace("target_value", F.lit(CHECKSUM), F.lit("")).alias("checksum_value"),
        created_time.alias("created_time"), F.lit(created_by).alias("created_by"))


def validate(
    spark: SparkSession,
    job_args: DataFrame,
    assignment: DataFrame,
    *,
    validation_type: str = PRE,
    audit_log: DataFrame | None = None,
    file_metadata: DataFrame | None = None,
    registry: DataFrame | None = None,
    digest: str = ORDERED,
    digest_bits: int = 512,
    tables: dict[str, DataFrame] | None = None,
    run_query: Callable[[str], DataFrame] | None = None,
    query_control: DataFrame | None = None,
    egress_targets: DataFrame | None = None,
    exclude_control_row: bool = False,
) -> DataFrame:
    """Suite results of all jobs (see ``run_suite``), read from where the jobs say.

    ``job_args`` are as ``read_job_args`` gives them. Only these settings, a short row per
    job, come to the driver, which looks up the paths; with a ``registry`` also the sizes and digest of each job's object, so
    that the objects are read once, however often the results are. The cluster reads all text objects in one scan for their
    edges and one for their rows, and parquet objects in one for each schema, whatever the number of jobs. A path may be a
    file, a folder with all below it, or a glob. Jobs whose path can't be looked up, whose file type is not known or whose
    parquet footers can't be read or merged end in an error; the others run.

    ``digest`` says what rule 11 compares: the ordered digest, for which the same rows in another order are
    new content, or the unordered one; ``digest_bits`` are those of the ordered one. ``registration`` gives the rows to append to the registry.
    ``tables`` holds objects of type SQLTable by name, such as ``read_table`` gives them; they have no row order, so
    theirs is the unordered digest. ``run_query`` runs the query texts of jobs whose control totals come from one;
    ``query_control`` is ``(job_id, control_count, control_balance)`` where they are known already.
    ``egress_targets`` is ``(object_name, egress_target_count)``, held against the rows of the job's object.
    ``exclude_control_row`` takes the control row of headers and footers off the row count. Rules
    whose inputs are not given are errors.
    """
    if digest not in (ORDERED, UNORDERED):
        raise ValueError(f"digest is {ORDERED} or {UNORDERED}, not {digest!r}")
    post = validation_type == POST
    blank = blank_object(validation_type)
    jobs = job_args.select(
        "*",
        F.col("object_path_post" if post else "object_path").alias("path"),
        F.col("post_metadata_place" if post else "metadata_place").alias("place"),
    )
    if post:
        jobs = jobs.withColumn("file_type", F.col("post_file_type"))
    jobs = jobs.withColumn("file_type", F.lower(F.trim("file_type")))
    readable = F.coalesce(F.col("object_type") == TABLE, F.lit(False)) | F.coalesce(
        F.col("file_type").isin(*FORMATS), F.lit(False))
    config = jobs.where(~blank & readable).select(
        "job_id", "object_name", "object_type", "path", "place", "file_type", "metadata_column",
        "balance_amount_column", "manifest_file_url", "count_query", "balance_query",
    ).collect()
    in_files = [j for j in config if j.object_type != TABLE]

    manifests = [j.manifest_file_url for j in config if j.place == "File" and j.manifest_file_url]
    places = matched_paths(spark, [*(j.path for j in in_files if j.path), *manifests])
    wanted = _wanted(in_files, places)
    rows, looked, edges, unreadable = object_rows(spark, wanted, [root for m in manifests for root in places[m] or ()])
    lost = set(unreadable)
    broken = {j.job_id for j in in_files if j.path and places[j.path] is None}
    broken |= {job for job, root, kind, *_ in wanted if kind == "parquet" and root.rstrip("/") in lost}
    if broken:
        flags = spark.createDataFrame([(i,) for i in sorted(broken)], "job_id bigint").withColumn("_broken", F.lit(True))
        jobs = jobs.join(flags, "job_id", "left")
        readable = readable & F.col("_broken").isNull()
    ordered = digest == ORDERED and registry is not None
    of_files = None if rows is None else object_measures(rows, looked, ordered=ordered, bits=digest_bits)
    measured = _union([of_files, table_measures(spark, [j for j in config if j.object_type == TABLE], tables or {})])

    by_job, by_object = [], []
    if measured is not None:
        unordered = content_text()
        if ordered and of_files is not None:
            unordered = F.coalesce(whole_digest(F.col("file_digests"), digest_bits), unordered)
        measured = measured.select("job_id", *SIZES, unordered.alias("digest"))
        if registry is not None:
            # Read twice here, and all objects with it, unless the short row per job is there already.
            measured = spark.createDataFrame(measured.collect(), measured.schema)
            measured = flag_duplicates(measured, registry.select(F.col("checksum_value").alias("digest")), "job_id")
        by_job.append(measured)
    by_job.append(control_strings(spark, config, places, edges))
    if run_query is not None:
        query_control = asked_totals(spark, config, run_query)
    if audit_log is not None:
        by_object += [arrival_measures(audit_log), audit_totals(audit_log)]
    if file_metadata is not None:
        by_object.append(expectations(file_metadata))
    if egress_targets is not None:
        by_object.append(egress_targets)

    # Jobs without an object or with one that can't be read need no measures.
    good = jobs.where(~blank & readable)
    measures = gather_measures(gather_measures(good, by_object, "object_name"), by_job, "job_id")
    totals = {
        "control_count": slice_long("meta_string", "count_start", "count_end"),
        "control_balance": slice_long("meta_string", "balance_start", "balance_end"),
    }
    if query_control is not None:
        asked = query_control.select("job_id", *[F.col(n).alias(f"_{n}") for n in totals])
        measures = measures.join(asked, "job_id", "left")
        totals = {n: F.when(F.col("place") == "SQLQUERY", F.col(f"_{n}")).otherwise(c) for n, c in totals.items()}
    if audit_log is not None:
        audited = {"control_count": "audit_count", "control_balance": "audit_balance"}
        totals = {n: F.when(F.col("place") == "Audit", F.col(audited[n])).otherwise(c) for n, c in totals.items()}
    measures = measures.withColumns(totals)
    if egress_targets is not None and measured is not None:
        measures = measures.withColumn("egress_source_count", F.col("row_count"))
    if exclude_control_row and measured is not None:
        measures = measures.withColumn(
            "row_count", F.col("row_count") - F.when(F.col("place").isin("Header", "Footer"), 1).otherwise(0))
    if post:
        measures = measures.withColumnsRenamed(
            {n: f"post_{n}" for n in ("row_count", "balance", "control_count", "control_balance")}
        )
    others = run_suite(jobs.where(blank | ~readable), assignment, validation_type)
    return run_suite(measures, assignment, validation_type).unionByName(others)
