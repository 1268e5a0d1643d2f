"""One query per check, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import views as v
from tallykeep.functions import clock_text, whole_amount
from checks.scratch import scratch
from tallykeep.operators import arrivals as arr
from tallykeep.operators import calendar, daily, rules, trees
from tallykeep.operators.assignment import assigned_rules
from tallykeep.operators.differences import differing_keys
from tallykeep.operators.digests import (
    content_digest, flag_duplicates, new_digests, unordered_digest,
)
from tallykeep.operators.profile import first_last_cell, object_profile
from tallykeep.operators.reconcile import keyed_counts, total_counts
from tallykeep.plans import runs, suite
from tallykeep.plans.validate import validate
from tallykeep.sinks import append_registry
from tallykeep.sources import control_cells, manifest_control, param_lookup
from tallykeep.sources.listing import listing_changes


def _control(spark, sf_dir) -> DataFrame:
    return manifest_control(v.manifest(spark, sf_dir), v.COUNT_SLICE, v.BALANCE_SLICE)


def _landed_profile(spark, sf_dir) -> DataFrame:
    return object_profile(v.landed(spark, sf_dir), balance="amt")


def _landed_counts(spark, sf_dir) -> DataFrame:
    return object_profile(v.landed(spark, sf_dir))


def object_profile_query(spark, sf_dir):
    return _landed_profile(spark, sf_dir).select(
        "object_name", "row_count", whole_amount("balance").alias("balance")
    )


def control_parse(spark, sf_dir):
    return _control(spark, sf_dir)


def control_first_last(spark, sf_dir):
    cells = first_last_cell(v.src(spark, sf_dir), "amt", "o_orderkey")
    return cells.select("object_name", *[F.col(c).cast("string").alias(c) for c in ("first_value", "last_value")])


def zero_size_check(spark, sf_dir):
    events = v.table(spark, sf_dir, "events").withColumn("slot_date", F.to_date("ts"))
    keys = ["user_id", "slot_date"]
    profile = object_profile(events, key=keys, text_columns=v.EVENT_COLUMNS, with_text=True)
    checked = rules.zero_size_check(v.daily_slots(spark, sf_dir), profile, keys)
    return checked.withColumn("slot_date", F.date_format("slot_date", "yyyy-MM-dd"))


def count_control_check(spark, sf_dir):
    return rules.count_control_check(_control(spark, sf_dir), _landed_counts(spark, sf_dir))


def balance_control_check(spark, sf_dir):
    return rules.balance_control_check(_control(spark, sf_dir), _landed_profile(spark, sf_dir))


def threshold_check(spark, sf_dir):
    bounds = v.manifest(spark, sf_dir).select(
        "object_name", F.lit(4).cast("bigint").alias("min_value"), F.lit(9).cast("bigint").alias("max_value")
    )
    return rules.threshold_check(bounds, _landed_counts(spark, sf_dir))


def audit_pre_filter(spark, sf_dir):
    return arr.pre_audit(v.audit_log(spark, sf_dir)).select("event_id", "file_name", "product_name")


def audit_post_filter(spark, sf_dir):
    return arr.post_audit(v.audit_log(spark, sf_dir)).select("event_id", "file_name", "product_name")


def first_arrival(spark, sf_dir):
    return v.arrivals(spark, sf_dir).select(
        "file_name", "event_id", clock_text("arrival_time").alias("arrival_time_of_day")
    )


def name_registered_check(spark, sf_dir):
    expected = v.file_meta(spark, sf_dir).select("file_name")
    return rules.name_registered_check(expected, arr.name_matches(arr.pre_audit(v.audit_log(spark, sf_dir))))


def file_size_check(spark, sf_dir):
    return rules.file_size_check(v.file_meta(spark, sf_dir), v.arrivals(spark, sf_dir))


def arrival_status(spark, sf_dir):
    return rules.arrival_status(v.file_meta(spark, sf_dir), v.arrivals(spark, sf_dir))


def arrival_window_check(spark, sf_dir):
    return rules.arrival_window_check(v.file_meta(spark, sf_dir), v.arrivals(spark, sf_dir))


def arrival_window_by_timestamp(spark, sf_dir):
    # Files are expected when their first event of any kind came.
    expected = v.file_meta(spark, sf_dir).withColumn("expected_time", F.col("first_time"))
    return rules.arrival_window_check(expected, v.arrivals(spark, sf_dir), by_clock=False)


def _query_control(spark, sf_dir) -> DataFrame:
    """Control totals the way a query on the source gives them."""
    return v.src(spark, sf_dir).groupBy("object_name").agg(
        F.count("*").alias("control_count"), F.sum("amt").cast("bigint").alias("control_balance")
    )


def post_count_check(spark, sf_dir):
    return rules.post_count_check(_query_control(spark, sf_dir), _landed_counts(spark, sf_dir))


def post_balance_check(spark, sf_dir):
    return rules.post_balance_check(_query_control(spark, sf_dir), _landed_profile(spark, sf_dir))


def _egress_sides(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("batch_id"))
    return orders.select("batch_id"), v.with_lines(spark, sf_dir, orders).select("batch_id")


def egress_count_reconcile(spark, sf_dir):
    return rules.egress_count_check(keyed_counts(*_egress_sides(spark, sf_dir), "batch_id"), "batch_id")


def egress_total_reconcile(spark, sf_dir):
    totals = total_counts(*_egress_sides(spark, sf_dir)).withColumn("object_name", F.lit("orders"))
    return rules.egress_count_check(totals, "object_name")


DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "n_chars"]


def _documents(spark, sf_dir) -> DataFrame:
    return v.table(spark, sf_dir, "documents").withColumnRenamed("source", "object_name")


def _bucket():
    return F.shiftright("doc_id", 20)


def content_digest_query(spark, sf_dir):
    return content_digest(
        _documents(spark, sf_dir), "object_name", "doc_id", _bucket(), DOCUMENT_COLUMNS, bits=256
    )


def content_digest_unordered(spark, sf_dir):
    return unordered_digest(_documents(spark, sf_dir), "object_name", DOCUMENT_COLUMNS)


def _digest_sides(spark, sf_dir):
    """Labelled documents are registered already; the others arrive."""
    labels = v.table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("labelled", F.lit(True))
    digests = v.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    known = digests.join(labels, "doc_id", "left")
    arriving = known.where(F.col("labelled").isNull()).drop("labelled")
    return arriving, known.where("labelled").drop("labelled")


def duplicate_content_check(spark, sf_dir):
    flagged = flag_duplicates(*_digest_sides(spark, sf_dir), "doc_id")
    return rules.duplicate_content_check(flagged, "doc_id")


def checksum_new_entries(spark, sf_dir):
    return new_digests(*_digest_sides(spark, sf_dir), "doc_id")


def rule_assignment_topn(spark, sf_dir):
    return assigned_rules(v.assignment(spark, sf_dir), limit=4)


def blank_object_guard(spark, sf_dir):
    return suite.blank_object_guard(v.job_args(spark, sf_dir))


def param_lookup_query(spark, sf_dir):
    requested = v.table(spark, sf_dir, "part").select(F.col("p_brand").alias("param_key")).union(
        v.table(spark, sf_dir, "nation").select("n_name")
    ).distinct()
    return param_lookup(requested, v.param_lines(spark, sf_dir))


def _logged_at():
    return F.lit(v.LOGGED_AT).cast("timestamp")


def suite_results(spark, sf_dir):
    log = suite.rule_execution_log(v.both_suites(spark, sf_dir), _logged_at(), v.LOGGED_BY)
    return log.withColumn("created_time", F.date_format("created_time", "yyyy-MM-dd HH:mm:ss.SSS"))


def suite_summary(spark, sf_dir):
    return suite.suite_summary(v.pre_suite(spark, sf_dir))


def post_suite_summary(spark, sf_dir):
    return suite.suite_summary(v.post_suite(spark, sf_dir))


def validation_log(spark, sf_dir):
    lines = suite.validation_log(v.pre_suite(spark, sf_dir), _logged_at())
    return lines.select("job_id", F.col("seq").cast("bigint").alias("seq"), "line")


def error_log(spark, sf_dir):
    return suite.error_log(v.pre_suite(spark, sf_dir), _logged_at()).withColumn(
        "created_date", F.date_format("created_date", "yyyy-MM-dd HH:mm:ss.SSS")
    )


def _time_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def batch_run_stats(spark, sf_dir):
    finished = runs.finish_batches(v.batch_runs(spark, sf_dir), v.batch_ends(spark, sf_dir))
    return finished.select(
        "execution_run_id", "batch_id", _time_text("batch_start_time"), _time_text("batch_end_time"), "status"
    )


def job_run_stats(spark, sf_dir):
    finished = runs.finish_jobs(v.job_runs(spark, sf_dir), v.job_ends(spark, sf_dir))
    return finished.select(
        "job_id", "execution_run_id", "source_count", "target_count", "reject_count",
        "duration_in_seconds", "status",
    )


def file_run_stats(spark, sf_dir):
    finished = runs.start_files(
        v.file_starts(spark, sf_dir), v.file_metadata(spark, sf_dir), v.job_runs(spark, sf_dir),
        ends=v.file_ends(spark, sf_dir),
    )
    return finished.select(
        "file_id", "job_run_id", "execution_run_id", "source_count", "target_count",
        "duration_in_seconds", "status",
    )


def run_lineage(spark, sf_dir):
    still_started = runs.finish_batches(v.batch_runs(spark, sf_dir), v.batch_ends(spark, sf_dir))
    return runs.run_lineage(v.file_metadata(spark, sf_dir), v.job_metadata(spark, sf_dir), still_started)


def _outcomes(results):
    return results.select("job_id", "object_name", "rule_id", "source_value", "target_value", "status", "text")


def validate_pre(spark, sf_dir):
    """From settings to results: files found, read, measured and judged before processing."""
    none = spark.createDataFrame([], "file_name string, checksum_value string")
    return _outcomes(validate(
        spark, v.file_jobs(spark, sf_dir), v.file_assignment(spark, "Pre", [0, 1, 2, 3, 11]),
        file_metadata=v.file_bounds(spark), registry=none, digest="unordered", run_query=v.file_totals(spark, sf_dir)))


def validate_post(spark, sf_dir):
    return _outcomes(validate(
        spark, v.file_jobs(spark, sf_dir), v.file_assignment(spark, "Post", [8, 9]), validation_type="Post",
        file_metadata=v.file_bounds(spark), run_query=v.file_totals(spark, sf_dir)))


def _validated_text(spark, sf_dir, rule_ids, digest):
    root = scratch(spark, "landing")
    v.write_text_objects(spark, sf_dir, root)
    jobs = v.text_jobs(spark, root)
    assigned = spark.createDataFrame(
        [(i, "Pre", r) for i in range(1, len(v.TEXT_FILES) + 1) for r in rule_ids], "job_id bigint, validation_type string, rule_id int")
    none = spark.createDataFrame([], "file_name string, checksum_value string")
    return _outcomes(validate(
        spark, jobs, assigned, file_metadata=v.text_bounds(spark), registry=none, digest=digest,
        digest_bits=256, run_query=v.text_totals(spark, sf_dir)))


def validate_text(spark, sf_dir):
    """As ``validate_pre`` over csv and json files with quoted commas, quotes and line ends, and control cells inside."""
    return _validated_text(spark, sf_dir, [0, 1, 2, 3, 11], "unordered")


def validate_text_ordered(spark, sf_dir):
    """Rule 11 in row order, over files that are in one piece each."""
    ran = _validated_text(spark, sf_dir, [11], "ordered")
    return ran.where(F.col("object_name").isin("supplier", "part"))


def control_cells_file(spark, sf_dir):
    """Control cells in the first and last lines of files, of which only the ends are read."""
    root = scratch(spark, "landing")
    v.write_text_objects(spark, sf_dir, root)
    found = None
    for place in ("Header", "Footer"):
        cells = control_cells(spark, [f"{root}/supplier", f"{root}/part"], "csv", place, key="folder")
        cells = cells.select("object_name", F.lit(place).alias("place"), "meta_string")
        found = cells if found is None else found.unionByName(cells)
    return found


def store_differences(spark, sf_dir):
    source = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", v.money("o_totalprice").alias("amt"))
    return differing_keys(source, v.booked_orders(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "amt"])


def arrival_calendar(spark, sf_dir):
    seen = v.table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_name"), F.to_timestamp("ts").alias("arrival_time"))
    held = calendar.arrival_calendar(calendar.due_times(v.due_schedule(spark, sf_dir)), seen)
    return held.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("due_time", "arrival_time")})


#: Four rows a chunk, as the objects of the given tables are small.
CHUNK_BITS = 2


def chunk_differences(spark, sf_dir):
    """The first chunk in which what arrived of a file is not what was sent."""
    stored, now = (
        trees.chunk_digests(rows, "object_name", "o_orderkey", F.shiftright("o_orderkey", 20), v.ORDER_COLUMNS, chunk_bits=CHUNK_BITS)
        for rows in (v.src(spark, sf_dir), v.landed(spark, sf_dir)))
    return trees.first_differences(stored, now, "object_name", chunk_bits=CHUNK_BITS)


def grown_digests(spark, sf_dir):
    """Digests of objects that grew, from the chunks of the first load and the rows after them."""
    orders = v.dated_orders(spark, sf_dir)
    how = {"key": "object_name", "position": "position", "bucket": F.shiftright("position", 40), "columns": v.ORDER_COLUMNS,
           "chunk_bits": CHUNK_BITS}
    first = trees.chunk_digests(orders.where(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit(v.SECOND_LOAD))), **how)
    whole = trees.digest_of_chunks(trees.chunk_digests(orders, **how, stored=first), "object_name")
    full = first.where(F.col("chunk_rows") == 1 << CHUNK_BITS).groupBy("object_name").agg(F.sum("chunk_rows").alias("_full"))
    return whole.join(full, "object_name", "left").select(
        "object_name", "row_count", (F.col("row_count") - F.coalesce("_full", F.lit(0))).alias("rehashed_rows"), "digest")


def profile_from_daily_state(spark, sf_dir):
    """What is measured of every object, from the state of the first load and the rows of the days after it."""
    orders, day = v.dated_orders(spark, sf_dir), F.date_sub(F.to_date(F.lit(v.SECOND_LOAD)), 1)
    state = {"key": "object_name", "time": "o_orderdate", "columns": v.ORDER_COLUMNS, "balance": "amt"}
    before = daily.daily_state(orders.where(F.to_date("o_orderdate") <= day), **state)
    after = daily.daily_state(daily.days_of(orders, "o_orderdate", day), **state)
    found = daily.profile_of_states(daily.merge_states(before, after, key="object_name"), "object_name")
    return found.select(
        "object_name", "row_count", whole_amount("balance").alias("balance"), "text_size", "digest",
        F.date_format("first_time", "yyyy-MM-dd").alias("first_day"), F.date_format("last_time", "yyyy-MM-dd").alias("last_day"))


def registry_lookup(spark, sf_dir):
    """As ``checksum_new_entries``, with a registry in buckets, which is read where it lies."""
    arriving, known = _digest_sides(spark, sf_dir)
    path = scratch(spark, "registry")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    append_registry(known.select("digest").distinct(), name, path, buckets=16)
    return new_digests(arriving, spark.table(name), "doc_id")


def changed_objects(spark, sf_dir):
    """Files of orders by day whose size or last time is not what it was when their lines were not looked at yet."""
    sent = v.table(spark, sf_dir, "orders").select(
        v.file_label("orders_", "o_orderdate").alias("file"), v.money("o_totalprice").alias("amt"), "o_orderdate", "o_orderkey")
    listings = [
        rows.groupBy("file").agg(F.count("*").alias("length"), F.max("o_orderdate").alias("modified"))
        for rows in (sent, v.with_lines(spark, sf_dir, sent))]
    return listing_changes(*listings)


QUERIES = {
    "registry_lookup": registry_lookup,
    "changed_objects": changed_objects,
    "validate_text": validate_text,
    "validate_text_ordered": validate_text_ordered,
    "control_cells_file": control_cells_file,
    "store_differences": store_differences,
    "arrival_calendar": arrival_calendar,
    "chunk_differences": chunk_differences,
    "grown_digests": grown_digests,
    "profile_from_daily_state": profile_from_daily_state,
    "validate_pre": validate_pre,
    "validate_post": validate_post,
    "object_profile": object_profile_query,
    "control_parse": control_parse,
    "control_first_last": control_first_last,
    "zero_size_check": zero_size_check,
    "count_control_check": count_control_check,
    "balance_control_check": balance_control_check,
    "threshold_check": threshold_check,
    "audit_pre_filter": audit_pre_filter,
    "audit_post_filter": audit_post_filter,
    "first_arrival": first_arrival,
    "name_registered_check": name_registered_check,
    "file_size_check": file_size_check,
    "arrival_status": arrival_status,
    "arrival_window_check": arrival_window_check,
    "arrival_window_by_timestamp": arrival_window_by_timestamp,
    "post_count_check": post_count_check,
    "post_balance_check": post_balance_check,
    "egress_count_reconcile": egress_count_reconcile,
    "egress_total_reconcile": egress_total_reconcile,
    "content_digest": content_digest_query,
    "content_digest_unordered": content_digest_unordered,
    "duplicate_content_check": duplicate_content_check,
    "checksum_new_entries": checksum_new_entries,
    "rule_assignment_topn": rule_assignment_topn,
    "blank_object_guard": blank_object_guard,
    "param_lookup": param_lookup_query,
    "suite_results": suite_results,
    "suite_summary": suite_summary,
    "post_suite_summary": post_suite_summary,
    "validation_log": validation_log,
    "error_log": error_log,
    "batch_run_stats": batch_run_stats,
    "job_run_stats": job_run_stats,
    "file_run_stats": file_run_stats,
    "run_lineage": run_lineage,
}
