"""The roles of the checks, played by views over the given tables.

Each function takes the session and the folder of the tables. The SQL text of the same view is
in ``oracle.VIEWS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallykeep.functions import file_label
from tallykeep.operators.arrivals import first_arrivals, pre_audit
from tallykeep.operators.digests import flag_duplicates
from tallykeep.operators.profile import object_profile
from tallykeep.plans import runs
from tallykeep.plans.suite import add_control_totals, gather_measures, run_suite
from tallykeep.schemas import JOB_ARGUMENT_COLUMNS

# Where count and amount stand in the control strings: 'CNT=0000000000000000003;BAL=-0000000000000000006'.
COUNT_SLICE = (4, 23)
BALANCE_SLICE = (28, 48)

# Rules of a job, by the market segment of its customer.
SEGMENT_RULES = {
    "AUTOMOBILE": list(range(12)),
    "BUILDING": [0, 1, 2, 3, 8, 9, 10],
    "FURNITURE": [1, 2, 3, 4, 8, 10, 11],
    "HOUSEHOLD": [0, 1, 3, 4, 6, 9, 10],
    "MACHINERY": [2, 3, 5, 7, 8, 9],
}
POST_RULES = [8, 9]

LOGGED_AT = "2024-02-01 06:30:00.123"
LOGGED_BY = "recon"


# Columns of the given tables that the views use. A known schema saves the job that infers one.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def src(spark, sf_dir) -> DataFrame:
    """One file of orders per day, as the source sent it."""
    return table(spark, sf_dir, "orders").select(
        file_label("orders_", "o_orderdate").alias("object_name"), "o_orderkey", money("o_totalprice").alias("amt"),
        "o_orderstatus",
    )


def with_lines(spark, sf_dir, orders: DataFrame) -> DataFrame:
    # One key per order before the shuffle: an order with very many lines weighs no more.
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return orders.join(lines, "o_orderkey", "left_semi")


def landed(spark, sf_dir) -> DataFrame:
    """What arrived of the files: orders whose lines are there."""
    return with_lines(spark, sf_dir, src(spark, sf_dir))


def signed_digits(amount: Column) -> Column:
    """A whole amount in 20 characters, the sign first: as many as a 64-bit number can need."""
    whole = amount.cast("bigint")
    return F.concat(F.when(whole < 0, "-").otherwise("0"), F.lpad(F.abs(whole).cast("string"), 19, "0"))


def control_string(count: Column, amount: Column) -> Column:
    return F.concat(
        F.lit("CNT="), F.lpad(count.cast("string"), 19, "0"), F.lit(";BAL="), signed_digits(amount),
    )


def manifest(spark, sf_dir) -> DataFrame:
    """Control strings of the files; the amount of a day with a pending order is still open."""
    total = F.when(F.max(F.col("o_orderstatus") == "P"), "open").otherwise(signed_digits(F.sum("amt")))
    return src(spark, sf_dir).groupBy("object_name").agg(
        F.concat(F.lit("CNT="), F.lpad(F.count("*").cast("string"), 19, "0"), F.lit(";BAL="), total).alias("meta_string")
    )


def audit_log(spark, sf_dir, *, by_type: bool = True) -> DataFrame:
    """A file arrival per event; small values come without a product name."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    name = F.concat(user, F.lit("_"), F.col("event_type")) if by_type else user
    product = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("Post-"), F.col("event_type")))
        .when(F.col("value") < 1, F.lit(None))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        name.alias("file_name"),
        product.alias("product_name"),
        F.round(F.col("value") * 100).cast("bigint").alias("file_size"),
        F.col("ts").alias("file_arrival_time"),
    )


def file_meta(spark, sf_dir, *, by_type: bool = True) -> DataFrame:
    """Expected time, buffer and size of every file."""
    log = audit_log(spark, sf_dir, by_type=by_type)
    return log.groupBy("file_name").agg(
        F.date_trunc("minute", F.max("file_arrival_time")).alias("expected_time"),
        (F.lit(60) + F.count("*") * 20).cast("int").alias("buffer_minutes"),
        F.min_by("file_size", F.struct("file_arrival_time", "event_id")).alias("expected_file_size"),
        F.date_trunc("minute", F.min("file_arrival_time")).alias("first_time"),
    )


def arrivals(spark, sf_dir, *, by_type: bool = True) -> DataFrame:
    log = pre_audit(audit_log(spark, sf_dir, by_type=by_type))
    first = first_arrivals(log, ["event_id", "file_size", "file_arrival_time"])
    return first.withColumnsRenamed({"file_size": "audit_file_size", "file_arrival_time": "arrival_time"})


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def daily_slots(spark, sf_dir) -> DataFrame:
    """A file is expected of every user on every day from the first to the last one seen."""
    day = F.to_date("ts")
    return (
        table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(day).alias("a"), F.max(day).alias("b"))
        .select("user_id", F.explode(F.sequence("a", "b")).alias("slot_date"))
    )


def assignment(spark, sf_dir) -> DataFrame:
    rules = F.lit(None).cast("array<int>")
    for segment, ids in SEGMENT_RULES.items():
        rules = F.when(F.col("c_mktsegment") == segment, F.array(*map(F.lit, ids))).otherwise(rules)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("job_id"), F.explode(rules).alias("rule_id")
    ).select(
        "job_id", F.when(F.col("rule_id").isin(POST_RULES), "Post").otherwise("Pre").alias("validation_type"), "rule_id"
    )


def _customer_object(key: str) -> Column:
    return F.concat(F.lit("u"), F.col(key).cast("string"))


def job_args(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("job_id"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(_customer_object("c_custkey")).alias("object_name"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("/landing/"), key)).alias("object_path"),
        F.when(F.col("c_acctbal") > 9000, " ").otherwise(F.concat(F.lit("/curated/"), key)).alias("object_path_post"),
        F.when(F.col("c_acctbal") < 2000, "SQLTable").when(F.col("c_acctbal") < 5000, "NASFile")
        .otherwise("File").alias("object_type"),
        F.lit(COUNT_SLICE[0]).alias("count_start"), F.lit(COUNT_SLICE[1]).alias("count_end"),
        F.lit(BALANCE_SLICE[0]).alias("balance_start"), F.lit(BALANCE_SLICE[1]).alias("balance_end"),
    )


def param_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_type") == "ECONOMY", F.col("p_brand"))
        .otherwise(F.concat_ws(",", "p_brand", "p_name", "p_type")).alias("value"),
    )


ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "amt"]


def _customer_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _customer_object("o_custkey").alias("object_name"), "o_orderkey", "o_orderstatus",
        money("o_totalprice").alias("amt"),
    )


def pre_measures(spark, sf_dir) -> DataFrame:
    """Every job with the measures rules 0 to 7, 10 and 11 need; its object is its customer's orders."""
    sent = _customer_orders(spark, sf_dir)
    arrived = with_lines(spark, sf_dir, sent).select("object_name", *ORDER_COLUMNS)
    # One row per object, used twice below: by itself and to find its digest's first object.
    profile = object_profile(arrived, balance="amt", with_text=True, with_digest=True)
    control = object_profile(sent, balance="amt", text_columns=ORDER_COLUMNS, with_digest=True)
    flagged = flag_duplicates(profile, control.select("digest"), "object_name")
    jobs = job_args(spark, sf_dir).select(
        "*", F.lit(5).cast("bigint").alias("min_value"), F.lit(15).cast("bigint").alias("max_value"),
        F.col("object_name").alias("metadata_name"),
    )
    measures = gather_measures(jobs, [
        flagged.withColumn("egress_source_count", F.col("row_count")),
        control.select(
            "object_name",
            control_string(F.col("row_count"), F.col("balance")).alias("meta_string"),
            F.col("row_count").alias("egress_target_count"),
            F.col("row_count").alias("post_control_count"), F.col("balance").cast("bigint").alias("post_control_balance"),
        ),
        arrivals(spark, sf_dir, by_type=False).withColumnRenamed("file_name", "object_name").drop("event_id"),
        file_meta(spark, sf_dir, by_type=False).withColumnRenamed("file_name", "object_name"),
    ])
    return add_control_totals(measures)


def post_measures(spark, sf_dir) -> DataFrame:
    """Every job with the measures of rules 8 and 9; the control totals come from a query."""
    sent = _customer_orders(spark, sf_dir)
    arrived = with_lines(spark, sf_dir, sent)
    control = sent.groupBy("object_name").agg(
        F.count("*").alias("post_control_count"), F.sum("amt").cast("bigint").alias("post_control_balance")
    )
    profile = object_profile(arrived, balance="amt").withColumnsRenamed(
        {"row_count": "post_row_count", "balance": "post_balance"}
    )
    jobs = job_args(spark, sf_dir).withColumn("metadata_name", F.col("object_name"))
    return gather_measures(jobs, [profile, control])


def both_suites(spark, sf_dir) -> DataFrame:
    """Both stages in one pass over one profile of what was sent and one of what arrived."""
    measures = pre_measures(spark, sf_dir).withColumns(
        {"post_row_count": F.col("row_count"), "post_balance": F.col("balance")})
    return run_suite(measures, assignment(spark, sf_dir), ["Pre", "Post"])


def pre_suite(spark, sf_dir) -> DataFrame:
    return run_suite(pre_measures(spark, sf_dir), assignment(spark, sf_dir), "Pre")


def post_suite(spark, sf_dir) -> DataFrame:
    return run_suite(post_measures(spark, sf_dir), assignment(spark, sf_dir), "Post")


# -- runs: a batch is a customer, a job an order, a file an order line -----------------------


def batch_starts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("batch_id")).agg(
        F.min("o_orderdate").alias("batch_start_time")
    ).withColumn("source_id", F.lit("orders"))


def batch_ends(spark, sf_dir) -> DataFrame:
    """Batches whose newest order is not pending have ended."""
    pending = (F.col("o_orderstatus") == "P").cast("int")
    return (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("batch_id"))
        .agg(F.max("o_orderdate").alias("batch_end_time"), F.max_by(pending, "o_orderkey").alias("_pending"))
        .where(F.col("_pending") == 0)
        .select("batch_id", "batch_end_time", F.lit("Completed").alias("status"))
    )


def batch_runs(spark, sf_dir) -> DataFrame:
    return runs.start_batches(batch_starts(spark, sf_dir))


def job_metadata(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("batch_id")
    )


def _order_path(key: str) -> Column:
    return F.concat(F.lit("/orders/"), F.col(key).cast("string"))


def job_starts(spark, sf_dir) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.concat(F.lit("load "), F.col("o_orderkey").cast("string")).alias("job_name"),
        F.lit("shop").alias("source_system"), _order_path("o_orderkey").alias("source_path"),
        F.lit("lake").alias("target_system"), F.lit("/lake/orders").alias("target_path"),
        none.alias("source_count"), none.alias("target_count"),
        F.col("o_orderdate").alias("job_start_time"),
    )


def job_ends(spark, sf_dir) -> DataFrame:
    """An order's job ends with its last shipment; lines still open are not in the target.

    Orders without a closed line give no target count, which then is 0.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("job_end_time"),
        F.count("*").alias("source_count"),
        F.nullif(F.count_if(F.col("l_linestatus") == "F"), F.lit(0)).alias("target_count"),
    )
    starts = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("job_start_time"))
    return starts.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "job_start_time", _order_path("o_orderkey").alias("source_path"),
        "job_end_time", "source_count", "target_count", F.lit("Completed").alias("status"),
    )


def job_runs(spark, sf_dir) -> DataFrame:
    return runs.start_jobs(
        job_starts(spark, sf_dir), job_metadata(spark, sf_dir), batch_runs(spark, sf_dir)
    )


def _files(spark, sf_dir) -> DataFrame:
    """Lines of an order with the same number are one file."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("load_end_time"),
        F.count("*").alias("source_count"),
        F.count_if(F.col("l_linestatus") == "F").alias("target_count"),
    ).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_id"),
        F.col("l_orderkey").alias("job_id"),
        "load_end_time", "source_count", "target_count",
    )


def file_metadata(spark, sf_dir) -> DataFrame:
    return _files(spark, sf_dir).select("file_id", "job_id")


def _file_times(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("load_start_time")
    )
    return _files(spark, sf_dir).join(orders, "job_id")


def file_starts(spark, sf_dir) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return _file_times(spark, sf_dir).select(
        "file_id", "load_start_time", none.alias("source_count"), none.alias("target_count")
    )


def file_ends(spark, sf_dir) -> DataFrame:
    """Loads whose shipment is on or after the order have ended."""
    return _file_times(spark, sf_dir).where(F.col("load_end_time") >= F.col("load_start_time")).select(
        "file_id", "load_start_time", "load_end_time", "source_count", "target_count",
        F.lit("Completed").alias("status"),
    )


# -- whole runs from settings: the objects are files of the given tables ----------------------

# Object, balance column and the bounds of its row count.
FILES = (
    ("region", "r_regionkey", 1, 10), ("nation", "n_nationkey", 30, 40), ("labels", "quality", 1, 10**12),
    ("benchmark", "item_id", 1, 10**12), ("conversations", "turn", 1, 10**12), ("documents", "n_chars", 1, 10**12),
    ("orders", "o_orderkey", 1, 10**12), ("customer", "c_nationkey", 1, 10**12), ("events", "user_id", 1, 10**12),
    ("lineitem", "l_linenumber", 1, 10**12),
)


def file_jobs(spark, sf_dir) -> DataFrame:
    """A job per file, one of a file type that can't be read, one of a file that isn't there, and one without a path."""
    jobs = [(i, name, f"{sf_dir}/{name}.parquet", "parquet", balance) for i, (name, balance, _, _) in enumerate(FILES, 1)]
    jobs += [(90, "sheet", f"{sf_dir}/nation.parquet", "xlsx", None), (91, "absent", f"{sf_dir}/absent.parquet", "parquet", None),
             (92, "nowhere", "", "parquet", None)]
    names = {name: kind for name, kind in JOB_ARGUMENT_COLUMNS.values()}
    given = spark.createDataFrame(
        [(i, name, path, path, kind, kind, balance, "File", "SQLQUERY", "SQLQUERY") for i, name, path, kind, balance in jobs],
        "job_id bigint, object_name string, object_path string, object_path_post string, file_type string, "
        "post_file_type string, balance_amount_column string, object_type string, metadata_place string, "
        "post_metadata_place string")
    return given.select(*[
        (F.col(n) if n in given.columns else F.lit(None)).cast(kind).alias(n) for n, kind in names.items()
    ]).withColumns({
        "count_query": F.concat(F.lit("count "), "object_name"), "balance_query": F.concat(F.lit("balance "), "object_name"),
    })


def file_assignment(spark, validation_type: str, rules: list[int]) -> DataFrame:
    rows = [(i, validation_type, r) for i in [*range(1, len(FILES) + 1), 90, 91, 92] for r in rules]
    return spark.createDataFrame(rows, "job_id bigint, validation_type string, rule_id int")


def file_bounds(spark) -> DataFrame:
    rows = [(i, name, low, high) for i, (name, _, low, high) in enumerate(FILES, 1)]
    bounds = spark.createDataFrame(rows, "file_id bigint, file_name string, min_value bigint, max_value bigint")
    return bounds.selectExpr("*", "1L as file_size", "timestamp'2024-01-01' as file_expected_time", "1 as file_buffer_time")


def file_totals(spark, sf_dir):
    """What a source says of its own table when it is asked."""
    balances = {name: balance for name, balance, _, _ in FILES}

    def run_query(text: str) -> DataFrame:
        what, name = text.split(" ")
        if name not in balances:
            return spark.range(0)
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return rows.select(F.count("*") if what == "count" else F.sum(balances[name]))

    return run_query


# -- whole runs over text files that Spark writes from the given tables ------------------------

# Object, file type, place of the control totals, balance column and the bounds of its row count.
TEXT_FILES = (
    ("orders", "csv", "SQLQUERY", "amt", 1, 10**12), ("customer", "json", "SQLQUERY", "c_nationkey", 1, 10),
    ("supplier", "csv", "Footer", "s_nationkey", 1, 10**12), ("part", "csv", "Header", None, 1, 10**12),
)


def noted_orders(spark, sf_dir) -> DataFrame:
    """Orders with a note that has quotes, commas and, where the order is open, a line end."""
    note = F.concat(F.lit('as "'), "o_orderstatus", F.lit('", by '), F.col("o_custkey").cast("string"))
    more = F.when(F.col("o_orderstatus") == "O", F.concat(note, F.lit("\nopen, still"))).otherwise(note)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amt"), more.alias("note"))


def write_text_objects(spark, sf_dir, root: str) -> None:
    """Orders as csv of several files, customers as json, and one csv each with its control cell in the last and first line."""
    noted_orders(spark, sf_dir).write.option("header", True).option("escape", '"').csv(f"{root}/orders")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").write.json(f"{root}/customer")
    # One line of control totals stands with the lines of its object, first or last.
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    footed = suppliers.select(F.lit(1).alias("at"), "s_suppkey", F.concat_ws(
        ",", F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string"), F.lit("x")).alias("value"))
    total = suppliers.agg(F.count("*").alias("n"), F.sum("s_nationkey").alias("t")).select(
        F.lit(2).alias("at"), F.lit(0).cast("bigint").alias("s_suppkey"),
        F.concat(F.lit("0,0,"), control_string(F.col("n") + 1, F.col("t"))).alias("value"))
    head = spark.createDataFrame([(0, 0, "s_suppkey,s_nationkey,note")], "at int, s_suppkey bigint, value string")
    _one_file(head.unionByName(footed).unionByName(total), "s_suppkey", f"{root}/supplier")
    parts = table(spark, sf_dir, "part")
    top = parts.agg(F.count("*").alias("n"), F.sum("p_partkey").alias("t")).select(
        F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("p_partkey"),
        F.concat(F.lit("p_partkey,p_brand,"), control_string(F.col("n") + 1, F.col("t"))).alias("value"))
    lines = parts.select(F.lit(1).alias("at"), "p_partkey", F.concat_ws(
        ",", F.col("p_partkey").cast("string"), "p_brand", F.lit("x")).alias("value"))
    _one_file(top.unionByName(lines), "p_partkey", f"{root}/part")


def _one_file(lines: DataFrame, key: str, path: str) -> None:
    """Small files only: the control line has to be the first or last one."""
    lines.coalesce(1).sortWithinPartitions("at", key).select("value").write.text(path)


def text_jobs(spark, root: str) -> DataFrame:
    rows = [(i, name, f"{root}/{name}", kind, balance, "NASFile", place, 1 if place == "Header" else None, *COUNT_SLICE, *BALANCE_SLICE)
            for i, (name, kind, place, balance, _, _) in enumerate(TEXT_FILES, 1)]
    given = spark.createDataFrame(
        rows, "job_id bigint, object_name string, object_path string, file_type string, balance_amount_column string, "
        "object_type string, metadata_place string, metadata_column int, count_start int, count_end int, balance_start int, "
        "balance_end int")
    return given.select(*[
        (F.col(n) if n in given.columns else F.lit(None)).cast(kind).alias(n) for n, kind in JOB_ARGUMENT_COLUMNS.values()
    ]).withColumns({"count_query": F.concat(F.lit("count "), "object_name"), "balance_query": F.concat(F.lit("balance "), "object_name")})


def text_bounds(spark) -> DataFrame:
    rows = [(i, name, low, high) for i, (name, _, _, _, low, high) in enumerate(TEXT_FILES, 1)]
    bounds = spark.createDataFrame(rows, "file_id bigint, file_name string, min_value bigint, max_value bigint")
    return bounds.selectExpr("*", "1L as file_size", "timestamp'2024-01-01' as file_expected_time", "1 as file_buffer_time")


def text_totals(spark, sf_dir):
    def run_query(text: str) -> DataFrame:
        what, name = text.split(" ")
        rows = noted_orders(spark, sf_dir) if name == "orders" else table(spark, sf_dir, name)
        amount = "amt" if name == "orders" else "c_nationkey"
        return rows.select(F.count("*") if what == "count" else F.sum(amount).cast("bigint"))

    return run_query


# -- two stores, two states --------------------------------------------------------------------


def booked_orders(spark, sf_dir) -> DataFrame:
    """What a second store holds: orders whose lines are there, pending ones at whole amounts, and one more row, with the
    key's sign turned, for those that were dear."""
    landed = with_lines(spark, sf_dir, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amt")))
    booked = landed.withColumn("amt", F.when(F.col("o_orderstatus") == "P", F.floor("amt")).otherwise(F.col("amt")).cast("decimal(18,2)"))
    dear = booked.where("amt > 450000").withColumn("o_orderkey", -F.col("o_orderkey"))
    return booked.unionByName(dear)


#: Orders from this day on came after the first load.
SECOND_LOAD = "1997-07-01"


def dated_orders(spark, sf_dir) -> DataFrame:
    """Orders of every customer with a position that grows by day: the day, then the key."""
    day = F.unix_date(F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("object_name"), "o_orderkey", "o_orderstatus",
        money("o_totalprice").alias("amt"), (F.shiftleft(day.cast("bigint"), 40) + F.col("o_orderkey")).alias("position"), "o_orderdate")


def due_schedule(spark, sf_dir) -> DataFrame:
    """A file of every user, due each day from the first to the last one seen, at the clock time at which the first came."""
    time = F.to_timestamp("ts")
    return table(spark, sf_dir, "events").groupBy(_customer_object("user_id").alias("file_name")).agg(
        F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"),
        F.date_format(F.min(time), "HH:mm:ss").alias("due_clock"),
    ).withColumns({"every_days": F.lit(1), "early_minutes": F.lit(30), "late_minutes": F.lit(60)})
