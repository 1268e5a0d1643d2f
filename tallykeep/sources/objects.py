"""What jobs need of their objects, in a number of scans that does not grow with the jobs, folders and files.

All text objects (csv, json, text, and manifests) are read as lines, and each line is taken apart by the header of its own
file; the first and last line of every file come from short ranges at its ends. Lines of csv files are put together to records where quoted
cells go over line ends. Parquet objects are one scan for each schema that is among them, so a row is only seen with its own
columns. An object is a file, a folder with all below it, or a glob, and files are matched to it by their path.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallykeep.functions import as_money
from tallykeep.functions.text import cell_text
from tallykeep.operators.digests import SUM_COLUMNS, hash_sums, tree_digest, with_ordinals
from tallykeep.sources.ranges import file_ends
from tallykeep.sources.records import csv_cells, quote_state, whole_records

LINE_FORMATS = ("csv", "json", "text")
FORMATS = (*LINE_FORMATS, "parquet")
SIZES = ["row_count", "balance", "text_size"]


def _plain(path: str) -> str:
    """Both 'file:/x' and 'file:///x' occur for a path without a host."""
    return path.replace(":///", ":/")


def matched_paths(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str] | None]:
    """The files and folders each path or glob stands for, in the form in which Spark names the files it reads.

    Paths come from the job settings, which the driver has; they are looked up side by side. None where that fails, as
    for a file system that isn't known.
    """
    conf, hadoop_path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path

    def look(text: str) -> list[str] | None:
        try:
            path = hadoop_path(text)
            found = path.getFileSystem(conf).globStatus(path)
        except (PySparkException, Py4JJavaError):
            return None
        return [_plain(status.getPath().toString()) for status in found or []]

    wanted = sorted(set(paths))
    with ThreadPoolExecutor(32) as pool:
        return dict(zip(wanted, pool.map(look, wanted)))


def outermost(roots: Iterable[str]) -> list[str]:
    """Roots that lie in no other root, so that no file is read twice."""
    wanted = {r.rstrip("/") for r in roots}
    return sorted(r for r in wanted if not any(
        r[:i] in wanted for i in range(len(r)) if r[i] == "/"))


def _file_path() -> Column:
    """The path as file systems write it; Spark gives it encoded as a URI, in which a plus sign stands for itself."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.replace(decoded, F.lit(":///"), F.lit(":/")).alias("file")


def _of_roots(files: DataFrame, roots: DataFrame) -> DataFrame:
    """Files joined to the roots they are or lie below of, by all beginnings of their path."""
    parts = F.split("file", "/")
    begins = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return files.withColumn("root", F.explode(begins)).join(roots, "root").drop("root")


def lines_of(spark: SparkSession, roots: list[str], *, empty: bool = False) -> DataFrame:
    """``(file, block_start, row_seq, value)`` of all lines with their order in the file; ``empty`` ones only if asked for."""
    read = spark.read.option("recursiveFileLookup", True).text(outermost(roots))
    lines = read.select(
        _file_path(), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_seq"), F.rtrim("value", F.lit("\r")).alias("value"),
    )
    return lines if empty else lines.where("value <> ''")


def csv_records(spark: SparkSession, roots: list[str]) -> DataFrame:
    """As ``lines_of``, with the lines of a record put together where a quoted cell goes over line ends.

    One pass counts quotes to see whether there are any such cells; most objects have none, and their lines are the records.
    """
    lines = lines_of(spark, roots, empty=True)
    return (lines if quote_state(lines).isEmpty() else whole_records(lines)).where("value <> ''")


def edge_lines(lines: DataFrame) -> DataFrame:
    """``(file, first_line, last_line)``."""
    place = F.struct("block_start", "row_seq")
    return lines.groupBy("file").agg(
        F.min_by("value", place).alias("first_line"), F.max_by("value", place).alias("last_line"))


def first_and_last(spark: SparkSession, roots: list[str], *, as_csv: bool) -> DataFrame:
    """``(file, first_line, last_line)`` of text files: their ends are read, or all lines where only Spark can open them."""
    ends = file_ends(spark, outermost(roots), as_csv)
    return edge_lines(csv_records(spark, roots) if as_csv else lines_of(spark, roots)) if ends is None else ends


def _json_cells(line: Column) -> Column:
    """Names and values that are there, by name."""
    return F.array_sort(F.filter(
        F.map_entries(F.from_json(line, "map<string,string>")), lambda e: e["value"].isNotNull()))


def _last_json_value(line: Column) -> Column:
    return F.element_at(F.transform(_json_cells(line), lambda e: e["value"]), -1)


def last_cell(kind: Column, line: Column) -> Column:
    """The control cell of a line: its last one; of json the last name's."""
    return F.when(kind == "json", _last_json_value(line)).when(kind == "csv", F.element_at(csv_cells(line), -1)).otherwise(line)


def _text(cells: Column) -> Column:
    """Cells as one text in which no two rows look alike (as ``row_text``)."""
    return F.array_join(F.transform(cells, lambda c: F.coalesce(
        F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))), "")


def _variants(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """The different ways in which jobs look at each file: format, header or not, balance column."""
    return _of_roots(files, wanted).select(*files.columns, "kind", "headerless", "balance_name", "position").distinct()


VARIANT = ["file", "kind", "headerless", "balance_name", "position"]

# Up to so many files have their ways of being looked at broadcast to the rows, one short row each.
FEW_FILES = 1 << 17


def _few(files: DataFrame) -> bool:
    return files.limit(FEW_FILES + 1).count() <= FEW_FILES


def _with_ways(rows: DataFrame, ways: DataFrame, few: bool) -> DataFrame:
    """``rows`` with the ways in which jobs look at their file.

    A file's rows have one key, so a shuffle by it would bring all rows of a large file to one task. Of very many files
    no single one is much of the whole.
    """
    return rows.join(F.broadcast(ways) if few else ways, "file")


def line_rows(lines: DataFrame, edges: DataFrame, wanted: DataFrame, *, as_csv: bool, few: bool) -> DataFrame:
    """Rows ``(*VARIANT, block_start, row_seq, sign, text, amount)`` of the text objects, which are all csv or all not.

    A header line comes twice, once with sign -1, so that it drops out of every sum.
    """
    rows = lines.withColumn("sign", F.lit(1))
    if not as_csv:
        looked = _variants(edges.select("file"), wanted)
        entries, is_json = _json_cells(F.col("value")), F.col("kind") == "json"
        named = F.coalesce(F.flatten(F.transform(entries, lambda e: F.array(e["key"], e["value"]))), F.array(F.col("value")))
        cells = F.when(is_json, named).otherwise(F.array("value"))
        mine = F.filter(entries, lambda e: e["key"] == F.col("balance_name"))
        amount = F.when(is_json, F.get(F.transform(mine, lambda e: e["value"]), F.lit(0)))
        rows = _with_ways(rows, looked, few)
    else:
        ways = _variants(edges.select("file", "first_line"), wanted).withColumn("_names", csv_cells(F.col("first_line")))
        named = ~F.col("headerless")
        at = F.when(named, F.nullif(F.array_position("_names", F.col("balance_name")), F.lit(0))).otherwise(F.col("position")) - 1
        looked = ways.select(*VARIANT, F.when(named, F.size("_names")).alias("width"), at.cast("int").alias("at"), "first_line")
        headers = looked.where("width is not null").select(
            "file", F.lit(None).cast("long").alias("block_start"), F.lit(None).cast("long").alias("row_seq"),
            F.col("first_line").alias("value"), F.lit(-1).alias("sign"), *VARIANT[1:], "width", "at")
        rows = _with_ways(rows, looked.drop("first_line"), few).unionByName(headers).withColumn("_cells", csv_cells(F.col("value")))
        none = F.array_repeat(F.lit(None).cast("string"), F.col("width"))
        # As many cells as the header has.
        cells = F.when(F.col("width").isNull(), F.col("_cells")).otherwise(
            F.slice(F.concat("_cells", none), F.lit(1), F.col("width")))
        amount = F.get("_cells", F.col("at"))
    return rows.select(
        *VARIANT, "block_start", "row_seq", "sign", _text(cells).alias("text"), as_money(amount).alias("amount"))


def schema_classes(spark: SparkSession, roots: Iterable[str]) -> tuple[dict[str, list[str]], list[str]]:
    """Parquet roots by their schema (as JSON), and the roots that can't be read.

    Spark's own jobs read the footers of a root on the cluster and merge them, several roots at a time; the driver gets a
    schema for each. A root that can't be read, or whose files don't agree on a type, is by itself: those
    below it that are asked for are tried on their own. Roots without a file have no schema and are in neither.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)

    def schema(root: str) -> str | None:
        try:
            return reader.parquet(root).schema.json()
        except (PySparkException, Py4JJavaError) as error:
            nothing = isinstance(error, PySparkException) and error.getCondition() == "UNABLE_TO_INFER_SCHEMA"
            return "" if nothing else None

    wanted = {r.rstrip("/") for r in roots}
    classes: dict[str, list[str]] = {}
    unreadable: list[str] = []
    pending = outermost(wanted)
    with ThreadPoolExecutor(16) as pool:
        while pending:
            inner: set[str] = set()
            for root, found in zip(pending, pool.map(schema, pending)):
                if found is None:
                    unreadable.append(root)
                    inner |= {r for r in wanted if r.startswith(f"{root}/")}
                elif found:
                    classes.setdefault(found, []).append(root)
            pending = outermost(inner)
    return classes, unreadable


def _class_frames(spark: SparkSession, classes: dict[str, list[str]]) -> list[DataFrame]:
    reader = spark.read.option("recursiveFileLookup", True)
    return [reader.schema(StructType.fromJson(json.loads(text))).parquet(*roots) for text, roots in classes.items()]


def _files_below(spark: SparkSession, roots: list[str]) -> DataFrame:
    """``(file)`` of all files of the roots, which are listed and not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    return listed.select(F.replace("path", F.lit(":///"), F.lit(":/")).alias("file"))


def _parquet_rows(df: DataFrame, files: DataFrame, balances: list[str], few: bool) -> DataFrame:
    """As ``line_rows``, of the ``files`` with the ways in which jobs look at them. A cell is written with its column's name and a null one not at all, so the text of a row does not
    depend on the columns of other objects."""
    cells = []
    for name in sorted(df.columns):
        text = cell_text(name, df.schema[name].dataType)
        cells.append(F.coalesce(F.concat(F.lit(f"{name}="), F.length(text).cast("string"), F.lit(":"), text), F.lit("")))
    amount = F.lit(None).cast("decimal(28,8)")
    for name in balances:
        if name in df.columns:
            amount = F.when(F.col("balance_name") == name, as_money(F.col(f"`{name}`"))).otherwise(amount)
    index = F.col("_metadata.row_index")
    rows = df.select("*", _file_path(), F.shiftright(index, 20).alias("block_start"), index.alias("row_seq"))
    return _with_ways(rows, files, few).select(
        *VARIANT, "block_start", "row_seq", F.lit(1).alias("sign"), F.concat(*cells).alias("text"), amount.alias("amount"))


def file_sums(rows: DataFrame) -> DataFrame:
    """Sums over the rows of every file and way to look at it, which add up to those of an object."""
    sign = F.col("sign")
    return rows.groupBy(*VARIANT).agg(
        F.sum(sign.cast("bigint")).alias("row_count"), F.sum(sign * F.col("amount")).alias("balance"),
        F.sum(sign * F.length("text").cast("bigint")).alias("text_size"), *hash_sums(F.col("text"), sign))


def file_digests(rows: DataFrame, bits: int) -> DataFrame:
    """``(_key, digest)``, the ordered digest of each file's rows without its header; the key is the VARIANT as json."""
    hashed = rows.where("sign = 1").select(
        F.to_json(F.struct(*VARIANT)).alias("_key"), "kind", "headerless", "block_start", "row_seq", F.sha2("text", 256).alias("row_digest"))
    ordered = with_ordinals(hashed, "_key", F.col("block_start"), "row_seq", "row_digest")
    has_header = F.when((F.col("kind") == "csv") & ~F.col("headerless"), 1).otherwise(0)
    ordered = ordered.withColumn("ordinal", F.col("ordinal") - has_header).where("ordinal >= 0")
    return tree_digest(ordered, "_key", bits=bits).select("_key", "digest")


def object_rows(
    spark: SparkSession, wanted: list[tuple], manifests: list[str]
) -> tuple[DataFrame | None, DataFrame, DataFrame | None, list[str]]:
    """Rows of all objects, the ``wanted`` frame, the edge lines of text files and manifests, and the roots that can't be read.

    ``wanted`` is ``(job_id, root, kind, headerless, balance_name, position)``.
    """
    looked = spark.createDataFrame(
        wanted, "job_id bigint, root string, kind string, headerless boolean, balance_name string, position int")
    parts, edges = [], []
    for as_csv in (True, False):
        roots = [w[1] for w in wanted if w[2] in LINE_FORMATS and (w[2] == "csv") == as_csv]
        read = roots if as_csv else [*roots, *manifests]
        if read:
            lines = csv_records(spark, read) if as_csv else lines_of(spark, read)
            ends = first_and_last(spark, read, as_csv=as_csv)
            edges.append(ends.withColumn("as_csv", F.lit(as_csv)))
            kinds = ["csv"] if as_csv else [k for k in LINE_FORMATS if k != "csv"]
            if roots:
                few = _few(_files_below(spark, outermost(read)))
                parts.append(line_rows(lines, ends, looked.where(F.col("kind").isin(*kinds)), as_csv=as_csv, few=few))
    in_parquet = [w for w in wanted if w[2] == "parquet"]
    classes, unreadable = schema_classes(spark, [w[1] for w in in_parquet])
    if classes:
        balances = sorted({w[4] for w in in_parquet if w[4]})
        listed = _files_below(spark, [r for roots in classes.values() for r in roots])
        files, few = _variants(listed, looked.where(F.col("kind") == "parquet")), _few(listed)
        parts += [_parquet_rows(df, files, balances, few) for df in _class_frames(spark, classes)]
    return _union(parts), looked, _union(edges), unreadable


def _union(frames: list[DataFrame]) -> DataFrame | None:
    whole = None
    for frame in frames:
        whole = frame if whole is None else whole.unionByName(frame)
    return whole


def object_measures(rows: DataFrame, wanted: DataFrame, *, ordered: bool, bits: int = 512) -> DataFrame:
    """``(job_id, row_count, balance, text_size, *SUM_COLUMNS, file_digests)`` of every object that has a row or header."""
    sums = file_sums(rows)
    if ordered:
        sums = sums.withColumn("_key", F.to_json(F.struct(*VARIANT))).join(file_digests(rows, bits), "_key", "left").drop("_key")
    else:
        sums = sums.withColumn("digest", F.lit(None).cast("string"))
    jobs = wanted.select("job_id", "root", *[F.col(c).alias(f"_{c}") for c in VARIANT[1:]])
    mine = _of_roots(sums, jobs).where(
        (F.col("kind") == F.col("_kind")) & (F.col("headerless") == F.col("_headerless"))
        & F.col("balance_name").eqNullSafe(F.col("_balance_name")) & F.col("position").eqNullSafe(F.col("_position")))
    # Two globs of one job may match the same file.
    once = mine.dropDuplicates(["job_id", *VARIANT])
    return once.groupBy("job_id").agg(
        *[F.sum(c).alias(c) for c in (*SIZES, *SUM_COLUMNS)],
        F.array_sort(F.collect_list(F.when(F.col("digest").isNotNull(), F.struct("file", "digest")))).alias("file_digests"))


def whole_digest(file_digests: Column, bits: int = 512) -> Column:
    """The ordered digest of an object: its file's, or that of its files' digests in path order."""
    listed = F.transform(file_digests, lambda x: x["digest"])
    return F.when(F.size(listed) == 1, listed[0]).when(
        F.size(listed) > 1, F.concat(F.lit("tree:"), F.sha2(F.array_join(listed, ","), bits)))


def edge_cells(edges: DataFrame, wanted: list[tuple[int, str, str, str]], spark: SparkSession) -> DataFrame:
    """``(job_id, meta_string)`` from ``(job_id, root, kind, place)``.

    Of an object of several files, the first by path has the header or manifest line, the last the footer.
    """
    asked = spark.createDataFrame(wanted, "job_id bigint, root string, kind string, place string")
    mine = _of_roots(edges, asked).where((F.col("kind") == "csv") == F.col("as_csv"))
    line = F.when(F.col("place") == "Footer", F.col("last_line")).otherwise(F.col("first_line"))
    cell = F.when(F.col("place") == "File", line).otherwise(last_cell(F.col("kind"), line))
    footer = F.max_by("cell", "file")
    return mine.withColumn("cell", cell).groupBy("job_id", "place").agg(
        F.when(F.col("place") == "Footer", footer).otherwise(F.min_by("cell", "file")).alias("meta_string")).drop("place")


def parquet_edges(rows: DataFrame) -> DataFrame:
    """``(file, first_line, last_line)`` of frames with ``file``, ``row_seq`` and ``value``."""
    return rows.groupBy("file").agg(
        F.min_by("value", "row_seq").alias("first_line"), F.max_by("value", "row_seq").alias("last_line"))


def parquet_last_cells(spark: SparkSession, roots: list[str]) -> DataFrame:
    """First and last row's last cell that is there, of every parquet file."""
    parts = []
    for df in _class_frames(spark, schema_classes(spark, roots)[0]):
        last = F.coalesce(*[cell_text(c, df.schema[c].dataType) for c in reversed(df.columns)])
        parts.append(parquet_edges(df.select(_file_path(), F.col("_metadata.row_index").alias("row_seq"), last.alias("value"))))
    none = spark.createDataFrame([], "file string, first_line string, last_line string")
    return _union([none, *parts]).withColumn("as_csv", F.lit(False))
