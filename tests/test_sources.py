"""Readers on small files: places of the control metadata, empty, split and dirty files."""

import gzip

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.operators.profile import object_profile
from tallykeep.sources.listing import listing_changes, revalidated
from tallykeep.operators.rules import balance_control_check, count_control_check, zero_size_check
from tallykeep.sources import (
    control_cells, param_lookup, query_options, read_control, read_job_args, read_listing,
    read_manifests, read_objects, read_params, table_options,
)

COUNT, BALANCE = (4, 8), (13, 20)


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_header_control(spark, tmp_path):
    path = write(tmp_path, "header.csv", "id,amt,CNT=0003;BAL=0000006\n1,1,\n2,2,\n3,3,\n")
    control = read_control(spark, "Header", path, COUNT, BALANCE)
    assert rows(control) == [("header.csv", 3, 6)]
    profile = object_profile(read_objects(spark, path, "csv", header=False), balance="_c1")
    # The control row is data of a file read without a header, as its count and sum show.
    assert rows(count_control_check(control, profile)) == [("header.csv", 3, 4, "Failed")]
    assert rows(balance_control_check(control, profile)) == [("header.csv", 6, 6, "Passed")]


def test_footer_control(spark, tmp_path):
    path = write(tmp_path, "footer.csv", "id,amt,note\n1,1,\n2,2,\n3,3,CNT=0003;BAL=0000006\n")
    control = read_control(spark, "Footer", path, COUNT, BALANCE)
    assert rows(control) == [("footer.csv", 3, 6)]
    profile = object_profile(read_objects(spark, path, "csv"), balance="amt")
    assert rows(count_control_check(control, profile)) == [("footer.csv", 3, 3, "Passed")]


def test_manifest_control_for_many_files(spark, tmp_path):
    for n in (1, 2):
        write(tmp_path, f"m{n}.txt", f"CNT=000000000{n};BAL=0000000000000{n}\nsecond line\n")
    assert rows(read_manifests(spark, str(tmp_path))) == [
        ("m1.txt", "CNT=0000000001;BAL=00000000000001"), ("m2.txt", "CNT=0000000002;BAL=00000000000002"),
    ]
    assert rows(read_control(spark, "File", str(tmp_path), (4, 14), (19, 33))) == [("m1.txt", 1, 1), ("m2.txt", 2, 2)]


def test_control_cells_of_files_in_many_splits(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        lines = [f"{i},{name}-{i}" for i in range(20_000)]
        write(tmp_path, name, "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        paths = str(tmp_path)
        assert read_objects(spark, paths, "csv", header=False).rdd.getNumPartitions() > 10
        assert rows(control_cells(spark, paths, "csv", "Header")) == [("a.csv", "a.csv-0"), ("b.csv", "b.csv-0")]
        assert rows(control_cells(spark, paths, "csv", "Footer")) == [
            ("a.csv", "a.csv-19999"), ("b.csv", "b.csv-19999")
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_control_in_other_formats(spark, tmp_path, fmt):
    path = str(tmp_path / "data")
    data = spark.createDataFrame([(1, "x"), (2, "y"), (3, "CNT=0003;BAL=0000006")], "a int, b string")
    getattr(data.coalesce(1).write, fmt)(path)
    control = read_control(spark, "Footer", path, COUNT, BALANCE, fmt=fmt, key="folder")
    assert rows(control) == [("data", 3, 6)]
    profile = object_profile(read_objects(spark, path, fmt, key="folder"), balance="a")
    assert rows(count_control_check(control, profile)) == [("data", 3, 3, "Passed")]
    assert rows(balance_control_check(control, profile)) == [("data", 6, 6, "Passed")]


def test_compressed_file(spark, tmp_path):
    path = tmp_path / "z.csv.gz"
    path.write_bytes(gzip.compress(b"id,amt\n1,2\n2,3\n"))
    assert rows(object_profile(read_objects(spark, str(path), "csv"), balance="amt"), "row_count") == [(2,)]


def test_empty_header_only_and_missing_files(spark, tmp_path):
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "header_only.csv", "id,amt\n")
    write(tmp_path, "full.csv", "id,amt\n1,2\n")
    landed = read_objects(spark, str(tmp_path), "csv", schema="id string, amt string")
    expected = spark.createDataFrame(
        [("empty.csv",), ("header_only.csv",), ("full.csv",), ("missing.csv",)], "object_name string"
    )
    checked = zero_size_check(expected, object_profile(landed, with_text=True), ["object_name"])
    assert rows(checked, "object_name", "status") == [
        ("empty.csv", "Failed"), ("full.csv", "Passed"), ("header_only.csv", "Failed"), ("missing.csv", "Failed"),
    ]


def test_listing_gives_sizes_without_reading(spark, tmp_path):
    write(tmp_path, "a.csv", "12345")
    assert rows(read_listing(spark, str(tmp_path)), "file_name", "file_size") == [("a.csv", 5)]


def test_text_that_is_no_number(spark, tmp_path):
    path = write(tmp_path, "dirty.csv", "id,amt\n1,1.50\n2,n/a\n3,\n4,2.25\n")
    profile = object_profile(read_objects(spark, path, "csv"), balance="amt")
    assert [(n, str(b.normalize())) for n, b in rows(profile, "row_count", "balance")] == [(4, "3.75")]


def test_amounts_without_any_number_are_an_error(spark, tmp_path):
    path = write(tmp_path, "none.csv", "id,amt\n1,x\n")
    profile = object_profile(read_objects(spark, path, "csv"), balance="amt")
    control = spark.createDataFrame([("none.csv", 1, 0)], "object_name string, control_count bigint, control_balance bigint")
    assert rows(balance_control_check(control, profile)) == [("none.csv", 0, None, "Error")]


def test_control_text_that_can_not_be_cut(spark):
    from tallykeep.functions import slice_long
    df = spark.createDataFrame([("CNT=12x4",), ("CN",), (" 42 ",), ("-0017",), (None,)], "t string")
    assert [r[0] for r in df.select(slice_long("t", 4, 8)).collect()] == [None, None, None, 7, None]
    assert [r[0] for r in df.select(slice_long("t", 0, 5)).collect()][2:4] == [42, -17]
    assert {r[0] for r in df.select(slice_long("t", 3, 3)).collect()} == {None}
    assert {r[0] for r in df.select(slice_long("t", -2, 3)).collect()} == {None}


def test_job_arguments(spark, tmp_path):
    path = write(
        tmp_path, "args.csv",
        "JobId,ObjectPath,ObjectName,ObjectType,sqlpassword,HeadCount_value_start_index,HeadCount_value_end_index\n"
        "7,/landing/a,a.csv,File,secret,4,14\n8,,b,SQLTable,secret,x,14\n",
    )
    args = read_job_args(spark, path)
    assert not [c for c in args.columns if "password" in c.lower()]
    assert rows(args, "job_id", "object_name", "object_path", "count_start", "count_end", "post_file_type") == [
        (7, "a.csv", "/landing/a", 4, 14, None), (8, "b", None, None, 14, None),
    ]


def test_parameters(spark, tmp_path):
    path = write(tmp_path, "params.txt", "server,one\nquery,select a, b from t\nserver,two\nalone\nalone,late\nempty,\n")
    wanted = spark.createDataFrame([(k,) for k in ("server", "query", "alone", "empty", "none")], "param_key string")
    assert dict(rows(param_lookup(wanted, read_params(spark, path)))) == {
        "server": "one", "query": "select a, b from t", "alone": "", "empty": "", "none": "",
    }


def test_jdbc_options():
    assert query_options("jdbc:x", "select 1", {"user": "u"}) == {"url": "jdbc:x", "query": "select 1", "user": "u"}
    options = table_options(
        "jdbc:x", "t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4
    )
    assert options["numPartitions"] == "4" and options["dbtable"] == "t" and "query" not in options
    with pytest.raises(ValueError):
        table_options("jdbc:x", "t", partition_column="id", lower_bound=5, upper_bound=5, num_partitions=4)


def test_position_orders_rows(spark, tmp_path):
    path = write(tmp_path, "o.csv", "n\n" + "\n".join(map(str, range(5000))) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = read_objects(spark, path, "csv", position=True)
        ordered = [int(r.n) for r in df.orderBy("block_start", "row_seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == list(range(5000))
    assert df.select(F.countDistinct("block_start")).first()[0] >= 1


def test_control_cells_of_files_with_other_columns(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    write(folder, "part-0.csv", "id,amt,CNT=0001\n1,2,CNT=0009\n")
    write(folder, "part-1.csv", "id,amt,more,CNT=0002\n" + "1,2,3,\n" * 300 + "1,2,3,CNT=0301\n")
    for place, key, wanted in (
        ("Header", "file", [("part-0.csv", "CNT=0001"), ("part-1.csv", "CNT=0002")]),
        ("Header", "folder", [("f", "CNT=0001")]), ("Footer", "folder", [("f", "CNT=0301")]),
    ):
        assert rows(control_cells(spark, str(folder), "csv", place, key=key)) == wanted


def test_only_changed_objects_are_validated_again(spark, tmp_path):
    for name in ("a", "b", "c"):
        spark.range(3).write.parquet(str(tmp_path / name))
    jobs = spark.createDataFrame([(1, f"{tmp_path}/a"), (2, f"{tmp_path}/b"), (3, f"{tmp_path}/c"), (4, f"{tmp_path}/none"), (5, "")],
                                 "job_id bigint, object_path string")
    ran = []

    def run(some):
        ran.append({r.job_id for r in some.collect()})
        return some.selectExpr("job_id", f"'run {len(ran)}' as text")

    none = spark.createDataFrame([], "job_id bigint, text string")
    nothing = spark.createDataFrame([], "file string, length bigint, modified timestamp")
    first, seen = revalidated(spark, jobs, nothing, none, run)
    first, seen = (spark.createDataFrame(df.collect(), df.schema) for df in (first, seen))
    assert ran[-1] == {1, 2, 3, 4, 5} and first.count() == 5
    again, _ = revalidated(spark, jobs, seen, first, run)
    assert ran[-1] == {4, 5} and again.count() == 5
    spark.range(5).write.mode("append").parquet(str(tmp_path / "b"))
    more = jobs.union(spark.createDataFrame([(6, f"{tmp_path}/a")], jobs.schema))
    again, now = revalidated(spark, more, seen, first, run)
    assert ran[-1] == {2, 4, 5, 6}
    assert dict(rows(again)) == {1: "run 1", 2: "run 3", 3: "run 1", 4: "run 3", 5: "run 3", 6: "run 3"}
    states = listing_changes(seen, now).groupBy("state").count()
    assert dict(rows(states))["New"] >= 1 and dict(rows(states))["Same"] >= 3
