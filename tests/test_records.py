"""Csv records whose quoted cells hold commas, quotes and line ends, whatever the splits of their file."""

import csv
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.sources import ranges
from tallykeep.sources.files import control_cells
from tallykeep.sources.objects import csv_records, edge_lines, lines_of, matched_paths, schema_classes
from tallykeep.sources.records import csv_cells, quote_state


def cells_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string")
    return [r.cells for r in df.select("i", csv_cells(F.col("line")).alias("cells")).orderBy("i").collect()]




@pytest.mark.parametrize("line, cells", [
    ("a,b,c", ["a", "b", "c"]), ("", [None]), (",", [None, None]), ('"a,b",c', ["a,b", "c"]), ('"say ""hi"", x",2', ['say "hi", x', "2"]),
    ('"",x', [None, "x"]), ('"""",x', ['"', "x"]), (' "a" ,b', ["a", "b"]), ('"line\nend",2', ["line\nend", "2"]),
    ('a\x01b,"c\x01,d"', ["a\x01b", "c\x01,d"]), ('"\x01c",\x01e', ["\x01c", "\x01e"]), ('"open,and,so on', ['"open', "and", "so on"]), ('5" pipe,"a,b"', ['5" pipe', "a,b"]),
])
def test_cells_of_a_line(spark, line, cells):
    assert cells_of(spark, [line]) == [cells]


def test_very_many_quoted_cells_take_linear_time(spark):
    many = 100_000
    line = ",".join(f'"{i}, ""x"""' for i in range(many))
    cells_of(spark, [line[:1000]])
    start = time.perf_counter()
    found = cells_of(spark, [line])[0]
    assert time.perf_counter() - start < 20
    assert len(found) == many and found[0] == '0, "x"' and found[-1] == f'{many - 1}, "x"'


def written(path, rows):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    path.write_text(text.getvalue())
    return text.getvalue()


def records(spark, path):
    read = csv_records(spark, [str(path)])
    cells = read.select("file", "block_start", "row_seq", csv_cells(F.col("value")).alias("cells")).orderBy("file", "block_start", "row_seq")
    return [r.cells for r in cells.collect()]


def test_records_do_not_depend_on_splits(spark, tmp_path):
    made = random.Random(4)
    piece = lambda: made.choice(["x", "a,b", 'q"q', "line\nend", "two\n\nempty", "z" * made.randint(1, 30)])
    rows = [[str(i), piece(), piece(), "end"] for i in range(400)]
    size = len(written(tmp_path / "a.csv", rows))
    for parts in (1, 3, 7, 40):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // parts + 1))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            starts = lines_of(spark, [str(tmp_path)]).select("block_start").distinct().count()
            assert starts >= min(parts, 3)
            assert records(spark, tmp_path) == rows
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_cell_over_whole_splits_and_line_ends(spark, tmp_path):
    rows = [["h1", "h2"], ["1", "\n".join(["long"] * 300)], ["2", "x"], ["3", "last\nline"]]
    text = written(tmp_path / "a.csv", rows)
    (tmp_path / "b.csv").write_text(text.replace("\n", "\r\n"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert records(spark, tmp_path) == rows + rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_without_such_cells_are_not_touched(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n"1, ""x""",2\n')
    (tmp_path / "unpaired.csv").write_text('a,b\n5" pipe,1\nx,y\n')
    lines = lines_of(spark, [str(tmp_path)], empty=True)
    assert quote_state(lines).count() == 0
    assert records(spark, tmp_path) == [["a", "b"], ['1, "x"', "2"], ["a", "b"], ['5" pipe', "1"], ["x", "y"]]


def test_control_cell_after_a_line_end_in_a_cell(spark, tmp_path):
    written(tmp_path / "a.csv", [["id", "note", "CNT=\n0002"], ["1", "x", "y"], ["2", "z", "two\nlines, CNT=0002"]])
    got = {place: control_cells(spark, str(tmp_path), "csv", place).first().meta_string for place in ("Header", "Footer")}
    assert got == {"Header": "CNT=\n0002", "Footer": "two\nlines, CNT=0002"}


# -- parquet roots by schema


def test_roots_are_grouped_by_schema_and_errors_stay_with_their_root(spark, tmp_path):
    for i in range(6):
        spark.range(3).selectExpr(f"id as k{i % 2}").write.parquet(str(tmp_path / f"t{i}"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"PAR1 no parquet at all PAR1")
    spark.range(1).write.parquet(str(tmp_path / "bad" / "inner"))
    (tmp_path / "empty").mkdir()
    roots = [str(tmp_path / n) for n in ("t0", "t1", "t2", "t3", "t4", "t5", "bad", "empty", "bad/inner")]
    classes, unreadable = schema_classes(spark, roots)
    assert sorted(sorted(r[-2:] for r in group) for group in classes.values()) == [["er"], ["t0", "t2", "t4"], ["t1", "t3", "t5"]]
    assert unreadable == [str(tmp_path / "bad")]


def test_unknown_file_systems_have_no_paths(spark, tmp_path):
    found = matched_paths(spark, ["nosuchscheme://x/y", str(tmp_path), str(tmp_path / "absent")])
    assert found["nosuchscheme://x/y"] is None and len(found[str(tmp_path)]) == 1 and found[str(tmp_path / "absent")] == []


# -- the ends of files


@pytest.mark.parametrize("quoted", [False, True])
def test_ends_of_files_are_those_of_a_scan(spark, tmp_path, monkeypatch, quoted):
    monkeypatch.setattr(ranges, "RANGE", 7)
    texts = ["a,b\n1,2\n", "one", "\n\n x \r\n\r\n", "", "\n", '"a\nb",c\n1,"x\n\ny"\n', "h\n" + "z" * 5000, "h\n" + '"l\n' * 1 + 'm"' + "\n",
             '5" pipe\nx\n', "a\r\nb\r\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"f {i}.csv").write_bytes(text.encode())
    lines = lines_of(spark, [f"file:{tmp_path}"], empty=True)
    scanned = edge_lines((csv_records(spark, [f"file:{tmp_path}"]) if quoted else lines).where("value <> ''"))
    assert rows(ranges.file_ends(spark, [f"file:{tmp_path}"], quoted), "file", "first_line", "last_line") == rows(
        scanned, "file", "first_line", "last_line")


def test_a_very_large_file_is_read_at_its_ends_only(spark, tmp_path):
    with open(tmp_path / "big.csv", "wb") as file:  # a hole of 10 GB, which takes no space
        file.write(b"id,CNT=0001\n")
        file.seek(10 << 30)
        file.write(b'\n1,"two\nlines, CNT=0002"\n')
    start = time.perf_counter()
    got = {p: control_cells(spark, str(tmp_path), "csv", p).first().meta_string for p in ("Header", "Footer")}
    assert got == {"Header": "CNT=0001", "Footer": "two\nlines, CNT=0002"}
    assert time.perf_counter() - start < 30


def test_where_only_spark_can_open_files_lines_are_scanned(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id,x\n1,y\n")
    assert not ranges.can_be_opened("viewfs://store/x") and ranges.can_be_opened(f"file:{tmp_path}")
    monkeypatch.setattr(ranges, "can_be_opened", lambda path: False)
    assert control_cells(spark, str(tmp_path), "csv", "Footer").first().meta_string == "y"
