"""Digests against plain Python, and the registry."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tallykeep.operators import digests


def sha(text, bits=512):
    return hashlib.new(f"sha{bits}", text.encode()).hexdigest()


def plain_tree(texts, block=1 << 10, chunk=1 << 20):
    level = [sha(t, 256) for t in texts]
    blocks = [sha(",".join(level[i:i + block]), 256) for i in range(0, len(level), block)]
    per_chunk = chunk // block
    chunks = [sha(",".join(blocks[i:i + per_chunk]), 256) for i in range(0, len(blocks), per_chunk)]
    return "tree:" + sha(",".join(chunks))


def cell(value):
    return "-" if value is None else f"{len(value)}:{value}"


@pytest.fixture
def small_tree(monkeypatch):
    monkeypatch.setattr(digests, "BLOCK_BITS", 2)
    monkeypatch.setattr(digests, "CHUNK_BITS", 4)


def test_tree_digest_against_plain_python(spark, small_tree):
    data = [("a", i * 3, f"row {i}", None if i % 4 == 0 else "x") for i in range(53)]
    data += [("b", i, f"row {i}", "y") for i in range(4)]
    df = spark.createDataFrame(data, "object_name string, pos bigint, t string, u string").repartition(7)
    found = digests.content_digest(df, "object_name", "pos", F.shiftright("pos", 4), ["t", "u"])
    wanted = []
    for name in "ab":
        texts = [cell(t) + cell(u) for n, _, t, u in data if n == name]
        wanted.append((name, len(texts), plain_tree(texts, 4, 16)))
    assert rows(found) == wanted


def test_equal_content_at_other_positions_has_an_equal_digest(spark, small_tree):
    data = [("a", i, str(i)) for i in range(40)] + [("b", 1000 + 7 * i, str(i)) for i in range(40)]
    data += [("c", i, str(39 - i)) for i in range(40)]
    df = spark.createDataFrame(data, "object_name string, pos bigint, t string")
    found = dict(rows(digests.content_digest(df, "object_name", "pos", F.shiftright("pos", 3), ["t"]), "object_name", "digest"))
    assert found["a"] == found["b"] != found["c"]
    loose = dict(rows(digests.unordered_digest(df, "object_name", ["t"]), "object_name", "digest"))
    assert loose["a"] == loose["b"] == loose["c"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("a,:-\n1é", max_size=4), st.one_of(st.none(), st.text("a,:-", max_size=3))), min_size=1, max_size=12))
def test_digest_does_not_depend_on_partitions(spark, values):
    data = [("o", i, *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "object_name string, pos bigint, t string, u string")
    args = ("object_name", "pos", F.shiftright("pos", 2), ["t", "u"])
    wanted = [("o", len(values), plain_tree([cell(t) + cell(u) for t, u in values]))]
    assert rows(digests.content_digest(df.repartition(5), *args)) == wanted
    assert rows(digests.content_digest(df.coalesce(1), *args)) == wanted


def test_cells_can_not_move(spark):
    df = spark.createDataFrame(
        [("a", 0, "a,b", "c"), ("b", 0, "a", "b,c"), ("c", 0, "", None), ("d", 0, None, "")],
        "object_name string, pos bigint, t string, u string",
    )
    found = digests.unordered_digest(df, "object_name", ["t", "u"])
    assert len({d for _, d in rows(found, "object_name", "digest")}) == 4


def test_rows_that_share_a_position_or_have_none(spark, small_tree):
    data = [("a", i % 20, f"row {i % 50}") for i in range(400)] + [("a", None, f"row {i}") for i in range(90)]
    df = spark.createDataFrame(data, "object_name string, pos bigint, t string")
    args = ("object_name", "pos", F.shiftright("pos", 2), ["t"])
    found = {rows(digests.content_digest(df.repartition(n), *args))[0] for n in (1, 3, 7)}
    assert len(found) == 1
    without = sorted(sha(cell(f"row {i}"), 256) for i in range(90))
    tied = [d for p in range(20) for d in sorted(sha(cell(t), 256) for _, q, t in data[:400] if q == p)]
    level = without + tied
    blocks = [sha(",".join(level[i:i + 4]), 256) for i in range(0, len(level), 4)]
    chunks = [sha(",".join(blocks[i:i + 4]), 256) for i in range(0, len(blocks), 4)]
    assert found == {("a", 490, "tree:" + sha(",".join(chunks)))}


def test_sums_hold_all_bits_of_the_row_hashes(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "object_name string, t string")
    hashes = [sha(cell(t), 256) for t in "xyx"]
    sums = [sum(int(h[i:i + 4], 16) for h in hashes) for i in range(0, 64, 4)]
    wanted = "sum:" + sha(":".join(map(str, [3, *sums])), 256)
    assert rows(digests.unordered_digest(df, "object_name", ["t"])) == [("a", 3, wanted)]


def test_duplicates_inside_and_before_the_arrival_set(spark):
    arrivals = spark.createDataFrame(
        [(1, "x"), (2, "x"), (3, "y"), (4, "z"), (5, None)], "id bigint, digest string"
    )
    registry = spark.createDataFrame([("y",), ("y",), ("w",)], "digest string")
    assert rows(digests.flag_duplicates(arrivals, registry, "id")) == [
        (1, "x", False), (2, "x", True), (3, "y", True), (4, "z", False), (5, None, None)
    ]
    assert rows(digests.new_digests(arrivals, registry, "id")) == [("x", 1), ("z", 4)]
    empty = registry.where("false")
    assert rows(digests.new_digests(arrivals, empty, "id")) == [("x", 1), ("y", 3), ("z", 4)]
    entries = digests.registry_entries(arrivals, empty, "id", F.lit("2024-01-01").cast("timestamp"), "me")
    assert entries.columns == ["file_name", "checksum_value", "created_time", "created_by"]


def test_file_rows_by_split(spark, tmp_path):
    from tallykeep.sources import read_objects
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("t\n" + "\n".join(f"row {i}" for i in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = read_objects(spark, str(tmp_path), "csv", position=True)
        found = rows(digests.content_digest(df, "object_name", "row_seq", F.col("block_start"), ["t"]), "digest")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = plain_tree([cell(f"row {i}") for i in range(3000)])
    assert found == [(wanted,), (wanted,)]
