"""What several operators need: shared storage for stages, text bytes, words and their hashes."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A-Z become a-z; other ASCII characters that are neither letters nor digits become blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where it is unset and all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends, no executor is needed any more."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged = path
    return back


def release(*tables: DataFrame, shuffles: bool = False) -> None:
    """Delete tables that `stage` wrote, once what is computed from them is written.

    Spark keeps the shuffle files of a plan as long as the driver holds the plan; with `shuffles` the driver gives up its
    garbage, and they go.
    """
    for table in tables:
        path = getattr(table, "_staged", None)
        if path is not None:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            table._staged = None
    if shuffles and tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of so many rows at most; the default of 10,000 long texts is a lot of memory.

    Python workers on this machine also get the place of this package, if it isn't installed there.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    place, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if place not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), place])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; lone surrogates, which only bad input has, become question marks."""
    return b"" if text is None else text.encode("utf-8", "replace")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of ASCII letters, digits and characters beyond ASCII."""
    return as_bytes(text).translate(WORD_BYTES).split()


_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


@functools.lru_cache(1)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words in translated bytes that end with a blank."""
    chars = np.frombuffer(data, np.uint8)
    inside = chars != 32
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate(([0], change))
    starts, ends = change[::2], change[1::2]
    size = max(_PIECE, 1 << (len(data) + 1).bit_length())
    power, inverse = _tables(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: Sequence[str | None]) -> list[np.ndarray]:
    """64-bit hashes of the words (as in `words_of`) of each text, for all texts at once in pieces of 64 KB."""
    each = [as_bytes(t).translate(WORD_BYTES) + b" " for t in texts]
    data = b"".join(each)
    at, starts, hashes = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    while at < len(data):
        # Pieces end at a blank; one that is all one word goes on to its end.
        to = data.rfind(b" ", at, at + _PIECE) + 1 or data.find(b" ", at) + 1
        start, h = _hashed(data[at:to])
        starts.append(start + at)
        hashes.append(h)
        at = to
    ends = np.cumsum([len(x) for x in each])
    cut = np.searchsorted(np.concatenate(starts), ends[:-1]) if len(each) else []
    return np.split(np.concatenate(hashes), cut) if each else []


def trimmed(work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """`work`, after which the Python worker, which Spark keeps for later tasks, gives freed memory back to the system."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from work(frames)
        finally:
            give_back()

    return run


def give_back() -> None:
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def in_batches(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Cut frames into pieces of at most so many rows."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at:at + rows]


def numbered(docs: DataFrame, name: str = "n", group_rows: int = 2_000) -> DataFrame:
    """`docs` with a number that orders documents: by doc_id; null ids first and equal ids by the hash of their text.

    Equal rows have equal numbers. Names of columns that begin with an underscore are for the operators. The texts of an id
    are ranked in ranges of their hashes of about `group_rows`, however many there are.
    """
    text_hash = F.xxhash64("text")
    ids = docs.where("doc_id IS NOT NULL").select("doc_id", text_hash.alias("h")).distinct()
    several = ids.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1")
    most = several.agg(F.max("c")).first()[0]
    none = F.shiftright(text_hash, 2) - F.lit(1 << 62)
    if most is None:
        return docs.withColumn(name, F.coalesce("doc_id", none).cast("long"))
    ranges = F.lit(1) + F.floor(F.col("c") / group_rows)
    part = F.shiftright((F.shiftright("h", 32) + F.lit(1 << 31)) * ranges, 32)
    parted = ids.join(several, "doc_id").select("doc_id", "h", part.alias("part"))
    before = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parted.groupBy("doc_id", "part").agg(F.count("*").alias("n")).select(
        "doc_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("h"))
    rank = parted.select("doc_id", "h", "part", within.alias("within")).join(sums, ["doc_id", "part"]).select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), (F.col("within") + F.col("before")).alias("_rank"))
    joined = docs.join(rank, (F.col("doc_id") == F.col("_id")) & (text_hash == F.col("_h")), "left")
    n = F.col("doc_id") * F.lit(most) + F.coalesce(F.col("_rank"), F.lit(1)) - 1
    return joined.withColumn(name, F.coalesce(n, none).cast("long")).drop("_id", "_h", "_rank")
