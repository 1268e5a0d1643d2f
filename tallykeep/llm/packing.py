"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents are cut into pieces of at most `capacity` tokens. Pieces of one length are interchangeable, and so are gaps
of one size, so a round handles a whole length at once, however many rows have it:

1. the pieces are range-sorted by length and ranked within it (in Spark, long lists in salted groups);
2. a round takes the longest length left, sweeps the sorted gaps for the smallest that is large enough, gives the
   first ranks to the first gaps of that size, and moves on to the next larger size while pieces are left;
3. gaps that took a piece shrink and are filed again, pieces without a gap open sequences, and the next round starts.

Gaps are kept as runs of consecutive sequences of equal gap. A round splits at most one run, so there are at most
2 x `capacity` runs, for any number of documents: that is all the driver sees. Every piece then finds its
sequence in its own task, as the successor of its rank in the sorted list of what each round gave away.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.shared import in_batches, stage
from tallykeep.llm.tokens import ids_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of every document: its ids and `end_id`, cut from the end so that only the first can be shorter.

    A null text is an empty one. Rows with the same doc_id are documents of their own.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, end = ids_of(tokenizer), np.uint32(end_id).astype("<u4").tobytes()
        for frame in in_batches(frames, 500):
            out = []
            for doc_id, packed in zip(frame.doc_id, ids.packed(frame.text)):
                packed += end
                n = len(packed) // 4
                at, to = 0, n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    out.append((doc_id, piece, at, to - at, zlib.crc32(packed[4 * at:4 * to])))
                    at, to = to, to + capacity
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])\
                .astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Rounds of best fit over lengths and their counts.

    Returns (length, first rank, first sequence, offset): the pieces of that length from that rank on, up to the
    next entry, go to consecutive sequences at that offset.
    """
    sizes: list[int] = []  # sorted gap sizes
    runs: dict[int, list[tuple[int, int]]] = {}  # gap size -> runs of (first sequence, how many)
    given: list[tuple[int, int, int, int]] = []
    opened = 0

    def file(gap: int, first: int, many: int) -> None:
        if gap not in runs:
            bisect.insort(sizes, gap)
            runs[gap] = []
        runs[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                # As many fit into a new sequence as it holds of this length; the rounds below fill it up.
                many = -(-left // (capacity // length))
                file(capacity, opened, many)
                opened += many
                continue
            gap = sizes[at]
            first, many = runs[gap].pop()
            if not runs[gap]:
                del runs[gap]
                sizes.pop(at)
            took = min(many, left)
            if took < many:
                file(gap, first + took, many - took)
            given.append((length, rank, first, capacity - gap))
            if gap > length:
                file(gap - length, first, took)
            rank += took
            left -= took
    return given


def pack(pieces: DataFrame, capacity: int = 2048, group_rows: int = 2_000) -> DataFrame:
    """Add sequence_id and offset to pieces with a `length` from 1 to `capacity`; gapless from 0 in each sequence.

    `pieces` is read twice, so it should be a stored table. Lengths that occur more than `group_rows` times are
    ranked in several groups of about that size. Null or other lengths are an error. An empty table gives an empty one.
    """
    bad = pieces.where(F.col("length").isNull() | ~F.col("length").between(1, capacity)).limit(1).count()
    if bad:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    most = max(by_length.values(), default=0)
    identity = [c for c in pieces.columns if c != "length"]
    # At most `capacity` rows, however many pieces there are.
    sizes = F.broadcast(pieces.groupBy("length").agg((F.lit(1) + F.floor(F.count("*") / group_rows)).alias("_salts")))
    salted = pieces.join(sizes, "length").withColumn("_salt", F.pmod(F.xxhash64(*identity), "_salts")).drop("_salts")
    group = Window.partitionBy("length", "_salt").orderBy(*identity)
    ranked = salted.withColumn("_rank", F.row_number().over(group) - F.lit(1).cast("long"))
    if most >= group_rows:
        sums = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
        before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        ranked = ranked.join(sums, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
        ranked = ranked.drop("_before")
    given = np.array(best_fit(by_length, capacity), np.int64).reshape(-1, 4)
    given = given[np.lexsort((given[:, 1], given[:, 0]))]
    # Rank and length in one number: no length has more ranks than there are pieces.
    width = np.int64(most + 1)
    keys = given[:, 0] * width + given[:, 1]
    columns = [c for c in ranked.columns if c not in ("_salt", "_rank")]
    schema = ranked.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = frame["_rank"].to_numpy(np.int64)
            at = np.searchsorted(keys, frame["length"].to_numpy(np.int64) * width + rank, side="right") - 1
            got = given[at]
            yield frame[columns].assign(sequence_id=got[:, 2] + rank - got[:, 1], offset=got[:, 3])

    return ranked.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Tokenize, cut and pack all documents; the pieces are stored once in between."""
    return pack(stage(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)
