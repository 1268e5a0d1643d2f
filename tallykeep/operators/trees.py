"""Stored digest trees: the digests of an object's chunks are kept, so that a change is found and growth is cheap.

A chunk is a fixed number of rows in row order. Its digest, how many rows it has and the position of its last row are what is
kept of it. The digest of the object follows from those of its chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallykeep.functions import row_text
from tallykeep.operators.digests import INNER_BITS, TREE, with_ordinals

CHUNK_BITS = 20


def chunk_digests(
    rows: DataFrame, key: str, position: str, bucket: Column, columns: Sequence[str], *,
    chunk_bits: int = CHUNK_BITS, stored: DataFrame | None = None,
) -> DataFrame:
    """``(key, chunk, chunk_rows, last_position, digest)`` of the chunks of every object.

    Rows are in the order of ``position``, equal positions in that of their content. ``bucket`` cuts objects into pieces
    that follow each other and fit a task, as for ``content_digest``. Rows without a key or position are in no chunk.

    With the ``stored`` chunks of objects that only grow at their end, rows up to the last full stored chunk are neither
    hashed nor moved: those chunks are taken over, and the rows after them begin the next one.
    """
    columns = list(columns)
    rows = rows.where(F.col(key).isNotNull() & F.col(position).isNotNull())
    full = None
    if stored is not None:
        full = stored.where(F.col("chunk_rows") == 1 << chunk_bits)
        last = full.groupBy(key).agg(F.max("last_position").alias("_done"), F.max("chunk").alias("_last"))
        rows = rows.join(last, key, "left").where(F.col("_done").isNull() | (F.col(position) > F.col("_done")))
    else:
        rows = rows.withColumn("_last", F.lit(None).cast("bigint"))
    hashed = rows.select(
        key, "_last", F.col(position).alias("_position"), bucket.alias("_piece"),
        F.sha2(row_text(rows, columns), INNER_BITS).alias("row_digest"))
    ordered = with_ordinals(hashed, key, F.col("_piece"), "_position", "row_digest")
    chunk = F.shiftright("ordinal", chunk_bits) + F.coalesce(F.col("_last") + 1, F.lit(0))
    in_order = F.array_sort(F.collect_list(F.struct("ordinal", "row_digest")))
    text = F.concat_ws(",", F.transform(in_order, lambda x: x["row_digest"]))
    chunks = ordered.withColumn("chunk", chunk).groupBy(key, "chunk").agg(
        F.count("*").alias("chunk_rows"), F.max("_position").alias("last_position"), F.sha2(text, INNER_BITS).alias("digest"))
    return chunks if full is None else full.select(chunks.columns).unionByName(chunks)


def digest_of_chunks(chunks: DataFrame, key: str) -> DataFrame:
    """``(key, row_count, digest)`` of the objects whose chunks these are."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "digest"))), lambda c: c["digest"])
    return chunks.groupBy(key).agg(
        F.sum("chunk_rows").alias("row_count"), F.concat(F.lit(TREE), F.sha2(F.concat_ws(",", listed), 256)).alias("digest"))


def first_differences(stored: DataFrame, chunks: DataFrame, key: str, *, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``(key, stored_rows, row_count, first_chunk, equal_rows, state)`` of every object of either side.

    ``first_chunk`` is the first chunk that is not the same in both, null if all are; ``equal_rows`` are those of the
    chunks before it. ``state`` is ``Same``, ``Grown`` (all full stored chunks are still there and rows were added),
    ``Changed``, ``New`` or ``Gone``.
    """
    a, b = stored.alias("a"), chunks.alias("b")
    both = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.chunk") == F.col("b.chunk")), "full")
    same = F.coalesce(F.col("a.digest") == F.col("b.digest"), F.lit(False))
    there = F.coalesce(F.col("a.chunk"), F.col("b.chunk"))
    was_full = F.col("a.chunk_rows") == 1 << chunk_bits
    found = both.groupBy(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key)).agg(
        F.sum("a.chunk_rows").alias("stored_rows"), F.sum("b.chunk_rows").alias("row_count"),
        F.min(F.when(~same, there)).alias("first_chunk"),
        F.max(F.when(was_full & ~same, 1).otherwise(0)).alias("_broken"))
    zero = F.lit(0).cast("bigint")
    size = F.least(F.coalesce("stored_rows", zero), F.coalesce("row_count", zero))
    equal = F.when(F.col("first_chunk").isNull(), size).otherwise(F.least(size, F.shiftleft("first_chunk", chunk_bits)))
    grown = (F.col("_broken") == 0) & (F.col("row_count") > F.col("stored_rows"))
    state = (F.when(F.col("stored_rows").isNull(), "New").when(F.col("row_count").isNull(), "Gone")
             .when(F.col("first_chunk").isNull(), "Same").when(grown, "Grown").otherwise("Changed"))
    return found.select(
        key, F.coalesce("stored_rows", zero).alias("stored_rows"), F.coalesce("row_count", zero).alias("row_count"),
        F.col("first_chunk").cast("bigint").alias("first_chunk"), equal.cast("bigint").alias("equal_rows"), state.alias("state"))
