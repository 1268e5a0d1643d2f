"""Content digests of objects, and the registry of digests already seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallykeep.functions import row_text

# Rows per block and blocks per chunk of the digest tree: a chunk covers 2^20 rows.
BLOCK_BITS = 10
CHUNK_BITS = 20

# Length of the digests inside the tree. They are what is shuffled, so they are short.
INNER_BITS = 256

# The kinds of digest. A value starts with its kind, so that values of two kinds never match.
TREE, SUM = "tree:", "sum:"


def with_ordinals(rows: DataFrame, key: str, bucket: Column, position: str, tie: str) -> DataFrame:
    """Number the rows of every object from 0 by ``position``, then by ``tie`` (``ordinal``).

    ``tie`` is a digest of the row in hex, so rows that share a position have one order in every run.

    ``bucket`` cuts an object into pieces that follow each other in position order and each
    fit a task: the split start of a file, or ``position >> 20``. Rows are ranked inside
    their bucket and moved up by the rows of the buckets before it, so a large object is
    never sorted in one place. Rows without a position come first, in buckets by their ``tie``, of
    which there are 2^20; rows without an object name belong to none.
    """
    by_tie = F.conv(F.substring(tie, 1, 5), 16, 10).cast("bigint")
    nowhere = F.struct(F.lit(0).alias("has"), by_tie.alias("of"))
    somewhere = F.struct(F.lit(1).alias("has"), bucket.cast("bigint").alias("of"))
    placed = F.when(F.col(position).isNull() | bucket.isNull(), nowhere).otherwise(somewhere)
    rows = rows.where(F.col(key).isNotNull()).withColumn("_bucket", placed)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    in_bucket = Window.partitionBy(key, "_bucket").orderBy(position, tie)
    return (
        rows.withColumn("_rank", F.row_number().over(in_bucket))
        .join(offsets, [key, "_bucket"])
        .withColumn("ordinal", F.col("_offset") + F.col("_rank") - 1)
        .drop("_bucket", "_offset", "_rank")
    )


def _in_order(order: str, value: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.concat_ws(",", F.transform(pairs, lambda p: p[value]))


def tree_digest(rows: DataFrame, key: str, *, bits: int = 512) -> DataFrame:
    """``(key, row_count, digest)`` from ``(key, ordinal, row_digest)``.

    Digests of 1,024 rows make a block digest, 1,024 blocks a chunk digest, and the chunks
    of an object its digest, each in row order; only the last one has ``bits`` bits, the others
    ``INNER_BITS``. Rows are shuffled once, by chunk, so the work
    on one large object is spread over many tasks; the last step sees one value per 2^20 rows.
    """
    chunked = (
        rows.select(
            key, "ordinal", "row_digest",
            F.shiftright("ordinal", CHUNK_BITS).alias("_chunk"),
            F.shiftright("ordinal", BLOCK_BITS).alias("_block"),
        )
        .repartition(key, "_chunk")
    )
    blocks = chunked.groupBy(key, "_chunk", "_block").agg(
        F.count("*").alias("_n"), F.sha2(_in_order("ordinal", "row_digest"), INNER_BITS).alias("_digest")
    )
    chunks = blocks.groupBy(key, "_chunk").agg(
        F.sum("_n").alias("_n"), F.sha2(_in_order("_block", "_digest"), INNER_BITS).alias("_digest")
    )
    return chunks.groupBy(key).agg(
        F.sum("_n").alias("row_count"), F.concat(F.lit(TREE), F.sha2(_in_order("_chunk", "_digest"), bits)).alias("digest")
    )


def _row_digests(rows, key, bucket, position, columns):
    hashed = rows.select(
        key, F.col(position).alias("_position"), bucket.alias("_piece"),
        F.sha2(row_text(rows, columns), INNER_BITS).alias("row_digest"),
    )
    return with_ordinals(hashed, key, F.col("_piece"), "_position", "row_digest")


def content_digest(
    rows: DataFrame,
    key: str,
    position: str,
    bucket: Column,
    columns: Sequence[str],
    *,
    bits: int = 512,
) -> DataFrame:
    """Digest of every object's content in row order, for objects of any size."""
    return tree_digest(_row_digests(rows, key, bucket, position, columns), key, bits=bits)


SUM_COLUMNS = tuple(f"_sum_{i}" for i in range(16))


def hash_sums(text: Column, sign: Column | None = None) -> list[Column]:
    """Aggregates for ``content_text``: all 256 bits of the hashes of row texts, added up in 16 pieces.

    A piece has 16 bits, so plain integers hold the sums of any object of up to 2^47 rows, and a sum beyond
    that is an error. ``sign`` -1 takes a row off.
    """
    row_hash = F.sha2(text, 256)
    pieces = [F.conv(F.substring(row_hash, 4 * i + 1, 4), 16, 10).cast("bigint") for i in range(16)]
    return [F.sum(p if sign is None else sign * p).alias(name) for p, name in zip(pieces, SUM_COLUMNS)]


def content_sums(rows: DataFrame, columns: Sequence[str]) -> list[Column]:
    return hash_sums(row_text(rows, columns))


def content_text() -> Column:
    return F.concat(F.lit(SUM), F.sha2(F.concat_ws(":", "row_count", *SUM_COLUMNS), 256))


def unordered_digest(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, row_count, digest)`` that does not depend on row order.

    The row hashes are added up, so each task sends one row per object and nothing is sorted.
    """
    summed = rows.groupBy(key).agg(F.count("*").alias("row_count"), *content_sums(rows, columns))
    return summed.select(key, "row_count", content_text().alias("digest"))


def new_digests(arrivals: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """``(digest, first_<key>)`` of digests the registry does not have yet, each one once.

    Both sides are brought to one row per digest before they meet, so many copies of one
    content are no load on one task.
    """
    firsts = arrivals.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(key).alias(f"first_{key}"))
    return firsts.join(registry.select("digest").distinct(), "digest", "left_anti")


def flag_duplicates(arrivals: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """``arrivals`` with ``is_duplicate``, null where there is no digest.

    An object is new when its content is not registered and it is the first of its arrival
    set to bring it; all others are duplicates. So the arrivals are matched with the new
    entries by object, which is unique, and not by digest, which a third of them may share.
    """
    firsts = new_digests(arrivals, registry, key).select(
        F.col(f"first_{key}").alias(key), F.lit(True).alias("_is_first")
    )
    return arrivals.join(firsts, key, "left").select(
        *arrivals.columns,
        F.when(F.col("digest").isNotNull(), F.col("_is_first").isNull()).alias("is_duplicate"),
    )


def registry_entries(arrivals: DataFrame, registry: DataFrame, key: str, created_time: Column, created_by: str) -> DataFrame:
    """Rows to append to the checksum registry."""
    return new_digests(arrivals, registry, key).select(
        F.col(f"first_{key}").cast("string").alias("file_name"),
        F.col("digest").alias("checksum_value"),
        created_time.alias("created_time"),
        F.lit(created_by).alias("created_by"),
    )
