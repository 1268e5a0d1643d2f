"""Which rows differ between two stores, found by sums over ranges of their key hashes.

Both stores are first added up in a fixed number of ranges of the key hash; only ranges whose sums differ are added up again in
finer ranges, and only rows of the finer ranges that differ are brought together by key. Two equal stores exchange
nothing but sums, and what is moved grows with the differences, not with the stores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallykeep.functions import row_text

MISSING, EXTRA, CHANGED = "Missing", "Extra", "Changed"

# Bits of the key hash that tell ranges apart in the two rounds.
ROUND_BITS = (12, 28)

_SUMS = [f"_s{i}" for i in range(8)]


def _hashed(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys, the hash of their text, and the row's hash in 8 whole numbers of 32 bits, whose sums are exact."""
    digest = F.sha2(row_text(rows, columns), 256)
    pieces = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(n) for i, n in enumerate(_SUMS)]
    return rows.select(*keys, F.xxhash64(row_text(rows, keys)).alias("_h"), *pieces)


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - bits)


def _summed(rows: DataFrame, bits: int) -> DataFrame:
    return rows.groupBy(_range(bits).alias("_range")).agg(F.count("*").alias("_n"), *[F.sum(s).alias(s) for s in _SUMS])


def _apart(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys whose counts or sums are not the same on both sides, with both counts."""
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("_n", *_SUMS)]
    match = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in on]
    equal = same[0]
    for s in same[1:]:
        equal = equal & s
    return a.join(b, match, "full").where(~equal).select(
        *[F.when(F.col("a._n").isNull(), F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in on],
        F.coalesce("a._n", F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce("b._n", F.lit(0)).cast("bigint").alias("target_rows"))


def differing_ranges(source: DataFrame, target: DataFrame, bits: int) -> DataFrame:
    """``(_range, source_rows, target_rows)`` of the ranges in which two hashed stores differ."""
    return _apart(_summed(source, bits), _summed(target, bits), ["_range"])


def differing_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, *,
    round_bits: tuple[int, int] = ROUND_BITS,
) -> DataFrame:
    """``(*keys, source_rows, target_rows, difference)`` of the keys whose rows are not the same in both stores.

    ``columns`` are compared, all of the source's but the keys by default; rows in any order, repeated ones as often
    as they occur. A key may be null. Keys only the source has are ``Missing``, those only the target has ``Extra``, the
    others ``Changed``. Rows are held against each other by sums of 256 bits of their hashes.
    """
    columns = [c for c in source.columns if c not in keys] if columns is None else list(columns)
    sides = [_hashed(s, keys, [*keys, *columns]) for s in (source, target)]
    for bits in round_bits:
        # The ranges of the first round are 2^12 at most; those of the second as many as there are differences.
        wanted = differing_ranges(*sides, bits).select("_range")
        sides = [s.withColumn("_range", _range(bits)).join(wanted, "_range", "left_semi").drop("_range") for s in sides]
    by_key = [s.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.sum(c).alias(c) for c in _SUMS]) for s in sides]
    kind = F.when(F.col("target_rows") == 0, MISSING).when(F.col("source_rows") == 0, EXTRA).otherwise(CHANGED)
    return _apart(*by_key, keys).withColumn("difference", kind)
