"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments, and an index has a row per code and segment. A round looks up, for every query that isn't
done, the values at exactly `radius` bits from each of its segments, and verifies the codes found there. After the round
with radius r on m segments every code within m (r + 1) - 1 bits has been seen; a query is done when its k-th distance is
within that. So radii grow only as far as a query needs, and the results are exact. Equal codes are one entry of the
index with its k smallest ids: more can't be among the k nearest.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.shared import stage


def sign_code(embedding: Column, bits: int, dims: int) -> Column:
    """A code of `bits` bits: bit i is 1 if the dimensions i, i + bits, i + 2 bits ... add up to more than 0."""
    one = F.lit(1).cast("long")
    total = F.lit(0).cast("long")
    for i in range(bits):
        fold = sum((F.get(embedding, j).cast("double") for j in range(i, dims, bits)), F.lit(0.0))
        total = total.bitwiseOR(F.when(fold > 0, F.shiftleft(one, bits - 1 - i)).otherwise(F.lit(0).cast("long")))
    return total


def segment_bits(bits: int, n: int) -> int:
    """Of the segment widths up to 16 that divide a code, the one nearest to log2(n): about one code for each value."""
    widths = [w for w in range(1, 17) if bits % w == 0]
    return min(widths, key=lambda w: (abs(w - math.log2(max(n, 1))), w))


def top_k(codes: DataFrame, queries: DataFrame, k: int, bits: int = 32, segment: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance): the k codes nearest to each query, by distance, then id.

    `codes` has (id, code), `queries` (query_id, code), both with codes of `bits` bits, up to 63. Rows with a null id or
    code are left out; repeated rows count once. With fewer than k codes all are returned; without codes, none.
    """
    if bits > 63 or segment and bits % segment:
        raise ValueError("bits must be at most 63 and a multiple of segment")
    codes = codes.select("id", "code").dropna().distinct()
    queries = queries.select("query_id", "code").dropna().distinct()
    first = Window.partitionBy("code").orderBy("id")
    entries = codes.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)
    entries = stage(entries.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")

    segment = segment or segment_bits(bits, entries.count())
    segments = bits // segment

    def cut(code: Column) -> Column:
        return F.explode(F.array(*[F.struct(
            F.lit(s).alias("segment"),
            F.shiftright(code, s * segment).bitwiseAND((1 << segment) - 1).alias("value")) for s in range(segments)]))

    index = stage(entries.select("code", cut(F.col("code")).alias("part")).select("code", "part.*"), "index")
    active = stage(queries.select("code").distinct(), "queries")
    best = None
    done = []
    by_distance = Window.partitionBy("query").orderBy("distance", "id")
    for radius in range(segment + 1):
        # A constant: at most 12,870 values at 16 bits.
        flips = ",".join(str(sum(1 << b for b in flipped)) for flipped in combinations(range(segment), radius))
        probes = active.select(F.col("code").alias("query"), cut(F.col("code")).alias("part")).select(
            "query", "part.*", F.explode(F.split(F.lit(flips), ",").cast("array<long>")).alias("flip")).select(
            "query", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
        near = probes.join(index, ["segment", "value"]).select(
            "query", "code", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).alias("distance"))
        found = near.distinct().join(entries, "code").select("query", "distance", F.explode("ids").alias("id"))
        if best is not None:
            found = found.union(best.select("query", "distance", "id")).distinct()
        ranked = found.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k)
        ranked = stage(ranked, "nearest")
        covered = segments * (radius + 1) - 1
        full = ranked.where((F.col("rank") == k) & (F.col("distance") <= covered)).select("query")
        done.append(ranked.join(full, "query", "left_semi"))
        best = ranked.join(full, "query", "left_anti")
        active = stage(active.join(full, active["code"] == full["query"], "left_anti"), "queries")
        if active.limit(1).count() == 0:
            break
    result = best
    for part in done:
        result = result.unionByName(part)
    return result.join(queries.withColumnRenamed("code", "query"), "query").select("query_id", "rank", "id", "distance")
