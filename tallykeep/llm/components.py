"""Connected components by alternating stars, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.shared import release, stage


#: Tables of so many rows at most, a few MB, are sent to all tasks instead of being met in a shuffle.
FEW = 1 << 17


def of_few(table: DataFrame, rows: int) -> DataFrame:
    """`table`, which has so many rows, marked for broadcast if they are few."""
    return F.broadcast(table) if rows <= FEW else table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, from links (a, b) of long ids; root is the smallest id of the component.

    Each round links all larger neighbours of a node to its smallest one, then all smaller ones, until only stars are
    left: about as many rounds as the logarithm of the longest path. The links of a round are a stored table, and so are the
    ends of them, which show whether all are stars. Null ends and links of a node to itself are left out; repeated links
    count once. A hub's links are many rows of one key in a join, which adaptive execution can split, and smallest neighbours
    are found by partial aggregates; those of few nodes are broadcast, so that a round is three small shuffles.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        ends = stage(both.groupBy("a").agg(
            F.min("b").alias("least"), F.max("b").alias("most"), F.max(F.when(F.col("b") < F.col("a"), F.col("b"))).alias("below")), "ends")
        # A root is below all its neighbours, a leaf has one, below it.
        tangled = F.max(F.col("below").isNotNull() & (F.col("least") < F.col("most")))
        now = ends.agg(F.count("*").alias("n"), tangled.alias("tangled")).first()
        least = ends.select("a", F.least("a", "least").alias("least"))
        if not now["tangled"]:
            release(edges)
            return least.select(F.col("a").alias("node"), F.col("least").alias("root"))
        large = both.where("b > a").join(of_few(least, now["n"]), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(of_few(below, now["n"]), "a")
        small = small.select("a", F.col("least").alias("b")).union(
            small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")))
        last, edges = edges, stage(small.distinct(), "links")
        release(last, ends)
