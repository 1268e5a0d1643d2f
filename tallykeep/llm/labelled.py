"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts (doc_id, text, label) of at most `per_class` learnable documents of each label, and how many there are.

    The smallest hashes of doc_id are taken. A doc_id labelled twice has the smaller label, null labels are left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min(label).alias("label"))
    many = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    some = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    # At most 2 x per_class ids.
    chosen = F.broadcast(some[0].union(some[1]))
    return docs.select("doc_id", "text").join(chosen, "doc_id"), many
