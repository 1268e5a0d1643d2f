"""License scan by diagonal voting, in DataFrame functions only.

The hash of every k words in a row of a text is joined to the places where the templates have the same k words. A
match at word p of a text and word t of a template votes for the diagonal p - t: where the whole template would start.
Votes are added up by diagonal; neighbouring diagonals of one template, as inserted or lost words make them, are merged;
a span is verified by the share of the template's words that matched words of the text cover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that must stand there whole, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Openings of common license notices, found also with a few words changed.
NOTICES = (
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     "apache-2"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _grams(found: Column, k: int) -> Column:
    """(gram, gram_words) at every word: the hash of k words in a row, fewer at the end, and the words with blanks between."""
    joined = F.transform(found, lambda w, i: F.concat_ws(" ", w, *[F.get(found, i + j) for j in range(1, k)]))
    return F.transform(joined, lambda g: F.struct(F.xxhash64(g).alias("gram"), g.alias("gram_words")))


def template_grams(spark: SparkSession, phrases, notices, k: int) -> DataFrame:
    """(gram, template, label, base, at, size, gram_words), one row per word k-gram; the templates are constants."""
    rows = [(i, text, label, i < len(phrases)) for i, (text, label) in enumerate([*phrases, *notices])]
    short = [text for _, text, _, _ in rows if len(text.split()) < k]
    if short:
        raise ValueError(f"templates need at least {k} words: {short}")
    table = F.explode(F.array(*[F.struct(
        F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"),
        F.split(F.lit(text), " ").alias("words"),
    ) for i, text, label, base in rows])).alias("t")
    all_words = spark.range(1).select(table).select("t.*")
    grams = all_words.select(
        "template", "label", "base", F.size("words").alias("size"),
        F.posexplode(F.slice(_grams(F.col("words"), k), F.lit(1), F.size("words") - (k - 1))).alias("at", "g"))
    return grams.select("template", "label", "base", "size", "at", "g.*")


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = 2, slack: int = 2, share: float = 0.9) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, spans.

    spans holds (label, base, start, share): for a phrase every place where all its words stand in a row, for a notice
    every group of diagonals at most `slack` apart that covers at least `share` of its words. A null text is empty.
    Rows that repeat a doc_id are documents of their own; null doc_ids are kept. Other columns are left out.
    """
    spark = docs.sparkSession
    # A row of its own for each document rides along, so that documents without a match need no second reading.
    itself = spark.range(1).select(
        F.lit(0).cast("long").alias("gram"), F.lit(-1).alias("template"), F.lit("").alias("label"),
        F.lit(False).alias("base"), F.lit(0).alias("at"), F.lit(1).alias("size"), F.lit("").alias("gram_words"))
    grams = template_grams(spark, phrases, notices, k).unionByName(itself)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    first = F.array(F.struct(F.lit(0).cast("long").alias("gram"), F.lit("").alias("gram_words")))
    # A place has its own k words only, so that the rows of a text grow with its length, not with its square.
    texts = texts.select("doc_id", "text_hash", F.size("words").alias("n_words"), "words")
    places = texts.select(
        "doc_id", "text_hash", "n_words", F.posexplode(F.concat(first, _grams(F.col("words"), k))).alias("place", "g"))
    places = places.select("doc_id", "text_hash", "n_words", "place", "g.gram", F.col("g.gram_words").alias("found"))
    # The templates are constants of this module or arguments, not data.
    hits = places.join(F.broadcast(grams), "gram").where(
        "(place = 0) = (template = -1) AND found = gram_words")
    hits = hits.select(
        "doc_id", "text_hash", "template", "label", "base", "size", "at",
        F.when(F.col("place") == 0, F.col("n_words")).alias("n_words"),
        (F.col("place") - 1 - F.col("at")).alias("diagonal"))
    key = ["doc_id", "text_hash"]
    votes = hits.repartition(*key).groupBy(*key, "template", "label", "base", "size", "diagonal").agg(
        F.collect_set("at").alias("at"), F.max("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("rows"))
    by_template = Window.partitionBy(*key, "template").orderBy("diagonal")
    new = F.col("base") | (F.col("diagonal") - F.lag("diagonal", 1, -10**9).over(by_template) > slack)
    runs = votes.withColumn("run", F.sum(new.cast("int")).over(by_template))
    merged = runs.groupBy(*key, "template", "label", "base", "size", "run").agg(
        F.flatten(F.collect_list("at")).alias("at"), F.min("diagonal").alias("start"),
        F.max("n_words").alias("n_words"), F.max("rows").alias("rows"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (k - 1))))))
    spans = merged.withColumn("share", covered / F.col("size"))
    verified = F.when(
        (F.col("template") >= 0) & (F.col("share") >= F.when(F.col("base"), 1.0).otherwise(share)),
        F.struct("label", "base", F.greatest("start", F.lit(0)).cast("long").alias("start"), "share"))
    found = spans.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_list(verified)).alias("spans"),
        F.max(F.when(F.col("template") == -1, F.col("rows"))).cast("int").alias("rows"))
    return found.select("doc_id", "n_words", "spans", F.explode(F.sequence(F.lit(1), "rows")).alias("_row")).drop("_row")
