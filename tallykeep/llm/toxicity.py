"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are lower-case words. Those that a bounded sample of labelled documents shows to go with the label make up the
vocabulary; their document frequencies are counted over all documents. All other words of a document are one more term,
so that a text with one such word among thousands isn't near one with ten among a hundred. The examples are the sample's documents as unit
TF-IDF vectors. The index keeps for every term its examples and weights in blocks of examples, and the largest weight
in each block. A document's blocks are visited from the largest bound on, until no bound beats the k-th best
similarity, so the k nearest are exact. Their votes, weighted by distance, are smoothed towards the rate of the label;
how much is fitted by leaving one example out. The nearest examples come with the score as evidence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.labelled import held_out, sample
from tallykeep.llm.shared import give_back, stage, words_of

_EPSILON = 0.05
#: The term that stands for all words outside the vocabulary, in every document that has one inside, and its weight.
REST, REST_WEIGHT = b"", 1.0


def counted(words: list[bytes], vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each term occurs; empty without a word of the vocabulary."""
    counts = {t: words.count(t) for t in vocabulary.intersection(words)}
    if counts:
        counts[REST] = len(words) - sum(counts.values())
    return {t: n for t, n in counts.items() if n}


class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks of `block` examples."""

    def __init__(self, vectors: list[dict[bytes, float]], block: int = 64) -> None:
        self.block, self.n = block, len(vectors)
        self.blocks = -(-self.n // block)
        by_term: dict[bytes, list[tuple[int, float]]] = {}
        for i, vector in enumerate(vectors):
            for term, weight in vector.items():
                by_term.setdefault(term, []).append((i, weight))
        self.postings = {}
        for term, entries in by_term.items():
            at = np.array([i for i, _ in entries])
            weight = np.array([w for _, w in entries])
            first = np.searchsorted(at // block, np.arange(self.blocks + 1))
            most = np.zeros(self.blocks)
            np.maximum.at(most, at // block, weight)
            self.postings[term] = (at, weight, first, most)

    def nearest(self, vector: dict[bytes, float], k: int, without: int = -1) -> list[tuple[int, float]]:
        """The k examples with the largest positive cosine: (example, cosine), ties by number."""
        terms = [(weight, self.postings[t]) for t, weight in vector.items() if t in self.postings]
        if not terms:
            return []
        bound = sum(weight * most for weight, (_, _, _, most) in terms)
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            # Sums in another order differ in the last digits, and equals with a smaller number still count.
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-9:
                break
            sums = np.zeros(self.block)
            for weight, (at, w, first, _) in terms:
                part = slice(first[b], first[b + 1])
                sums[at[part] - b * self.block] += weight * w[part]
            here = np.flatnonzero(sums > 0)
            best += [(-float(sums[i]), int(i + b * self.block)) for i in here if i + b * self.block != without]
            best = sorted(best)[:k]
        return [(i, -s) for s, i in best]


class Model:
    """Vocabulary with weights, examples and what the votes are smoothed with."""

    def __init__(
        self, idf: dict[bytes, float], ids: list[int], labels: list[int], counts: list[dict[bytes, int]],
        rates: dict[int, int], k: int,
    ) -> None:
        self.idf, self.vocabulary, self.k = idf | {REST: REST_WEIGHT}, frozenset(idf), k
        # A class is sampled down, so an example stands for as many documents as its class has for each of its examples.
        sampled = np.bincount(labels, minlength=2)
        stands = [rates.get(v, 0) / sampled[v] if sampled[v] else 0.0 for v in (0, 1)]
        vectors = [self.vector(c) for c in counts]
        empty = [y for y, v in zip(labels, vectors) if not v]
        toxic, clean = (sum(stands[y] for y in empty if y == v) for v in (1, 0))
        self.without = (toxic + 0.5) / (toxic + clean + 1.0)
        total = sum(rates.values())
        self.prior = (rates.get(1, 0) + 0.5) / (total + 1.0)
        # Examples of one term stand together, by the weight of all other words: blocks are alike, their bounds tight.
        main = [max(((w, t) for t, w in v.items() if t != REST), default=(0.0, REST))[1] for v in vectors]
        full = [i for i, v in enumerate(vectors) if v]
        full.sort(key=lambda i: (main[i], vectors[i].get(REST, 0.0), ids[i]))
        self.ids = [ids[i] for i in full]
        self.labels = np.array([labels[i] for i in full], np.int64)
        self.stands = np.array([stands[labels[i]] for i in full])
        self.index = BlockMaxIndex([vectors[i] for i in full])
        # At most 2,000 examples, evenly chosen, are left out one by one.
        tried = list(range(0, len(full), -(-len(full) // 2000) or 1))
        near = [self.index.nearest(vectors[full[at]], k, without=at) for at in tried]
        pulls = (0.01, 0.03, 0.1, 0.3, 1.0, 3.0, 10.0)
        self.pull = min(pulls, key=lambda pull: self._loss(tried, near, pull))

    def _loss(self, tried: list[int], near: list[list[tuple[int, float]]], pull: float) -> float:
        p = np.array([self.vote(found, pull) for found in near])
        right = np.where(self.labels[tried] == 1, p, 1 - p)
        return -float(np.sum(self.stands[tried] * np.log(right))) if tried else 0.0

    def vector(self, counts: dict[bytes, int]) -> dict[bytes, float]:
        raw = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items()) if t in self.idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()} if norm else {}

    def vote(self, found: list[tuple[int, float]], pull: float) -> float:
        for_it, all_of_it = pull * self.prior, pull
        for i, cosine in found:
            weight = self.stands[i] / (1 - min(cosine, 1.0) + _EPSILON)
            all_of_it += weight
            for_it += weight * self.labels[i]
        return min(max(for_it / all_of_it, 1e-6), 1 - 1e-6)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float]]]:
        counts = counted(words_of(text), self.vocabulary)
        found = self.index.nearest(self.vector(counts), self.k) if counts else []
        if not found:
            return self.without, []
        return self.vote(found, self.pull), [(self.ids[i], round(c, 6)) for i, c in found]


def _terms(docs: DataFrame) -> DataFrame:
    """(doc_id, label, term) of every different word of the sample's documents."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, label, text in zip(frame.doc_id, frame.label, frame.text):
                yield pd.DataFrame({"doc_id": doc_id, "label": label, "term": list(set(words_of(text)))})

    return docs.mapInPandas(work, "doc_id long, label int, term binary")


def _frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """How many documents there are, and how many have each term."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, found = 0, dict.fromkeys(vocabulary, 0)
        for frame in frames:
            n += len(frame)
            for text in frame.text:
                for term in vocabulary.intersection(words_of(text)):
                    found[term] += 1
        yield pd.DataFrame({"term": [None, *found], "n": [n, *found.values()]})

    rows = docs.select("text").mapInPandas(work, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {None if r["term"] is None else bytes(r["term"]): r["n"] for r in rows.collect()}
    return counts.pop(None, 0), counts


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 20_000, terms: int = 4000,
    least: int = 4, share: float = 0.002, odds: float = 20.0, k: int = 15,
) -> Model:
    """Learn from at most `per_class` documents of each label that are not held out.

    The vocabulary has the at most `terms` words in at least `least` documents and the given share of label 1 that are
    `odds` times as frequent there as among label 0. Without labels there is none, and every document scores the smoothed rate, one half.
    """
    texts, rates = sample(docs, labels, label, per_class)
    texts = stage(texts, "examples")
    sampled = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    one, zero = max(sampled.get(1, 0), 1), max(sampled.get(0, 0), 1)
    by_term = _terms(texts).groupBy("term").agg(
        F.sum(F.col("label").cast("long")).alias("with"), F.sum((1 - F.col("label")).cast("long")).alias("without"))
    ratio = (F.col("with") / one) / ((F.col("without") + 0.5) / zero)
    chosen = by_term.where((F.col("with") >= max(least, share * one)) & (ratio >= odds)).orderBy(F.desc("with"), "term").limit(terms)
    vocabulary = frozenset(bytes(r["term"]) for r in chosen.select("term").collect())
    n, frequency = _frequencies(docs, vocabulary)
    idf = {t: math.log((n + 1) / (frequency.get(t, 0) + 1)) + 1 for t in sorted(vocabulary)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, y, text in zip(frame.doc_id, frame.label, frame.text):
                counts = counted(words_of(text), vocabulary)
                rows.append((doc_id, y, list(counts), list(counts.values())))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "terms", "counts"])

    rows = texts.mapInPandas(count, "doc_id long, label int, terms array<binary>, counts array<long>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], [bytes(t) for t in r["terms"]]))
    counts = [dict(zip(map(bytes, r["terms"]), r["counts"])) for r in rows]
    model = Model(idf, [r["doc_id"] for r in rows], [r["label"] for r in rows], counts, rates, k)
    del rows, counts
    give_back()  # what the driver needed to train
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with toxicity (0 to 1) and evidence (doc_id and cosine of the nearest examples).

    A null text is an empty one; texts without a term of the vocabulary get the rate of such examples.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by per_class and terms
    columns = docs.columns
    evidence = "array<struct<doc_id: long, cosine: double>>"
    schema = docs.selectExpr("*", "0D AS toxicity", f"CAST(NULL AS {evidence}) AS evidence").schema

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            scored = [shared.value.score(text) for text in frame["text"]]
            yield frame[columns].assign(toxicity=[s for s, _ in scored], evidence=[e for _, e in scored])

    return docs.mapInPandas(work, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, toxicity and evidence of every row of `docs`."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity", "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose toxicity is below the threshold."""
    scored = score(docs.withColumnRenamed("toxicity", "_toxicity").withColumnRenamed("evidence", "_evidence"),
                   train(docs, labels))
    kept = scored.where(F.col("toxicity") < threshold).drop("toxicity", "evidence")
    return kept.withColumnRenamed("_toxicity", "toxicity").withColumnRenamed("_evidence", "evidence")
