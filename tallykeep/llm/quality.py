"""Document quality by a linear-chain conditional random field over lines.

Every line that isn't blank is good or bad. What is seen of a line are counts by kind of character, words, different
words and repetition, each cut into bins; the lines before and after it are seen the same way. Weights of bins and the
four transitions are fitted by the conditional likelihood of the lines of a bounded sample of labelled documents, whose lines
all have their document's label. A document's quality is the mean of its lines' marginals from forward-backward, weighted
by length, and calibrated on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.labelled import held_out, sample
from tallykeep.llm.shared import as_bytes, in_batches, stage

BINS = 12


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    for i, chars in enumerate((
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b".,;:'\"-", b"!?",
        bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:'\"-!?"), bytes(range(128, 256)),
    ), 1):
        kind[list(chars)] = i
    return kind


_KINDS = _kinds()
FEATURES = 8 + 7


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that aren't blank, (lines x FEATURES); their lengths in bytes; which text each is of."""
    lines, of = [], []
    for i, text in enumerate(texts):
        mine = [x for x in as_bytes(text).split(b"\n") if x.strip()]
        lines += mine
        of += [i] * len(mine)
    if not lines:
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(size) - size
    kinds = _KINDS[np.frombuffer(b"".join(lines), np.uint8)]
    out = np.empty((len(lines), FEATURES))
    for j in range(8):
        out[:, j] = np.add.reduceat((kinds == j + 1).astype(np.int64), starts) / size
    words = [x.split() for x in lines]
    many = np.fromiter(map(len, words), np.int64, len(words))
    different = np.fromiter((len(set(x)) for x in words), np.int64, len(words))
    of_text = np.array(of, np.int64)
    seen: dict[tuple[int, bytes], int] = {}
    for key in zip(of, lines):
        seen[key] = seen.get(key, 0) + 1
    ends = np.frombuffer(b"".join([x.rstrip()[-1:] for x in lines]), np.uint8)
    out[:, 8] = np.log1p(size)
    out[:, 9] = np.log1p(many)
    out[:, 10] = different / many
    out[:, 11] = size / many
    out[:, 12] = np.log1p([seen[key] for key in zip(of, lines)])
    out[:, 13] = np.isin(ends, list(b".!?:;\"'"))
    out[:, 14] = np.log1p(different)
    return out, size, of_text


def binned(features: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of each feature, as an index into the weights."""
    bins = np.empty(features.shape, np.int32)
    for j in range(FEATURES):
        bins[:, j] = np.searchsorted(edges[j], features[:, j], side="right") + j * BINS
    return bins


def with_neighbours(bins: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Bins of the line, the one before and the one after; a place of its own where there is none."""
    width = FEATURES * BINS
    before, after = np.full_like(bins, 3 * width), np.full_like(bins, 3 * width + 1)
    same = of[1:] == of[:-1]
    before[1:][same] = bins[:-1][same] + width
    after[:-1][same] = bins[1:][same] + 2 * width
    return np.concatenate([bins, before, after], axis=1)


WEIGHTS = 3 * FEATURES * BINS + 2


def marginals(good: np.ndarray, of: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected transitions (2 x 2) over all, from the lines' log odds and transition scores.

    Forward-backward in log odds, over all texts at once: step t handles line t of every text that has one.
    """
    if not len(of):
        return np.zeros(0), np.zeros((2, 2))
    begin = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    many = np.diff(np.concatenate((begin, [len(of)])))
    order = np.argsort(-many, kind="stable")
    begin, many = begin[order], many[order]
    left = np.searchsorted(-many, -np.arange(1, many[0] + 1), side="right")  # texts with at least t lines
    forward, backward = np.empty(len(of)), np.zeros(len(of))
    forward[begin] = good[begin]
    for t in range(1, many[0]):
        at = begin[:left[t]] + t
        x = forward[at - 1]
        forward[at] = good[at] + np.logaddexp(move[1, 1] + x, move[0, 1]) - np.logaddexp(move[1, 0] + x, move[0, 0])
    for t in range(many[0] - 2, -1, -1):
        at = begin[:left[t + 1]] + t
        x = good[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(move[1, 1] + x, move[1, 0]) - np.logaddexp(move[0, 1] + x, move[0, 0])
    p = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
    inner = np.flatnonzero(of[1:] == of[:-1])
    x, y = forward[inner], good[inner + 1] + backward[inner + 1]
    joint = np.stack([np.zeros_like(x) + move[0, 0], y + move[0, 1], x + move[1, 0], x + y + move[1, 1]])
    joint = np.exp(joint - joint.max(axis=0))
    return p, (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)


class Model:
    """Bin edges, weights, transitions and the calibration of a fitted field."""

    def __init__(self, features: np.ndarray, size: np.ndarray, of: np.ndarray, label: np.ndarray, stands: np.ndarray,
                 steps: int = 150, rate: float = 0.05, decay: float = 1e-3) -> None:
        """label and stands (how many documents one stands for) are by text, `of` numbers texts from 0."""
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = np.quantile(features, quantiles, axis=0).T if len(features) else np.zeros((FEATURES, BINS - 1))
        self.weights, self.move = np.zeros(WEIGHTS), np.zeros((2, 2))
        self.calibration = (1.0, 0.0)
        total = float(stands.sum())
        self.empty = (float((stands * label).sum()) + 0.5) / (total + 1.0)
        if not len(features) or len(set(label.tolist())) < 2:
            return
        seen = with_neighbours(binned(features, self.edges), of)
        y = label[of].astype(float)
        inner = np.flatnonzero(of[1:] == of[:-1])
        true_moves = np.zeros((2, 2))
        for v in (0, 1):
            true_moves[v, v] = (y[inner] == v).sum()
        # Adam on the mean log likelihood of a line.
        theta = np.zeros(WEIGHTS + 4)
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            p, moves = marginals(theta[:WEIGHTS][seen].sum(axis=1), of, theta[WEIGHTS:].reshape(2, 2))
            slope = np.zeros_like(theta)
            slope[:WEIGHTS] = np.bincount(seen.ravel(), np.repeat(y - p, seen.shape[1]), WEIGHTS)
            slope[WEIGHTS:] = (true_moves - moves).ravel()
            slope = slope / len(y) - decay * theta
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope ** 2
            theta += rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        self.weights, self.move = theta[:WEIGHTS], theta[WEIGHTS:].reshape(2, 2)
        raw = self.raw(features, size, of, len(label))
        there = ~np.isnan(raw)
        x = self._odds(raw[there])
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton's method for a logistic curve over the log odds
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            w = stands[there] * p * (1 - p)
            g = stands[there] * (label[there] - p)
            hessian = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
            a, b = np.array([a, b]) + np.linalg.solve(hessian, [(g * x).sum() - (a - 1), g.sum()])
        self.calibration = (float(a), float(b))

    @staticmethod
    def _odds(p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def raw(self, features: np.ndarray, size: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
        """Length-weighted mean of the marginals of each text; NaN where it has no line."""
        p = marginals(self.weights[with_neighbours(binned(features, self.edges), of)].sum(axis=1), of, self.move)[0]
        length = np.bincount(of, size, texts)
        return np.divide(np.bincount(of, size * p, texts), length, out=np.full(texts, np.nan), where=length > 0)

    def score(self, texts: list[str | None]) -> np.ndarray:
        raw = self.raw(*line_features(texts), len(texts))
        a, b = self.calibration
        p = 1 / (1 + np.exp(-np.clip(a * self._odds(raw) + b, -30, 30)))
        return np.where(np.isnan(raw), self.empty, p)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 3000) -> Model:
    """Fit on at most `per_class` documents of each label that are not held out, on the driver."""
    texts, rates = sample(docs, labels, label, per_class)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            features, size, of = line_features(list(frame.text))
            cut = np.searchsorted(of, np.arange(len(frame) + 1))
            yield pd.DataFrame({
                "doc_id": frame.doc_id, "label": frame.label,
                "features": [features[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])],
                "sizes": [size[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]})

    rows = stage(texts.mapInPandas(work, "doc_id long, label int, features binary, sizes binary"), "lines").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["sizes"]), bytes(r["features"])))
    y = np.array([r["label"] for r in rows], np.int64)
    sampled = np.bincount(y, minlength=2) if len(y) else np.zeros(2)
    stands = np.array([rates.get(int(v), 0) / sampled[v] for v in y])
    sizes = [np.frombuffer(r["sizes"], "<i4").astype(np.int64) for r in rows]
    features = np.frombuffer(b"".join([r["features"] for r in rows]), "<f4").reshape(-1, FEATURES).astype(float)
    of = np.repeat(np.arange(len(rows)), [len(s) for s in sizes])
    return Model(features, np.concatenate([*sizes, np.zeros(0, np.int64)]), of, y, stands)


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out and quality (0 to 1) of every row of `docs`.

    A null text is an empty one. Texts without a line get the smoothed rate of label 1, as all do without labels.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))  # fixed size

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            yield pd.DataFrame({
                "doc_id": frame.doc_id.astype("Int64"), "quality": shared.value.score(list(frame.text))})

    scored = docs.select("doc_id", "text").mapInPandas(work, "doc_id long, quality double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "quality")
