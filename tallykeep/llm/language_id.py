"""Language of texts by a convolutional network over bytes, trained here with numpy.

The UTF-8 bytes of a text are cut into windows of `WINDOW` bytes, all of them, which is what makes batches of one shape;
each window also sees the first bytes of the next, so nothing is cut apart. Filters of two, three and four bytes run over
a window, the largest value of each filter is what is known of it, and a softmax layer turns these into a probability for
each language. A text's score for a language is the mean of its windows' log probabilities, weighted by their bytes.

A filter is a table of weights by byte and place, so a filter's value is a sum of table rows. Bytes that tell nothing of a
language (digits, control characters, marks) share a row, upper-case letters have those of lower-case ones. That leaves few
enough pairs of bytes to keep the sums of two neighbouring rows as tables of their own, and every value takes two lookups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.shared import as_bytes, in_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
FILTERS = 16
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"
_AT_ONCE = 64  # windows
#: A window holds no more than this against a language.
LEAST = -8.0


def _rows() -> tuple[bytes, int]:
    """The table row of every byte, and the number of rows: white space, digits, other ASCII, letters, then all bytes from 128."""
    row = bytes(
        0 if b in b" \t\n\r\x0b\x0c" else 1 if 48 <= b <= 57 else 3 + (b | 32) - 97 if 97 <= (b | 32) <= 122 and b < 128
        else 2 if b < 128 else 29 + b - 128 for b in range(256))
    return row, max(row) + 1


_ROW, ROWS = _rows()


def no_letter(text: str | None) -> bool:
    return text is None or LETTER.search(text) is None


def windows(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of all windows, one after the other; the text of each window; its bytes.

    A text is filled up with white space, at least `REACH` bytes of it, so the last places of its last window hold nothing else.
    """
    parts, of, sizes = [], [], []
    for i, text in enumerate(texts):
        data = as_bytes(text).translate(_ROW)
        many = -(-(len(data) + REACH) // WINDOW)
        parts.append(data.ljust(many * WINDOW, b"\0"))
        of += [i] * many
        sizes += [WINDOW] * (many - 1) + [max(0, len(data) - (many - 1) * WINDOW)]
    return np.frombuffer(b"".join(parts), np.uint8), np.array(of, np.int64), np.array(sizes, np.int64)


class Network:
    """Filters (by width: place x row x filter), the softmax layer, and the languages it tells apart."""

    def __init__(self, languages: Sequence[str], seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        self.languages = list(languages)
        self.filters = {w: random.normal(0, 0.3, (w, ROWS, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.layer = random.normal(0, 0.1, (FILTERS * len(WIDTHS), len(self.languages))).astype(np.float32)
        self.offset = np.zeros(len(self.languages), np.float32)
        self.tables: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}  # made again where they are used

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """By the pair of rows at a place: all three widths' sums of the first two places, and of the places after them."""
        if self.tables is None:
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
            two, three, four = (self.filters[w] for w in WIDTHS)
            head = np.concatenate([pair(x[0], x[1]) for x in (two, three, four)], axis=1)
            tail = np.concatenate([pair(three[2], np.zeros_like(three[2])), pair(four[2], four[3])], axis=1)
            self.tables = np.ascontiguousarray(head), np.ascontiguousarray(tail)
        return self.tables

    def _values(self, pairs: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Values of all filters, (windows x WINDOW x filters), from the pairs of rows at all places and `REACH` - 1 more.

        In the `last` windows of texts, the last places would see the next text; they hold white space and are left out.
        """
        head, tail = self._tables()
        values = head[pairs[:1 - REACH]]
        values[:, FILTERS:] += tail[pairs[REACH - 1:]]
        values = values.reshape(-1, WINDOW, values.shape[1])
        values[last, -REACH:] = -np.inf
        return values

    def pooled(self, rows: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The largest value of each filter in each window, (windows x filters)."""
        padded = np.concatenate([rows, np.zeros(REACH, np.uint8)]).astype(np.int32)
        pairs = padded[:-1] * ROWS + padded[1:]
        out = np.empty((len(last), FILTERS * len(WIDTHS)), np.float32)
        for at in range(0, len(out), _AT_ONCE):
            a, b = at * WINDOW, min(len(out), at + _AT_ONCE) * WINDOW
            out[at:at + _AT_ONCE] = self._values(pairs[a:b + REACH - 1], last[at:at + _AT_ONCE]).max(axis=1)
        return out

    def log_probabilities(self, pooled: np.ndarray) -> np.ndarray:
        x = np.maximum(pooled + self.bias, 0).astype(np.float64) @ self.layer + self.offset
        x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of every text and its probability; `und` and 0 for texts without a letter."""
        none = np.array([no_letter(t) for t in texts], bool)
        if not len(none) or not self.languages:
            return [UNDETERMINED] * len(none), np.zeros(len(none))
        rows, of, sizes = windows(texts)
        last = np.concatenate((of[1:] != of[:-1], [True]))
        each = np.maximum(self.log_probabilities(self.pooled(rows, last)), LEAST)
        many = np.maximum(np.bincount(of, sizes, len(none)), 1)
        mean = np.stack([np.bincount(of, each[:, j] * sizes, len(none)) / many for j in range(each.shape[1])], axis=1)
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return ([UNDETERMINED if n else self.languages[b] for n, b in zip(none, best)],
                np.where(none, 0.0, p[np.arange(len(p)), best]))

    def fit(self, rows: np.ndarray, language: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 12) -> None:
        """Adam on the cross entropy of windows (windows x WINDOW) of one language each, half of them cut short at random.

        The slope of a largest value goes to the rows of the place where it was found.
        """
        random = np.random.default_rng(seed)
        weights = [*(self.filters[w] for w in WIDTHS), self.bias, self.layer, self.offset]
        mean, square = ([np.zeros_like(w) for w in weights] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for at in range(0, len(order), batch):
                chosen = order[at:at + batch]
                x = rows[chosen].copy()
                length = np.where(random.random(len(x)) < 0.5, WINDOW, random.integers(8, WINDOW, len(x)))
                x[np.arange(WINDOW)[None, :] >= np.minimum(length, WINDOW - REACH)[:, None]] = 0
                step += 1
                for w, slope, m, s in zip(weights, self._slopes(x, language[chosen]), mean, square):
                    m *= 0.9
                    m += 0.1 * slope
                    s *= 0.999
                    s += 0.001 * slope ** 2
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
                self.tables = None

    def _slopes(self, x: np.ndarray, language: np.ndarray) -> list[np.ndarray]:
        padded = np.concatenate([x.ravel(), np.zeros(REACH, np.uint8)]).astype(np.int32)
        values = self._values(padded[:-1] * ROWS + padded[1:], np.ones(len(x), bool))
        place = values.argmax(axis=1)
        pooled = np.take_along_axis(values, place[:, None, :], axis=1)[:, 0]
        wrong = np.exp(self.log_probabilities(pooled))
        wrong[np.arange(len(x)), language] -= 1
        wrong = (wrong / len(x)).astype(np.float32)
        seen = np.maximum(pooled + self.bias, 0)
        back = (wrong @ self.layer.T) * (seen > 0)
        slopes = []
        for i, w in enumerate(WIDTHS):
            mine = slice(i * FILTERS, (i + 1) * FILTERS)
            slope = np.zeros_like(self.filters[w])
            for j in range(w):
                at = padded[(np.arange(len(x)) * WINDOW)[:, None] + place[:, mine] + j]
                np.add.at(slope[j], (at, np.arange(FILTERS)[None, :]), back[:, mine])
            slopes.append(slope)
        return [*slopes, back.sum(axis=0), seen.T @ wrong, wrong.sum(axis=0)]


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that is never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(docs: DataFrame, per_language: int = 400, cuts: int = 4, languages: int = 256, epochs: int = 8) -> Network:
    """Fit on the driver, on at most `cuts` windows of each of at most `per_language` documents of each language.

    Texts that aren't held out and have a language and a letter are learned from; those with the smallest hashes of doc_id
    are taken, of an id with several texts or languages one. Beyond `languages` languages, the most frequent are learned.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    many = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in many)
    network = Network(names)
    if not names:
        return network
    ids = known.select("doc_id", "lang").where(F.col("lang").isin(names)).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = ids.withColumn("_rank", rank).where(F.col("_rank") <= per_language).select("doc_id", "lang")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            out = []
            for text in frame.text:
                data = windows([text])[0].reshape(-1, WINDOW)
                at = np.unique(np.linspace(0, max(0, len(data) - 2), cuts).astype(np.int64))
                out.append(b"" if no_letter(text) else data[at].tobytes())
            yield pd.DataFrame({"doc_id": frame.doc_id, "lang": frame.lang, "windows": out})

    # At most per_language x languages ids.
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang"]).mapInPandas(cut, "doc_id long, lang string, windows binary")
    rows = texts.groupBy("doc_id", "lang").agg(F.max("windows").alias("windows")).orderBy("lang", "doc_id").collect()
    number = {name: i for i, name in enumerate(names)}
    seen = np.frombuffer(b"".join([bytes(r["windows"]) for r in rows]), np.uint8).reshape(-1, WINDOW)
    language = np.repeat([number[r["lang"]] for r in rows], [len(r["windows"]) // WINDOW for r in rows]).astype(np.int64)
    if len(seen):
        network.fit(seen, language, epochs)
    return network


def identify(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row of `docs`, over its whole text.

    Null texts and texts without a letter are `und` with score 0, as are all where there is nothing to learn from. Repeated
    rows each count; columns but doc_id, text and lang are left out, and lang is only learned from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network or train(docs))  # fixed size for each language

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            names, score = shared.value.predict(list(frame.text))
            yield pd.DataFrame({"doc_id": frame.doc_id.astype("Int64"), "lang_pred": names, "score": score})

    found = docs.select("doc_id", "text").mapInPandas(work, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
