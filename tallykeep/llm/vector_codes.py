"""Vector compression by product codes whose nearest entries are found with geometric near-neighbour access trees.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook, and a part's code is the
index of its nearest entry. The entries of a codebook stand in a tree: a node has some split points, every other entry
belongs to the nearest of them, and for each split point and each child the node keeps the least and the greatest
distance from that split point to the entries of the child. The distance of a query part to a split point then rules out
all children whose range lies wholly outside of that distance give or take the best one so far.

Distances in the ranges are square roots, rounded away from what could rule out too much, and a child goes only if it is
strictly farther than the best. All comparisons of entries are of whole squared distances, ties to the lower index, so
the codes are those of a comparison with every entry.

A round of fitting is one pass over the vectors: tasks add up their parts by entry, Spark adds up the tasks' sums, and
at most parts x entries rows reach the driver, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.shared import in_batches, stage

#: Components up to this size, and their squared distances, are 64-bit numbers; larger ones are Python's.
SMALL = 1 << 24
#: Sums leave tasks as two decimals: multiples of this, and the rest.
LIMB = 1 << 62
#: More than the error of a square root and of the additions that follow it.
SLACK = 2.0 ** -40
SPLITS = 6
#: Components that are searched for at once.
BATCH = 1 << 20


def whole(vectors: list, scale: int) -> np.ndarray:
    """floor(scale x) of every component, as 64-bit numbers where all are small enough."""
    x = np.array(vectors, np.float64)
    if not x.size or np.abs(x).max() * scale < SMALL:
        return np.floor(x * scale).astype(np.int64)
    # A float is a whole number over a power of two, so this floor is exact at any size.
    ratio = [[v.as_integer_ratio() for v in row] for row in x.tolist()]
    out = np.empty(x.shape, object)
    out[:] = [[n * scale // d for n, d in row] for row in ratio]
    return out


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = x - entry
    return (gap * gap).sum(axis=1)


def _roots(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Tree:
    """The entries of one codebook: `splits` of them with the distance ranges of their children, or a leaf."""

    def __init__(self, book: np.ndarray, rows: np.ndarray | None = None, splits: int = SPLITS) -> None:
        self.book = book
        rows = np.arange(len(book)) if rows is None else rows
        self.leaf = len(rows) <= splits
        self.rows = rows if self.leaf else self._far_apart(rows, splits)
        if self.leaf:
            return
        apart = np.stack([squared(book[rows], book[s]) for s in self.rows])
        nearest = np.argmin(apart, axis=0)
        at = {int(r): i for i, r in enumerate(self.rows)}
        nearest = np.array([at.get(int(r), n) for r, n in zip(rows, nearest)])  # a split point stands in its own child
        root = np.stack([_roots(a) for a in apart])
        self.low, self.high = (np.stack([f(root[:, nearest == j], axis=1) for j in range(splits)], axis=1)
                               for f in (np.min, np.max))
        self.low, self.high = self.low * (1 - SLACK), self.high * (1 + SLACK)
        below = [rows[(nearest == j) & ~np.isin(rows, self.rows)] for j in range(splits)]
        self.children = [Tree(book, b, splits) if len(b) else None for b in below]

    def _far_apart(self, rows: np.ndarray, splits: int) -> np.ndarray:
        """The first entry, then again and again the one that is farthest from those chosen."""
        chosen = [int(rows[0])]
        least = squared(self.book[rows], self.book[rows[0]])
        free = np.ones(len(rows), bool)
        free[0] = False
        while len(chosen) < splits:
            there = np.flatnonzero(free)
            i = there[int(np.argmax(least[there]))]
            free[i] = False
            chosen.append(int(rows[i]))
            least = np.minimum(least, squared(self.book[rows], self.book[rows[i]]))
        return np.array(chosen)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance, of each row of `x`."""
        best = np.zeros(len(x), np.int64)
        error = squared(x, self.book[0])
        self._visit(x, np.arange(len(x)), best, error)
        return best, error

    def _visit(self, x: np.ndarray, at: np.ndarray, best: np.ndarray, error: np.ndarray) -> None:
        alive = np.ones((len(at), len(self.rows)), bool)
        for i, entry in enumerate(self.rows):
            asked = np.flatnonzero(alive[:, i])
            if not len(asked):
                continue
            rows = at[asked]
            apart = squared(x[rows], self.book[entry])
            closer = (apart < error[rows]) | ((apart == error[rows]) & (entry < best[rows]))
            best[rows[closer]], error[rows[closer]] = entry, apart[closer]
            if self.leaf:
                continue
            reach = _roots(error[rows]) * (1 + SLACK)
            d = _roots(apart)
            far = (d * (1 - SLACK))[:, None] - self.high[i] > reach[:, None] * (1 + SLACK)
            near = self.low[i] - (d * (1 + SLACK))[:, None] > reach[:, None] * (1 + SLACK)
            alive[asked] &= ~(far | near)
        if not self.leaf:
            for j, child in enumerate(self.children):
                if child is not None and alive[:, j].any():
                    child._visit(x, at[alive[:, j]], best, error)


class Codebooks:
    """One codebook for each part position, each as (entries x width) whole numbers."""

    def __init__(self, books: list[np.ndarray]) -> None:
        self.books = books
        self.trees = [Tree(b) for b in books]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x parts) and squared distances, in the same shape, of whole-number vectors."""
        width = x.shape[1] // len(self.books)
        found = [tree.nearest(np.ascontiguousarray(x[:, p * width:(p + 1) * width])) for p, tree in enumerate(self.trees)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def sha256(self) -> str:
        """Of all entries' components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.ravel()).encode()).hexdigest()


def _gathered(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Frames put together to about BATCH components, vectors having `size`: trees work on many rows at once."""
    held, rows = [], 0
    for frame in in_batches(frames, max(1, BATCH // size)):
        held.append(frame)
        rows += len(frame)
        if rows * size >= BATCH:
            yield pd.concat(held)
            held, rows = [], 0
    if rows:
        yield pd.concat(held)


def usable(vector: Column) -> Column:
    """True where a vector is there and all its components are finite numbers."""
    none = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~none, F.lit(False))


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if all(-SMALL < v < SMALL for v in x.ravel().tolist()) else x


class _Sums:
    """How many parts went to each entry, and their sums."""

    def __init__(self, parts: int, entries: int, width: int) -> None:
        self.n = np.zeros((parts, entries), np.int64)
        self.total = np.zeros((parts, entries, width), object)

    def add(self, x: np.ndarray, codes: np.ndarray) -> None:
        width = self.total.shape[2]
        for p in range(len(self.n)):
            order = np.argsort(codes[:, p], kind="stable")
            ordered = codes[order, p]
            begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            self.n[p, ordered[begin]] += np.diff([*begin, len(order)])
            self.total[p, ordered[begin]] += np.add.reduceat(x[order, p * width:(p + 1) * width], begin, axis=0).astype(object)

    def rows(self) -> pd.DataFrame:
        """(part, entry, n, multiples of LIMB, rests)."""
        return pd.DataFrame([
            (p, e, int(self.n[p, e]), [Decimal(v // LIMB) for v in self.total[p, e]], [Decimal(v % LIMB) for v in self.total[p, e]])
            for p, e in np.argwhere(self.n).tolist()], columns=["part", "entry", "n", "high", "low"])


def fit(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks:
    """Codebooks of `vectors` (id, vector), all of one size: the parts of the `entries` smallest ids, then `rounds` rounds of
    assigning every part to its nearest entry and moving entries to the floor of their parts' mean.

    Equal ids are ordered by their vectors; null ids come last. Entries without parts stay where they are.
    """
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()  # `entries` rows
    seeds = whole([r["vector"] for r in first], scale)
    width = seeds.shape[1] // parts
    books = [seeds[:, p * width:(p + 1) * width] for p in range(parts)]
    shape = "part int, entry int, n long, high array<decimal(38,0)>, low array<decimal(38,0)>"
    context = vectors.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(Codebooks(books))  # parts x entries x width numbers

        def work(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            sums = _Sums(parts, entries, width)
            for frame in _gathered(frames, parts * width):
                x = whole(list(frame.vector), scale)
                sums.add(x, shared.value.assign(x)[0])
            yield sums.rows()

        sums = vectors.select("vector").mapInPandas(work, shape).groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            *[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("high", "low") for i in range(width)])
        moved = [b.astype(object) for b in books]
        for r in sums.collect():
            mean = [(int(r[f"high{i}"]) * LIMB + int(r[f"low{i}"])) // r["n"] for i in range(width)]
            moved[r["part"]][r["entry"]] = mean
        books = [_narrow(b) for b in moved]
    return Codebooks(books)


def compress(
    rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row whose vector is usable.

    code has two hex digits for each part, error is the vector's whole squared distance to its entries, label_error the
    sum of the errors of its label; null labels are one. Left out are rows whose vector is null, empty or of another
    size than that with the smallest id, or has a null or non-finite component. Repeated rows each count; with fewer
    rows than entries the codebooks are smaller. Errors beyond 2^63 - 1 are given as that number. No rows give none. The
    size of a vector has to be a multiple of `parts`, and entries are 256 at most, else a ValueError tells so.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits, for 256 entries at most")
    kept = rows.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    kept = kept.where(usable(F.col("vector")))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()
    names = f"id {rows.schema[vec_id].dataType.simpleString()}, label {rows.schema[label].dataType.simpleString()}"
    if not first:
        none = rows.sparkSession.createDataFrame([], f"{names}, code string, error long, label_error long, codebooks_sha256 string")
        return none.withColumnRenamed("id", "vec_id")
    size = len(first[0]["vector"])
    if size % parts:
        raise ValueError(f"vectors of {size} components can't be cut into {parts} equal parts")
    kept = kept.where(F.size("vector") == size)
    books = fit(kept.select("id", "vector"), parts, entries, rounds, scale)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _gathered(frames, size):
            codes, error = shared.value.assign(whole(list(frame.vector), scale))
            text = codes.astype(np.uint8).tobytes().hex()
            total = [min(int(e), 2 ** 63 - 1) for e in error.sum(axis=1)]
            yield pd.DataFrame({
                "id": frame.id, "label": frame.label, "code": [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)],
                "error": np.array(total, np.int64)})

    # Ids and labels pass through Python as text, which keeps nulls and types apart from floats.
    as_text = kept.select(F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label"), "vector")
    coded = stage(as_text.mapInPandas(work, "id string, label string, code string, error long"), "codes")
    most = F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    # One row for each label on that side; adaptive execution splits the rows of a hot one on this.
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return out.select(
        F.col("id").cast(rows.schema[vec_id].dataType).alias("vec_id"), F.col("label").cast(rows.schema[label].dataType).alias("label"),
        "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
