"""Benchmark decontamination by greedy string tiling.

A document is held against every benchmark item it shares `seed` words in a row with. Seeds are found with a rolling
Karp-Rabin hash over word hashes and joined to the items' places; a fixed-size bit table of the items' seeds drops nearly
all others before the join. For each pair of document and item the longest match not yet covered is marked as a tile,
again and again, until no run of `seed` free words is left. An item is in a document if tiles cover at least `share` of
its words; as tiles may come in any order, reordered passages count.

A text's places of one seed are one row of the join, however often the seed comes back in it. Where the places of a pair
would be many two by two, as in a word said a thousand times, matches are found from windows instead: windows of twice
the length from two windows next to each other, those that only one side has left out, which grows with the sum of the places.
"""

from __future__ import annotations

import bisect
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.shared import in_batches, stage, word_hashes

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the table, a power of 2: 2 MB, whatever the size of the benchmark.
_TABLE_BITS = 24
#: Up to so many pairs of places are tiled one by one, which is faster there; the tiles are the same.
_FEW = 4096


def seed_hashes(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Karp-Rabin hash of each `seed` words in a row."""
    n = len(hashes) - seed + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(seed):
        out = out * _BASE + hashes[j:j + n]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _places(grams: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different grams, at least one, and the places of each."""
    order = np.argsort(grams, kind="stable")
    grams, at = grams[order], (order if at is None else at[order]).astype(np.int32)
    cut = np.flatnonzero(grams[1:] != grams[:-1]) + 1
    return grams[np.concatenate(([0], cut))], np.split(at, cut)


def item_seeds(items: DataFrame, seed: int) -> DataFrame:
    """(gram, item_id, item_hash, item_at, item_words, seed), a row per different seed of an item with all its places.

    Null ids are kept. Empty items have no seeds, shorter ones than a seed are one seed as a whole.
    """
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item_id, item_hash, words in zip(frame.item_id, frame.item_hash, word_hashes(list(frame.text))):
                if len(words):
                    grams, places = _places(seed_hashes(words, min(seed, len(words))))
                    yield pd.DataFrame({
                        "gram": grams.view(np.int64), "item_id": item_id, "item_hash": item_hash, "item_at": places,
                        "item_words": len(words), "seed": min(seed, len(words))}).astype({"item_id": "Int64"})

    return items.select("item_id", F.xxhash64("text").alias("item_hash"), "text").distinct().mapInPandas(
        work, "gram long, item_id long, item_hash long, item_at array<int>, item_words int, seed int")


def _bit_table(grams: DataFrame) -> np.ndarray:
    """A bit for each value of the grams' last bits; no more than 2^24 bits come to the driver, in words of 64."""
    low = F.col("gram").bitwiseAND((1 << _TABLE_BITS) - 1)
    words = grams.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(gram & 63 AS INT))")).alias("bits")).collect()
    table = np.zeros(1 << _TABLE_BITS - 6, np.uint64)
    for r in words:
        table[r["word"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    return table


def tiles(pairs: list[tuple[int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from shared seeds: (place in the document, place in the item, words) of each tile.

    Runs of seeds on one diagonal are maximal matches. The longest whose words are all free is taken first (ties: first in
    the document, then in the item); one that is partly covered goes back with what is left of it.
    """
    by_diagonal: dict[int, list[int]] = {}
    for at, item_at in sorted(set(pairs)):
        by_diagonal.setdefault(at - item_at, []).append(at)
    matches: dict[int, list[tuple[int, int]]] = {}
    for diagonal, places in by_diagonal.items():
        start = last = places[0]
        for at in [*places[1:], None]:
            if at is None or at != last + 1:
                matches.setdefault(last - start + seed, []).append((start, start - diagonal))
                start = at
            last = at
    doc_used: set[int] = set()
    item_used: set[int] = set()
    found = []
    while matches:
        size = max(matches)
        for at, item_at in sorted(matches.pop(size)):
            start = None
            free = [at + i not in doc_used and item_at + i not in item_used for i in range(size)]
            if all(free):
                found.append((at, item_at, size))
                doc_used.update(range(at, at + size))
                item_used.update(range(item_at, item_at + size))
                continue
            for i, is_free in enumerate([*free, False]):
                if is_free and start is None:
                    start = i
                elif not is_free and start is not None:
                    if i - start >= seed:
                        matches.setdefault(i - start, []).append((at + start, item_at + start))
                    start = None
    return found


def _both(codes: np.ndarray, at: np.ndarray, n: int, size: int) -> np.ndarray:
    """A number for each code that stands both before place n and from there on, at its places; -1 elsewhere."""
    known, number = np.unique(codes, return_inverse=True)
    here, there = np.zeros(len(known), bool), np.zeros(len(known), bool)
    here[number[at < n]], there[number[at >= n]] = True, True
    out, keep = np.full(size, -1, np.int64), (here & there)[number]
    out[at[keep]] = number[keep]
    return out


def _free(places: np.ndarray, starts: list[int], size: int, seed: int) -> np.ndarray:
    """Which seeds have no word in tiles of `size` words at these places."""
    tiles_at = np.sort(np.array(starts, np.int64))
    last = np.searchsorted(tiles_at, places + seed - 1, side="right") - 1
    return (last < 0) | (places >= tiles_at[last] + size)


def tiles_of_windows(
    at: np.ndarray, grams: np.ndarray, item_at: np.ndarray, item_grams: np.ndarray, seed: int,
) -> list[tuple[int, int, int]]:
    """The tiles that `tiles` finds, from sorted places and the number of the seed at each."""
    found = []
    while len(at) and len(item_at):
        n, place = len(at), np.concatenate((at, item_at + at[-1] + 2))
        many = len(place)

        def joined(left: np.ndarray, length: int, right: np.ndarray) -> np.ndarray:
            i = np.flatnonzero((left[:-length] >= 0) & (right[length:] >= 0) & (place[length:] - place[:-length] == length))
            return _both(left[i] * many + right[i + length], i, n, many)

        window, length = _both(np.concatenate((grams, item_grams)), np.arange(many), n, many), 1
        if window.max() < 0:
            break
        levels = []
        while True:
            levels.append(window)
            longer = joined(window, length, window) if 2 * length < many else window[:0]
            if not len(longer) or longer.max() < 0:
                break
            window, length = longer, 2 * length
        for k in reversed(range(len(levels) - 1)):
            longer = joined(window, length, levels[k])
            if longer.max() >= 0:
                window, length = longer, length + (1 << k)
        size = length + seed - 1
        waiting: dict[int, deque[int]] = defaultdict(deque)
        for i in np.flatnonzero(window[n:] >= 0):
            waiting[window[n + i]].append(int(item_at[i]))
        starts: list[int] = []
        taken: list[int] = []
        for i in np.flatnonzero(window[:n] >= 0):
            if starts and at[i] < starts[-1] + size:
                continue
            queue = waiting[window[i]]
            while queue:
                first = queue.popleft()
                j = bisect.bisect(taken, first)
                if (j == 0 or first - taken[j - 1] >= size) and (j == len(taken) or taken[j] - first >= size):
                    taken.insert(j, first)
                    starts.append(int(at[i]))
                    found.append((int(at[i]), first, size))
                    break
        keep, item_keep = _free(at, starts, size, seed), _free(item_at, taken, size, seed)
        at, grams, item_at, item_grams = at[keep], grams[keep], item_at[item_keep], item_grams[item_keep]
    return found


def tiles_of_places(places: list[np.ndarray], item_places: list[np.ndarray], seed: int) -> list[tuple[int, int, int]]:
    """The tiles of a document and an item from the places of each seed that both have."""
    if sum(len(x) * len(y) for x, y in zip(places, item_places)) <= _FEW:
        return tiles([(a, b) for x, y in zip(places, item_places) for a in x.tolist() for b in y.tolist()], seed)
    sides = []
    for side in (places, item_places):
        at = np.concatenate(side).astype(np.int64)
        order = np.argsort(at)
        sides += [at[order], np.repeat(np.arange(len(side)), [len(x) for x in side])[order]]
    return tiles_of_windows(*sides, seed)


def overlaps(docs: DataFrame, items: DataFrame, seed: int = 5) -> DataFrame:
    """(doc_id, text_hash, item_id, item_words, covered, tiles) of every document and item that share a seed.

    Null texts are empty. Rows of `docs` that are equal give one row; equal ids with different texts are told apart by
    text_hash. Null doc_ids and item_ids are kept as they are; different texts of one item_id are items of their own. Items of fewer than `seed` words match as a whole.
    """
    seeds = stage(item_seeds(items, seed), "item_seeds")
    sizes = sorted(r["seed"] for r in seeds.select("seed").distinct().collect())  # 1 to `seed`
    table = docs.sparkSession.sparkContext.broadcast(_bit_table(seeds))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = np.uint64((1 << _TABLE_BITS) - 1)
        for frame in in_batches(frames, 500):
            for doc_id, text_hash, hashes in zip(frame.doc_id, frame.text_hash, word_hashes(list(frame.text))):
                for size in sizes:
                    grams = seed_hashes(hashes, size)
                    low = grams & mask
                    hit = np.flatnonzero(
                        table.value[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1))
                    if len(hit):
                        grams, at = _places(grams[hit], hit)
                        yield pd.DataFrame({
                            "doc_id": doc_id, "text_hash": text_hash, "gram": grams.view(np.int64), "at": at,
                            "seed": size}).astype({"doc_id": "Int64"})

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    places = rows.mapInPandas(work, "doc_id long, text_hash long, gram long, at array<int>, seed int")
    shared = places.join(seeds, ["gram", "seed"])

    def tile(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        frame = frame.loc[~frame.gram.duplicated()]  # of equal rows of `docs`
        found = tiles_of_places(list(frame["at"]), list(frame.item_at), int(first.seed))
        return pd.DataFrame({
            "doc_id": frame.doc_id.iloc[:1], "text_hash": frame.text_hash.iloc[:1], "item_id": frame.item_id.iloc[:1],
            "item_words": frame.item_words.iloc[:1], "covered": [sum(n for _, _, n in found)], "tiles": [found]})

    return shared.groupBy("doc_id", "text_hash", "item_id", "item_hash", "item_words").applyInPandas(
        tile, "doc_id long, text_hash long, item_id long, item_words int, covered int,"
              " tiles array<struct<at: int, item_at: int, words: int>>")


def contaminated(docs: DataFrame, items: DataFrame, seed: int = 5, share: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, items) of documents with items: item_id, coverage and tiles, by item_id."""
    found = overlaps(docs, items, seed).withColumn("coverage", F.col("covered") / F.col("item_words"))
    return found.where(F.col("coverage") >= share).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "coverage", "tiles"))).alias("items"))


def without_benchmark(docs: DataFrame, items: DataFrame, seed: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of `docs` that hold no item."""
    bad = contaminated(docs, items, seed, share).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
