"""Language-model scores of all documents by the corpus itself: stupid backoff from word pairs to words.

Each document is scored by the counts of all others: what it has itself is taken off every count. A pair seen elsewhere
scores log(count(v w) / count(v)), any other log(backoff x count(w) / words). The start and the end of a document are words.

The join runs on compact blocks. Pairs (v, w) of each document go to buckets by the hash of v, so that a bucket has all pairs
of its words v: it adds up the count tables of its pairs and words, and joins them to the pairs of the documents in it.
Pairs without a count elsewhere go on to buckets by the hash of w, with the table of word counts. The shares of the
documents come back in blocks by group of documents and are summed at last. Words with more than a bucket's share of the corpus (at most as many as there are buckets)
are known to all tasks: as v their pairs are dealt out by v and w, and as w they need no second bucket.

Words are 48-bit hashes: of 10^8 different words about 18 pairs share one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.shared import in_batches, numbered, shuffle_partitions, stage, trimmed, word_hashes

_WORD_BITS = 48
#: Hashes of the start and the end; real words have other ones but by chance.
START, END = 1, 2
_FLUSH_WORDS = 800_000
_BUCKETS_PER_PARTITION = 3


def word_ids(texts: Sequence[str | None]) -> list[np.ndarray]:
    return [h >> np.uint64(64 - _WORD_BITS) for h in word_hashes(texts)]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pack(ids: tuple[np.ndarray, ...], numbers: tuple[np.ndarray, ...]) -> bytes:
    """48-bit ids in 6 bytes, numbers in 4, in columns of bytes, so that equal upper bytes stand together."""
    parts = [np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes() for x in ids]
    parts += [np.ascontiguousarray(x).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in numbers]
    return zstandard.compress(b"".join(parts), 1)


def _unpack(data: bytes, ids: int, numbers: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    n = len(raw) // (6 * ids + 4 * numbers)
    first, second = [], []
    for i in range(ids):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = raw[6 * n * i:6 * n * (i + 1)].reshape(6, n).T
        first.append(wide.view("<u8").ravel())
    for i in range(numbers):
        at = 6 * n * ids + 4 * n * i
        second.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<i4").ravel())
    return first, second


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def _totals(keys: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    """For every row the sum of the amounts of its key."""
    order = np.argsort(keys)
    begin = _runs(keys[order])
    sums = np.add.reduceat(amounts[order], begin, dtype=np.int64)
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(sums, np.diff(np.concatenate((begin, [len(keys)]))))
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) over all documents, with a word START and END for each."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, many, size = [], 0, 0
        for frame in in_batches(frames, 500):
            held += word_ids(list(frame.text))
            many += len(frame)
            size += sum(map(len, held[-len(frame):]))
            if size > _FLUSH_WORDS:
                yield counted(held, many)
                held, many, size = [], 0, 0
        if many:
            yield counted(held, many)

    def counted(held: list[np.ndarray], many: int) -> pd.DataFrame:
        words, count = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({
            "word": np.concatenate([words.astype(np.int64), [START, END]]),
            "count": np.concatenate([count, [many, many]])})

    rows = docs.select("text").mapInPandas(trimmed(work), "word long, count long")
    return rows.groupBy("word").agg(F.sum("count").alias("count"))


def _pairs(docs: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """(bucket, docs, data): blocks of different pairs (v, w) of documents, with how often they and their words occur."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, size = [], [], 0
        for frame in in_batches(frames, 500):
            held += word_ids(list(frame.text))
            ids += frame.n.tolist()
            size += sum(len(h) + 2 for h in held[-len(frame):])
            if size > _FLUSH_WORDS:
                yield block(held, ids)
                held, ids, size = [], [], 0
        if ids:
            yield block(held, ids)

    def block(held: list[np.ndarray], ids: list[int]) -> pd.DataFrame:
        words = np.concatenate([x for h in held for x in (np.array([START], np.uint64), h, np.array([END], np.uint64))])
        doc = np.repeat(np.arange(len(held), dtype=np.uint64), [len(h) + 2 for h in held])
        own = _totals(_mixed(doc + np.uint64(1), words), np.ones(len(words), np.int32))
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        v, w, doc, own_v, own_w = words[inner], words[inner + 1], doc[inner], own[inner], own[inner + 1]
        bucket = np.where(np.isin(v, frequent), _bucket(_mixed(v, w) >> np.uint64(16), buckets), _bucket(v, buckets))
        order = np.lexsort((doc, w, v, bucket))
        v, w, doc, own_v, own_w, bucket = (x[order] for x in (v, w, doc, own_v, own_w, bucket))
        new = np.flatnonzero(np.concatenate(
            ([True], (doc[1:] != doc[:-1]) | (w[1:] != w[:-1]) | (v[1:] != v[:-1]))))
        times = np.diff(np.concatenate((new, [len(v)])))
        v, w, doc, own_v, own_w, bucket = (x[new] for x in (v, w, doc, own_v, own_w, bucket))
        cut = _runs(bucket)
        names = zstandard.compress(np.diff(np.array(ids, np.int64), prepend=0).tobytes(), 1)
        rows = [
            (int(bucket[a]), names, _pack((v[a:b], w[a:b]), (doc[a:b], times[a:b], own_v[a:b], own_w[a:b])))
            for a, b in zip(cut, [*cut[1:], len(v)])]
        return pd.DataFrame(rows, columns=["bucket", "docs", "data"])

    return docs.select("n", "text").mapInPandas(trimmed(work), "bucket long, docs binary, data binary")


def _joined(frame: pd.DataFrame, frequent: np.ndarray, counts: np.ndarray):
    """The blocks of a bucket with the counts of their pairs and words v joined to them."""
    names, v, w, doc, times, own_v, own_w = [], [], [], [], [], [], []
    at = 0
    for docs, data in zip(frame.docs, frame.data):
        ids = np.cumsum(np.frombuffer(zstandard.decompress(docs), np.int64))
        (a, b), (c, d, e, f) = _unpack(data, 2, 4)
        names.append(ids)
        for held, x in zip((v, w, doc, times, own_v, own_w), (a, b, c + at, d, e, f)):
            held.append(x)
        at += len(ids)
    names, v, w, doc, times, own_v, own_w = (np.concatenate(x) for x in (names, v, w, doc, times, own_v, own_w))
    pair = _totals(_mixed(v, w), times) - times
    first = _totals(v, times)
    place = np.minimum(np.searchsorted(frequent, v), max(len(frequent) - 1, 0))
    known = frequent[place] == v
    first = np.where(known, counts[place], first) - own_v
    return names, v, w, doc, times, own_w, pair, first


def scores(docs: DataFrame, backoff: float = 0.4) -> DataFrame:
    """`docs` doc_id with n_words, score (mean log probability of its words and its end) and unseen (share backed off).

    A null text is empty: one event, its end. Rows that repeat a doc_id are documents of their own, and equal rows are
    copies that see each other. Words that no other document has count as half a word.
    """
    spark = docs.sparkSession
    groups = shuffle_partitions(spark)  # of documents, and of words that pairs back off to
    buckets = groups * _BUCKETS_PER_PARTITION
    texts = numbered(docs.select("doc_id", "text"))
    words = stage(word_counts(docs), "words")
    total = words.where(F.col("word") != START).agg(F.sum("count")).first()[0] or 0
    # At most `buckets` + 2 words: each has more than a bucket's share.
    often = words.where((F.col("count") > total / buckets) | F.col("word").isin(START, END)).orderBy("word").collect()
    frequent = np.array([r["word"] for r in often], np.uint64)
    counts = np.array([r["count"] for r in often], np.int64)
    pairs = _pairs(texts, buckets, frequent)

    def seen(frame: pd.DataFrame) -> pd.DataFrame:
        names, v, w, doc, times, own_w, pair, first = _joined(frame, frequent, counts)
        found = pair > 0
        value = np.log(np.where(found, pair / np.maximum(first, 1), 1.0))
        # Frequent words need no table but their own.
        place = np.minimum(np.searchsorted(frequent, w), max(len(frequent) - 1, 0))
        back = ~found & (frequent[place] == w)
        value = np.where(back, np.log(np.maximum(counts[place] - own_w, 0.5)), value)
        use = found | back
        return summed(names, doc, np.where(use, value * times, 0.0), times, np.where(found, 0, times))

    def summed(names, doc, value, times, missed, all_of_them=False) -> pd.DataFrame:
        """What a bucket adds to its documents, in one row for each group of documents."""
        n = len(names)
        events, gone = np.bincount(doc, times, n), np.bincount(doc, missed, n)
        total = np.bincount(doc, value, n)
        there = np.arange(n) if all_of_them else np.flatnonzero(events + gone)
        group = (_mixed(names.view(np.uint64), np.uint64(1)) % np.uint64(groups)).astype(np.int64)
        there = there[np.lexsort((names[there], group[there]))]
        cut = _runs(group[there]) if len(there) else []
        rows = []
        for a, b in zip(cut, [*cut[1:], len(there)]):
            at = there[a:b]
            rows.append((int(group[at[0]]), zstandard.compress(b"".join([
                np.diff(names[at], prepend=0).tobytes(), total[at].tobytes(), events[at].astype(np.int64).tobytes(),
                gone[at].astype(np.int64).tobytes()]), 1)))
        return pd.DataFrame(rows, columns=["group", "data"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for data in frame.data:
            raw = zstandard.decompress(data)
            n = len(raw) // 32
            parts.append((np.cumsum(np.frombuffer(raw, np.int64, n)), np.frombuffer(raw, np.float64, n, 8 * n),
                          np.frombuffer(raw, np.int64, n, 16 * n), np.frombuffer(raw, np.int64, n, 24 * n)))
        names, total, events, missed = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(names, kind="stable")
        cut = _runs(names[order])
        return pd.DataFrame({"n": names[order][cut], **{
            c: np.add.reduceat(x[order], cut) for c, x in (("sum", total), ("events", events), ("missed", missed))}})

    def unseen(frame: pd.DataFrame) -> pd.DataFrame:
        names, v, w, doc, times, own_w, pair, first = _joined(frame, frequent, counts)
        go = np.flatnonzero((pair <= 0) & ~np.isin(w, frequent))
        w, doc, times, own_w = w[go], doc[go], times[go], own_w[go]
        bucket = _bucket(w, groups)
        order = np.lexsort((doc, w, bucket))
        w, doc, times, own_w, bucket = (x[order] for x in (w, doc, times, own_w, bucket))
        cut = _runs(bucket) if len(bucket) else []
        rows = []
        for a, b in zip(cut, [*cut[1:], len(w)]):
            used, short = np.unique(doc[a:b], return_inverse=True)
            ids = zstandard.compress(np.diff(names[used], prepend=0).tobytes(), 1)
            rows.append((int(bucket[a]), ids, _pack((w[a:b],), (short, times[a:b], own_w[a:b]))))
        return pd.DataFrame(rows, columns=["bucket", "docs", "data"])

    def backed_off(frame: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(table["word"].to_numpy())
        word, count = table["word"].to_numpy()[order].astype(np.uint64), table["count"].to_numpy()[order]
        whole, at = ([], [], []), 0
        for docs_, data in zip(frame.docs, frame.data):
            names = np.cumsum(np.frombuffer(zstandard.decompress(docs_), np.int64))
            (w,), (doc, times, own_w) = _unpack(data, 1, 3)
            value = np.log(np.maximum(count[np.searchsorted(word, w)] - own_w, 0.5)) * times
            for held, x in zip(whole, (names, doc + at, value)):
                held.append(x)
            at += len(names)
        if not at:
            return pd.DataFrame({"group": [], "data": []})
        names, doc, value = (np.concatenate(x) for x in whole)
        # The documents of all parts may repeat; their events and misses were counted with the pairs.
        used, doc = np.unique(names[doc], return_inverse=True)
        return summed(used, doc, value, np.zeros_like(doc), np.zeros_like(doc), all_of_them=True)

    shares, blocks = "group long, data binary", "bucket long, docs binary, data binary"
    by_word = words.withColumn(
        "bucket", F.shiftright(F.shiftright("word", 16) * F.lit(groups), 32))
    later = pairs.groupBy("bucket").applyInPandas(unseen, blocks).groupBy("bucket").cogroup(
        by_word.groupBy("bucket")).applyInPandas(backed_off, shares)
    parts = pairs.groupBy("bucket").applyInPandas(seen, shares).union(later)
    sums = parts.groupBy("group").applyInPandas(add_up, "n long, sum double, events long, missed long")
    own = F.col("events") / F.col("rows")
    rest = F.greatest(F.lit(float(total)) - own, F.lit(1.0))
    score = (F.col("sum") + F.col("missed") * (F.lit(float(np.log(backoff))) - F.log(rest))) / F.col("events")
    ids = texts.groupBy("n", "doc_id").agg(F.count("*").alias("rows"))
    return sums.join(ids, "n").select(
        "doc_id", (own - 1).cast("long").alias("n_words"), score.alias("score"),
        (F.col("missed") / F.col("events")).alias("unseen"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_row")).drop("_row")
