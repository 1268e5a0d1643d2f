"""Suffix-array dedup: bytes covered by a string of `span` bytes that also starts earlier are removed.

All suffixes of a corpus are too many to sort, and most can't matter. Of the `gram`-byte strings in each window of `span`
bytes, the one with the smallest hash is its anchor (the last one of equals). Equal windows have equal anchors at equal
places, so a window can only repeat if its anchor does.

1. Anchors: one in about 35 bytes. Their hashes go to buckets by hash range, in blocks; anchors that occur once end here.
2. Suffixes at repeated anchors, with the bytes before them that a window can hold, are range-partitioned by their
   leading bytes; the splitters are sampled. Each bucket is sorted by its words of 8 bytes, and equal windows that meet in it
   are found at each offset of the anchor. The smallest (document, start) of equal windows stays, the others are marked.
3. Suffixes whose anchor is very frequent are dealt out by document over many buckets. Each of these hands on the first of
   its equal windows, and a last aggregate compares these firsts across the boundaries of the buckets.

Whole copies of a text are found by digest and take no part in 2 and 3, as what they repeat is known. Matches never
cross documents. All is counted in UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.shared import as_bytes, in_batches, numbered, shuffle_partitions, stage, trimmed

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 18
#: More equal anchors than these in one block, or in all, are dealt out over PARTS buckets.
_COMMON, PARTS = 64, 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` (a power of 2) bytes from each place on."""
    h, base, width = data.astype(np.uint64) + np.uint64(1), _BASE, 1
    with np.errstate(over="ignore"):
        while width < gram:
            h = h[:len(h) - width] * base + h[width:]
            base, width = base * base, width * 2
    return _mixed(h)


def anchors(data: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `span` bytes the place of its anchor; hashes of all grams."""
    h = _gram_hashes(data, gram)
    wide = span - gram + 1
    value, place, width = h, np.arange(len(h), dtype=np.int32), 1
    while width < wide:
        step = min(width, wide - width)
        n = len(value) - step
        later = value[step:] <= value[:n]
        place = np.where(later, place[step:], place[:n])
        value = np.minimum(value[step:], value[:n])
        width += step
    return place, h


def _pieces(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A quarter of a megabyte at a time: the bytes, which text each window is of, and its start in it.

    Windows that reach over the end of a text are left out; long texts come in pieces that overlap.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - span + 1), _PIECE):
            part = text[at:at + _PIECE + span - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= _PIECE:
                yield _windows(held, span)
                held, size = [], 0
    if held:
        yield _windows(held, span)


def _windows(held: list[tuple[int, int, bytes]], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(part) for _, _, part in held])
    begins = np.cumsum(sizes) - sizes
    many = sizes - span + 1
    of = np.repeat(np.arange(len(held)), many)
    at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    which = np.array([(i, start) for i, start, _ in held], np.int64)
    data = np.frombuffer(b"".join([part for _, _, part in held]), np.uint8)
    return data, np.stack([which[of, 0], which[of, 1] + at]), begins[of] + at


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join([a.tobytes() for a in arrays]), 1)


def _unpacked(blocks: pd.Series, kinds: tuple[str, ...]) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for block in blocks:
        raw = zstandard.decompress(block)
        n, at = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds)]


def _repeated_anchors(texts: DataFrame, span: int, gram: int, buckets: int, common: int, group_rows: int) -> DataFrame:
    """(n, places) of anchors that occur at least twice: twice the place in the document, and 1 if it is dealt out."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for frame in in_batches(frames, 500):
            data, ids = [as_bytes(t) for t in frame.text], frame.n.to_numpy(np.int64)
            for piece, (of, start), at in _pieces(data, span):
                place, h = anchors(piece, span, gram)
                chosen = place[at]
                new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (of[1:] != of[:-1]))))
                held.append((h[chosen[new]], ids[of[new]], start[new] + chosen[new] - at[new]))
            if sum(len(x[0]) for x in held) > 400_000:
                yield block(held)
                held = []
        if held:
            yield block(held)

    def block(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
        h, n, at = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(h, kind="stable")
        h, n, at = h[order], n[order], at[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        many = np.diff(np.concatenate((first, [len(h)])))
        count = np.repeat(many, many)
        often = count > common
        # Of a common anchor one stands for all in the block, and the others need no answer.
        asks = ~often
        asks[first] = True
        # Anchors are the smallest hashes around, so their own upper bits aren't even.
        bucket = ((_mixed(h) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        out = []
        for b, rows in _by(bucket, np.flatnonzero(asks)):
            rows = rows[np.lexsort((at[rows], n[rows]))]
            ids = n[rows]
            out.append((b, _packed(
                h[rows], np.diff(ids, prepend=0), at[rows].astype(np.int64), count[rows].astype(np.int64))))
        rest = np.flatnonzero(~asks)
        for b, rows in _by(n % buckets, rest):
            out.append((-1 - b, _packed(n[rows], at[rows] * 2 + 1)))
        return pd.DataFrame(out, columns=["bucket", "data"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        if frame.bucket.iloc[0] < 0:
            n, places = _unpacked(frame.data, ("<i8", "<i8"))
        else:
            sent = [_unpacked(pd.Series([x]), ("<u8", "<i8", "<i8", "<i8")) for x in frame.data]
            h, n, at, count = (np.concatenate(x) for x in zip(*[(a, np.cumsum(b), c, d) for a, b, c, d in sent]))
            order = np.argsort(h)
            h, n, at, count = h[order], n[order], at[order], count[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff(np.concatenate((first, [len(h)])))
            # A common anchor's one row stands for `count` of its block.
            weight = np.where(count > common, count, 1)
            total = np.repeat(np.add.reduceat(weight, first), size)
            split = np.repeat(np.maximum.reduceat(count, first) > common, size) | (total > group_rows)
            n, places = n[total > 1], (at * 2 + split)[total > 1]
        order = np.argsort(n, kind="stable")
        n, places = n[order], places[order]
        cut = np.flatnonzero(np.concatenate(([True], n[1:] != n[:-1]))) if len(n) else np.empty(0, int)
        return pd.DataFrame({"n": n[cut], "places": [p.tobytes() for p in np.split(places, cut[1:])] if len(n) else []})

    asked = texts.select("n", "text").mapInPandas(trimmed(ask), "bucket long, data binary")
    return asked.groupBy("bucket").applyInPandas(answer, "n long, places binary")


def _by(key: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    rows = rows[np.argsort(key[rows], kind="stable")]
    cut = np.flatnonzero(np.diff(key[rows])) + 1
    for part in np.split(rows, cut):
        if len(part):
            yield int(key[part[0]]), part


def _suffixes(texts: DataFrame, span: int, gram: int, parts: int) -> DataFrame:
    """(lead, part, n, place, low, high, context) of the wanted anchors: `low` to `high` are the starts of their
    windows, the context is the bytes that these windows hold, `span - gram` of them before the anchor."""
    before = span - gram
    around = np.arange(-before, span)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            data, ids = [as_bytes(t) for t in frame.text], frame.n.to_numpy(np.int64)
            wanted = [np.unique(np.frombuffer(b"".join(x), "<i8")) for x in frame.places]
            for piece, (of, start), at in _pieces(data, span):
                place, _ = anchors(piece, span, gram)
                chosen = place[at]
                new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (of[1:] != of[:-1]))))
                last = np.concatenate((new[1:], [len(of)])) - 1
                where = start[new] + chosen[new] - at[new]
                # Both lists are sorted by text and place.
                keep = np.zeros(len(new), bool)
                flag = np.zeros(len(new), np.int64)
                doc, begin = of[new], np.flatnonzero(np.concatenate(([True], np.diff(of[new]) != 0)))
                for a, b in zip(begin, [*begin[1:], len(new)]):
                    want = wanted[doc[a]]
                    i = np.minimum(np.searchsorted(want, where[a:b] * 2), len(want) - 1)
                    keep[a:b] = want[i] >> 1 == where[a:b]
                    flag[a:b] = want[i] & 1
                new, last, where, flag = new[keep], last[keep], where[keep], flag[keep]
                padded = np.concatenate((np.zeros(before, np.uint8), piece, np.zeros(span, np.uint8)))
                context = padded[chosen[new][:, None] + (around + before)]
                lead = np.ascontiguousarray(context[:, before:before + 8]).view(">u8").ravel().astype(np.uint64)
                n = ids[of[new]]
                yield pd.DataFrame({
                    "lead": (lead ^ np.uint64(1 << 63)).view(np.int64),
                    "part": np.where(flag, 1 + _mixed(n.view(np.uint64)).astype(np.uint64) % np.uint64(parts), 0)
                    .astype(np.int32),
                    "n": n, "place": where, "low": start[new], "high": start[last],
                    "context": [x.tobytes() for x in context]})

    return texts.mapInPandas(trimmed(cut), "lead long, part int, n long, place long, low long, high long, context binary")


def _equal_windows(frames: Iterator[pd.DataFrame], span: int, gram: int) -> Iterator[pd.DataFrame]:
    """In one bucket: (n, low, high) of starts that repeat earlier ones; with a `window` hash, firsts of dealt-out ones."""
    held = [f for f in frames if len(f)]
    if not held:
        return
    n, place, low, high, part = (
        np.concatenate([f[c].to_numpy(np.int64) for f in held]) for c in ("n", "place", "low", "high", "part"))
    wide = 2 * span - gram
    context = np.concatenate([np.frombuffer(b"".join(f.context), np.uint8).reshape(-1, wide) for f in held])
    before = span - gram
    words = np.ascontiguousarray(context[:, before:before + gram]).view(">u8").astype(np.uint64)
    order = np.lexsort((place, n, *words.T[::-1]))
    words, n, place, low, high, part, context = (x[order] for x in (words, n, place, low, high, part, context))
    group = np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]).any(axis=1), [True])))
    power = _BASE ** np.uint64(span)
    at = 0
    while at < len(group) - 1:
        # Whole groups, some thousand rows at a time; a dealt-out group is as large as its bucket's share.
        to = max(at + 1, int(np.searchsorted(group, group[at] + 4000, side="right")) - 1)
        a, b = group[at], group[to]
        at = to
        chars = context[a:b]
        sums = np.zeros((b - a, wide + 1), np.uint64)
        for j in range(wide):
            sums[:, j + 1] = sums[:, j] * _BASE + chars[:, j] + np.uint64(1)
        many = high[a:b] - low[a:b] + 1
        row = np.repeat(np.arange(b - a), many)
        start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + low[a:b][row]
        column = before - (place[a:b][row] - start)
        window = _mixed(sums[row, column + span] - sums[row, column] * power) ^ column.astype(np.uint64)
        by = np.argsort(window)
        cut = np.flatnonzero(np.concatenate(([True], window[by][1:] != window[by][:-1])))
        first = np.empty(len(row), np.int64)
        first[by] = np.repeat(np.minimum.reduceat(by, cut), np.diff(np.concatenate((cut, [len(by)]))))
        # Rows are sorted by document and place within a group, and equal windows have equal offsets.
        other = np.flatnonzero(first != np.arange(len(row)))
        mine, theirs = row[other], row[first[other]]
        pairs, which = np.unique(mine * (b - a) + theirs, return_inverse=True)
        same = _same_bytes(chars, pairs // (b - a), pairs % (b - a), which, column[other], span)
        earlier = (n[a:b][mine] != n[a:b][theirs]) | (start[other] != start[first[other]])
        marked = np.zeros(len(row), bool)
        marked[other[same & earlier]] = True
        run = np.flatnonzero(marked)
        begins = np.concatenate(([True], (np.diff(run) != 1) | (np.diff(row[run]) != 0))) if len(run) else run
        ends = np.concatenate((begins[1:], [True])) if len(run) else run
        begin, end = run[np.flatnonzero(begins)], run[np.flatnonzero(ends)]
        yield pd.DataFrame({
            "n": n[a:b][row[begin]], "low": start[begin], "high": start[end],
            "window": pd.array([None] * len(begin), "Int64")})
        hand = np.flatnonzero((part[a:b][row] > 0) & (first == np.arange(len(row))))
        if len(hand):
            yield pd.DataFrame({
                "n": n[a:b][row[hand]], "low": start[hand], "high": start[hand],
                "window": pd.array(window[hand].view(np.int64), "Int64")})


def _same_bytes(
    chars: np.ndarray, mine: np.ndarray, theirs: np.ndarray, which: np.ndarray, column: np.ndarray, span: int,
) -> np.ndarray:
    """Whether the windows at `column` of the pairs `which` of rows (mine, theirs) have equal bytes; some pairs at a time."""
    same = np.zeros(len(which), bool)
    order = np.argsort(which)
    step = 8192
    cut = np.searchsorted(which[order], np.arange(0, len(mine) + step, step))
    for k, (a, b) in enumerate(zip(cut, cut[1:])):
        at = order[a:b]
        x, y = (rows[k * step:(k + 1) * step] for rows in (mine, theirs))
        differ = np.zeros((len(x), chars.shape[1] + 1), np.int16)
        np.cumsum(chars[x] != chars[y], axis=1, out=differ[:, 1:], dtype=np.int16)
        pair = which[at] - k * step
        same[at] = differ[pair, column[at] + span] == differ[pair, column[at]]
    return same


def _marks(texts: DataFrame, span: int, gram: int, common: int, group_rows: int, parts: int) -> DataFrame:
    """(n, copy, marks) of documents that lose bytes: a whole copy, or pairs (low, high) of marked starts."""
    if gram & (gram - 1) or gram < 8 or gram > span:
        raise ValueError("gram must be a power of 2 from 8 to span")
    spark = texts.sparkSession
    buckets = shuffle_partitions(spark)
    digests = texts.where(F.octet_length("text") >= span).select("n", F.sha2("text", 256).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("n").alias("first"), F.count("*").alias("c")).where("c > 1")
    copies = stage(digests.join(first, "digest").where("n > first").select("n").distinct(), "copies")
    repeated = _repeated_anchors(texts, span, gram, buckets, common, group_rows)
    wanted = repeated.groupBy("n").agg(F.collect_list("places").alias("places")).join(copies, "n", "left_anti")
    wanted = stage(wanted, "anchors")
    distinct = texts.select("n", "text").join(wanted, "n")
    suffixes = _suffixes(distinct, span, gram, parts).repartitionByRange(2 * buckets, "lead", "part")
    found = suffixes.mapInPandas(
        trimmed(lambda frames: _equal_windows(frames, span, gram)), "n long, low long, high long, window long")
    found = stage(found, "windows")
    firsts = found.where("window IS NOT NULL").select("window", "n", "low")
    least = firsts.groupBy("window").agg(F.min(F.struct("n", "low")).alias("least"))
    across = firsts.join(least, "window").where("struct(n, low) > least").select("n", "low", F.col("low").alias("high"))
    marks = found.where("window IS NULL").select("n", "low", "high").union(across)
    marks = marks.groupBy("n").agg(F.collect_list(F.array("low", "high")).alias("marks"))
    none = F.lit(None).cast("array<array<bigint>>")
    return marks.select("n", F.lit(False).alias("copy"), "marks").union(
        copies.select("n", F.lit(True), none))


def cut_text(text: str | None, copy: object, marks: object, span: int) -> tuple[bytes, list[tuple[int, int]], bytes]:
    """The bytes of a text, the spans that go, and what is left."""
    data = as_bytes(text)
    if copy is True or copy == True:  # noqa: E712  numpy's own kind
        return data, [(0, len(data))], b""
    spans: list[tuple[int, int]] = []
    for low, high in sorted((int(a), int(b)) for a, b in (marks if marks is not None else ())):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], high + span))
        else:
            spans.append((low, high + span))
    kept, at = [], 0
    for low, high in spans:
        kept.append(data[at:low])
        at = high
    return data, spans, b"".join([*kept, data[at:]])


def repeats(
    docs: DataFrame, span: int = 100, gram: int = 32, common: int = _COMMON, group_rows: int = 50_000,
    parts: int = PARTS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, spans (start, end) that are removed, kept_sha256 of what is left.

    A null text is empty, and texts shorter than `span` lose nothing. Order is by doc_id; null ids come first, rows of one
    id are ordered by the hash of their text, and equal rows are one document with one result each.
    """
    texts = numbered(docs.select("doc_id", "text"))
    joined = texts.join(_marks(texts, span, gram, common, group_rows, parts), "n", "left")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 200):
            out = []
            for doc_id, text, copy, marks in zip(frame.doc_id, frame.text, frame["copy"], frame.marks):
                data, spans, kept = cut_text(text, copy, marks, span)
                out.append((doc_id, len(data), spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    return joined.select("doc_id", "text", "copy", "marks").mapInPandas(
        trimmed(work), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string")


def without_repeats(docs: DataFrame, span: int = 100, gram: int = 32) -> DataFrame:
    """`docs` with the repeated bytes cut from the texts; rows that lose all their text go.

    A character that loses some of its bytes goes whole. Other columns stay as they are.
    """
    marks = _marks(numbered(docs.select("doc_id", "text")), span, gram, _COMMON, 50_000, PARTS).toDF("_n", "_copy", "_marks")
    joined = numbered(docs, "_n").join(marks, "_n", "left")
    columns = docs.columns
    schema = docs.select(F.lit(False).alias("_gone"), "*").schema

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            new, gone = [], []
            for text, copy, marks in zip(frame["text"], frame["_copy"], frame["_marks"]):
                _, spans, kept = cut_text(text, copy, marks, span)
                new.append(kept.decode("utf-8", "ignore") if spans else text)
                gone.append(bool(spans) and not kept)
            yield frame[columns].assign(text=new, _gone=gone)[["_gone", *columns]]

    return joined.drop("_n").mapInPandas(trimmed(work), schema).where("NOT _gone").drop("_gone")
