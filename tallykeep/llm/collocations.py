"""Collocations by stripes: every prefix of words keeps a counter of the words that follow it.

The stripes of the empty prefix count words, those of a word the pairs it begins, those of a pair the triples, and so on.
Tasks count stripes of blocks of text, Spark brings the stripes of a prefix together, and they are added up element by
element. From the one table of stripes come the occurrences of phrases (an extension of their prefix), those of their
parts (extensions of shorter prefixes), and the most frequent longer phrase that holds a phrase.

Words are 64-bit hashes on the way. The stripes of the empty prefix keep the words themselves; if two words of a language
had one hash, which is checked over all words, everything is counted anew with other hashes, so counts are exact. (In one
block of text, different words are told apart by 64 more bits.) A
phrase can't be more frequent than its parts, so a longer prefix is only extended where both its own phrase and the
phrase without its first word are frequent enough; mappers look that up in a bitmap of fixed size, which may let other
phrases through, whose counts then fall to the same exact test.

Stripes of a prefix that is more than one part in 131,072 of all words are cut into 64 by their words, so no task gets a
frequent prefix whole, and stripes are merged in sorted order with one prefix in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.llm.shared import as_bytes, in_batches, mixed, stage, trimmed

#: A-Z become a-z, marks and line ends that end a piece become line feeds, tabs become blanks.
_PIECE_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
BLOCK = 20 << 20
_CELL = 1 << 16
HOT_SHARE, HOT_PARTS_BITS = 1 << 17, 6
_BITMAP_BITS = (20, 26)
#: Of a word in a key.
WORD_BYTES = 8


def _odd(seed: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * seed + 1)) & ((1 << 64) - 1) | 1


class Words:
    """The words of a block of text: 64-bit hashes, places in the bytes, and the piece each stands in."""

    def __init__(self, data: bytes, seed: int) -> None:
        chars = np.frombuffer(data, np.uint8)
        inside = (chars != 32) & (chars != 10)
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edge = np.concatenate((np.zeros(int(inside[:1].any()), np.int64), change, np.full(int(inside[-1:].any()), len(data))))
        self.data, self.starts, self.ends = data, edge[::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(chars == 10), self.starts).astype(np.int32)
        self.hashes = self._hashes(chars, seed)

    def _hashes(self, chars: np.ndarray, seed: int) -> np.ndarray:
        base = _odd(seed)
        most = int(max((self.ends - self.starts).max(initial=0), _CELL))
        power, inverse = (np.multiply.accumulate(np.concatenate((
            [np.uint64(1)], np.full(most - 1, x, np.uint64)))) for x in (base, pow(base, -1, 1 << 64)))
        out = np.zeros(len(self.starts), np.uint64)
        first = 0
        while first < len(out):
            # Cells hold whole words, a long word by itself.
            at = self.starts[first]
            last = max(first + 1, np.searchsorted(self.ends, at + _CELL, side="right"))
            some = chars[at:self.ends[last - 1]].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(some) + 1, np.uint64)
            np.cumsum(some * power[:len(some)], out=sums[1:])
            a, b = self.starts[first:last] - at, self.ends[first:last] - at
            out[first:last] = (sums[b] - sums[a]) * inverse[a]
            first = last
        return mixed(out + (self.ends - self.starts).astype(np.uint64) * np.uint64(_odd(seed + 2)))

    def others(self, seed: int) -> np.ndarray:
        """Hashes of another kind."""
        return self._hashes(np.frombuffer(self.data, np.uint8), seed + 3)

    def grams(self, n: int) -> np.ndarray:
        """Where n words in a row of one piece begin."""
        if n > len(self.piece):
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[n - 1:] == self.piece[:len(self.piece) - n + 1])


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
    """(lang, bytes) of texts one after the other, in blocks of about BLOCK bytes that end where a piece ends."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for frame in in_batches(frames, 500):
        for lang, text in zip(frame.lang, frame.text):
            data = as_bytes(text).translate(_PIECE_BYTES)
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size >= BLOCK:
                for of, texts in held.items():
                    yield from ((of, b) for b in _cut(b"\n".join(texts)))
                held, size = {}, 0
    for of, texts in held.items():
        yield from ((of, b) for b in _cut(b"\n".join(texts)))


def _cut(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        to = len(data) if len(data) - at <= 2 * BLOCK else data.find(b"\n", at + BLOCK) + 1 or len(data)
        yield data[at:to]
        at = to


def _folded(words: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of words."""
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = mixed(out * np.uint64(_odd(5)) + w)
    return out


class Bitmap:
    """A set of 64-bit hashes that may hold others as well; at most 8 MB whatever its number of members."""

    def __init__(self, bits: int, cells: np.ndarray, values: np.ndarray) -> None:
        self.bits = bits
        self.cells = np.zeros(1 << bits - 6, np.uint64)
        self.cells[cells] = values

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.cells[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _folded_key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if not len(frame):
            continue
        keys = np.frombuffer(b"".join(frame.key), ">u8").astype(np.uint64).reshape(len(frame), -1)
        yield pd.DataFrame({"hash": _folded(list(keys.T)).view(np.int64)})


def bitmap(phrases: DataFrame, many: int) -> Bitmap:
    """Of the phrases' hashes, from (key), all of one length."""
    bits = min(max((16 * many).bit_length(), _BITMAP_BITS[0]), _BITMAP_BITS[1])
    slot = F.shiftrightunsigned("hash", 64 - bits)
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    cells = phrases.select("key").mapInPandas(_folded_key, "hash long").select(slot.alias("slot")).groupBy(
        F.shiftright("slot", 6).alias("cell")).agg(F.bit_or(one).alias("value"))
    # At most 2^20 rows.
    found = cells.toPandas()
    return Bitmap(bits, found["cell"].to_numpy(np.int64), found["value"].to_numpy(np.int64).view(np.uint64))


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new row of values begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(columns: list[np.ndarray]) -> bytes:
    return np.stack(columns, axis=1).astype(">u8").tobytes()


STRIPE = "lang string, prefix binary, part int, words binary, counts binary"


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """The stripes of the empty prefix: (lang, key, word, f, other), where `other` is another word with the same hash."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, data in _blocks(frames):
            words = Words(data, seed)
            if not len(words.hashes):
                continue
            check = words.others(seed)
            order = np.lexsort((check, words.hashes))
            begin = _runs([words.hashes[order], check[order]])
            first, many = order[begin], np.diff([*begin, len(order)])
            packed = _packed([words.hashes[first]])
            yield pd.DataFrame({
                "lang": lang, "key": [packed[i:i + 8] for i in range(0, len(packed), 8)],
                "word": [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist())], "n": many})

    counted = docs.mapInPandas(trimmed(work), "lang string, key binary, word binary, n long")
    return counted.groupBy("lang", "key").agg(
        F.sum("n").alias("f"), F.min("word").alias("word"), F.max("word").alias("other"))


def count_stripes(docs: DataFrame, n: int, seed: int, frequent: Bitmap, hot: np.ndarray) -> DataFrame:
    """The stripes of prefixes of n - 1 words, by block of text: (lang, prefix, part, words, counts)."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((frequent, hot))  # 8 MB and 131,072 hashes at most

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, hot = shared.value
        for lang, data in _blocks(frames):
            words = Words(data, seed)
            at = words.grams(n)
            shorter = frequent.has(_folded([words.hashes[i:len(words.hashes) - n + 2 + i] for i in range(n - 1)])) if len(at) else at
            at = at[shorter[at] & shorter[at + 1]] if len(at) else at
            grams = [words.hashes[at + i] for i in range(n)]
            del words, shorter, at
            order = np.lexsort(grams[::-1])
            grams = [g[order] for g in grams]
            begin = _runs(grams)
            if not len(begin):
                continue
            counts = np.diff([*begin, len(order)]).astype(">u4")
            grams = [g[begin] for g in grams]
            is_hot = np.isin(_folded(grams[:-1]), hot)
            part = np.where(is_hot, grams[-1] >> np.uint64(64 - HOT_PARTS_BITS), np.uint64(0))
            stripe = _runs([*grams[:-1], part])
            ends = [*stripe[1:].tolist(), len(part)]
            keys, nexts, many = _packed([g[stripe] for g in grams[:-1]]), grams[-1].astype(">u8").tobytes(), counts.tobytes()
            width = 8 * (n - 1)
            yield pd.DataFrame({
                "lang": lang, "prefix": [keys[i:i + width] for i in range(0, len(keys), width)],
                "part": part[stripe].astype(np.int32),
                "words": [nexts[8 * a:8 * b] for a, b in zip(stripe.tolist(), ends)],
                "counts": [many[4 * a:4 * b] for a, b in zip(stripe.tolist(), ends)]})

    return docs.mapInPandas(trimmed(work), STRIPE)


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, key, f) of the extensions of all prefixes that occur `least` times, from stripes of blocks."""
    def merged(lang: list, prefix: list, words: list, counts: list) -> Iterator[pd.DataFrame]:
        size = np.fromiter(map(len, counts), np.int64, len(counts)) // 4
        new = np.array([True, *(a != b or c != d for a, b, c, d in zip(prefix, prefix[1:], lang, lang[1:]))])
        first = np.flatnonzero(new)
        of = np.repeat(np.cumsum(new) - 1, size)
        word = np.frombuffer(b"".join(words), ">u8").astype(np.uint64)
        many = np.frombuffer(b"".join(counts), ">u4").astype(np.int64)
        order = np.lexsort((word, of))
        of, word, many = of[order], word[order], many[order]
        begin = _runs([of, word])
        total = np.add.reduceat(many, begin)
        keep = total >= least
        if not keep.any():
            return
        of, word = of[begin][keep].tolist(), word[begin][keep].astype(">u8").tobytes()
        yield pd.DataFrame({
            "lang": [lang[first[i]] for i in of], "key": [prefix[first[g]] + word[8 * i:8 * i + 8] for i, g in enumerate(of)],
            "f": total[keep]})

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list] = [[], [], [], []]
        last = None
        for frame in frames:
            columns = [frame[c].tolist() for c in ("lang", "prefix", "words", "counts", "part")]
            group = list(zip(columns[0], columns[1], columns[4]))
            if not group:
                continue
            # What belongs to the last prefix may go on in the next frame.
            cut = len(group)
            while cut > 0 and group[cut - 1] == group[-1]:
                cut -= 1
            if group[0] != last or cut > 0:
                done = [h + c[:cut] for h, c in zip(held, columns)]
                if done[0]:
                    yield from merged(*done)
                held = [c[cut:] for c in columns[:4]]
            else:
                held = [h + c for h, c in zip(held, columns)]
                held = _shrunk(held)
            last = group[-1]
        if held[0]:
            yield from merged(*held)

    def _shrunk(held: list[list]) -> list[list]:
        """The stripes of one prefix, added up once they are many."""
        if sum(map(len, held[3])) < 1 << 22:
            return held
        word = np.frombuffer(b"".join(held[2]), ">u8").astype(np.uint64)
        many = np.frombuffer(b"".join(held[3]), ">u4").astype(np.int64)
        order = np.argsort(word, kind="stable")
        begin = _runs([word[order]])
        total = np.add.reduceat(many[order], begin)
        word = word[order][begin]
        # Counts of over 32 bits are written as several.
        out: list[list] = [[], [], [], []]
        while len(word):
            now = np.minimum(total, (1 << 32) - 1)
            for o, v in zip(out, (held[0][0], held[1][0], word.astype(">u8").tobytes(), now.astype(">u4").tobytes())):
                o.append(v)
            word, total = word[total > now], (total - now)[total > now]
        return out

    dealt = stripes.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    return dealt.mapInPandas(trimmed(work), "lang string, key binary, f long")


def _hot(phrases: DataFrame, all_words: int) -> np.ndarray:
    """Hashes of the phrases that are over one part in HOT_SHARE of all words: at most that many."""
    some = phrases.where(F.col("f") * HOT_SHARE >= all_words).select("key").distinct().mapInPandas(_folded_key, "hash long")
    return np.sort(some.toPandas()["hash"].to_numpy(np.int64).view(np.uint64))


def frequencies(docs: DataFrame, longest: int = 3, least: int = 10, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) words; (lang, key, word) of the frequent words; (lang, key, length, f) of all phrases of up to `longest`
    words that occur `least` times. key is the hashes of the words, one after the other."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    while True:
        words = stage(count_words(texts, seed), "words")
        if words.where("word <> other").isEmpty():
            break
        seed += 7
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    phrases = stage(words.where(F.col("f") >= least).select("lang", "key", "f"), "phrases")
    known = phrases.withColumn("length", F.lit(1))
    all_words = words.agg(F.sum("f")).first()[0] or 0
    for n in range(2, longest + 1):
        many = phrases.count()
        if not many:
            break
        stripes = count_stripes(texts, n, seed, bitmap(phrases, many), _hot(phrases, all_words))
        phrases = stage(merge_stripes(stripes, least), "phrases")
        known = known.unionByName(phrases.withColumn("length", F.lit(n)))
    return totals, words.where(F.col("f") >= least).select("lang", "key", "word"), known


def _part(key: Column | str, first: Column | int, many: Column | int) -> Column:
    """`many` words of a key from word `first` (from 0) on."""
    key = F.col(key) if isinstance(key, str) else key
    whole = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.substring(key, whole(first) * WORD_BYTES + 1, whole(many) * WORD_BYTES)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, top: int | None = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best collocations of each language.

    Texts lose their capitals A-Z and are cut into pieces and words at the marks and blanks above; a null text is empty and
    a null lang is 'und', and the two are one language. Phrases of 2 to `longest` words with a >= `least` occurrences are
    cut after each of their words into parts of l and r occurrences; floor(1000000 a a / (l r)) of the lowest-scoring cut,
    of equal ones the earliest, is their score. Phrases that stand in a longer one with at least `inside` percent
    of their occurrences are left out. Ranks are by score and a, falling, then by the phrase's bytes; `top` of them are
    given, all if None. Repeated rows count each time; other columns are left out; no rows give none.
    """
    totals, words, known = frequencies(docs, longest, least)
    known = known.select("lang", "key", "length", "f")
    longer = known.where("length > 1")
    within = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("length") - 1),
        lambda m: F.transform(F.sequence(F.lit(0), F.col("length") - m), lambda i: F.struct(i.alias("first"), m.alias("many"))))))
    held = longer.where("length > 2").select("lang", "key", "f", within.alias("at")).groupBy(
        "lang", _part("key", F.col("at.first"), F.col("at.many")).alias("key")).agg(F.max("f").alias("most"))
    left = longer.join(held, ["lang", "key"], "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * inside))
    cuts = left.select("lang", "key", "length", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    side = lambda name: known.select("lang", F.col("key").alias(f"{name}_key"), F.col("f").alias(name))
    cuts = cuts.withColumns({"l_key": _part("key", 0, F.col("k")), "r_key": _part("key", F.col("k"), F.col("length") - F.col("k"))})
    cuts = cuts.join(side("l"), ["lang", "l_key"]).join(side("r"), ["lang", "r_key"])
    wide = lambda c: F.col(c).cast("decimal(14,0)")
    scored = cuts.withColumn("_top", wide("a") * wide("a") * F.lit(1000000).cast("decimal(7,0)")).withColumn("_low", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("_top div _low"))
    best = scored.groupBy("lang", "key", "length", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = stage(best.select("lang", "key", "length", "a", "cut.score", "cut.l", "cut.r"), "scored")
    if top is not None:
        # Ties with the last of the best go on to the ranking by phrase.
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= top).drop("_rank")
    spelled = best.select("lang", F.col("key").alias("_key"), F.posexplode(F.sequence(F.lit(0), F.col("length") - 1)).alias("i", "_i")).select(
        "lang", "_key", "i", _part("_key", F.col("i"), 1).alias("key")).join(words, ["lang", "key"])
    spelled = spelled.groupBy("lang", F.col("_key").alias("key")).agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    text = F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ")
    named = best.join(spelled.select("lang", "key", text.alias("phrase")), ["lang", "key"])
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(by).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
