"""Near duplicates: 64-bit SimHash fingerprints, linked at two or fewer differing bits by Golay-code fuzzy hashing.

A fingerprint is cut into segments of 23, 23 and 18 bits. With two errors in three segments, one segment has none. The next
segment is decoded with the binary Golay code (23, 12): every 23-bit word lies within 3 bits of exactly one codeword. Two
words at most 2 bits apart have a word half-way, 1 bit from each, so the codeword nearest to that one is within 4 bits of
both. Every fingerprint therefore gets, for each of its segments, that segment with the index of each codeword within 4
bits of the next segment (5 on average), and all pairs to be linked share such a key. Pairs that share a key are
verified. Copies share a fingerprint, so only different fingerprints are compared.

Where more than `group_most` fingerprints share a key, no pairs are formed: each of these fingerprints gets its 64
neighbours at one bit and itself as keys, and all that share such a neighbour are within two bits of each other, so a star
of links from the smallest joins them. Nothing is lost, and the links stay in proportion to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.components import connected_components, of_few
from tallykeep.llm.shared import as_bytes, in_batches, release, stage, trimmed, word_hashes

#: Generator of the binary Golay code (23, 12): x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011
_PARITY_BITS = 11
MAX_DISTANCE = 2

#: The bits of six parts of a code, and every two of them: two codes at most 2 bits apart are equal but for two parts.
_PARTS = [np.int64(np.uint64((1 << to) - (1 << at)).view(np.int64)) for at, to in pairwise((0, 11, 22, 33, 43, 53, 64))]
_COMBOS = list(combinations(range(6), 2))
#: Of 128 bins, so that a pair of similarity 0.8 is as far (six standard errors) above it as above 0.65 of 256 bins.
_BRIEF_BITS, _BRIEF_LEAST = 7, 0.58
#: What a task keeps of what it found before it hands it on.
_HELD_ROWS = 1 << 18


def fingerprint(text: str | None, shingle: int = 3) -> bytes:
    """SimHash of a text's word shingles, 8 bytes, most significant first: a bit is set if it is in over half of them."""
    words = as_bytes(text).lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_digest
    hashes = b"".join([
        digest(joined[a:b], 42) for a, b in zip(starts[:last].tolist(), ends[len(words) - last:].tolist())])
    counts = np.zeros(64, np.int64)
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, last, 65536):
        counts += np.unpackbits(bits[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > last).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, code) of every row; a null text is an empty one, whose code is 0."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            codes = b"".join([fingerprint(text, shingle) for text in frame.text])
            yield pd.DataFrame({
                "doc_id": frame.doc_id.astype("Int64"), "text_hash": frame.text_hash,
                "code": np.frombuffer(codes, ">i8").astype(np.int64)})

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInPandas(work, "doc_id long, text_hash long, code long")


def _remainder(word: int) -> int:
    for bit in range(word.bit_length() - 1, _PARITY_BITS - 1, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << bit - _PARITY_BITS
    return word


def _near_patterns(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """By remainder: the error patterns of up to `radius` bits, one row each, and their number."""
    by: list[list[int]] = [[] for _ in range(1 << _PARITY_BITS)]
    unit = [_remainder(1 << b) for b in range(23)]
    for n in range(radius + 1):
        for bits in combinations(range(23), n):
            rest = 0
            for b in bits:
                rest ^= unit[b]
            by[rest].append(sum(1 << b for b in bits))
    many = np.array([len(x) for x in by])
    table = np.zeros((len(by), many.max()), np.int64)
    for i, x in enumerate(by):
        table[i, :len(x)] = x
    return table, many


def golay_indices(segments: np.ndarray, radius: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: (row, index) of every codeword within `radius` bits of a word."""
    table, many = _near_patterns(radius)
    heads = np.array([_remainder(x << _PARITY_BITS) for x in range(1 << 12)])
    rest = heads[segments >> _PARITY_BITS] ^ (segments & (1 << _PARITY_BITS) - 1)
    row = np.repeat(np.arange(len(segments)), many[rest])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many[rest]) - many[rest], many[rest])
    return row, (segments[row] ^ table[rest[row], nth]) >> _PARITY_BITS


def golay_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of the 64-bit codes."""
    bits = codes.astype(np.int64).view(np.uint64)
    cut = [(bits >> np.uint64(41)).astype(np.int64), (bits >> np.uint64(18)).astype(np.int64) & 0x7FFFFF,
           bits.astype(np.int64) & 0x3FFFF]
    rows, keys = [], []
    for i in range(3):
        row, index = golay_indices(cut[(i + 1) % 3])
        rows.append(row)
        keys.append((i << 35) | (cut[i][row] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def _meetings(codes: DataFrame, group_most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (view, a, b) of codes at most 2 bits apart; of those with a key of over `group_most` (view, code, middle),
    where two that are at most 2 bits apart share a middle; and the table that both are read from."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            code, view = frame.code.to_numpy(), frame["view"].to_numpy(np.int64)
            row, key = golay_keys(code)
            yield pd.DataFrame({"key": view[row] << 37 | key, "view": view[row], "code": code[row]})

    keys = stage(codes.select("view", "code").mapInPandas(work, "key long, view int, code long"), "golay_keys")
    sizes = keys.groupBy("key").count().where("count > 1")
    shared = stage(keys.join(sizes, "key"), "shared_keys")
    release(keys)
    few = shared.where(F.col("count") <= group_most)
    pairs = few.select("key", "view", F.col("code").alias("a")).join(
        few.select("key", F.col("code").alias("b")), "key").where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE))
    many = shared.where(F.col("count") > group_most).select("view", "code").distinct()
    around = F.explode(F.array(F.col("code"), *[
        F.col("code").bitwiseXOR(F.lit(v).cast("long")) for v in np.left_shift(1, np.arange(64)).tolist()]))
    return pairs.select("view", "a", "b"), many.select("view", "code", around.alias("middle")), shared


def _starred(pairs: DataFrame, neighbours: DataFrame) -> DataFrame:
    least = neighbours.groupBy("view", "middle").agg(F.min("code").alias("least"))
    stars = neighbours.join(least, ["view", "middle"]).where("code <> least").select(
        "view", F.col("least").alias("a"), F.col("code").alias("b"))
    return pairs.union(stars).distinct()


def links(codes: DataFrame, group_most: int = 64) -> DataFrame:
    """Links (view, a, b) between different codes of a view: every two at most 2 bits apart are linked or in one star.

    `codes` is (view, code), each pair once; views are small numbers, and all are handled at once.
    """
    return _starred(*_meetings(codes, group_most)[:2])


def groups(docs: DataFrame, shingle: int = 3, group_most: int = 64) -> DataFrame:
    """(doc_id, text_hash, code, component_id) of every row of `docs`.

    component_id is the smallest doc_id reachable over links; null where all doc_ids of the component are null.
    Rows that repeat a doc_id are documents of their own. Empty and null texts have code 0 and are linked like others.
    """
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    codes = prints.groupBy("code").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(codes.withColumn("view", F.lit(0)), group_most).select("a", "b"))
    rooted = codes.join(roots, F.col("code") == F.col("node"), "left").select(
        "code", "least", F.coalesce("root", "code").alias("root"))
    rooted = stage(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("code", "root", "component_id"), "code")


def views(words: np.ndarray, many: int) -> list[int]:
    """`many` SimHash fingerprints of word hashes, with repeats, each from other bits."""
    out = []
    for v in range(many):
        x = (words ^ np.uint64(v * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        bits = (x ^ (x >> np.uint64(29))).view(np.uint8).reshape(-1, 8)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(bits), 65536):
            counts += np.unpackbits(bits[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(counts * 2 > max(len(words), 1)).view(np.int64)[0]))
    return out


def shingles(words: np.ndarray, shingle: int) -> np.ndarray:
    """The different hashes of the word shingles of a text, sorted; a text of fewer words is one shingle, without any none."""
    n = max(1, len(words) - shingle + 1) if len(words) else 0
    h = np.zeros(n, np.uint64)
    for j in range(min(shingle, len(words))):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h ^ (h >> np.uint64(32)))


def packed(h: np.ndarray) -> bytes:
    """The first half of sorted hashes, each once: of two texts of 1,000 shingles, one in 2,000 pairs has two that are alike."""
    return np.unique((h >> np.uint64(32)).astype("<u4")).tobytes()


def sketch(h: np.ndarray, bits: int = 8) -> bytes:
    """One-permutation MinHash of sorted shingles: a byte for the smallest hash of each of 2^bits bins, 0 if empty."""
    bins, first = np.unique(h >> np.uint64(64 - bits), return_index=True)
    out = np.zeros(1 << bits, np.uint8)
    out[bins.astype(np.int64)] = (h[first] * np.uint64(0xA0761D6478BD642F) >> np.uint64(56)) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def jaccard(x: bytes, y: bytes, least: float) -> bool:
    """Whether two sets of shingles (sorted 4-byte hashes) share at least that part of their union."""
    few, all_of = sorted((len(x) // 4, len(y) // 4))
    if not few or few < least * all_of:
        return False
    both = len(np.intersect1d(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), assume_unique=True))
    return both >= least * (few + all_of - both)


def _of_nodes(table: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of `table` with these nodes, of a stored table. Up to 2^20 nodes, 8 MB, are broadcast, so that the others aren't moved."""
    return table.join(F.broadcast(nodes) if nodes.count() <= 1 << 20 else nodes.distinct(), "node", "left_semi")


def _ends(pairs: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    """The stored pairs (a, b) with the `column` of their texts as x and y: only those of texts in pairs are moved."""
    x, y = (_of_nodes(texts.select("node", column), pairs.select(F.col(end).alias("node"))).select(
        F.col("node").alias(end), F.col(column).alias(name)) for end, name in (("a", "x"), ("b", "y")))
    return x.join(of_few(pairs, pairs.count()), "a").join(y, "b").select("a", "b", "x", "y")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The stored pairs (a, b) whose shingles have a Jaccard similarity of `least`."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.loc[[jaccard(x, y, least) for x, y in zip(frame.x, frame.y)], ["a", "b"]]

    return _ends(pairs, sets, "shingles").mapInPandas(work, "a long, b long")


def _similar(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The stored pairs (a, b) whose sketches estimate a Jaccard similarity of `least`."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x, y = (np.frombuffer(b"".join(frame[c]), np.uint8).reshape(-1, 256) for c in ("x", "y"))
            yield frame.loc[_estimates(x, y) >= least, ["a", "b"]]

    return _ends(pairs, sketches, "sketch").mapInPandas(work, "a long, b long")


def _block_keys(view: str, code: str) -> Column:
    """(combo, key) of the four parts that are left of a code without each two of six: two codes at most 2 bits apart share one."""
    left = [~(_PARTS[p] | _PARTS[q]) for p, q in _COMBOS]
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias("combo"), F.xxhash64(view, F.lit(c), F.col(code).bitwiseAND(F.lit(int(mask)).cast("long"))).alias("key"))
        for c, mask in enumerate(left)]))


def _first_met(differ: np.ndarray, combo: int) -> np.ndarray:
    """Whether codes that differ in these bits, two at most, meet at no key of a lower combo: a pair is looked at once."""
    p, q = _COMBOS[combo]
    met = np.ones(differ.shape, bool)
    if p:
        met &= differ & _PARTS[p] != 0
    if q > 1:
        met &= differ & _PARTS[q] != 0
    return met


def _estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The estimated Jaccard similarities of the sketches in the rows of x and y."""
    shared, either = ((x == y) & (x > 0)).sum(axis=1), ((x > 0) | (y > 0)).sum(axis=1)
    return shared / np.maximum(either, 1)


def _alike(r, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, estimate) of the texts of two blocks, or two of one, that are of different components, at most 2 bits apart, first
    met at this key and estimated at `least`. Those that are as near in an earlier view were compared there."""
    within = r.node_b is None
    code, root, sketches, prints = (
        {x: getattr(r, f"{c}_{'a' if within else x}") for x in ("a", "b")} for c in ("code", "root", "sketch", "prints"))
    sketches = {x: np.frombuffer(b"".join(y), np.uint8).reshape(len(y), -1) for x, y in sketches.items()}
    prints = {x: np.frombuffer(b"".join(y), np.uint64).reshape(len(y), -1) for x, y in prints.items()}
    view, combo = divmod(r.combo, len(_COMBOS))
    differ = np.asarray(code["a"])[:, None] ^ np.asarray(code["b"])
    met = (np.bitwise_count(differ.view(np.uint64)) <= MAX_DISTANCE) & (np.asarray(root["a"])[:, None] != np.asarray(root["b"]))
    met &= _first_met(differ, combo)
    i, j = np.nonzero(np.triu(met) if within else met)
    new = np.ones(len(i), bool)
    for v in range(view):
        new &= np.bitwise_count(prints["a"][i, v] ^ prints["b"][j, v]) > MAX_DISTANCE
    i, j = i[new], j[new]
    found = [np.zeros(0)]
    for at in range(0, len(i), 65536):
        found.append(_estimates(sketches["a"][i[at:at + 65536]], sketches["b"][j[at:at + 65536]]))
    estimate = np.concatenate(found)
    keep = estimate >= least
    return i[keep], j[keep], estimate[keep]


def _placed(members: DataFrame, size: int) -> DataFrame:
    """(key, combo, node, code, root, parts): the members of keys that have some of different components, stored, with the number of
    blocks of about `size` of their key."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    parts = sizes.where("low < high").select("key", F.ceil(F.col("n") / size).alias("parts"))
    return stage(members.join(parts, "key"), "placed")


def _blocks(placed: DataFrame, extra: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The texts of each key of `placed` in its blocks: each block alone (the columns of b are null) and every two of a key; and
    the stored table that they are read from.

    A key of many texts is many rows of small size, and most keys are one block.
    """
    columns = ["node", "code", "root", *columns]
    dealt = placed.join(extra, "node").withColumn("nth", F.pmod(F.xxhash64("node"), "parts"))
    blocks = dealt.groupBy("key", "combo", "parts", "nth").agg(F.collect_list(F.struct(*columns)).alias("m"))
    blocks = stage(blocks.select("key", "combo", "parts", "nth", *[F.col(f"m.{c}").alias(c) for c in columns]), "blocks")
    many = blocks.where("parts > 1")
    kinds = dict(blocks.dtypes)
    a = ["key", "combo", *[F.col(c).alias(f"{c}_a") for c in columns]]
    alone = blocks.select(*a, *[F.lit(None).cast(kinds[c]).alias(f"{c}_b") for c in columns])
    side = many.select("key", F.col("nth").alias("nth_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    two = many.select(*a, "nth").join(side, "key").where("nth < nth_b")
    return alone.union(two.select(*alone.columns)), blocks


def _likest(met: DataFrame, least: float, held: int = _HELD_ROWS) -> DataFrame:
    """(key, combo, node, code, estimate, other) of every text with an estimate of `least` to one of another component that it
    meets at this key: its likest such text.

    The blocks of a key come to a task one after the other, and a text is one row for all of them, so that rows are in
    proportion to the texts of a key and not to its pairs of blocks. Only beyond `held` rows does a task hand on what it has so far.
    """
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame()
        for frame in frames:
            out = [best]
            for r in frame.itertuples(index=False):
                i, j, estimate = _alike(r, least)
                if not len(i):
                    continue
                x, y = (np.asarray(c) for c in (r.node_a, r.node_a if r.node_b is None else r.node_b))
                code = np.concatenate([np.asarray(r.code_a)[i], np.asarray(r.code_a if r.node_b is None else r.code_b)[j]])
                found = pd.DataFrame({
                    "node": np.concatenate([x[i], y[j]]), "code": code, "estimate": np.tile(estimate, 2),
                    "other": np.concatenate([y[j], x[i]])})
                out.append(found.sort_values("estimate").drop_duplicates("node", keep="last").assign(key=r.key, combo=r.combo))
            if len(out) > 1:
                best = pd.concat(out) if len(best) else pd.concat(out[1:])
                best = best.sort_values("estimate").drop_duplicates(["key", "node"], keep="last")
            if len(best) > held:
                # The last key may go on in the next frame; it is kept unless it is most of the rows.
                going = (best["key"] == r.key).to_numpy()
                going &= going.sum() <= held // 2
                yield best.loc[~going, ["key", "combo", "node", "code", "estimate", "other"]]
                best = best[going]
        if len(best):
            yield best[["key", "combo", "node", "code", "estimate", "other"]]

    return met.mapInPandas(work, "key long, combo int, node long, code long, estimate double, other long")


def _linked(met: DataFrame, loose: float, least: float) -> DataFrame:
    """Links (a, b) with a similarity of `least` between texts of different components, as many as join the components
    in each pair of blocks."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for r in frame.itertuples(index=False):
                i, j, estimate = _alike(r, loose)
                root, node, sets = (
                    (x, x if r.node_b is None else y)
                    for x, y in ((r.root_a, r.root_b), (r.node_a, r.node_b), (r.shingles_a, r.shingles_b)))
                part = {x: x for x in (*root[0], *root[1])}
                for at in np.argsort(-estimate, kind="stable").tolist():
                    p, q = root[0][i[at]], root[1][j[at]]
                    while part[p] != p:
                        p = part[p]
                    while part[q] != q:
                        q = part[q]
                    if p != q and jaccard(sets[0][i[at]], sets[1][j[at]], least):
                        part[max(p, q)] = min(p, q)
                        found.append((node[0][i[at]], node[1][j[at]]))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return met.mapInPandas(work, "a long, b long")


class _Copies:
    """The components that links found so far make of the texts of one `texts` table (node, codes, prints, sketch, brief, shingles)."""

    def __init__(self, texts: DataFrame, group_most: int, similarity: float, loose: float) -> None:
        self.texts, self.group_most, self.similarity, self.loose = texts, max(group_most, 16), similarity, loose
        self.sets = texts.select("node", "shingles")
        self.roots = stage(texts.sparkSession.createDataFrame([], "node long, root long"), "roots")

    def add(self, links: DataFrame) -> None:
        """Links join components: those of the components that they join are looked for, not those of all texts again."""
        links = stage(links, "verified")
        rows = links.count()
        if rows:
            last = self.roots
            ends = links.select(F.col("a").alias("node")).union(links.select("b"))
            known = last.join(of_few(ends, 2 * rows), "node", "left_semi")
            joined = links
            for end in ("a", "b"):
                root = known.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
                joined = joined.join(of_few(root, 2 * rows), end, "left")
            joined = connected_components(joined.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
            joined = joined.select(F.col("node").alias("root"), F.col("root").alias("joined"))
            both = last.union(ends.select("node", F.col("node").alias("root")))
            both = both.groupBy("node").agg(F.max(F.when(F.col("root") != F.col("node"), F.col("root"))).alias("root"))
            self.roots = stage(both.select("node", F.coalesce("root", "node").alias("root")).join(
                of_few(joined, 2 * rows), "root", "left").select("node", F.coalesce("joined", "root").alias("root")), "roots")
            release(last)
        release(links, shuffles=True)

    def add_alike(self, found: DataFrame) -> None:
        """Link the pairs (node, other) that have the similarity."""
        found = stage(found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")), "found")
        pairs = stage(_similar(found, self.texts, self.loose), "pairs")
        release(found)
        self.add(_verified(pairs, self.sets, self.similarity))
        release(pairs)

    def rooted(self, coded: DataFrame) -> DataFrame:
        return stage(coded.join(self.roots, "node", "left").select(
            "view", "code", "node", F.coalesce("root", "node").alias("root")), "rooted")

    def apart(self, views: list[int]) -> DataFrame:
        """The texts at keys of these views that have some of different components, with the smallest text of the key."""
        code = F.explode(F.array(*[F.struct(F.lit(v).alias("view"), F.col("codes")[v].alias("code")) for v in views])).alias("c")
        first = self.rooted(self.texts.select("node", code).select("node", "c.view", "c.code"))
        keyed = first.select("node", "root", "code", "view", _block_keys("view", "code").alias("k")).select(
            "node", "root", "code", (F.col("view") * len(_COMBOS) + F.col("k.combo")).alias("combo"), "k.key")
        apart = keyed.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("head"),
            F.min_by("code", "node").alias("head_code"), F.min_by("root", "node").alias("head_root")).where("low < high")
        shared = stage(keyed.join(apart.select("key", "head", "head_code", "head_root"), "key"), "shared_keys")
        release(first)
        return shared

    def look(self, views: list[int]) -> None:
        """Link all texts that meet in these views: each with the first of a key, then what is left in different components, in
        blocks of the texts of a key."""
        shared = self.apart(views)
        if shared.isEmpty():
            release(shared, shuffles=True)
            return
        # One pair a text, so that pairs are in proportion to texts however many meet at a key.
        bits = F.bit_count(F.col("code").bitwiseXOR(F.col("head_code")))
        nearest = shared.where(F.col("root") != F.col("head_root")).groupBy("node").agg(*[
            F.min(F.when(bits == n, F.col("head"))).alias(f"at_{n}") for n in range(MAX_DISTANCE + 1)])
        head = F.coalesce(*[f"at_{n}" for n in range(MAX_DISTANCE + 1)])
        self.add_alike(nearest.select("node", head.alias("other")).where("other IS NOT NULL"))
        members = shared.select("key", "combo", "node", "code").join(self.roots, "node", "left").select(
            "key", "combo", "node", "code", F.coalesce("root", "node").alias("root"))
        placed = _placed(members, 4 * self.group_most)
        met, blocks = _blocks(placed, self.texts.select("node", F.col("brief").alias("sketch"), "prints"), ["sketch", "prints"])
        release(shared, placed)
        likest = stage(_likest(met, _BRIEF_LEAST), "likest")
        release(blocks)
        if not likest.isEmpty():
            # Only these can still be linked; first each to the likest, which leaves few components to compare in full.
            best = likest.groupBy("node").agg(F.max(F.struct("estimate", "other")).alias("best"))
            self.add_alike(best.select("node", "best.other"))
            members = likest.select("key", "combo", "node", "code").distinct().join(self.roots, "node", "left").select(
                "key", "combo", "node", "code", F.coalesce("root", "node").alias("root"))
            placed = _placed(members, self.group_most // 4)
            both = _of_nodes(self.texts.select("node", "sketch", "prints", "shingles"), placed.select("node"))
            met, blocks = _blocks(placed, both, ["sketch", "prints", "shingles"])
            release(placed)
            self.add(_linked(met, self.loose, self.similarity))
            release(blocks)
        release(likest, shuffles=True)


def near_copies(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, many: int = 8, group_most: int = 64, loose: float = 0.65,
    together: int = 1 << 17,
) -> DataFrame:
    """(doc_id, node, root): groups of texts that are alike, whatever the length of the chain between them.

    Single fingerprints miss most copies in which a word in fifty differs, so a text has `many`, over its words. Texts whose
    fingerprints are equal or at most 2 bits apart in any of them are candidates: cut into six parts, they share four. One view
    of fingerprints is looked at after the other: a pair for each text is verified first; then every two candidates that links
    leave in different components are compared where they meet, in blocks of about 4 x `group_most` texts, so what is left out
    can't change a group, and no join makes a row for each pair. The next views only see texts whose fingerprint meets that of
    another component. A link stands if the sets of different `shingle`-word shingles of its texts have a Jaccard
    similarity of at least `similarity`. Sketches of them only keep pairs from that test whose estimate, with a standard
    error of 0.025 at 0.8, is below `loose`; short ones, with 0.05, drop most others as they meet. node is the text's 64-bit hash, so equal texts are one; of
    10^9 different texts, 0.03 pairs share one. Tables between the steps are deleted as soon as they are read. Of up to
    `together` texts the views after the first are looked at in two turns instead of four: the groups are the same, and the
    driver plans, and keeps the records of, fewer jobs.
    """
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_batches(frames, 500):
            words = word_hashes(list(frame.text))
            codes, sets = [views(w, many) for w in words], [shingles(w, shingle) for w in words]
            yield pd.DataFrame({
                "node": frame.node, "codes": codes, "prints": [np.array(c, np.int64).tobytes() for c in codes], "sketch": [sketch(h) for h in sets],
                "brief": [sketch(h, _BRIEF_BITS) for h in sets], "shingles": [packed(h) for h in sets]})

    node = F.xxhash64(F.coalesce("text", F.lit("")))
    seen = docs.select(node.alias("node"), "text").mapInPandas(
        trimmed(work), "node long, codes array<long>, prints binary, sketch binary, brief binary, shingles binary")
    texts = stage(seen.groupBy("node").agg(*[F.first(c).alias(c) for c in ("codes", "prints", "sketch", "brief", "shingles")]), "texts")
    copies = _Copies(texts, group_most, similarity, loose)
    # The first view finds most copies; later ones have little left to do and go two by two, those of few texts in halves.
    if texts.limit(together + 1).count() <= together:
        turns = [[0], list(range(1, many // 2)), list(range(max(1, many // 2), many))]
    else:
        turns = [[0], [1], *[list(range(v, min(v + 2, many))) for v in range(2, many, 2)]]
    for some in turns:
        if some and some[0] < many:
            copies.look(some)
    release(texts)
    return docs.select("doc_id", node.alias("node")).join(copies.roots, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without near copies, found by `near_copies`: of each group the row with the smallest doc_id
    stays (null ids come last; among equal ids the smallest text hash; of equal rows one). Null and empty texts are
    copies of each other."""
    node = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = stage(near_copies(docs, **options), "groups")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_id"), F.col("first.node").alias("_node"))
    numbered = docs.withColumn("_own", node)
    kept = numbered.join(first, numbered["doc_id"].eqNullSafe(first["_id"]) & (F.col("_own") == F.col("_node")), "left_semi")
    if rows.groupBy("doc_id", "node").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id", "_own"])
    return kept.drop("_own")
