"""The operators against plain versions, and on nulls, empty and long texts, ties, repeated rows and other columns."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import rows
from tallykeep.llm import (
    chat, components, decontaminate, language_model, licenses, packing, quality, search, shared, simhash, suffixes, tokens,
    toxicity,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, code string, n long, rank int, key long, label int, words string"


def docs_of(spark, texts, schema=DOCS):
    """Rows with columns of names that the operators use themselves."""
    return spark.createDataFrame([(i, t, "c", 7, 1, 2, 3, "w") for i, t in texts], schema)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "x"), (4, "x"), (4, "y"), (None, "no id"), (None, "no id"), (None, None),
       (5, "word " * 5000), (6, "é😀 " * 50), (7, "all rights reserved. " * 3), (8, "\x00\x1c  a")]


@pytest.fixture
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture
def nothing(spark):
    return docs_of(spark, [])


# -- 1: packing


def test_tokens_are_those_of_tokenizers():
    texts = ["", " ", "  a  b \n c  d <|endoftext|> 's  ", "é😀 x\x85y", "I'll we've 12 34,56!! ..\t\t z", "a" * 3000]
    plain = Tokenizer.from_file(BPE)
    wanted = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(tokens.Ids(BPE).packed(texts)) == wanted
    assert np.frombuffer(next(tokens.Ids(BPE).packed(["a<|endoftext|><|endoftext|> b"])), "<u4").tolist()[1:3] == [50256] * 2
    other = public_tokenizers.path("word_bpe_49k.json")
    lower = Tokenizer.from_file(other)
    assert list(tokens.Ids(other).packed(["Some WORDS"])) == [
        np.array(lower.encode("Some WORDS", add_special_tokens=False).ids, "<u4").tobytes()]


def test_pieces_and_sequences(spark, odd):
    got = packing.pack_documents(odd, BPE, 64).toPandas()
    plain = Tokenizer.from_file(BPE)
    wanted = []
    for doc_id, text in ODD:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cut = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        wanted += [(doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cut, cut[1:]))]
    found = [(None if r[0] != r[0] else int(r[0]), *map(int, r[1:])) for r in got[
        ["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (by.length.sum() <= 64).all()
    assert (by.length.cumsum() - got.length == got.offset).all()
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 64) + 1


def test_packing_of_many_equal_lengths_in_groups(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "case when id % 3 > 0 then 40 else 1 + id % 60 end as length")
    some = packing.pack(pieces, 64, group_rows=100).toPandas()
    assert len(some) == 5000 and (some.groupby("sequence_id").length.sum() <= 64).all()
    ordered = some.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert some.sequence_id.nunique() == packing.pack(pieces, 64).select("sequence_id").distinct().count()
    with pytest.raises(ValueError):
        packing.pack(pieces, 50)


def test_best_fit_takes_the_smallest_gap():
    given = packing.best_fit({6: 1, 5: 1, 4: 1, 3: 1}, 10)
    assert sorted(given) == [(3, 0, 1, 5), (4, 0, 0, 6), (5, 0, 1, 0), (6, 0, 0, 0)]
    assert packing.best_fit({}, 10) == []


# -- 2: licenses


def test_license_spans(spark):
    texts = [
        (1, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights reserved"), (2, "cc cc by by"),
        (3, "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software and "
            "associated documentation files"), (4, "general public\x00license GNU GENERAL PUBLIC  LICENSE"),
        (5, "İCC BY É all rights"), *[(10 + i, t) for i, (_, t) in enumerate(ODD)],
    ]
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        n, places = brute.phrase_places(text)
        assert got[i].n_words == n
        assert sorted((s.start, s.label) for s in got[i].spans if s.base) == places
    assert [s.label for s in got[3].spans] == ["mit"] and got[3].spans[0].share == 1.0
    assert {s.label for s in got[1].spans} == {"cc-by", "cc-by-nc", "reserved"}


def test_license_scan_keeps_repeated_and_odd_rows(odd, nothing):
    got = licenses.scan(odd)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i, _ in ODD)
    assert licenses.scan(nothing).collect() == []


def test_license_scan_of_a_long_text(spark):
    text = " ".join("CC by" if i % 50 == 0 else f"w{i % 977}" for i in range(100_000))
    got = licenses.scan(docs_of(spark, [(1, text)])).first()
    n, places = brute.phrase_places(text)
    assert got.n_words == n and sorted((s.start, s.label) for s in got.spans if s.base) == places


# -- texts of one id


def test_texts_of_one_id_are_numbered_by_hash(spark):
    texts = [*[(5, f"t{i}") for i in range(50)], (5, "t0"), (4, None), (9, "a"), (9, "a"), (7, "b"), (7, "c"), (None, "x")]
    docs = docs_of(spark, texts).withColumnRenamed("n", "n_").withColumn("h", F.xxhash64("text"))
    found = {(r.doc_id, r.h): r.n for r in shared.numbered(docs, group_rows=3).collect()}
    by_id = collections.defaultdict(list)
    for doc_id, h in sorted(k for k in found if k[0] is not None):
        by_id[doc_id].append(h)
    assert {k: n for k, n in found.items() if k[0] is not None} == {
        (i, h): 50 * i + at for i, hashes in by_id.items() for at, h in enumerate(hashes)}
    assert all(n < 0 for (i, _), n in found.items() if i is None)


# -- 3: language model


def _plain_scores(texts):
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(t or "")) for _, t in texts]
    own1 = [collections.Counter(["<s>", *w, "</s>"]) for w in words]
    own2 = [collections.Counter(zip(["<s>", *w], [*w, "</s>"])) for w in words]
    one, two = sum(own1, collections.Counter()), sum(own2, collections.Counter())
    total = sum(one.values()) - one["<s>"]
    out = []
    for (doc_id, _), w, a, b in zip(texts, words, own1, own2):
        score = missed = 0
        for (v, x), n in b.items():
            seen = two[v, x] - n
            if seen > 0:
                score += n * math.log(seen / max(one[v] - a[v], 1))
            else:
                missed += n
                score += n * math.log(0.4 * max(one[x] - a[x], 0.5) / max(total - len(w) - 1, 1))
        out.append((doc_id, len(w), round(score / (len(w) + 1), 9), round(missed / (len(w) + 1), 9)))
    return out


def test_scores_of_odd_rows(odd, nothing):
    got = language_model.scores(odd).collect()
    found = [(r.doc_id, r.n_words, round(r.score, 9), round(r.unseen, 9)) for r in got]
    assert sorted(found, key=repr) == sorted(_plain_scores(ODD), key=repr)
    assert language_model.scores(nothing).collect() == []


# -- 4: quality


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(3)
    good, move = rng.normal(size=5), rng.normal(size=(2, 2))
    p, moves = quality.marginals(good, np.zeros(5, np.int64), move)
    weight = collections.Counter()
    for code in range(32):
        y = [code >> i & 1 for i in range(5)]
        w = math.exp(sum(g for g, v in zip(good, y) if v) + sum(move[a, b] for a, b in zip(y, y[1:])))
        weight["all"] += w
        for i, v in enumerate(y):
            weight[i] += w * v
        for a, b in zip(y, y[1:]):
            weight[a, b] += w
    assert np.allclose(p, [weight[i] / weight["all"] for i in range(5)])
    assert np.allclose(moves, [[weight[a, b] / weight["all"] for b in (0, 1)] for a in (0, 1)])
    both, _ = quality.marginals(np.tile(good, 2), np.repeat([0, 1], 5), move)
    assert np.allclose(both, np.tile(p, 2))


def _labelled(spark, n=120):
    texts = [(i, f"plain words about thing {i}.\nAnd more of them here.\n" if i % 3 else f"BUY!!! $$$ {i} ***\n$$$ !!!\n")
             for i in range(n)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), int(i % 3 == 0), "x") for i in range(n)] + [(5, None, None, "x"), (None, 1, 0, "x")],
        "doc_id long, quality int, toxic int, text string")
    return texts, labels


def test_quality_is_learned(spark, nothing):
    texts, labels = _labelled(spark)
    got = quality.score(docs_of(spark, texts + [(1000, None), (1001, "\n \n")]), labels).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.quality <= 1
        if r.doc_id < 1000:
            assert (r.quality >= 0.3) == (r.doc_id % 3 > 0)
    none = quality.score(docs_of(spark, texts[:3]), labels.where("false")).collect()
    assert {r.quality for r in none} == {0.5}
    assert quality.score(nothing, labels).collect() == []


# -- 5: SimHash


def test_golay_keys_meet():
    rng = np.random.default_rng(1)
    codes = rng.integers(-2**63, 2**63 - 1, 300)
    for flips in (0, 1, 2):
        other = codes.copy()
        for bits in (rng.permuted(np.tile(np.arange(64), (300, 1)), axis=1)[:, :flips]).T:
            other ^= np.left_shift(np.int64(1), bits)
        (a, x), (b, y) = simhash.golay_keys(codes), simhash.golay_keys(other)
        for i in range(300):
            assert set(x[a == i]) & set(y[b == i])


def test_simhash_groups(spark, odd, nothing):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(["a", "b", "cc", "dd", "e"], 200)) for _ in range(3)]
    texts = []
    for i in range(60):
        words = base[i % 3].split(" ")
        words[int(rng.integers(200))] = "Z"
        texts.append((100 + i, " ".join(words)))
    texts += [(i, t) for i, t in ODD if i is not None and i != 4]
    codes = {i: brute.simhash(t) for i, t in texts}
    wanted = brute.components(codes)
    for most in (0, 3, 64):
        got = simhash.groups(docs_of(spark, texts), group_most=most).collect()
        assert {r.doc_id: (r.code & (1 << 64) - 1, r.component_id) for r in got} == {
            i: (codes[i], wanted[i]) for i, _ in texts}
    assert simhash.groups(odd).count() == len(ODD)
    assert simhash.groups(nothing).collect() == []


def test_near_copies_leave_one(spark, odd, nothing):
    rng = np.random.default_rng(4)
    word = [f"w{i}" for i in range(500)]
    texts = []
    for g in range(12):
        base = list(rng.choice(word, 300))
        for c in range(8):
            copy = list(base)
            if c > 1:
                copy[int(rng.integers(300))] = f"new{g}{c}"
            texts.append((g * 10 + c, " ".join(copy)))
    docs = docs_of(spark, texts)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted([(g * 10,) for g in range(12)], key=repr)
    left = simhash.keep_one(odd)
    assert sorted(map(repr, rows(left, "doc_id", "text"))) == sorted(map(repr, [
        (1, None), (3, " \n"), (4, "x"), (4, "y"), (None, "no id"), (5, "word " * 5000), (6, "é😀 " * 50),
        (7, "all rights reserved. " * 3), (8, "\x00\x1c  a")]))
    assert simhash.keep_one(nothing).collect() == []


def test_near_copies_whose_head_is_unlike_them(spark, monkeypatch):
    # All fingerprints meet, so that only the comparison decides: of many copies, each is like the original alone.
    monkeypatch.setattr(simhash, "views", lambda words, many: [int(words[0] & np.uint64(1)) if len(words) else 0] * many)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(400)]
    texts = [(0, " ".join(base))]
    for c in range(40):
        copy = list(base)
        for at in rng.choice(np.arange(4, 396, 6), 7, replace=False):
            copy[at] = f"new{c}x{at}"
        texts.append((1 + c, " ".join(copy)))
    texts += [(100 + i, " ".join(rng.choice([f"v{j}" for j in range(300)], 100))) for i in range(160)]
    docs = docs_of(spark, texts)
    for most in (0, 64):
        assert rows(simhash.keep_one(docs, group_most=most), "doc_id") == sorted(
            [(0,), *[(100 + i,) for i in range(160)]], key=repr)


def test_near_copies_are_decided_exactly(spark, monkeypatch):
    monkeypatch.setattr(simhash, "views", lambda words, many: [len(words)] * many)
    texts, wanted = [], {}
    for g in range(60):
        # Of 400 shingles, 44 or 45 differ: the similarity is 356/444 or 355/445, just above 0.8 and just below.
        base = [f"g{g}w{i}" for i in range(404)]
        copy = base[:360 - g % 2] + [f"new{g}x{i}" for i in range(44 + g % 2)]
        texts += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
        wanted[2 * g + 1] = g % 2 == 1
    kept = {r.doc_id for r in simhash.keep_one(docs_of(spark, texts)).collect()}
    assert kept == {i for i, _ in texts if wanted.get(i, True)}


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100)]
    links = spark.createDataFrame(pairs, "a long, b long")
    assert rows(components.connected_components(links)) == sorted(
        [(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 200)], key=repr)
    assert components.connected_components(links.where("false")).collect() == []


# -- 6: search


@pytest.mark.parametrize("segment", [None, 4, 8])
def test_search_against_all_pairs(spark, segment):
    rng = np.random.default_rng(5)
    codes = [(i, int(c)) for i, c in enumerate(rng.integers(0, 2**16, 300))]
    codes += [(1000 + i, codes[0][1]) for i in range(40)] + [(2000, None), (None, 5), codes[3]]
    frame = spark.createDataFrame(codes, "id long, code long")
    asked = frame.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    got = rows(search.top_k(frame, asked, 5, bits=16, segment=segment))
    known = {i: c for i, c in codes if i is not None and c is not None}
    wanted = []
    for q in known:
        if q % 50 == 0:
            near = sorted(((known[q] ^ c).bit_count(), i) for i, c in known.items())[:5]
            wanted += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    assert got == sorted(wanted, key=repr)


def test_search_with_few_or_no_codes(spark):
    frame = spark.createDataFrame([(1, 0), (2, 65535)], "id long, code long")
    asked = frame.withColumnRenamed("id", "query_id")
    assert rows(search.top_k(frame, asked, 5, bits=16)) == [(1, 1, 1, 0), (1, 2, 2, 16), (2, 1, 2, 0), (2, 2, 1, 16)]
    assert search.top_k(frame.where("false"), asked, 5, bits=16).collect() == []
    assert search.top_k(frame, asked.where("false"), 5, bits=16).collect() == []


# -- 7: decontamination


def test_tiles_are_longest_first_and_do_not_overlap():
    doc, item = "a b c d e f x a b c".split(), "a b c d e f".split()
    seeds = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i:i + 3] == item[j:j + 3]]
    assert decontaminate.tiles(seeds, 3) == [(0, 0, 6)]
    doc = "d e f a b c".split()
    seeds = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i:i + 3] == item[j:j + 3]]
    assert sorted(decontaminate.tiles(seeds, 3)) == [(0, 3, 3), (3, 0, 3)]
    # A match that loses its end to a longer one keeps what is left of it.
    assert decontaminate.tiles([(0, 0), (1, 1), (2, 2), (3, 3), (10, 3), (11, 4), (12, 5)], 2) == [(0, 0, 5), (12, 5, 2)]


def test_tiles_of_windows_are_those_of_pairs(monkeypatch):
    draw = random.Random(3)
    for _ in range(400):
        seed, kinds = draw.choice([1, 2, 3, 5]), draw.choice([1, 2, 3, 5])
        doc, item = ([draw.randrange(kinds) for _ in range(draw.randrange(1, n))] for n in (40, 25))
        item += doc[5:draw.randrange(5, 25)]
        sides = [collections.defaultdict(list), collections.defaultdict(list)]
        for side, words in zip(sides, (doc, item)):
            for i in range(len(words) - seed + 1):
                side[tuple(words[i:i + seed])].append(i)
        both = sorted(set(sides[0]) & set(sides[1]))
        places = [[np.array(side[g], np.int32) for g in both] for side in sides]
        monkeypatch.setattr(decontaminate, "_FEW", 10**9)
        wanted = decontaminate.tiles_of_places(*places, seed)
        monkeypatch.setattr(decontaminate, "_FEW", -1)
        assert not both or decontaminate.tiles_of_places(*places, seed) == wanted


def test_items_of_one_word(spark):
    items = spark.createDataFrame([(1, "w " * 4000), (2, "w " * 5000), (2, "v " * 5000)], "item_id long, text string")
    texts = [(1, "a " + "w " * 4000), (1, "a " + "w " * 4000), (2, ("w " * 900 + "x ") * 5), (3, "v " * 4000 + "u " + "v " * 1000)]
    got = decontaminate.contaminated(docs_of(spark, texts), items).collect()
    assert {r.doc_id: [(x.item_id, x.coverage) for x in r["items"]] for r in got} == {
        1: [(1, 1.0), (2, 0.8)], 2: [(1, 1.0), (2, 0.9)], 3: [(2, 1.0)]}
    assert len(got) == 3


def test_contaminated_documents(spark, odd, nothing):
    word = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame(
        [(1, " ".join(word[:20]), 0), (2, " ".join(word[20:]), 0), (3, "Only THREE words", 0), (4, "", 0), (5, None, 0),
         (1, " ".join(word[:20]), 1)], "item_id long, text string, at int")
    texts = [
        (1, "before " + " ".join(word[:20]).upper() + ", after"), (2, " ".join(word[10:20] + ["x"] + word[:10])),
        (3, " ".join(word[:14])), (4, " ".join(word)), (5, "these are only three words"), (6, None), (7, "w1 w2"),
        (8, " ".join(w + " q" for w in word)),
    ]
    docs = docs_of(spark, texts + texts[:1])
    got = {r.doc_id: [x.item_id for x in r["items"]] for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: [1], 2: [1], 4: [1, 2], 5: [3]}
    assert rows(decontaminate.without_benchmark(docs, items), "doc_id") == [(3,), (6,), (7,), (8,)]
    assert decontaminate.without_benchmark(odd, items).count() == len(ODD)
    assert decontaminate.without_benchmark(docs, items.where("false")).count() == len(texts) + 1
    assert decontaminate.contaminated(nothing, items).collect() == []


# -- 8: toxicity


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(500):
        raw = {bytes([65 + t]): float(w) for t, w in zip(rng.integers(0, 12, 4), rng.random(4))}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    index = toxicity.BlockMaxIndex(vectors, block=16)
    for q in vectors[:40]:
        all_of = [sum(w * v.get(t, 0) for t, w in q.items()) for v in vectors]
        wanted = sorted((c for c in all_of if c > 0), reverse=True)[:7]
        assert np.allclose([c for _, c in index.nearest(q, 7)], wanted)
    assert index.nearest({b"none": 1.0}, 7) == []


def test_toxicity_is_learned(spark, odd, nothing):
    texts = [(i, f"some text {i} about things " + ("idiot " * (1 + i % 2) + "scum" if i % 3 == 0 else "of no kind"))
             for i in range(150)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(150)] + [(3, None, "x")],
                                   "doc_id long, toxic int, evidence string")
    got = toxicity.toxicity(docs_of(spark, texts + [(900, None)]), labels).collect()
    for r in got:
        assert (r.toxicity >= 0.5) == (r.doc_id % 3 == 0 and r.doc_id < 900)
        assert bool(r.evidence) == (r.doc_id % 3 == 0 and r.doc_id < 900)
    docs = docs_of(spark, texts, DOCS.replace("code", "toxicity").replace("words", "evidence"))
    clean = toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns and clean.count() == 100
    assert toxicity.without_toxic(odd, labels.where("false"), threshold=0.6).count() == len(ODD)
    assert toxicity.toxicity(nothing, labels).collect() == []


# -- 9: suffixes


def _check_repeats(spark, texts, **options):
    order = sorted({t for t in texts}, key=lambda x: x[0])
    marks = {d: m for d, m in zip(order, brute.removed_bytes([shared.as_bytes(t) for _, t in order]))}
    for r, (doc_id, text) in zip(
            sorted(suffixes.repeats(docs_of(spark, texts), **options).collect(), key=lambda r: r.doc_id), sorted(texts, key=lambda x: x[0])):
        mark, data = marks[doc_id, text], shared.as_bytes(text)
        assert r.doc_id == doc_id and r.n_bytes == len(data)
        assert sum(s.end - s.start for s in r.spans) == sum(mark)
        assert r.kept_sha256 == hashlib.sha256(bytes(c for c, m in zip(data, mark) if not m)).hexdigest()


def test_repeats_against_all_strings(spark):
    rng = np.random.default_rng(7)
    passage = "".join(rng.choice(list("abcde é"), 400))
    texts = [(0, "a" * 350), (1, "a" * 99), (2, "ab" * 120), (3, passage[:150] + "x" + passage[150:]), (4, passage),
             (5, passage), (6, passage[50:260] * 2), (7, passage[:100]), (8, passage[:99]), (9, None), (10, ""),
             (11, "y" + passage[100:230] + "z" + "a" * 120)]
    texts += [(20 + i, f"{i} " * 10 + passage[i * 7:i * 7 + 130] + f" {i}" * 8) for i in range(30)]
    _check_repeats(spark, texts)
    _check_repeats(spark, texts, common=1, group_rows=3, parts=4)


def test_a_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 500)
    rng = np.random.default_rng(8)
    long = "".join(rng.choice(list("abcdef "), 3000))
    _check_repeats(spark, [(1, long), (2, long[700:2200] + "q" + long[100:400]), (3, long[1234:1400])])


def test_repeats_of_odd_rows(spark, odd, nothing):
    got = suffixes.repeats(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert suffixes.repeats(nothing).collect() == []
    text = "".join(np.random.default_rng(9).choice(list("abcdefg "), 150))
    docs = docs_of(spark, [(1, text), (2, text), (2, text), (3, "start " + text + "é end"), (4, "other"), (None, text)])
    left = rows(suffixes.without_repeats(docs), "doc_id", "text")
    # The null id comes first and keeps the passage.
    assert left == sorted([(None, text), (3, "start é end"), (4, "other")], key=repr)
    assert suffixes.without_repeats(docs).columns == docs.columns
    same = docs_of(spark, [(1, text), (1, text + "!")])
    assert sum(r.n_bytes - sum(s.end - s.start for s in r.spans) for r in suffixes.repeats(same).collect()) == 151


# -- 10: chat


def test_folding_and_round_trip(spark):
    odd = "\\### Assistant: </turn> <turn>\\\\<\\/turn> #### ##\\# <</turn>\n"
    log = spark.createDataFrame([
        (1, 0, "message", "user", "hi", 0), (1, 1, "message", "assistant", "", 0), (1, 2, "delta", None, "he", 0),
        (1, 3, "delta", None, "llo", 0), (1, 4, "regenerate", None, None, 0), (1, 5, "delta", None, odd, 0),
        (1, 6, "message", "user", "typo", 0), (1, 7, "edit", None, "fixed", 0), (1, 8, "delta", None, "!", 0),
        (2, 1, "delta", None, "lost", 0), (2, 2, "message", "weird: </turn>\n role", None, 0), (2, 3, "unknown", "x", "y", 0),
        (3, 5, "message", "assistant", "a", 0), (3, 5, "message", "assistant", "a", 0), (None, 1, "message", None, "n", 0),
    ], "conv_id long, seq long, event string, role string, text string, message long")
    done = chat.format_conversations(log)
    read = done.select("conv_id", chat.parse(F.col("formatted")).alias("turns"),
                       chat.learned(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.learned) for r in read}
    assert got == {
        1: ([("user", "hi"), ("assistant", odd), ("user", "fixed!")], odd),
        2: ([("weird: </turn>\n role", "")], ""),
        3: ([("assistant", "a"), ("assistant", "a")], "aa"), None: ([("", "n")], ""),
    }
    assert chat.format_conversations(log.where("false")).collect() == []


@pytest.mark.parametrize("text", ["<\\turn>", "\\", "\\\\<", "#", "###", "#\\#", "</turn", "<turn></turn>\\", "é😀#\\"])
def test_escapes_are_reversible(spark, text):
    row = spark.range(1).select(chat.escaped(F.lit(text)).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row.u == text and "</turn>" not in row.e and "##" not in row.e


def test_few_texts_are_looked_at_in_fewer_turns_with_the_same_groups(spark, monkeypatch):
    turns, look = [], simhash._Copies.look
    monkeypatch.setattr(simhash._Copies, "look", lambda self, views: (turns.append(views), look(self, views))[1])
    base = " ".join(f"word{i}" for i in range(120))
    texts = [base, base + " more", base.replace("word7 ", "other "), " ".join(f"else{i}" for i in range(90)), "short text"]
    docs = docs_of(spark, list(enumerate(texts)))
    few = rows(simhash.near_copies(docs, many=4), "doc_id", "root")
    assert turns == [[0], [1], [2, 3]]
    del turns[:]
    few8 = rows(simhash.near_copies(docs), "doc_id", "root")
    assert turns == [[0], [1, 2, 3], [4, 5, 6, 7]]
    del turns[:]
    many8 = rows(simhash.near_copies(docs, together=0), "doc_id", "root")
    assert turns == [[0], [1], [2, 3], [4, 5], [6, 7]]
    assert few == few8 == many8 and len({root for _, root in few}) == 3


def test_near_copies_pair_each_text_once_however_many_meet(spark, monkeypatch):
    # 60 codes of one bit: every two are two bits apart and meet.
    monkeypatch.setattr(simhash, "views", lambda words, many: [1 << len(words) % 60] * many)
    pairs, similar = [], simhash._similar
    monkeypatch.setattr(simhash, "_similar", lambda some, *rest: (pairs.append(some.count()), similar(some, *rest))[1])
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(60 + i))) for i in range(58)]
    base = [f"w57x{j}" for j in range(117)]
    texts += [(100, " ".join([*base, "and"])), (101, " ".join([*base, "and", "more"]))]
    docs = docs_of(spark, texts)
    assert rows(simhash.keep_one(docs), "doc_id") == sorted([(i,) for i in range(58)], key=repr)
    assert pairs and max(pairs) <= len(texts)


def test_codes_at_most_two_bits_apart_are_compared_at_one_key(spark):
    rng = np.random.default_rng(12)
    codes = rng.integers(-2**63, 2**63 - 1, 200)
    for flips in (0, 1, 2):
        differ = np.zeros(200, np.int64)
        for bits in (rng.permuted(np.tile(np.arange(64), (200, 1)), axis=1)[:, :flips]).T:
            differ ^= np.left_shift(np.int64(1), bits)
        keys = []
        for side in (codes, codes ^ differ):
            df = spark.createDataFrame([(i, 0, int(c)) for i, c in enumerate(side)], "i int, view int, code long")
            keys.append({tuple(r) for r in df.select("i", simhash._block_keys("view", "code").alias("k")).select("i", "k.combo", "k.key").collect()})
        met = np.zeros(200, int)
        for i, combo, _ in keys[0] & keys[1]:
            met[i] += simhash._first_met(differ[i:i + 1], combo)[0]
        assert (met == 1).all()


def test_texts_left_apart_are_one_row_for_all_blocks_of_a_key_and_compared_in_one_view(spark, monkeypatch):
    # All fingerprints meet in all views, every two texts are estimated at about 0.7, and no two are alike.
    monkeypatch.setattr(simhash, "views", lambda words, many: [0] * many)
    found, stage = [], simhash.stage

    def counted(df, name):
        table = stage(df, name)
        if name == "likest":
            found.append(table.count())
        return table

    monkeypatch.setattr(simhash, "stage", counted)
    rng = np.random.default_rng(8)
    base, texts = [f"w{i}" for i in range(400)], []
    for c in range(140):
        copy = list(base)
        for at in rng.choice(np.arange(4, 396, 6), 7, replace=False):
            copy[at] = f"new{c}x{at}"
        texts.append((c, " ".join(copy)))
    groups = simhash.near_copies(docs_of(spark, texts), many=2, group_most=16)
    assert len(rows(groups.select("root").distinct())) == 140
    # Blocks alone and in twos are read by different tasks.
    assert 140 <= found[0] <= 280 and found[1:] == [0]
