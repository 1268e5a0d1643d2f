"""Language identification, collocations and vector codes against plain versions, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from conftest import rows
from tallykeep.llm import collocations, language_id, vector_codes

DOCS = "doc_id long, text string, lang string, source string, n long, key string, word string, f long"
WORDS = {"en": "the cat sat on a warm mat while rain fell".split(), "de": "über straße größe für schön wäre müßte".split(),
         "fi": "yksi kaksi kolme neljä viisi kuusi".split()}


def docs_of(spark, found):
    return spark.createDataFrame([(i, t, g, "s", 7, "k", "w", 1) for i, t, g in found], DOCS)


def spoken(many=240):
    random = np.random.default_rng(3)
    names = sorted(WORDS)
    return [(i, " ".join(random.choice(WORDS[names[i % 3]], 5 + i)), names[i % 3]) for i in range(many)]


# -- 11: language


def plain_log_probabilities(network, window: bytes) -> np.ndarray:
    """One window that is a text by itself, one place and one filter after the other."""
    pooled = []
    for w in language_id.WIDTHS:
        for f in range(language_id.FILTERS):
            pooled.append(max(sum(float(network.filters[w][j][window[i + j], f]) for j in range(w))
                              for i in range(language_id.WINDOW - language_id.REACH)))
    x = np.maximum(np.array(pooled) + network.bias, 0) @ network.layer.astype(float) + network.offset
    return x - x.max() - math.log(np.exp(x - x.max()).sum())


def test_network_is_a_convolution_with_pooling():
    network = language_id.Network(["a", "b", "c"])
    network.fit(np.random.default_rng(1).integers(0, language_id.ROWS, (40, language_id.WINDOW)).astype(np.uint8),
                np.arange(40) % 3, epochs=2)
    text = "Größe 12, x!"
    cells, of, sizes = language_id.windows([text, ""])
    assert of.tolist() == [0, 1] and sizes.tolist() == [len(text.encode()), 0]
    got = network.log_probabilities(network.pooled(cells, np.array([True, True])))
    wanted = [plain_log_probabilities(network, cells[i * language_id.WINDOW:(i + 1) * language_id.WINDOW].tobytes()) for i in (0, 1)]
    assert np.allclose(got, wanted, atol=1e-4)


def test_slopes_are_those_of_the_loss():
    network = language_id.Network(["a", "b"], seed=5)
    x = np.random.default_rng(2).integers(0, language_id.ROWS, (3, language_id.WINDOW)).astype(np.uint8)
    y = np.array([0, 1, 1])

    def loss():
        network.tables = None
        return -network.log_probabilities(network.pooled(x.ravel(), np.ones(3, bool)))[np.arange(3), y].mean()

    slopes = network._slopes(x, y)
    for weights, slope in zip([*(network.filters[w] for w in language_id.WIDTHS), network.bias, network.layer], slopes):
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        step = np.float32(2e-3)
        weights[at] += step
        more = loss()
        weights[at] -= 2 * step
        less = loss()
        weights[at] += step
        assert abs((more - less) / (2 * step) - slope[at]) < 0.05 * abs(slope[at]) + 1e-3


def test_windows_cover_whole_texts():
    text = "ab" * 1000
    cells, of, sizes = language_id.windows([text, None, "é"])
    assert sizes[of == 0].sum() == 2000 and len(cells) == len(of) * language_id.WINDOW
    assert bytes(cells[:2000]) == text.encode().translate(language_id._ROW)
    # What decides may stand at the very end.
    network = language_id.train_on = language_id.Network(["x", "y"])
    random = np.random.default_rng(4)
    kinds = np.where(random.random((200, 1)) < 0.5, 3, 10).astype(np.uint8)
    network.fit(np.repeat(kinds, language_id.WINDOW, axis=1), (kinds[:, 0] == 10).astype(np.int64), epochs=4)
    (names, score) = network.predict(["a" * 100, "h" * 100, "a" * 5000, "h" * 5000])
    assert names == ["x", "y", "x", "y"] and (score > 0.5).all()


def test_languages_are_told_apart(spark):
    found = spoken()
    got = {r.doc_id: r for r in language_id.identify(docs_of(spark, found)).collect()}
    assert len(got) == len(found)
    for i, _, lang in found:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].lang_pred == lang and 0 <= got[i].score <= 1


def test_language_of_odd_rows(spark):
    odd = [(1, None, "en"), (2, "", "en"), (3, " 12 .. ### \n", None), (None, "the cat sat", "de"), (5, "the cat sat " * 9000, None),
           (5, "the cat sat", "en"), (5, "the cat sat", "en"), (6, "über straße größe", None)]
    got = rows(language_id.identify(docs_of(spark, odd), language_id.train(docs_of(spark, spoken()))), "doc_id", "held_out", "lang_pred")
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 4 == 2
    wanted = [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (5, "en"), (5, "en"), (6, "de")]
    assert got == sorted(((i, held(i), lang) for i, lang in wanted), key=repr)
    nothing = docs_of(spark, [])
    assert language_id.identify(nothing).collect() == []
    unlabelled = language_id.identify(docs_of(spark, [(1, "some words", None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


# -- 12: collocations


def plain_collocations(found, longest=3, least=10, inside=50, top=2000):
    counts = collections.Counter()
    for _, text, lang in found:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            counts.update((lang or "und", tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang in {g for g, _ in counts}:
        mine = {p: c for (g, p), c in counts.items() if g == lang}
        n = sum(c for p, c in mine.items() if len(p) == 1)
        long = {p: c for p, c in mine.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in long.items():
            if any(len(q) > len(p) and 100 * c >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, c in long.items()):
                continue
            cuts = [(10**6 * a * a // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, r, n, -s) for i, (s, a, p, le, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def talk():
    random = np.random.default_rng(9)
    words = ["a", "b", "New", "york", "city", "é😀", "x\x00y", "x", "the"]
    found = [(i, " ".join(random.choice(words, 60, p=[.2, .1, .1, .1, .1, .1, .1, .1, .1])) + "." * (i % 2) + "\tNew York  city", "en")
             for i in range(30)]
    found += [(i, "no. no no, no\nno no no no no no no no; NO no", "xx" if i % 2 else None) for i in range(8)]
    return found + [(1, None, "en"), (None, "", None), (None, "New York City! New York City", "en"), (7, "z " * 5000, "en"), (7, "z " * 5000, "en")]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_are_those_of_plain_counting(spark, longest, monkeypatch):
    found = talk()
    wanted = plain_collocations(found, longest)
    assert rows(collocations.collocations(docs_of(spark, found), longest), *COLUMNS) == wanted
    assert len(wanted) > 10


def test_best_and_all_collocations(spark):
    found, docs = talk(), docs_of(spark, talk())
    assert rows(collocations.collocations(docs, top=3), *COLUMNS) == plain_collocations(found, top=3)
    assert rows(collocations.collocations(docs, top=None, inside=101), *COLUMNS) == plain_collocations(found, inside=101, top=10**9)
    assert collocations.collocations(docs_of(spark, [])).collect() == []
    assert collocations.collocations(docs_of(spark, [(1, None, None), (2, "a b", "en")])).collect() == []


def test_counting_does_not_depend_on_blocks_or_hot_prefixes(spark, monkeypatch):
    found = talk()
    wanted = plain_collocations(found)
    texts = docs_of(spark, found).repartition(5)
    hot = np.sort(collocations._folded([collocations.Words(b"no the a new z", 0).hashes]))
    # Small blocks, cells that a word fills, and every word a hot prefix.
    monkeypatch.setattr(collocations, "_hot", lambda phrases, n: hot)
    assert rows(collocations.collocations(texts), *COLUMNS) == wanted


def test_words_of_blocks():
    data = b"a b\nabc  a\n\n b" + b"q" * 70000 + b" a"
    words = collocations.Words(data, 0)
    assert [data[a:b] for a, b in zip(words.starts, words.ends)] == data.split()
    same = {}
    for w, h in zip(data.split(), words.hashes.tolist()):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    assert words.grams(2).tolist() == [0, 2, 4] and words.grams(3).tolist() == [] and words.grams(99).tolist() == []
    text = b"one two.three " * 10
    blocks = list(collocations._cut(text.translate(collocations._PIECE_BYTES)))
    assert b"".join(blocks) == text.translate(collocations._PIECE_BYTES)


def test_equal_hashes_are_counted_anew(spark, monkeypatch):
    found = talk()
    real = collocations.count_words
    seeds = []

    def once(docs, seed):
        seeds.append(seed)
        counted = real(docs, seed)
        return counted.withColumn("other", counted["word"] if len(seeds) > 1 else counted["key"])

    monkeypatch.setattr(collocations, "count_words", once)
    assert rows(collocations.collocations(docs_of(spark, found)), *COLUMNS) == plain_collocations(found)
    assert len(seeds) == 2 and seeds[0] != seeds[1]


# -- 13: vector codes


def plain_codes(found, parts, entries, rounds, scale=256):
    """(vec_id, code, error) and the codebooks, each part compared with each entry, in Python's numbers."""
    kept = sorted(((i, v) for i, v in found if v and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0], r[1]))
    if not kept:
        return [], []
    size = len(kept[0][1])
    kept = [(i, [n * scale // d for n, d in (x.as_integer_ratio() for x in v)]) for i, v in kept if len(v) == size]
    w = size // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = collections.defaultdict(list)
            for _, v in kept:
                mine[near(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*mine[i])] if mine[i] else e for i, e in enumerate(book)]
    out = []
    for i, v in kept:
        found_at = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found_at), min(sum(d for d, _ in found_at), 2**63 - 1)))
    return out, books


ROWS = "vec_id long, embedding array<float>, label int, code string, error long, part int"


def check_codes(spark, found, parts=4, entries=8, rounds=2):
    got = vector_codes.compress(
        spark.createDataFrame([(i, v, None if i is None or i % 3 == 0 else i % 3, "c", 1, 2) for i, v in found], ROWS).repartition(3),
        parts=parts, entries=entries, rounds=rounds).collect()
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in found]
    wanted, books = plain_codes(as_float, parts, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=repr) == sorted(wanted, key=repr)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} <= {digest}
    by = collections.Counter()
    for r in got:
        by[r.label] += r.error
    assert all(r.label_error == min(by[r.label], 2**63 - 1) for r in got)
    return got


def test_codes_are_those_of_full_comparison(spark):
    random = np.random.default_rng(8)
    found = [(i, random.normal(0, 0.2, 16).round(2).tolist()) for i in range(400)]
    assert len(check_codes(spark, found, 4, 64)) == 400
    # Few different values: ties and equal entries everywhere.
    check_codes(spark, [(i, (random.integers(0, 3, 16) / 256).tolist()) for i in range(300)], 8, 40, 3)


def test_codes_of_odd_rows(spark):
    random = np.random.default_rng(10)
    found = [(i, random.normal(0, 1, 8).tolist()) for i in range(30)]
    found += [(50, None), (51, [None] * 8), (52, [float("nan")] * 8), (53, [1.0] * 7 + [float("inf")]), (54, []), (55, [1.0] * 12),
              (None, [0.5] * 8), (None, [0.5] * 8), (3, [0.25] * 8), (3, [0.25] * 8), (60, [3e38, -3e38] * 4), (61, [1e10] * 8)]
    assert max(r.error for r in check_codes(spark, found)) > 0
    check_codes(spark, [(1, [1.0] * 8)])
    check_codes(spark, [(i, [1e30 + i * 1e28] * 8) for i in range(20)])
    assert check_codes(spark, []) == []
    assert check_codes(spark, [(1, None)]) == []
    with pytest.raises(ValueError):
        check_codes(spark, [(1, [1.0] * 7)])


def test_trees_leave_entries_out_and_lose_none():
    random = np.random.default_rng(12)
    book = random.integers(-200, 200, (64, 4))
    x = random.integers(-250, 250, (2000, 4))
    tree = vector_codes.Tree(book)
    apart = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    best, error = tree.nearest(x)
    assert (best == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    looked = []
    plain = vector_codes.squared
    vector_codes.squared = lambda a, e: (looked.append(len(a)), plain(a, e))[1]
    try:
        tree.nearest(x)
    finally:
        vector_codes.squared = plain
    assert sum(looked) < 0.8 * apart.size
