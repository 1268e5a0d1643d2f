"""The registered queries on a small given folder."""

from __future__ import annotations

import collections
import hashlib
import os
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, duck_rows, spark_rows
from tallykeep.llm import registry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_all_are_registered():
    names = sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert {*names, "pipeline"} <= set(entry.queries())
    assert set(registry.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    found = spark_rows(registry.QUERIES[name](spark, FOLDER))
    assert found == duck_rows(connect(FOLDER), registry.ORACLES[name])


@pytest.fixture(scope="module")
def texts():
    found = connect(FOLDER).execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    assert len({i for i, _ in found}) == len(found)
    return dict(found)


def ran(spark, name):
    return {r["doc_id"]: r for r in registry.QUERIES[name](spark, FOLDER).collect()}


def test_op1_pieces(spark, texts):
    rows = registry.QUERIES["op1_best_fit_packing"](spark, FOLDER).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [sum(x.length for x in pieces[:i]) for i in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(ids) and all(r.length == 2048 for r in pieces[1:])
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in pieces]
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 2048


def test_op2_places(spark, texts):
    found = ran(spark, "op2_license_scan")
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        n, places = brute.phrase_places(text)
        r, starts = found[doc_id], [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_op5_fingerprints_and_components(spark, texts):
    found = ran(spark, "op5_simhash_near_dedup")
    codes = {i: brute.simhash(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{c:016x}" for i, c in codes.items()}
    assert {i: r.component_id for i, r in found.items()} == brute.components(codes)


def test_op9_removed_bytes(spark, texts):
    found = ran(spark, "op9_suffix_array_dedup")
    data = [(t or "").encode() for t in texts.values()]
    for doc_id, text, mark in zip(texts, data, brute.removed_bytes(data)):
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        kept = bytes(b for b, m in zip(text, mark) if not m)
        assert tuple(found[doc_id])[1:] == (len(text), sum(mark), runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("name", ["op4_quality_classifier", "op8_toxicity", "op11_language_id"])
def test_classifiers_give_every_document_a_score(spark, name, texts):
    found = ran(spark, name)
    assert set(found) == set(texts)
    rest, of = (2, 4) if name.startswith("op11") else (0, 5)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % of == rest) and 0 <= r.score <= 1 for i, r in found.items())
    least = {"op4_quality_classifier": 0.3, "op8_toxicity": 0.5}.get(name)
    assert least is None or all(r.predicted == (r.score >= least) for r in found.values())


def test_pipeline_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now, many = docs, docs.count()
    for _, work in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stage(work(spark, now, FOLDER), "test")
        assert now.dtypes == docs.dtypes
        assert 0 < now.count() <= many
        many = now.count()
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}
    empty = docs.where("false")
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, empty, FOLDER).count() == 0
