"""Registered queries against their SQL; the pipeline's stages against brute force."""

import zlib

import brute
import numpy as np
import pytest
import zstandard
from compare import ROOT, compare, oracle_connection
from tokenizers import Tokenizer

import corpus_pipeline
from pairwarden.llm.language_id import fit_dictionaries, held_out, letters
from pairwarden.llm.queries import ORACLES, QUERIES
from pairwarden.llm.tokens import BYTE_BPE, WORD_BPE, byte_tokenizer
from pairwarden.session import stage

FOLDER = str(ROOT / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    _, problem = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert problem is None


@pytest.fixture(scope="module")
def rows_in(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_simhash_query(spark, rows_in, same):
    prints = [(d, brute.fingerprint(t)) for d, t in rows_in]
    same(QUERIES["op5_simhash_dedup"](spark, FOLDER), ["doc_id", "fingerprint", "component_id"],
         brute.components(prints))


def test_language_query_against_brute_force(spark):
    """Every text compressed anew with each language's dictionary; held-out rows against their language."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    dictionaries = fit_dictionaries(docs.filter(~held_out("doc_id", 5, 0)))
    rows = {r.doc_id: r for r in docs.collect()}
    right = tried = 0
    for r in QUERIES["op4_language_id"](spark, FOLDER).collect():
        row = rows[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        text = letters(row.text).encode()
        sizes = {}
        for lang, content in dictionaries.items():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=5, dict_data=own, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(coder.compress(text[i:i + 2048])) for i in range(0, len(text), 2048))
        assert r.lang_pred == (min(sizes, key=sizes.get) if text else "und") and 0 <= r.score <= 1
        if r.held_out and row.lang is not None and text:
            right, tried = right + (r.lang_pred == row.lang), tried + 1
    assert right >= 0.95 * tried > 0


def test_toxicity_query_on_held_out_rows(spark):
    folder = str(ROOT / "sf0.01")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in QUERIES["op8_toxicity"](spark, folder).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    judged = [(r.predicted, toxic[r.doc_id]) for r in got if r.held_out and toxic.get(r.doc_id) is not None]
    bad = [p for p, t in judged if t == 1]
    good = [p for p, t in judged if t == 0]
    assert sum(bad) >= 0.8 * len(bad) and sum(good) <= 0.02 * len(good)


def test_token_counts_query_against_brute_force(spark, rows_in):
    encoder = byte_tokenizer(BYTE_BPE)
    lengths = [len(encoder.encode(text or "")) for _, text in rows_in]
    for r in QUERIES["op7_token_counts"](spark, FOLDER).collect():
        assert r.n_docs == lengths.count(r.n_tokens)
        assert r.tokens_from == sum(n for n in lengths if n >= r.n_tokens)


def test_packing_query_against_brute_force(spark, rows_in):
    whole = Tokenizer.from_file(WORD_BPE)
    pieces = {}
    for r in QUERIES["op3_packing"](spark, FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert len(pieces) == len(rows_in)
    for doc, text in rows_in:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(pieces[doc], key=lambda r: r.start)
        assert sum(r.length for r in own) == own[0].doc_tokens == len(ids)
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part) and r.offset == 0 and r.length & (r.length - 1) == 0


def test_nearest_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    ids, table = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in QUERIES["op11_nearest"](spark, FOLDER).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == [i for i in ids.tolist() if i % 20 == 0]
    hit = 0
    for i in np.flatnonzero(ids % 20 == 0):
        products = (table * table[i]).sum(axis=1)
        products[i] = -np.inf
        want = set(ids[np.lexsort((ids, -products))[:20]].tolist())
        own = sorted(found[ids[i]])
        assert [rank for rank, _, _ in own] == list(range(1, 21))
        assert [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        assert all(s == pytest.approx(products[np.searchsorted(ids, v)], abs=1e-12) for _, v, s in own)
        hit += len(want & {v for _, v, _ in own})
    assert hit >= 0.9 * 20 * len(found)


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {"documents": [(r.doc_id, r.text) for r in docs.collect()]}
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, FOLDER), name)
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {d for d, _ in rows}
            break
        assert docs.columns == columns
        old = [(r.doc_id, r.text) for r in before.collect()]
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert set(rows) <= set(old)
        if name == "exact_dedup":
            last = {(t or "").translate(brute.LOW): d for d, t in sorted(old)}
            assert sorted(d for d, _ in rows) == sorted(last.values())
        if name == "near_dedup":
            parts = brute.components([(d, brute.fingerprint(t)) for d, t in old])
            assert sorted(d for d, _ in rows) == sorted({p for _, _, p in parts})
        if name == "decontamination":
            clean = {r[0] for r in brute.contamination(old, items) if not r[-1]}
            assert {d for d, _ in rows} == clean
    assert len(kept["documents"]) * 0.5 < len(rows)
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()
