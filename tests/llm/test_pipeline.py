"""Pipeline stages on odd documents: nulls, empty and very long texts, repeated rows, clashing columns, no rows."""

import pytest

import corpus_pipeline
from pairwarden.session import stage

FOLDER = "/root/testdata/sf0.001"
UPPER = {c: c - 32 for c in range(97, 123)}
EXTRA = ["_language", "_contamination", "language", "fp", "_fp", "_keep_id", "row", "keep_id", "length", "bucket", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.limit(120).collect()]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()
    text = rows[5][1]
    rows += [(1000, None, "en", "s", 1), (1001, "", "en", "s", 1), (1002, " \n", None, None, None),
             (1003, "12 ½ --", "en", "s", 1), (None, text + " more", None, None, None), (None, text + " more", "en", "s", 2),
             (1004, text, "en", "s", 1), (1004, text, "en", "s", 1), (1005, text.translate(UPPER), "de", None, 1),
             (1006, " ".join([text] * (3_000_000 // max(1, len(text)) + 1)), rows[5][2], "s", 1),
             (1007, f"{text} {item.text} {text}", rows[5][2], "s", 1)]
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], SCHEMA).repartition(3)


def test_stages_on_odd_documents(spark, odd):
    docs, kept = odd, {}
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, FOLDER), name)
        if name != "packing":
            assert out.columns == odd.columns
            assert out.exceptAll(docs).count() == 0  # rows are kept as they are
        kept[name] = [r.doc_id for r in out.select("doc_id").collect()]
        docs = out
    for gone in (1000, 1001, 1002, 1003):  # nothing to tell a language by
        assert gone not in kept["language_id"]
    assert {1004, 1005, 1006, 1007, None} <= set(kept["language_id"])
    assert kept["language_id"].count(1004) == 2 and kept["exact_dedup"].count(1004) == 0
    assert kept["exact_dedup"].count(1005) == 1  # the largest id of equal texts
    assert kept["exact_dedup"].count(None) == 1
    assert 1007 not in kept["decontamination"]
    assert set(kept["packing"]) == set(kept["decontamination"])


def test_stages_without_rows(spark, odd):
    docs = odd.limit(0)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, FOLDER), name)
        assert docs.count() == 0
