"""Packing, token counts, decontamination, language and toxicity."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairwarden.llm.decontamination import WuManber, mark_contamination
from pairwarden.llm.language_id import fit_dictionaries, held_out, identify, letters
from pairwarden.llm.packing import pack_powers, piece_lengths
from pairwarden.llm.token_counts import (
    context_totals,
    cut_at,
    encoded_lengths,
    length_histogram,
    length_quantile,
)
from pairwarden.llm import tokens
from pairwarden.llm.tokens import (
    BYTE_BPE,
    MAX_CACHED_CHARS,
    WORD_BPE,
    WordTokenizer,
    as_ids,
    byte_tokenizer,
    word_tokenizer,
)
from pairwarden.llm.toxicity import (
    VOTERS,
    Lexicon,
    _correlated,
    _families,
    fit_classifier,
    fit_label_model,
    score_toxicity,
    votes,
)


def test_word_tokenizer_equals_the_library():
    rng = random.Random(5)
    letters_ = "abcABCÀéñßµª²¼ 's'll've \t\n\x0b\x85\xa0日ا́ΣςİK\U0001F600<|>endoftext!?.,0123 "
    texts = ["", "<|endoftext|> a", "it's IT'S ''s", "ΟΔΥΣΣΕΥΣ"]
    texts += ["".join(rng.choice(letters_) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    whole = Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)
    got = word_tokenizer(WORD_BPE).encode(texts)
    assert [as_ids(g).tolist() for g in got] == [w.ids for w in whole]


def test_word_tokenizer_remembers_a_bounded_size():
    """Texts with special tokens and texts without spaces are not remembered."""
    tokenizer = WordTokenizer(WORD_BPE, most=1000)
    whole = Tokenizer.from_file(WORD_BPE)
    for n in range(40):
        texts = [f"<|{n} " + "word " * 3000, f"{n}" + "日本語の文" * 2000, "é" * 5000 + str(n), f"plain words {n}"]
        got = tokenizer.encode(texts)
        assert [as_ids(g).tolist() for g in got] == [
            w.ids for w in whole.encode_batch(texts, add_special_tokens=False)]
    held = {**tokenizer.known, **tokenizer.older}
    assert len(held) <= 1000 + 400 and all(len(p) <= MAX_CACHED_CHARS for p in held)


def test_byte_tokenizer_cuts_gaps_like_the_pattern(monkeypatch):
    import re

    encoder, rng = byte_tokenizer(BYTE_BPE), random.Random(1)
    monkeypatch.setattr(tokens, "LONG_GAP", 3)
    monkeypatch.setattr(tokens, "_LONG_GAP", re.compile(rf"[{tokens._SPACES}]{{3,}}"))
    for _ in range(5000):
        text = "".join(rng.choice(" \n\t\xa0\x85\x1c ab1!'s é日") for _ in range(rng.randint(0, 25)))
        assert encoder.encode(text) == encoder._split(text)


@pytest.mark.parametrize("gap", [" ", "\n", "\t", "\xa0"])
def test_token_counts_of_millions_of_blanks(make_docs, gap):
    rows = [(1, "a" + gap * 5_000_000 + "b"), (2, gap * 1_500_000), (3, "plain")]
    got = {r.doc_id: r.n_tokens for r in encoded_lengths(make_docs(rows)).collect()}
    encoder = byte_tokenizer(BYTE_BPE)
    short = {n: len(encoder._split(gap * n)) for n in (500_000, 400_000)}
    assert got[3] == 1 and got[2] > 2 * short[500_000] and got[1] > 12 * short[400_000] - 10
    assert all(n >= 5_000_000 / 128 for d, n in got.items() if d == 1)


def test_packing(docs, rows):
    got = pack_powers(docs, with_ids=True, longest=64).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = sorted(
        (str(d), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, ids in ((d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows))
    assert sum(r.length for r in got) == sum(n for _, n, _ in want)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0 for r in got)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by_number = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in by_number] == sorted((r.length for r in got), reverse=True)
    unique = [d for d, _ in rows if d is not None and [x for x, _ in rows].count(d) == 1]
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for d in unique:
        own = sorted(pieces[d], key=lambda r: r.start)
        ids = [i for r in own for i in r.ids]
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert (str(d), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) in want
        assert {r.doc_tokens for r in own} == {len(ids)}


def test_copies_of_a_long_item_stay_within_the_bound(make_docs, same):
    from pairwarden.llm import decontamination as D

    rng = random.Random(2)
    long = " ".join(f"w{rng.randint(0, 400)}" for _ in range(3000))
    items = [(1, long)] * 300 + [(i, " ".join(f"x{rng.randint(0, 9)}" for _ in range(40))) for i in range(2, 90)]
    docs = [(i, " ".join(long.split()[at : at + 60])) for i, at in enumerate(range(0, 2940, 97))]
    docs += [(500, "nothing of it"), (501, None), (501, items[-1][1]), (None, items[-2][1])]
    frame = make_docs(docs)
    benchmark = frame.sparkSession.createDataFrame(items, "item_id long, text string")
    sizes = [sum(len(D.words(t)) for _, t in block) for block in D._pattern_blocks(benchmark, "item_id", "text", 10, 1200)]
    assert len(sizes) > 4 and max(sizes) <= 1200
    got = mark_contamination(frame, benchmark, max_words=1200)
    same(got.select("doc_id", "contamination.*").drop("items"),
         ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], brute.contamination(docs, items))
    again = mark_contamination(got, benchmark)
    assert again.columns == got.columns and again.exceptAll(got).count() == 0  # the column is replaced


def test_numerals_are_no_letters(make_docs):
    for text in ("²³ ½", "①②", "12 Ⅷ", "_-_", "٣٤", "", None):
        assert letters(text) == ""
    assert letters("x² ½b ①c") == "x b c" and letters("日本 1 é") == "日本 é"
    docs = make_docs([(i, "the same words of one language") for i in range(40)] + [(99, "²³ ½"), (98, "①②")])
    train = docs.filter("doc_id < 40").withColumn("lang", F.lit("en"))
    found = {r.doc_id: r.language.lang_pred for r in identify(docs.drop("lang"), train).collect()}
    assert found[99] == found[98] == "und" and found[0] == "en"


def test_piece_lengths():
    for n in (1, 5, 2047, 2048, 2049, 10_000):
        own = piece_lengths(n, 2048)
        assert sum(own) == n and len(own) == n // 2048 + (n % 2048).bit_count()


def test_token_counts(docs, rows):
    encode = byte_tokenizer(BYTE_BPE).encode
    lengths = sorted(len(encode(t or "")) for _, t in rows)
    totals = context_totals(length_histogram(encoded_lengths(docs))).cache()
    got = {r.n_tokens: r for r in totals.collect()}
    assert sorted(got) == sorted(set(lengths))
    for limit, r in got.items():
        assert r.n_docs == lengths.count(limit)
        assert r.docs_from == sum(n >= limit for n in lengths)
        assert r.tokens_from == sum(n for n in lengths if n >= limit)
        assert r.total_tokens_cut == sum(min(n, limit) for n in lengths)
        assert r.tokens_fitting == sum(n for n in lengths if n <= limit)
        assert r.quantile == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    for limit in (0, 1, 17, 60, 10**6):
        assert cut_at(totals, limit) == sum(min(n, limit) for n in lengths)
    assert length_quantile(totals, 0.5) == lengths[-(-len(lengths) // 2) - 1]


ITEMS = [(1, "one Two three four five six seven eight nine ten eleven"), (2, "short item"), (30, "x"),
         (4, "..."), (5, None), (None, "no id here"), (2, "short item"), (6, "two three four five six seven "
         "eight nine ten eleven twelve"), (7, "a a a a a a a a a a a")]


@pytest.mark.parametrize("max_words", [500_000, 60])
def test_decontamination(make_docs, rows, same, max_words):
    more = [(900, "zero one two, THREE four-five six seven eight nine ten eleven twelve x"), (901, "a " * 30),
            (902, "Short ITEM short item"), (903, "no-id here"), (904, "one two three four five six seven eight nine")]
    both = rows + more
    docs = make_docs(both)
    items = docs.sparkSession.createDataFrame(ITEMS, "item_id long, text string")
    got = mark_contamination(docs, items, max_words=max_words)
    assert got.columns == [*docs.columns, "contamination"]
    same(got.select("doc_id", "contamination.*"),
         ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
         brute.contamination(both, ITEMS))


def test_wu_manber_skips():
    machine = WuManber(10)
    machine.add(tuple(b"abcdefghij"[i:i + 1] for i in range(10)), 1)
    assert machine.shift[b"a", b"b"] == 8 and machine.shift[b"i", b"j"] == 0
    looked = []

    class Watched(list):
        def __getitem__(self, at):
            looked.append(at)
            return super().__getitem__(at)

    machine.search(Watched([b"z"] * 900), [], set())
    assert len(looked) == 99 + 1 or len(looked) == 99


def _language_rows():
    rng = random.Random(11)
    stems = {"en": ["the", "ing", "tion", "and", "wh", "ould"], "de": ["sch", "ung", "der", "ein", "ich", "zu"],
             "fr": ["eau", "que", "oui", "ment", "aux", "tre"]}
    rows = []
    for i in range(600):
        lang = rng.choice(list(stems))
        words = ["".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 60))]
        rows.append((i, " ".join(words), lang))
    return rows + [(1000, None, "en"), (1001, "", None), (1002, "123 !!", "de"), (None, rows[0][1], rows[0][2])]


def test_language_id_on_held_out_rows(shipped):
    rows = _language_rows()
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "held_out", held_out("doc_id", 5, 0))
    got = identify(docs, docs.filter(~F.col("held_out"))).select("doc_id", "held_out", "lang", "language.*").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.held_out
        elif r.doc_id >= 1000:
            assert (r.lang_pred, r.rejected) == ("und", True)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    tested = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert len(tested) > 80 and np.mean([r.lang_pred == r.lang for r in tested]) > 0.98
    assert np.mean([r.rejected for r in tested]) < 0.02


def test_language_dictionaries_are_bounded(shipped):
    docs = shipped.createDataFrame(_language_rows(), "doc_id long, text string, lang string")
    fitted = fit_dictionaries(docs, dictionary_bytes=500)
    assert set(fitted) == {"en", "de", "fr"} and all(0 < len(d) <= 500 for d in fitted.values())
    nothing = identify(docs, docs.filter("false")).select("language.*").collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert letters("Ab, ab!! AB x1x y") == "ab x y"


def test_copies_do_not_shrink_the_sample_of_a_language(shipped):
    rows = [(t, lang) for _, t, lang in _language_rows() if t and lang]
    own = {t for t, lang in rows if lang == "de"}
    docs = shipped.createDataFrame(rows, "text string, lang string")
    copies = shipped.range(20_000).select(F.lit("der ein zu").alias("text"), F.lit("de").alias("lang"))
    fitted = fit_dictionaries(docs.union(copies), sample_rows=60)
    assert list(fitted)[0] == "de"  # most rows
    parts = sum(letters(t[:300]).encode()[:40] in fitted["de"] for t in own if len(t) <= 300)
    assert len(fitted["de"]) > len(fitted["fr"]) / 2 and parts > 5


def test_every_language_has_a_dictionary(shipped):
    rng = random.Random(14)
    rows = []
    for i in range(300):
        stems = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(20)]
        rows += [(" ".join(rng.choice(stems) for _ in range(40)), f"l{i}") for _ in range(3)]
    docs = shipped.createDataFrame(rows, "text string, lang string")
    assert len(fit_dictionaries(docs)) == 300
    fitted = fit_dictionaries(docs, total_bytes=300 * 200)
    assert len(fitted) == 300 and all(0 < len(d) <= 200 for d in fitted.values())


def _toxic_rows():
    rng = random.Random(12)
    plain = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(300)]
    bad = ["zzquu", "zzquuma", "zzquuto", "wrrkl", "moron"]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "clash"))
        if i % 2 == 0:
            labels.append((i, int(toxic), 1))
    truth = {i: any(w in bad for w in t.split()) for i, t, _ in rows}
    rows += [(2000, None, "x"), (2001, "", "x"), (None, "moron " * 9, "x")]
    return rows, labels + [(None, 1, 1), (3, None, 0)], truth


def test_toxicity_on_held_out_rows(shipped):
    rows, labels, truth = _toxic_rows()
    docs = shipped.createDataFrame(rows, "doc_id long, text string, label string")
    marks = shipped.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = score_toxicity(docs, marks, held_out("doc_id", 3, 1)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    tested = [(r.predicted == 1, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in tested]) > 0.97
    assert all(r.predicted == 0 for r in got if r.doc_id in (2000, 2001))


def test_only_near_copies_with_one_label_are_a_family(shipped):
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(3000)]
    passage = rng.sample(words, 14)
    texts = [passage + rng.sample(words, 12) for _ in range(60)]  # share a passage, are no copies
    rows = [(i, " ".join(t), i % 2) for i, t in enumerate(texts)]
    copied = rng.sample(words, 80)
    for i in range(100, 140):  # near copies, two of them with the other label
        rows.append((i, " ".join([*copied[: i - 80], "changed", *copied[i - 79 :]]), int(i in (100, 120))))
    docs = shipped.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    marks = shipped.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = [(r.text, r.toxic) for r in _families(docs, marks).collect()]
    assert set(got) <= {(t, y) for _, t, y in rows}
    assert sorted(g for g in got if passage[0] in g[0].split() and "changed" not in g[0]) == sorted(
        (t, y) for i, t, y in rows if i < 100)
    assert sorted(y for t, y in got if "changed" in t) == [0, 1]


def test_toxicity_without_labels_or_rows(shipped):
    docs = shipped.createDataFrame([(1, "moron"), (2, None)], "doc_id long, text string")
    marks = shipped.createDataFrame([], "doc_id long, toxic int")
    assert score_toxicity(docs, marks, held_out("doc_id", 3, 1)).count() == 2
    assert score_toxicity(docs.filter("false"), marks, held_out("doc_id", 3, 1)).count() == 0


def test_label_model_does_not_count_correlated_voters_twice():
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.3
    pattern = np.zeros(n, np.int64)
    copied = np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.2)  # a weak voter and three copies of it
    for bit in range(4):
        pattern |= copied.astype(np.int64) << bit
    for bit in (5, 6, 7):  # good voters, independent
        pattern |= np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.05).astype(np.int64) << bit
    given = np.where(rng.random(n) < 0.05, y, -1)
    rows, counts = np.unique(np.stack([pattern, given]), axis=1, return_counts=True)
    model = fit_label_model(rows[0], counts.astype(float), rows[1])
    group = next(g for g in model.groups if 0 in g)
    assert {0, 1, 2, 3} <= set(group)
    posterior = model.posterior(pattern)
    assert abs(posterior.mean() - y.mean()) < 0.03
    assert np.mean((posterior > 0.5) == y) > 0.93
    weights = fit_classifier(rows[0], counts.astype(float), model.posterior(rows[0]))
    assert weights[1 + 5] > 1 and len(weights) == len(VOTERS) + 1
    assert any(len(g) > 1 for g in _correlated(rows[0], counts.astype(float), model.posterior(rows[0])))


def test_votes():
    lexicon = Lexicon(words={"foo": 2}, stems={"barb": 1})
    found = [v for i, v in enumerate(VOTERS) if votes("Foo, BARBARIAN moron!", lexicon) >> i & 1]
    assert found == ["insults_en", "words_2", "stems_1", "two_hits", "dense", "very_dense"]
    assert votes(None, lexicon) == 1 << VOTERS.index("nothing_found")


def test_empty_tables(empty):
    items = empty.sparkSession.createDataFrame([], "item_id long, text string")
    assert pack_powers(empty).count() == 0
    assert context_totals(length_histogram(encoded_lengths(empty))).count() == 0
    assert mark_contamination(empty, items).count() == 0
    assert identify(empty, empty).count() == 0
