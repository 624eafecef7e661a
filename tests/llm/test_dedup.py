"""Exact, line, suffix, substring and SimHash de-duplication against brute force."""

import random
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from pairwarden.llm import components as star
from pairwarden.llm.exact_dedup import exact_duplicates, heavy_digests, keep_one, text_digests
from pairwarden.llm.line_dedup import drop_repeated_lines
from pairwarden.llm.repeats import mixed, twice_seen
from pairwarden.llm.simhash_dedup import fingerprint, links, near_duplicates
from pairwarden.llm.simhash_dedup import keep_one as keep_one_near
from pairwarden.llm.substring_dedup import levels, remove_repeats, smallest, window_hashes
from pairwarden.llm.suffix_dedup import RunIndex, remove_long_repeats, seeds
from pairwarden.llm.tables import narrow


def test_suffix_dedup(docs, rows, same):
    got = remove_long_repeats(docs)
    same(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.long_repeats(rows))


def test_suffix_dedup_other_window_and_text(docs, rows, same):
    got = remove_long_repeats(docs, window=20, seed=9).cache()
    same(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.long_repeats(rows, 20))
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in got.collect())


def test_suffix_dedup_splits_hot_seeds(make_docs, same):
    rng = random.Random(1)
    passage = "a passage that every second document holds, with its own words around it; " * 2
    rows = [(i, f"{rng.random()}" * 4 + passage * (i % 2) + f"{rng.random()}" * 4) for i in range(300)]
    docs = make_docs(rows)
    assert len(twice_seen(narrow(docs), lambda t: seeds(t, 50, 16), 10_000, hot_parts=512).hot) > 0
    same(remove_long_repeats(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
         brute.long_repeats(rows))


def test_suffix_dedup_of_a_text_longer_than_a_block(make_docs, same, monkeypatch):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1_100_000))
    rows = [(1, base), (2, "x" + base[1_040_000:1_060_000] + "y")]
    got = {r.doc_id: r for r in remove_long_repeats(make_docs(rows)).collect()}
    assert got[1].n_removed == 0
    assert (got[2].n_removed, got[2].n_spans) == (20_000, 1)


def test_run_index_against_all_windows():
    rng = random.Random(4)
    for _ in range(150):
        depth = rng.choice([3, 7, 8, 15, 50])
        letters = bytes(rng.sample(range(256), 3)) + b"\0"
        base = bytes(rng.choice(letters) for _ in range(120))
        segments = {}
        for _ in range(rng.randint(1, 25)):
            n, at = rng.randint(depth, depth + 20), rng.randrange(50)
            text = base[at:at + n] if rng.random() < 0.6 else bytes(rng.choice(letters) for _ in range(n))
            segments[text] = rng.randint(0, 9)
        first = {}
        for text, doc in segments.items():
            for i in range(len(text) - depth + 1):
                first[text[i:i + depth]] = min(first.get(text[i:i + depth], 99), doc)
        index = RunIndex(list(segments), np.array(list(segments.values())), depth)
        found, windows = index.first_documents(list(segments))
        assert windows.tolist() == [len(text) - depth + 1 for text in segments]
        assert found.tolist() == [first[text[i:i + depth]] for text in segments for i in range(len(text) - depth + 1)]


def test_run_index_compresses_repetitive_text():
    text = bytes(random.Random(5).choice(b"abcdefgh") for _ in range(600))
    segments = [text[i:i + 100] for i in range(0, 500)]
    index = RunIndex(segments, np.arange(500), 50)
    assert len(index.key) < 500 * 52 / 10


@pytest.mark.parametrize("window, first", [(13, 7), (13, 2), (5, 3)])
def test_substring_dedup(docs, rows, same, window, first):
    got = remove_repeats(docs, window=window, first=first)
    same(got, ["doc_id", "n_words", "n_removed", "kept_sha256"], brute.word_repeats(rows, window))


def test_levels_double_up_to_the_window():
    assert levels(7, 13) == [7]
    assert levels(2, 13) == [2, 4, 8]
    h = np.random.default_rng(1).integers(0, 2**63, 60, dtype=np.uint64)
    for n in (1, 2, 3, 7, 13, 16, 50):
        assert (window_hashes(h, n)[3:] == window_hashes(h[3:], n)).all()
        assert len(set(window_hashes(h, n).tolist())) == 61 - n
    for n in (1, 2, 3, 7, 8):
        assert smallest(h, n).tolist() == [h[i:i + n].min() for i in range(61 - n)]


@pytest.mark.parametrize("broadcast", [200_000, 0])
@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(docs, rows, same, broadcast, keep_first):
    got = drop_repeated_lines(docs, min_docs=6, keep_first=keep_first, max_broadcast_keys=broadcast)
    want = brute.repeated_lines(rows, 6, keep_first)
    if keep_first:  # of repeated rows, each holds the first occurrence
        assert sum(r[2] for r in want) > 0
    same(got, ["doc_id", "n_lines", "n_dropped", "kept_sha256"], want)


def test_tiny_filter_only_costs_suspects(docs, rows, same):
    got = drop_repeated_lines(docs, min_docs=6, max_filter_bytes=1 << 17)
    same(got, ["doc_id", "n_lines", "n_dropped", "kept_sha256"], brute.repeated_lines(rows, 6))


def test_twice_seen_filter_has_no_false_negatives(make_docs):
    rng = np.random.default_rng(7)
    values = mixed(rng.integers(0, 2**63, 30_000, dtype=np.uint64))
    docs = narrow(make_docs([(i, str(i)) for i in range(60)]))

    def hasher(text):
        at = int(text) % 30 * 1000
        return values[at:at + 500] if int(text) >= 30 else values[at:at + 1000]

    seen = twice_seen(docs, hasher, 60_000)
    twice = np.concatenate([values[i:i + 500] for i in range(0, 30_000, 1000)])
    once = np.concatenate([values[i + 500:i + 1000] for i in range(0, 30_000, 1000)])
    assert seen(twice).all()
    assert seen(once).mean() < 0.1


def test_exact_dedup(docs, rows):
    got = exact_duplicates(docs, counters=8).collect()
    groups = defaultdict(list)
    for doc, text in rows:
        groups[brute.sha((text or "").translate(brute.LOW).encode())].append(doc)
    assert sorted((r.doc_id, r.text_sha256) for r in got if r.doc_id is not None) == sorted(
        (d, k) for k, g in groups.items() for d in g if d is not None)
    kept = defaultdict(int)
    for r in got:
        group = groups[r.text_sha256]
        largest = max((d for d in group if d is not None), default=None)
        assert (r.keep_id, r.group_size) == (largest, len(group))
        assert not r.kept or r.doc_id == largest
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_dedup_keeps_whole_rows(docs, rows):
    got = keep_one(docs, counters=8)
    assert got.columns == docs.columns
    texts = [(r.text or "").translate(brute.LOW) for r in got.collect()]
    assert sorted(texts) == sorted({(t or "").translate(brute.LOW) for _, t in rows})


def test_misra_gries_finds_every_heavy_digest(make_docs):
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 5 == 0 else f"cold {i}") for i in range(3000)]
    heavy = {bytes(r.digest).hex() for r in heavy_digests(text_digests(make_docs(rows)), 16).collect()}
    assert {brute.sha(b"hot"), brute.sha(b"warm")} <= heavy
    assert len(heavy) <= 16


def test_simhash(docs, rows, same):
    prints = [(d, brute.fingerprint(t)) for d, t in rows]
    got = near_duplicates(docs)
    same(got, ["doc_id", "fingerprint", "component_id"], brute.components(prints))


def test_simhash_keeps_one_row_of_each_component(docs, rows):
    got = keep_one_near(docs)
    assert got.columns == docs.columns
    want = {c for _, _, c in brute.components([(d, brute.fingerprint(t)) for d, t in rows])}
    ids = [r.doc_id for r in got.collect()]
    assert set(ids) == want and ids.count(15) <= 1
    parts = brute.components([(i, brute.fingerprint(t)) for i, (_, t) in enumerate(rows)])
    assert len(ids) == len({part for _, _, part in parts})  # components without any id count each


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_links_connect_whatever_is_near(shipped, distance):
    rng = random.Random(distance)
    prints = {0}
    for _ in range(25):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(6):
            flips = rng.sample(range(64), rng.randint(1, distance + 2))
            prints.add(base ^ sum(1 << b for b in flips))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = star.components(links(shipped.createDataFrame(signed, "fp long"), distance)).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in found}
    parts = defaultdict(set)
    for doc, _, part in brute.components(list(enumerate(prints)), distance):
        parts[part].add(prints[doc])
    got = defaultdict(set)
    for p in prints:
        got[root.get(p, p)].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, parts.values()))


def test_fingerprint_of_few_words():
    assert fingerprint(b" \n", 3) == 0
    assert fingerprint(b"One", 3) == brute.fingerprint("one")
    assert fingerprint("É b\tC d e".encode(), 3) == brute.fingerprint("É b\tC d e")


def test_components_of_a_long_chain_and_a_hub(shipped):
    edges = [(i, i + 1) for i in range(100, 160)] + [(-5, x) for x in range(500, 900)] + [(7, 7)]
    got = {r.node: r.root for r in star.components(shipped.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(500, 900)} == {-5} and got[-5] == -5


def test_empty_tables(empty):
    for frame in (remove_long_repeats(empty), remove_repeats(empty), drop_repeated_lines(empty),
                  exact_duplicates(empty), keep_one(empty), near_duplicates(empty), keep_one_near(empty)):
        assert frame.count() == 0


def test_windows_of_one_first_hash_are_told_apart(make_docs, monkeypatch, same):
    """A forced collision of the first 64 bits: windows of different words stay."""
    from pairwarden.llm import substring_dedup as S

    pairs = np.array([[5, 1], [5, 2], [7, 1]], np.uint64)
    h, c = np.array([5, 5, 5, 7, 8], np.uint64), np.array([1, 2, 3, 1, 1], np.uint64)
    assert S.among(h, c, pairs).tolist() == [True, True, False, True, False]
    assert not S.among(h, c, pairs[:0]).any()
    d = np.array([9, 4, 3, 2, 1])
    assert [x.tolist() for x in S._first_of(h[[0, 0, 1, 2, 2]], c[[0, 0, 1, 2, 2]], d)] == [[5, 5, 5], [1, 2, 3], [4, 3, 1]]
    owned = next(S._own(iter([pa.RecordBatch.from_pylist([
        {"bucket": 0, "hashes": h[:3].tobytes(), "checks": c[:3].tobytes(), "docs": np.array([3, 2, 1]).tobytes()},
        {"bucket": 0, "hashes": h[:1].tobytes(), "checks": c[:1].tobytes(), "docs": np.array([1]).tobytes()},
    ])])))
    assert {r["rank"]: np.frombuffer(r["own"], np.uint64).reshape(-1, 2).tolist() for r in owned.to_pylist()} == {
        1: [[5, 1], [5, 3]], 2: [[5, 2]]}
