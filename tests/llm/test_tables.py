"""Nearest neighbours, manifest and divergence against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import CLASHING
from pyspark.sql import functions as F

from pairwarden.llm.divergence import divergence_audit, shares
from pairwarden.llm.manifest import Store, fold, merkle_manifest, read_path
from pairwarden.llm.nearest import Settings, nearest_by_product

def asks():
    return F.col("vec_id") % 3 == 0


def brute_nearest(rows, k):
    """All rows in order for each query: (query_id, rank, vec_id)."""
    fine = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in fine), default=0)
    full = [(i, np.array(v + [0.0] * (width - len(v)))) for i, v in fine]
    out = []
    for n, (i, q) in enumerate(full):
        if i is None or i % 3:
            continue
        others = [(-(v * q).sum(), 2**63 if j is None else j, j) for m, (j, v) in enumerate(full) if m != n]
        out += [(i, r, j) for r, (_, _, j) in enumerate(sorted(others, key=lambda o: o[:2])[:k], 1)]
    return out


@pytest.fixture(scope="module")
def vectors(shipped):
    def make(rows):
        names = [c for c in CLASHING.split()] + ["pivot", "part", "query", "score"]
        schema = "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in names)
        return shipped.createDataFrame([(i, v, *["x"] * len(names)) for i, v in rows], schema).repartition(3)

    return make


def test_nearest_with_odd_rows(vectors):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(90, [1.0] * 6)] * 3 + [(91 + i, [1.0] * 6) for i in range(30)]  # repeated rows, ties
    rows += [(None, [1.0] * 6), (200, None), (201, []), (203, [0.0] * 6), (204, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (207, [float("nan")] * 6), (210, [float("inf")] + [0.0] * 5), (213, [5.0, 5.0]), (216, [1e-200] * 6)]
    got = nearest_by_product(vectors(rows), asks(), k=7, miss=1e-9).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(brute_nearest(rows, 7))


def test_nearest_returns_all_when_fewer(vectors):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (3, [-1.0, 0.0])]
    got = nearest_by_product(vectors(rows), asks(), k=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 0.5), (0, 2, 3, -1.0), (3, 1, 1, -0.5), (3, 2, 0, -1.0)]
    assert nearest_by_product(vectors([(0, [1.0])]), asks()).count() == 0
    assert nearest_by_product(vectors([]), asks()).count() == 0
    assert nearest_by_product(vectors([]), asks()).columns == ["query_id", "rank", "vec_id", "score"]


def test_nearest_recall(vectors):
    """Clustered vectors of unequal length with a hot vector: 0.9 and more of the true neighbours."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((25, 24))
    rows = [(i, (centres[i % 25] + 0.4 * rng.standard_normal(24)) * rng.uniform(0.5, 2)) for i in range(3000)]
    rows += [(3000 + i, centres[0]) for i in range(1500)]
    rows = [(i, v.tolist()) for i, v in rows]
    got = defaultdict(set)
    for r in nearest_by_product(vectors(rows), F.col("vec_id") % 30 == 0, k=10).collect():
        got[r.query_id].add(r.vec_id)
    table, hit, all_ = np.array([v for _, v in rows]), 0, 0
    for q in range(0, 4500, 30):
        s = (table * table[q]).sum(axis=1)
        s[q] = -np.inf
        want = set(np.lexsort((np.arange(len(s)), -s))[:10].tolist())
        hit, all_ = hit + len(want & got[q]), all_ + 10
    assert hit / all_ >= 0.9


def test_collision_threshold():
    assert Settings(20, 32, 10.0, 0.01).threshold == 32  # a window that holds all
    few = Settings(20, 32, 1.5, 0.02).threshold
    assert Settings(20, 32, 1.5, 0.2).threshold >= few >= Settings(20, 32, 1.0, 0.02).threshold


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes):
    """(root, path of each leaf)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            if at ^ 1 < len(nodes):
                paths[i].append((at % 2, nodes[at ^ 1]))
            else:
                paths[i].append((0, ""))
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        places = [at // 2 for at in places]
    return nodes[0], paths


def brute_manifest(rows):
    out, trees = [], defaultdict(list)
    for row in rows:
        trees[row[2]].append((sha("".join(map(field, row))), row))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    subroots = {lang: brute_tree([leaf for leaf, _ in trees[lang]]) for lang in order}
    root, tops = brute_tree([subroots[lang][0] for lang in order])
    for lang, top in zip(order, tops):
        for (leaf, row), path in zip(trees[lang], subroots[lang][1]):
            whole, node = path + top, leaf
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            if changed and row[3] is not None:
                node = sha("".join(map(field, (*row[:3], row[3] + 1, row[4]))))
            for right, other in whole:
                node = sha(other + node if right else node + other)
            out.append((row[0], leaf, subroots[lang][0], root, sha("".join(o for _, o in whole)), node, node == root))
    return out


MANIFEST = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


@pytest.fixture(scope="module")
def tables(shipped):
    def make(rows):
        names = ["tree", "idx", "size", "hash", "path", "block", "term", "n", "d", "value", "rank", "_row"]
        schema = "doc_id long, source string, lang string, n_chars long, text string, "
        schema += ", ".join(f"`{c}` string" for c in names)
        return shipped.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema).repartition(3)

    return make


def odd_rows(n=60):
    rng = random.Random(4)
    words = ["Straße", "été", "A1b", "x", "日本", "THE", "the", "of", "Öl", "i̇"]
    rows = [(i, rng.choice(["s1", "s2", "Ä", None]), rng.choice(["en", "de", "é", None]), rng.choice([None, i]),
             rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 30))), "\0 1-2"])) for i in range(n)]
    rows += [rows[3]] * 3 + [(None, "s1", "en", 5, "tie")] * 2 + [(None, "s1", "en", 6, "tie")]
    return rows + [(500, "s9", "alone", 1, "one leaf only"), (501, "s1", "", 2, "empty language"),
                   (502, "s1", "en", 10**6, "long text " * 100_000)]


def test_manifest_matches_brute_force(tables, same):
    rows = odd_rows()
    out = merkle_manifest(tables(rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    same(out, MANIFEST, brute_manifest(rows))
    assert out.filter("not verified").count() > 0


@pytest.mark.parametrize("rows", [[], [(7, None, None, None, None)], [(7, "s", "en", 1, "a"), (7, "s", "en", 1, "a")]])
def test_manifest_of_few_rows(tables, same, rows):
    out = merkle_manifest(tables(rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    same(out, MANIFEST, brute_manifest(rows) if rows else [])


def test_manifest_beyond_one_block(shipped, same):
    """More leaves than a block in one language, and more languages than a block."""
    rows = [(i, "s", "en", i, f"text {i}") for i in range(2500)]
    rows += [(5000 + i, "s", f"l{i:04}", i, "x") for i in range(1100)]
    docs = shipped.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    out = merkle_manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0, with_copies=True)
    same(out, MANIFEST, brute_manifest(rows))
    row = out.filter("not verified and lang = 'en'").first()
    path = read_path(row.path)
    assert row.copies == [row.copies[0], *fold(row.copies[0], path)] and row.copies[-1] == row.folded_root


def test_store_shares_untouched_nodes():
    store = Store([sha(str(i)) for i in range(11)], 4)
    before = len(store.hash)
    version = store.set(6, sha("other"))
    assert len(store.hash) == before + 5  # the leaf and its four ancestors
    assert store.hash[store.root] != store.hash[version]
    assert store.path(6) == store.path(6, version) and store.path(7) != store.path(7, version)
    again = store.set(6, sha("6"), version)  # a version of the version
    assert store.hash[again] == store.hash[store.root]


def brute_audit(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, source, lang, _, text in rows:
        lang, source = lang or "", source or ""
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]

        def share(count, total):
            return 1 + 1_000_000_000 * (count + 5) // (total + 5 * len(kept))

        each = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], each[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(each.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            more = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)]
    return out


AUDIT = "lang source part item value rank".split()


@pytest.mark.parametrize("top", [3, 50])
def test_audit_matches_brute_force(tables, same, top, monkeypatch):
    from pairwarden.llm import divergence

    monkeypatch.setattr(divergence, "SHARD_NUMBERS", 12)  # several shards a language
    rows = odd_rows(300)
    same(divergence_audit(tables(rows), 5, top), AUDIT, brute_audit(rows, 5, top))


def test_audit_without_terms(tables, same):
    rows = [(1, "a", "en", 1, None), (2, "b", "en", 1, "12 %"), (3, None, None, 1, ""), (3, None, None, 1, "word")]
    same(divergence_audit(tables(rows)), AUDIT, brute_audit(rows, 30, 50))
    assert divergence_audit(tables([])).count() == 0


def test_shares_are_exact():
    rng = random.Random(2)
    totals = [rng.randrange(1, 9 * 10**14) for _ in range(50)]
    counts = np.array([[rng.randrange(0, t + 1) for _ in range(3)] for t in totals])
    got = shares(counts, np.array(totals), 7)
    want = [[1 + 10**9 * (int(c) + 5) // (t + 35) for c in row] for row, t in zip(counts, totals)]
    assert got.tolist() == want
