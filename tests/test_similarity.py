"""Similarity pairs against brute force, with hot words, copies and bounds."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairwarden.operators import dots, similarity
from pairwarden.operators.similarity import bag_degrees, bag_rows, named_links, similar_bags, similar_classes, similar_pairs


def brute(rows, min_sim):
    out = {}
    bags = [(i, g, Counter(re.findall(r"\w\w+", t.lower()))) for i, g, t in rows]
    for (i, g, a), (j, h, b) in itertools.combinations(bags, 2):
        dot = sum(a[w] * b[w] for w in a)
        if g != h or not dot:
            continue
        sim = dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        if sim > min_sim:
            out[min(i, j), max(i, j)] = round(sim, 9)
    return out


def texts():
    words = [f"w{k}" for k in range(12)]
    rows = []
    for i in range(60):
        picked = " ".join(words[(i * k) % 12] for k in range(1, 3 + i % 5))
        # a word in every text, and a third of all rows are copies
        rows.append((i, "g" if i % 4 else "h", "common same text" if i % 3 == 0 else f"common {picked}"))
    return [*rows, (100, "g", "!"), (101, "g", "a b"), (102, "g", "alone")]


@pytest.mark.parametrize("min_sim", [0.0, 0.4, 0.8, 0.95])
@pytest.mark.parametrize("block", [2048, 4])
def test_pairs_match_brute_force(spark, min_sim, block):
    rows = texts()
    df = spark.createDataFrame(rows, "id int, g string, t string").repartition(3)
    found = similar_pairs(df, ["g"], "id", ["id"], "t", min_sim, block).collect()
    assert len(found) == len({(r.f_id, r.b_id) for r in found})
    assert {(r.f_id, r.b_id): round(r.sim, 9) for r in found} == brute(rows, min_sim)


def test_copies_share_a_bag(spark):
    df = spark.createDataFrame([(i, "g", "same words here") for i in range(50)], "id int, g string, t string")
    found = similar_bags(df, ["g"], "t")
    assert found.pairs.count() == 0
    assert found.members.select("bag").distinct().count() == 1


@pytest.mark.parametrize("min_sim", [0.0, 0.95])
def test_a_burst_of_equal_texts_makes_as_many_rows(spark, min_sim):
    df = spark.range(100_000).selectExpr("id", "'g' as g", "'the same words here' as t").unionByName(
        spark.createDataFrame([(200_000, "g", "the same words there"), (200_001, "g", "!")], "id long, g string, t string"))
    found = similar_classes(df, ["g"], "id", "t", min_sim)
    links = found.groupBy("f_id").count().collect()
    assert [(r.f_id, r["count"]) for r in links] == [(0, 99_999 + (min_sim == 0.0))]


def test_classes_are_the_pairs_in_less_space(spark):
    df = spark.createDataFrame(texts(), "id int, g string, t string")
    links = [(r.g, r.f_id, r.b_id, r.sim) for r in similar_classes(df, ["g"], "id", "t").collect()]
    pairs = similar_pairs(df, ["g"], "id", ["id"], "t").collect()
    name = {b: f for _, f, b, s in links if s == 1.0}
    sims = {(f, b): s for _, f, b, s in links}
    for r in pairs:
        f, b = name.get(r.f_id, r.f_id), name.get(r.b_id, r.b_id)
        assert r.sim == pytest.approx(1.0 if f == b else sims[min(f, b), max(f, b)])


@pytest.mark.parametrize("block", [2048, 4])
def test_links_are_counted_without_being_written(spark, block):
    rows = [(*r, f"s{r[0] % 3}" if r[0] % 7 else None) for r in texts()]
    df = spark.createDataFrame(rows, "id int, g string, t string, site string")
    found = bag_degrees(bag_rows(df, "t"), ["g"], 0.4, "site", block)
    assert "Join" not in found._jdf.queryExecution().analyzed().toString().split("MapInArrow")[0]
    bags = similar_bags(df, ["g"], "t", 0.4)
    sites = {}
    for r in bags.members.collect():
        if r.site and r.bag:
            sites.setdefault((r.g, bytes(r.bag)), set()).add(r.site)
    want = Counter()
    for r in bags.pairs.collect():
        ends = [(r.g, bytes(x)) for x in (r.a, r.b)]
        if len(set().union(*[sites.get(x, set()) for x in ends])) > 1:
            want.update(ends)
    assert want and {(r.g, bytes(r.bag)): r.n_links for r in found.collect()} == want


@pytest.mark.parametrize("min_sim", [0.4, 0.95])
@pytest.mark.parametrize("block", [2048, 4])
def test_links_of_two_sites_are_all_written(spark, block, min_sim):
    rows = [(*r, f"s{r[0] % 3}" if r[0] % 7 else None) for r in texts()]
    rows += [(200 + i, g, " ".join(f"long{k}" for k in range(40 + i)), s) for i, (g, s) in enumerate(
        [("g", "s0"), ("g", "s0"), ("g", "s1"), ("g", None), ("h", "s1"), (None, "s1")])]
    bags = bag_rows(spark.createDataFrame(rows, "id int, g string, t string, site string"), "t")
    links, degrees = named_links(bags, ["g"], min_sim, F.min("id"), "site", block)
    sites, name = {}, {}
    for i, g, t, place in rows:
        bag = g, tuple(sorted(re.findall(r"\w\w+", t.lower())))
        name[i] = min(name.get(bag, i), i)
        name[bag] = name[i]
        sites.setdefault(name[i], set()).update({place} - {None})
    want = {p: sim for p, sim in brute([r[:3] for r in rows if r[1]], min_sim).items()
            if all(name[i] == i for i in p) and len(sites[p[0]] | sites[p[1]]) > 1}
    found = links.collect()
    assert len(want) > 2 and {tuple(sorted((r.a_name, r.b_name))): round(r.sim, 9) for r in found} == want
    assert len(found) == len(want) and sum(r.n_links for r in degrees.collect()) == 2 * len(want)


@pytest.mark.parametrize("asked", [None, "id % 50 = 0"])
def test_pairs_below_the_bound_make_no_rows(spark, asked):
    """All texts share 30 words: 8 million pairs of 31 meetings each, of which one is a link."""
    df = spark.range(4000).selectExpr(
        "id", "'g' as g", "concat_ws(' ', transform(sequence(1, 30), x -> concat('common', x)), "
        "transform(sequence(1, 3), x -> concat('own', x, '_', id - if(id = 3950, 50, 0))), if(id = 3950, 'own1_3900', '')) as t")
    found = similar_classes(df, ["g"], "id", "t", 0.95, 512, asked and F.expr(asked))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "word" not in plan.replace("_words", "")
    assert [(r.f_id, r.b_id) for r in found.collect()] == [(3900, 3950)]


def test_sketches_are_never_less_than_the_similarity():
    draw = np.random.default_rng(5)
    texts = [" ".join(sorted(f"wörd{w}" for w in draw.zipf(1.3, n) % 3000)) for n in draw.integers(1, 400, 300)]
    texts += [t + " zz" for t in texts[:50]]
    near = np.frombuffer(b"".join(dots.sketch(pa.array(texts)).to_pylist()), np.float16).reshape(-1, dots.SKETCH)
    near = near.astype(np.float32) @ near.astype(np.float32).T
    want = brute([(i, "g", t) for i, t in enumerate(texts)], 0.0)
    assert len(want) > 10_000 and all(near[pair] > sim - dots.ROUNDED for pair, sim in want.items())
    assert any(sim > 0.95 for sim in want.values()) and (near < 0.8).any()


@pytest.mark.parametrize("asked", [None, "id % 50 = 0"])
@pytest.mark.parametrize("min_sim", [0.95, 0.999])
def test_bags_near_to_none_are_not_repeated(spark, asked, min_sim):
    """Of 2,000 texts in 40 blocks three are near; before, all were in as many cells as blocks."""
    df = spark.range(2000).selectExpr(
        "id", "'g' as g", "concat_ws(' ', 'common', transform(sequence(1, 40), x -> concat('own', x, '_', "
        "id - case id when 1950 then 1253 when 700 then 3 else 0 end)), if(id = 1950, 'more', '')) as t")
    found = similar_classes(df, ["g"], "id", "t", min_sim, 50, asked and F.expr(asked))
    links = sorted((r.f_id, r.b_id) for r in found.collect())
    want = [(697, 700)] + ([(697, 1950)] if min_sim == 0.95 else [])
    assert links == want
    rows = bag_rows(df, "t", asked and F.expr(asked))
    cells = similarity._bag_cells(rows, ["g"], min_sim, 50, asked is not None, {})
    assert cells.count() <= 4
