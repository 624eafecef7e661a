"""Source divergence audit: how far the word shares of each source are from those of the others.

Counting is an Arrow compute pipeline inside ``mapInArrow``: ``ascii_lower``, a split at the
characters that are in no term, ``dictionary_encode``, and two hash ``group_by``, first by
(document, term), then by (language, source, term). A task merges its partial counts and hands
them on whenever they reach ``HELD_TERMS`` rows, so it holds a bounded number of them.

Merged counts of kept terms are cut into shards of a language by term. A shard is a columnar
matrix of sources x terms of about ``SHARD_NUMBERS`` numbers; it computes the shares of its
terms, their part of the distance of each two sources, and its own best terms of each source.
Distances add up over shards and the best terms are ranked again. Arithmetic is on integers.

Null language, source and text are empty texts. Rows are documents, repeated ones count again.
A (language, source) without terms still takes part: all its counts are 0. In a language
without kept terms all distances are 0. Ties are ranked by the item's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.session import stage

# Fixed value: runs of characters that belong to no term (ASCII without letters).
GAP = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
HELD_TERMS = 150_000
SHARD_NUMBERS = 50_000
SCALE = 1_000_000_000  # of shares
PRIOR = 5
_COUNTS = "lang string, source string, term string, n long, d long"


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, d): occurrences and documents of each term in a batch of
    (lang, source, text)."""
    texts = pc.ascii_lower(batch.column(2))
    parts = pc.split_pattern_regex(texts, pattern=GAP)
    terms = pc.list_flatten(parts)
    docs = pc.list_parent_indices(parts)
    real = pc.not_equal(terms, "")  # a gap at either end leaves an empty part
    coded = pc.dictionary_encode(pc.filter(terms, real))
    pairs = pa.table({"doc": pc.filter(docs, real), "term": coded.indices})
    pairs = pairs.group_by(["doc", "term"]).aggregate([([], "count_all")])
    lang, source = (pc.dictionary_encode(batch.column(i)) for i in (0, 1))
    pairs = pa.table({
        "lang": pc.take(lang.indices, pairs["doc"]), "source": pc.take(source.indices, pairs["doc"]),
        "term": pairs["term"], "n": pairs["count_all"],
    })
    found = pairs.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
    spelt = [pc.take(x.dictionary, found[c]) for x, c in ((lang, "lang"), (source, "source"), (coded, "term"))]
    return pa.table([*spelt, found["n_sum"], found["n_count"]], names=["lang", "source", "term", "n", "d"])


def _merged(held: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("d", "sum")])
    return both.select(["lang", "source", "term", "n_sum", "d_sum"]).rename_columns(["lang", "source", "term", "n", "d"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows, kept = [], 0, 0
    for batch in batches:
        held.append(count_terms(batch))
        rows += held[-1].num_rows
        if rows > max(HELD_TERMS, 2 * kept):
            held = [_merged(held)]
            kept = rows = held[0].num_rows
            if rows > HELD_TERMS:
                yield from held[0].to_batches()
                held, rows, kept = [], 0, 0
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d) over all documents."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = texts.mapInArrow(_partial_counts, _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), a row per total.

    Three digits at a time, so that nothing exceeds 64 bits up to totals of 9e15.
    """
    below = (np.asarray(totals, np.int64) + PRIOR * terms)[:, None]
    whole, rest = np.divmod(counts + PRIOR, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


_RESULT = "lang string, source string, part string, item string, value long"


def _audit_shard(top: int):
    def audit(cells: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        lang, sources = groups["lang"][0].as_py(), groups["source"].to_pylist()
        totals, n_terms = groups["total"].to_numpy(), groups["terms"][0].as_py()
        place = {s: i for i, s in enumerate(sources)}
        coded = pc.dictionary_encode(cells["term"]).combine_chunks()
        terms = coded.dictionary
        counts = np.zeros((len(sources), len(terms)), np.int64)
        if len(terms):
            rows = pc.index_in(cells["source"], pa.array(place)).to_numpy()
            counts[rows, coded.indices.to_numpy()] = cells["n"].to_numpy()
        of = shares(counts, totals, n_terms) if len(terms) else counts
        every = shares(counts.sum(axis=0)[None], totals.sum()[None], n_terms)[0] if len(terms) else counts[0]
        out = []
        for i, source in enumerate(sources):
            far = np.abs(of - of[i]).sum(axis=1)
            others = [j for j in range(len(sources)) if j != i]
            out.append(_rows(lang, source, "pair", pa.array([sources[j] for j in others], pa.string()), far[others]))
            more = np.flatnonzero((counts[i] > 0) & (of[i] > every))
            value = of[i][more] - every[more]
            if len(more) > top:  # all that tie with the last one go on
                least = np.partition(value, len(value) - top)[len(value) - top]
                more, value = more[value >= least], value[value >= least]
            out.append(_rows(lang, source, "term", terms.take(pa.array(more)), value))
        return pa.concat_tables(out)

    return audit


def _rows(lang: str, source: str, part: str, items: pa.Array, values: np.ndarray) -> pa.Table:
    n = len(items)
    fixed = [pa.array([x] * n, pa.string()) for x in (lang, source, part)]
    return pa.table([*fixed, items, pa.array(values, pa.int64())], names=["lang", "source", "part", "item", "value"])


def divergence_audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: for each (lang, source) its distance to each other
    source of the language (part ``pair``, all ranks) and the kept terms it uses more than the
    language does (part ``term``, ranks to ``top``). Kept are terms in at least ``min_docs``
    documents of the language.
    """
    counts = stage(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("d").alias("docs")).filter(F.col("docs") >= min_docs)
    cells = stage(counts.join(kept.drop("docs"), ["lang", "term"]), "kept-counts")
    occurring = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    ).distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = occurring.join(totals, ["lang", "source"], "left").na.fill(0, ["total"])
    terms = cells.groupBy("lang", "term").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("terms"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(terms, "lang", "left").na.fill(0, ["terms"])
    langs = stage(
        langs.withColumn("shards", F.expr(f"greatest(1L, ceil(sources * terms / {SHARD_NUMBERS}))")), "languages"
    )
    keys = ["lang", "shard"]
    matrix = cells.join(langs.select("lang", "shards"), "lang").select(
        "lang", F.expr("pmod(xxhash64(term), shards)").alias("shard"), "source", "term", "n"
    )
    sides = groups.join(langs, "lang").select(
        "lang", F.explode(F.expr("sequence(0L, shards - 1)")).alias("shard"), "source", "total", "terms"
    )
    found = matrix.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(_audit_shard(top), _RESULT)
    # a term is in one shard, a pair of sources in each
    added = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = added.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
