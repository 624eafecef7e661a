"""Approximate nearest neighbours by collision counting (largest inner product).

Vectors are lifted by one coordinate so that all have the length of the longest one; the
largest inner products with a query are then the smallest distances. Each of ``projections``
random lines gives a sorted array of single projections. A query opens a window around its
own projection on every line and widens all of them together, radius by radius (virtual
rehashing: nothing is hashed again, only the newly covered ends of the windows are counted).
A vector met in enough windows is verified: its exact inner product is computed from the
original vectors. Widening ends when the radius has passed the distance of the k-th best
found; a vector that close fails to collide often enough with probability ``miss``.

Layout. Every row is indexed: it goes to the nearest of at most ``MAX_PIVOTS`` pivots (rows
drawn by hash, the only fit) and, where a pivot has many rows, to a part of bounded size, in
which the arrays are built. Each query first searches its own part; the k-th best of it
rules out pivots whose ball (largest distance of a row) cannot hold anything better, which is
exact. Queries then meet the parts that are left in chunks, so a task holds one part and one
chunk. A pivot whose rows are a third of the table is many parts like any other.

Rows whose vector is null, empty, zero, or holds null or non-finite components take no part.
Rows are rows: repeated ids and repeated vectors all count, a query leaves out only its own
row. Ties go to the smaller id, rows without an id last; those are never queries. Shorter
vectors count as filled up with zeros. With fewer than k other rows all are returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.llm.tables import record
from pairwarden.session import stage

MAX_PIVOTS = 1024  # rows that the grouping is fitted on; also the most groups
LEAST_PART, MOST_PART = 512, 8192  # rows of a part
CHUNK = 1024  # queries of a chunk
SEED = 11
_GROWTH = 1.25  # of the radius from one level to the next
_SLACK = 1 + 1e-9
_FOUND = "query long, query_id long, row long, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    """``half`` is half a window's width at radius 1."""

    k: int
    projections: int
    half: float
    miss: float

    @property
    def threshold(self) -> int:
        """Collisions that a vector inside the radius reaches with probability 1 - ``miss``."""
        m, p = self.projections, erf(self.half / sqrt(2))
        below = 0.0
        for n in range(m + 1):
            below += comb(m, n) * p**n * (1 - p) ** (m - n)
            if below > self.miss:
                return max(n, 1)
        return m


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of numbers of ``width``, shorter ones filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    ends = ends - ends[0]
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, size in enumerate(sizes):
        out[i, :size] = flat[ends[i] : ends[i] + size]
    return out


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


class Lines:
    """Sorted arrays of the projections of a part's rows, and the search in them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, ranks: np.ndarray, settings: Settings):
        self.rows, self.ids, self.ranks, self.settings = rows, ids, ranks, settings
        width = rows.shape[1]
        self.lines = np.random.default_rng(SEED).standard_normal((settings.projections, width + 1))
        lengths = _lengths(rows)
        self.longest = float(lengths.max(initial=0.0))
        lift = np.sqrt(np.maximum(self.longest**2 - lengths**2, 0.0))
        placed = self.lines[:, :width] @ rows.T + self.lines[:, width:] * lift
        self.order = np.argsort(placed, axis=1, kind="stable")
        self.places = np.take_along_axis(placed, self.order, axis=1)

    def _radius(self, worst: float, length: float) -> float:
        """Distance at which the inner product is ``worst``; below 0 if nothing here reaches it."""
        if worst == -np.inf:
            return np.inf
        square = 2 * self.longest * (self.longest - worst / length)
        return sqrt(square) * _SLACK if square >= 0 else -1.0 if square < -1e-9 * self.longest**2 else 0.0

    def search(self, query: np.ndarray, own: int, worst: float) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the best k rows found, the query's own row left out.

        ``worst`` is a score that k rows elsewhere reach; nothing below it is wanted.
        """
        k, n = self.settings.k, len(self.ids)
        scaled = query / np.abs(query).max()
        length = float(np.abs(query).max() * np.sqrt((scaled * scaled).sum()))
        centre = self.lines[:, :-1] @ (scaled / np.sqrt((scaled * scaled).sum())) * self.longest
        counts = np.zeros(n, np.int64)
        counts[self.ids == own] = -self.settings.projections - 1
        met, scores = np.empty(0, np.int64), np.empty(0)
        lo = hi = None
        limit = 2 * self.longest * _SLACK
        wanted = self._radius(worst, length)
        if wanted < 0:
            return met, scores
        radius = wanted / _GROWTH if wanted < np.inf else limit / _GROWTH**10
        while True:
            reach = self.settings.half * min(radius, wanted)
            whole = min(radius, wanted) >= limit
            ends = [(0, n) if whole else (p.searchsorted(c - reach, "left"), p.searchsorted(c + reach, "right"))
                    for p, c in zip(self.places, centre, strict=True)]
            if lo is None:
                fresh = [o[a:b] for o, (a, b) in zip(self.order, ends, strict=True)]
            else:
                fresh = [o[a:x] for o, (a, _), x in zip(self.order, ends, lo, strict=True)]
                fresh += [o[y:b] for o, (_, b), y in zip(self.order, ends, hi, strict=True)]
            lo, hi = zip(*ends, strict=True)
            counts += np.bincount(np.concatenate(fresh), minlength=n)
            some = np.flatnonzero(counts >= (1 if whole else self.settings.threshold))
            counts[some] = -self.settings.projections - 1  # verified once
            met = np.concatenate([met, some])
            scores = np.concatenate([scores, (self.rows[some] * query).sum(axis=1)])
            if len(scores) >= k:
                worst = max(worst, float(np.partition(scores, len(scores) - k)[len(scores) - k]))
                wanted = min(wanted, self._radius(worst, length))
            if radius >= wanted or whole:
                break
            radius *= _GROWTH
        good = scores >= worst
        met, scores = met[good], scores[good]
        best = np.lexsort((self.ranks[met], -scores))[:k]
        return met[best], scores[best]


_NO_RANK = np.iinfo(np.int64).max


def _ranks(ids: pa.ChunkedArray) -> np.ndarray:
    return ids.fill_null(_NO_RANK).to_numpy()


def _found(parts: list, lines: Lines) -> pa.Table:
    """Result rows of (query row, query id, (positions, scores))."""
    sizes = [len(p[2][0]) for p in parts]
    at = np.concatenate([p[2][0] for p in parts]) if parts else np.empty(0, np.int64)
    columns = [
        np.repeat([p[0] for p in parts], sizes), np.repeat([p[1] for p in parts], sizes),
        lines.ids[at],
        pa.array(lines.ranks[at], mask=lines.ranks[at] == _NO_RANK),
        np.concatenate([p[2][1] for p in parts]) if parts else np.empty(0),
    ]
    types = [pa.int64()] * 4 + [pa.float64()]
    return pa.Table.from_batches([record("query query_id row vec_id score".split(), columns, types)])


def _search_home(settings: Settings, width: int):
    def search(part: pa.Table) -> pa.Table:
        rows, ids = _matrix(part["v"], width), part["row"].to_numpy()
        lines = Lines(rows, ids, _ranks(part["vec_id"]), settings)
        asks = np.flatnonzero(part["asks"].to_numpy(zero_copy_only=False))
        return _found([(ids[i], lines.ranks[i], lines.search(rows[i], ids[i], -np.inf)) for i in asks], lines)

    return search


def _search_part(settings: Settings, width: int):
    def search(part: pa.Table, asked: pa.Table) -> pa.Table:
        if not part.num_rows or not asked.num_rows:
            return _found([], Lines(np.zeros((0, width)), np.empty(0, np.int64), np.empty(0, np.int64), settings))
        lines = Lines(_matrix(part["v"], width), part["row"].to_numpy(), _ranks(part["vec_id"]), settings)
        asks = zip(_matrix(asked["v"], width), asked["row"].to_numpy(), asked["vec_id"].to_numpy(),
                   asked["worst"].to_numpy(), strict=True)
        return _found([(row, name, lines.search(q, row, worst)) for q, row, name, worst in asks], lines)

    return search


def _assign(pivots: np.ndarray, names: list[str]):
    """Adds the nearest pivot and the distance to it."""
    squares = (pivots * pivots).sum(axis=1)

    def assign(batches):
        for batch in batches:
            rows = _matrix(batch.column(names.index("v")), pivots.shape[1])
            nearest = np.empty(len(rows), np.int64)
            for a in range(0, len(rows), 4096):
                nearest[a : a + 4096] = (squares - 2 * rows[a : a + 4096] @ pivots.T).argmin(axis=1)
            far = _lengths(rows - pivots[nearest])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest), pa.array(far)], names=[*names, "pivot", "far"]
            )

    return assign


def _route(pivots: np.ndarray, reach: np.ndarray):
    """One row per query and pivot whose ball can hold a better row than the query's worst."""

    def route(batches):
        for batch in batches:
            queries, worst = _matrix(batch.column(2), pivots.shape[1]), batch.column(3).to_numpy()
            # a rounding error of the products must not rule a pivot out
            most = queries @ pivots.T + _lengths(queries)[:, None] * reach * (1 + 1e-6)
            scale = _lengths(queries)[:, None] * (_lengths(pivots) + reach)
            who, pivot = np.nonzero((most + 1e-9 * scale >= worst[:, None]) & (reach >= 0))
            taken = batch.take(pa.array(who))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(pivot)], names=["row", "vec_id", "v", "worst", "home", "pivot"]
            )

    return route


def usable_vectors(vectors: DataFrame, asks: Column, id_col: str, vector_col: str) -> DataFrame:
    """Staged rows (row, vec_id, v, asks) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = vectors.filter(fine & F.exists(v, lambda x: x != 0)).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"),
        (F.coalesce(asks, F.lit(False)) & F.col(id_col).isNotNull()).alias("asks"),
    )
    return stage(chosen, "vectors")


def nearest_by_product(
    vectors: DataFrame, asks: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    projections: int = 32, half: float = 1.5, miss: float = 0.02,
) -> DataFrame:
    """The ``k`` rows with the largest inner product found for each row where ``asks`` holds:
    query_id, rank (from 1), vec_id, score."""
    settings = Settings(k, projections, half, miss)
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, asks, id_col, vector_col)
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part_rows = min(MOST_PART, max(LEAST_PART, total // 32))
    drawn = rows.orderBy(F.xxhash64("row")).limit(min(MAX_PIVOTS, -(-total // part_rows))).select("v").collect()
    pivots = np.array([[*r.v, *[0.0] * (width - len(r.v))] for r in drawn])
    kind = "row long, vec_id long, v array<double>, asks boolean, pivot long, far double"
    placed = stage(rows.mapInArrow(_assign(pivots, rows.columns), kind), "placed")
    sizes = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("far").alias("reach")).collect()
    reach = np.full(len(pivots), -1.0)  # at most MAX_PIVOTS rows
    for r in sizes:
        reach[r.pivot] = r.reach
    parts = spark.createDataFrame([(r.pivot, -(-r.n // part_rows)) for r in sizes], "pivot long, parts long")
    placed = placed.join(F.broadcast(parts), "pivot").withColumn("part", F.expr("pmod(xxhash64(row), parts)"))
    home = stage(
        placed.select("pivot", "part", "row", "vec_id", "v", "asks")
        .groupBy("pivot", "part").applyInArrow(_search_home(settings, width), _FOUND),
        "home-found",
    )
    bound = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    worst = F.coalesce(F.when(F.col("n") >= k, F.col("least")), F.lit(float("-inf")))
    asked = placed.filter("asks").join(bound, F.col("row") == F.col("query"), "left").select(
        "row", "vec_id", "v", worst.alias("worst"), F.struct("pivot", "part").alias("home")
    )
    sent = stage(
        asked.mapInArrow(
            _route(pivots, reach),
            "row long, vec_id long, v array<double>, worst double, home struct<pivot:long,part:long>, pivot long",
        ),
        "routed",
    )
    asking = sent.groupBy("pivot").agg(F.count("*").alias("n")).collect()  # at most MAX_PIVOTS rows
    chunks = spark.createDataFrame([(r.pivot, -(-r.n // CHUNK)) for r in asking], "pivot long, chunks long")
    chunks = F.broadcast(chunks)
    held = placed.join(chunks, "pivot").select(
        "pivot", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        "row", "vec_id", "v",
    )
    asked = (
        sent.join(chunks, "pivot").join(F.broadcast(parts), "pivot")
        .withColumn("chunk", F.expr("pmod(xxhash64(row, 1), chunks)"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .filter(F.struct("pivot", "part") != F.col("home"))
        .select("pivot", "part", "chunk", "row", "vec_id", "v", "worst")
    )
    keys = ["pivot", "part", "chunk"]
    others = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search_part(settings, width), _FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = home.unionByName(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
