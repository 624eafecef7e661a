"""Reconstruction errors, robust thresholds and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwarden.operators.lookup import lookup_join
from pairwarden.session import stage

SCORE_DIGITS = 9
_BINS = 4096


def stable(score: Column) -> Column:
    """Score cut to 9 decimals, so that equal rows compare equal in every run."""
    return F.round(score, SCORE_DIGITS)


def _squares(x: Column, xhat: Column) -> Column:
    return F.zip_with(x, xhat, lambda a, b: (b - a) * (b - a))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v) / F.size(values)


def row_rmse(x: Column, xhat: Column) -> Column:
    """Root of the mean squared error of one row (two arrays)."""
    return F.sqrt(_mean(_squares(x, xhat)))


def window_mse(x: Column, xhat: Column) -> Column:
    """Mean squared error of a window (two arrays of steps); no root is taken."""
    steps = F.zip_with(x, xhat, lambda a, b: _mean(_squares(a, b)))
    return _mean(steps)


def masked_rmse(df: DataFrame, x: str, xhat: str, mask: float = -1.0) -> DataFrame:
    """Error over a whole batch, without the cells whose true value is the mask."""
    cells = df.select(F.explode(F.arrays_zip(F.col(x).alias("x"), F.col(xhat).alias("y"))).alias("c"))
    error = F.avg((F.col("c.y") - F.col("c.x")) * (F.col("c.y") - F.col("c.x")))
    return cells.filter(F.col("c.x") != mask).agg(F.sqrt(error).alias("masked_rmse"))


def _finite_at(part: DataFrame, rank: int, lo: float, hi: float) -> float:
    """Value at a 0-based rank of finite rows (v, n) between ``lo`` and ``hi``, each counted n times.

    The range is narrowed by histograms of fixed size until it is one value or holds no
    more representable numbers than a histogram has bins: every pass is one aggregation
    that shuffles no values.
    """
    while lo < hi:
        width = hi / _BINS - lo / _BINS
        if lo + width == lo or hi - width == hi or width == 0:
            counts = sorted(part.groupBy("v").agg(F.sum("n").alias("n")).collect())
            for found in counts:
                if rank < found.n:
                    return found.v
                rank -= found.n
        slot = F.least(F.floor(F.col("v") / width - F.lit(lo / width)), F.lit(_BINS))
        bins = part.groupBy(F.greatest(slot, F.lit(0)).alias("slot")).agg(
            F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
        for found in sorted(bins.collect()):
            if rank < found.n:
                break
            rank -= found.n
        if (found.lo, found.hi) == (lo, hi):
            raise ArithmeticError(f"no progress between {lo} and {hi}")
        lo, hi = found.lo, found.hi
        part = part.filter(F.col("v").between(lo, hi))
    return lo


def exact_median(df: DataFrame, value: Column, weight: Column | None = None) -> float | None:
    """Exact median of a column, each row counted ``weight`` times; None without rows.

    NaN and the infinities are counted apart, in Spark's order (NaN last); only finite
    values are narrowed. Reads ``df`` a few times, so it should be a stored frame.
    """
    count = F.lit(1) if weight is None else weight
    part = df.select(value.cast("double").alias("v"), count.cast("long").alias("n")).filter("v is not null and n > 0")
    v, n, inf = F.col("v"), F.col("n"), float("inf")
    finite = ~F.isnan("v") & (F.abs("v") < inf)
    sizes = part.agg(
        F.sum(n), F.sum(F.when(v == -inf, n)), F.sum(F.when(finite, n)), F.sum(F.when(v == inf, n)),
        F.min(F.when(finite, v)), F.max(F.when(finite, v)),
    ).first()
    total, below, within, above = (x or 0 for x in sizes[:4])
    if not total:
        return None
    lo, hi = sizes[4:]

    def at(rank: int) -> float:
        if rank < below:
            return -inf
        if rank < below + within:
            return _finite_at(part.filter(finite), rank - below, lo, hi)
        return inf if rank < below + within + above else float("nan")

    low = at((total - 1) // 2)
    if total % 2 or total // 2 < below or total // 2 >= below + within + above:
        return low
    if total // 2 >= below + within or abs(low) == inf:
        high = at(total // 2)
    else:
        upto, after = part.agg(F.sum(F.when(v <= low, n)), F.min(F.when(v > low, v))).first()
        high = low if upto > total // 2 else after
    return low if low == high else low / 2 + high / 2


def mad_parts(df: DataFrame, col: str, weight: str | None = None) -> tuple[float, float]:
    """Median and median absolute deviation of a column."""
    w = None if weight is None else F.col(weight)
    median = exact_median(df, F.col(col), w)
    if median is None:
        raise ValueError(f"no values in {col}")
    return median, exact_median(df, F.abs(F.col(col) - median), w)


# Factor of the modified z-score and the score the threshold is nearest to.
Z_FACTOR = 0.976
Z_TARGET = 2.5


def _z(col: str, median: float, mad: float) -> Column:
    return F.lit(Z_FACTOR) * F.abs(F.col(col) - median) / mad


def mad_threshold(df: DataFrame, col: str, target: float = Z_TARGET, weight: str | None = None) -> float:
    """Data value whose modified z-score is nearest to ``target`` (the smaller on ties).

    Without any spread it is the median itself.
    """
    median, mad = mad_parts(df, col, weight)
    if mad == 0:
        return median
    distance = F.round(F.abs(_z(col, median, mad) - target), SCORE_DIGITS)
    nearest = F.min_by(F.col(col), F.struct(distance, F.col(col)))
    return df.filter(F.col(col).isNotNull()).agg(nearest).first()[0]


# ---- per group ---------------------------------------------------------------------

SKETCH_ACCURACY = 10_000  # ranks of a group's sketch are off by at most this part of its rows
BRACKET_VALUES = 50_000  # different values of a group that one task orders
_GRID = 200  # steps of rank that a sketch is asked for


def _bracket(rows: DataFrame, *more: Column) -> DataFrame:
    """Per group of ``rows`` (g, v, first, second: 0-based ranks among the group's finite values)
    the bounds that both values lie between, from one mergeable sketch; and further aggregates."""
    v, finite = F.col("v"), ~F.isnan("v") & (F.abs("v") < float("inf"))
    return rows.groupBy("g").agg(
        F.percentile_approx(F.when(finite, v), [i / _GRID for i in range(_GRID + 1)], F.lit(SKETCH_ACCURACY)).alias("_at"),
        F.count(F.when(finite, v)).alias("_finite"), F.min(F.when(finite, v)).alias("_least"),
        F.max(F.when(finite, v)).alias("_most"), *more,
    )


def _bounds() -> list[Column]:
    """Bounds of the ranks ``first`` and ``second`` on the grid, with room for the sketch's error."""
    room, n = 3 / SKETCH_ACCURACY, F.greatest(F.col("_finite"), F.lit(1))
    low = F.floor((F.col("first") / n - room) * _GRID).cast("int")
    high = F.ceil(((F.col("second") + 1) / n + room) * _GRID).cast("int")
    return [
        F.when(low <= 0, F.col("_least")).otherwise(F.get("_at", low)).alias("_low"),
        F.when(high >= _GRID, F.col("_most")).otherwise(F.get("_at", high)).alias("_high"),
    ]


def _within(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Finite rows of each group up to the upper bound, with the group's state."""
    joined = rows.join(state, "g")
    return joined.filter((F.abs("v") < float("inf")) & (F.col("v") <= F.col("_high")))


def grouped_median(df: DataFrame, by: Sequence[str], value: Column, name: str = "median") -> DataFrame:
    """Exact median of each group (``by``, ``name``), all groups at once.

    A mergeable sketch per group brackets the middle ranks, and one pass counts the different
    values inside the brackets, which tasks aggregate before anything is shuffled. A group that
    has too many of them for one task is bracketed again inside its bracket. NaN is the
    largest value and the infinities are counted apart. Null groups are groups; null values
    do not count. Reads ``df`` twice or more, so it should be a stored frame.
    """
    inf = float("inf")
    rows = df.select(F.struct(*by).alias("g"), value.cast("double").alias("v")).filter("v is not null")
    sizes = _bracket(rows, F.count("v").alias("n"), F.count_if(F.col("v") == -inf).alias("_below"),
                     F.count_if(F.col("v") == inf).alias("_above"))
    state = sizes.select(
        "g", "n", "_below", "_above", "_finite", "_least", "_most", "_at",
        F.expr("(n - 1) div 2 - _below").alias("first"), F.expr("n div 2 - _below").alias("second"),
    )
    state = stage(state.select("*", *_bounds()).drop("_at", "_least", "_most"), "brackets")
    ranks = state.select("g", "n", "_below", "_above", "_finite", F.col("first").alias("_first"),
                         F.col("second").alias("_second"))
    while True:
        kept = _within(rows, state.select("g", "_low", "_high"))
        inside = F.when(F.col("v") >= F.col("_low"), F.col("v"))  # null: below the bracket
        counted = stage(kept.groupBy("g", inside.alias("v")).agg(F.count("*").alias("c")), "bracket-counts")
        most = counted.groupBy("g").count().agg(F.max("count")).first()[0] or 0
        if most <= BRACKET_VALUES:
            break
        before = counted.filter("v is null").select("g", F.col("c").alias("_less"))
        narrowed = stage(kept.filter("v >= _low").select("g", "v"), "bracketed")
        shifted = state.select("g", "first", "second").join(before, "g", "left").select(
            "g", *[(F.col(c) - F.coalesce("_less", F.lit(0))).alias(c) for c in ("first", "second")]
        )
        state = stage(_bracket(narrowed).join(shifted, "g").select("*", *_bounds()).drop("_at", "_least", "_most"),
                      "brackets")
        again = narrowed.join(state.select("g", "_low", "_high"), "g").groupBy("g").agg(
            F.countDistinct(F.when(F.col("v").between(F.col("_low"), F.col("_high")), F.col("v"))).alias("d"))
        if (again.agg(F.max("d")).first()[0] or 0) >= most:
            raise ArithmeticError("brackets of the groups do not narrow")
        rows = narrowed
    counted = counted.join(state.select("g", "first", "second"), "g")
    upto = F.sum("c").over(Window.partitionBy("g").orderBy(F.asc_nulls_first("v")))
    placed = counted.withColumn("_upto", upto).filter("v is not null")
    found = placed.groupBy("g").agg(
        *[F.min(F.when(F.col("_upto") > F.col(c), F.col("v"))).alias(f"_v{c}") for c in ("first", "second")]
    )
    joined = ranks.join(found, "g", "left")

    def at(c: str) -> Column:
        rank = F.col(f"_{c}")
        return (
            F.when(rank < 0, F.lit(-inf)).when(rank < F.col("_finite"), F.col(f"_v{c}"))
            .when(rank < F.col("_finite") + F.col("_above"), F.lit(inf)).otherwise(F.lit(float("nan")))
        )

    low, high = at("first"), at("second")
    middle = F.when(low == high, low).otherwise(low / 2 + high / 2)
    return joined.select(*[F.col("g")[c].alias(c) for c in by], middle.alias(name))


def grouped_mad_parts(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Median and median absolute deviation of each group: ``by``, median, mad."""
    medians = stage(grouped_median(df, by, F.col(col)), "medians")
    off = stage(lookup_join(df.select(*by, F.col(col).alias("_v")), medians, list(by), null_safe=True)
                .select(*by, F.abs(F.col("_v") - F.col("median")).alias("_off")), "deviations")
    return lookup_join(medians, grouped_median(off, by, F.col("_off"), "mad"), list(by), null_safe=True)


def grouped_mad_threshold(df: DataFrame, by: Sequence[str], col: str, target: float = Z_TARGET) -> DataFrame:
    """``mad_threshold`` of each group: ``by``, median, mad, threshold."""
    parts = stage(grouped_mad_parts(df, by, col), "group-mads")
    known = lookup_join(df.select(*by, F.col(col).alias("_v")).filter("_v is not null"), parts, list(by), null_safe=True)
    z = F.lit(Z_FACTOR) * F.abs(F.col("_v") - F.col("median")) / F.when(F.col("mad") != 0, F.col("mad"))
    distance = F.round(F.abs(z - target), SCORE_DIGITS)
    nearest = F.min_by("_v", F.when(F.col("mad") != 0, F.struct(distance, F.col("_v"))))
    return known.groupBy(*by).agg(
        F.first("median").alias("median"), F.first("mad").alias("mad"), nearest.alias("_nearest")
    ).select(*by, "median", "mad", F.coalesce("_nearest", "median").alias("threshold"))


def grouped_mad_score(df: DataFrame, by: Sequence[str], col: str, name: str = "z_score") -> DataFrame:
    """``mad_score`` within each group."""
    known = lookup_join(df, stage(grouped_mad_parts(df, by, col), "group-mads"), list(by), null_safe=True)
    off = F.abs(F.col(col) - F.col("median"))
    score = F.when(F.col("mad") != 0, F.lit(Z_FACTOR) * off / F.col("mad")).when(off > 0, F.lit(float("inf")))
    return known.withColumn(name, score).drop("median", "mad")


def mad_score(df: DataFrame, col: str, name: str = "z_score") -> DataFrame:
    """Modified z-score per row; without any spread NULL at the median, infinite elsewhere."""
    median, mad = mad_parts(df, col)
    if mad == 0:
        score = F.when(F.col(col) != median, F.lit(float("inf")))
    else:
        score = _z(col, median, mad)
    return df.withColumn(name, score)


def label(df: DataFrame, score: str, threshold: float, mode: str = "above", factor: float = 1.0) -> DataFrame:
    """``ai_label``: ``above`` marks scores over threshold x factor, ``within`` the others."""
    limit = F.lit(threshold * factor)
    test = F.col(score) > limit if mode == "above" else F.col(score) <= limit
    return df.withColumn("ai_label", test)


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column (fitted scalars)."""
    aggs = [f(F.col(c)).cast("double") for c in cols for f in (F.min, F.max)]
    row = df.agg(*aggs).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(cols)}


def minmax_of(col: str, bounds: tuple[float, float]) -> Column:
    """Scaled value; new values are not clipped, a constant column is only shifted."""
    lo, hi = bounds
    if lo is None:
        return F.lit(None).cast("double")
    span = hi - lo
    return (F.col(col) - lo) / (span if span else 1.0)


def minmax_apply(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: minmax_of(c, b) for c, b in bounds.items()})
