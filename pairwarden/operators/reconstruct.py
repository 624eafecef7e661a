"""Reconstruction of rows: linear models, and networks from ``autoencoder``.

A linear model reconstructs a row as mean + V V'(row - mean); with no components that is the
column mean. Three input shapes share the idea: dense columns, look-back windows
and one-hot positions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.operators.autoencoder import Network, restore_rows, score_network
from pairwarden.operators.directions import (
    MAX_BLOCK_NUMBERS,
    PIECES,
    add_blocks,
    block_pieces,
    dense_directions,
    dense_product,
    principal_directions,
)
from pairwarden.operators.lookup import lookup_join
from pairwarden.operators.scoring import stable
from pairwarden.session import ship_package, stage


@dataclass(frozen=True)
class Linear:
    """Fitted means and components (k rows of one weight per input)."""

    means: list[float]
    components: list[list[float]] = field(default_factory=list)


def _fit_array(df: DataFrame, values: Column, k: int) -> Linear:
    vectors = df.select(array_to_vector(values).alias("features"))
    found = vectors.agg(Summarizer.mean(F.col("features")).alias("m"), F.count("*").alias("n")).first()
    if found.m is None or not len(found.m):
        raise ValueError("no rows to fit")
    means = found.m.toArray()
    if not k:
        return Linear(means.tolist())
    rows = stage(df.select(values.alias("x")), "dense-rows")
    return Linear(means.tolist(), dense_directions(rows, means, found.n, k).T.tolist())


def fit_arrays(df: DataFrame, column: str, k: int = 0) -> Linear:
    """Model over an array column, for tables with too many columns to name."""
    return _fit_array(df, F.col(column).cast("array<double>"), k)


def variances_along(df: DataFrame, column: str, model: Linear) -> tuple[float, list[float]]:
    """(variance of all columns together, variance along each direction) of an array column."""
    means = np.array(model.means)
    rows = stage(df.select(F.col(column).cast("array<double>").alias("x")), "dense-rows")
    n = rows.count()
    block = np.array(model.components).T.reshape(len(means), -1)
    along = dense_product(rows, means, n)(block)
    spread = rows.select(F.aggregate(
        F.zip_with("x", _numbers(model.means), lambda a, m: (a - m) * (a - m)), F.lit(0.0), lambda acc, v: acc + v
    ).alias("d")).agg(F.sum("d")).first()[0]
    return (spread or 0.0) / max(1, n), (block * along).sum(axis=0).tolist()


def fit_reconstructor(df: DataFrame, cols: Sequence[str], k: int = 0) -> Linear:
    """Model over numeric columns."""
    return _fit_array(df, F.array(*[F.col(c).cast("double") for c in cols]), k)


def _numbers(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _along(centred: Column, weights: Column) -> Column:
    """Scalar product of two arrays."""
    return F.aggregate(
        F.zip_with(centred, weights, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
    )


def _restore(model: Linear, x: Column) -> Column:
    """Reconstruction of an array column."""
    means = _numbers(model.means)
    centred = F.zip_with(x, means, lambda a, m: a - m)
    out = means
    for weights in map(_numbers, model.components):
        step = F.zip_with(
            weights, F.array_repeat(_along(centred, weights), len(model.means)), lambda w, p: w * p
        )
        out = F.zip_with(out, step, lambda a, b: a + b)
    return out


def reconstruct(model: Linear | Network, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``x`` and ``xhat`` (arrays in column order)."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    restored = restore_rows(model, F.col("x")) if isinstance(model, Network) else _restore(model, F.col("x"))
    return df.withColumn("x", x).withColumn("xhat", restored)


def fit_window_reconstructor(df: DataFrame, window: str = "window", k: int = 0) -> Linear:
    """Model over look-back windows (arrays of steps), flattened."""
    return _fit_array(df.filter(F.col(window).isNotNull()), F.flatten(window), k)


def reconstruct_window(
    model: Linear, df: DataFrame, steps: int, width: int, window: str = "window"
) -> DataFrame:
    """Add ``window_hat``, the reconstructed window in the same shape."""
    flat = _restore(model, F.col("_flat"))
    shaped = F.transform(
        F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.slice("_hat", i * width + 1, width)
    )
    return (
        df.withColumn("_flat", F.flatten(window))
        .withColumn("_hat", flat)
        .withColumn("window_hat", F.when(F.col(window).isNotNull(), shaped))
        .drop("_flat", "_hat")
    )


@dataclass(frozen=True)
class Sparse:
    """Model over one-hot positions: (position, mean, weights) for seen positions.

    ``base`` is the squared error of the all-zero row before projection, ``shift``
    the projection of the mean.
    """

    size: int
    weights: DataFrame
    base: float
    shift: list[float]


def fit_sparse(
    df: DataFrame, size: int, features: str = "features", weight: str | None = None, k: int = 0
) -> Sparse:
    """Model over the positions of the ones of each row, rows counted ``weight`` times.

    Equal rows are counted first; means and directions are aggregates over the distinct
    combinations. Directions come from products with the covariance (``directions``).
    """
    count = F.lit(1) if weight is None else F.col(weight)
    combos = stage(df.groupBy(F.col(features).alias("f")).agg(F.sum(count).cast("long").alias("n")), "combos")
    total = combos.agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("no rows to fit")
    ones = stage(
        combos.select(F.explode("f").alias("position"), "n").groupBy("position").agg(F.sum("n").alias("n")),
        "ones",
    )
    # counts are added exactly, so that every run gives the same number
    exact = F.col("n").cast("decimal(19,0)")
    squares = ones.agg(F.sum((exact * exact).cast("decimal(38,0)")).cast("decimal(38,0)")).first()[0] or 0
    base = float(Fraction(int(squares), total * total))
    means = ones.select("position", (F.col("n") / F.lit(total)).alias("mean"))
    if not k:
        return Sparse(size, means.withColumn("weights", F.array().cast("array<double>")), base, [])
    if size * k > MAX_BLOCK_NUMBERS:
        raise ValueError(f"{size} positions x {k} directions exceed {MAX_BLOCK_NUMBERS} numbers")
    mu = np.zeros(size)
    for r in means.collect():  # at most size numbers, checked above
        mu[r.position] = r["mean"]
    top = _directions(combos, mu, total, k)
    rows = [(i, float(mu[i]), top[i].tolist()) for i in range(size)]
    weights = df.sparkSession.createDataFrame(
        rows, "position long, mean double, weights array<double>"
    )
    return Sparse(size, weights, base, (mu @ top).tolist())


def _directions(combos: DataFrame, mu: np.ndarray, total: int, k: int) -> np.ndarray:
    """First ``k`` principal directions of counted one-hot rows (size x k, largest variance first).

    Each product with the covariance is one job over the distinct combinations.
    """

    ship_package(combos.sparkSession)

    def multiply(block: np.ndarray) -> np.ndarray:
        parts = combos.mapInArrow(_multiply(block), PIECES)
        return add_blocks(parts).reshape(block.shape) / total - np.outer(mu, mu @ block)

    _, block = principal_directions(multiply, len(mu), k)
    return block


def _multiply(block: np.ndarray):
    """Per task: sum of n x (x . block) over its rows, at the positions of the rows' ones."""

    def multiply(batches):
        image = np.zeros_like(block)
        for batch in batches:
            lists, n = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            places = lists.flatten().to_numpy(zero_copy_only=False)
            row = pc.list_parent_indices(lists).to_numpy()
            along = np.zeros((len(lists), block.shape[1]))
            np.add.at(along, row, block[places])
            np.add.at(image, places, (along * n[:, None])[row])
        yield block_pieces(image)

    return multiply


def _weight_of(component: int):
    return lambda term: F.coalesce(F.get(term["weights"], F.lit(component)), F.lit(0.0))


def score_sparse(
    model: Sparse, df: DataFrame, features: str = "features", name: str = "ai_rmse"
) -> DataFrame:
    """Root mean squared reconstruction error of each row.

    Each distinct combination is scored once and joined back, so the work over the
    rows is one lookup; ``df`` is read twice and should be a stored frame. Terms are added
    in position order: equal rows get equal scores.
    """
    scores = _combination_errors(model, df, features).select(
        F.col("f").alias(features), F.element_at("errors", -1).alias(name)
    )
    return lookup_join(df, stage(scores, "scores"), [features])


def score_features(
    model: Sparse | Network, df: DataFrame, features: str = "features", name: str = "ai_rmse"
) -> DataFrame:
    """Reconstruction error of each one-hot row, by either kind of model."""
    if isinstance(model, Network):
        return score_network(model, df, features, name)
    return score_sparse(model, df, features, name)


def prefix_losses(model: Sparse, df: DataFrame, features: str = "features", weight: str = "copies") -> list[float]:
    """Mean error of the counted rows with the first 0, 1, ... directions, in one pass."""
    errors = lookup_join(df, stage(_combination_errors(model, df, features), "prefix-errors").withColumnRenamed(
        "f", features), [features])
    means = [F.sum(F.col("errors")[i] * F.col(weight)) / F.sum(weight) for i in range(len(model.shift) + 1)]
    return list(errors.agg(*means).first())


def _combination_errors(model: Sparse, df: DataFrame, features: str) -> DataFrame:
    """Errors of each distinct combination ``f`` with the first 0, 1, ... directions."""
    cells = (
        df.select(F.col(features).alias("f")).distinct()
        .select("f", F.explode_outer("f").alias("position"))
    )
    known = lookup_join(cells, model.weights, ["position"], "left")
    mean = F.coalesce("mean", F.lit(0.0))
    gain = F.when(F.col("position").isNotNull(), 1 - 2 * mean).otherwise(0.0)
    terms = F.array_sort(
        F.collect_list(F.struct(F.coalesce("position", F.lit(-1)).alias("p"), gain.alias("g"), "weights"))
    )
    error = F.aggregate(F.col("terms"), F.lit(model.base), lambda acc, t: acc + t["g"])
    errors = [error]
    for c, shift in enumerate(model.shift):
        part = F.transform("terms", _weight_of(c))
        along = F.aggregate(part, F.lit(-shift), lambda acc, w: acc + w)
        error = error - along * along
        errors.append(error)
    rmse = [stable(F.sqrt(F.greatest(e, F.lit(0.0)) / model.size)) for e in errors]
    return known.groupBy("f").agg(terms.alias("terms")).select("f", F.array(*rmse).alias("errors"))
