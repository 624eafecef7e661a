"""Window model of ordered rows: each row predicted from the T rows before it.

One pass over ordered chunks, each of which also holds the T rows before its first, adds up
the covariances of a row with the rows 0..T before it. Whittle's recursion solves the normal
equations, whose matrix is made of blocks that repeat along its diagonals, one lag after the
other: there is never a matrix of (T x columns) squared, only T blocks of columns squared.
Its remaining variance at each lag is the loss of a model with that many lags.

Rows before the first one count as the mean, so covariances are sums divided by the number of
all rows, and the first T rows are predicted from the rows there are. A null counts as the mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwarden.operators.ordering import CHUNK_ROWS, number_rows, spread
from pairwarden.operators.scoring import stable
from pairwarden.session import ship_package

MAX_LAG_NUMBERS = 16_000_000  # lags x columns x columns


@dataclass(frozen=True)
class LagModel:
    """``weights[j]`` (columns x columns) tells what the row j + 1 before adds; ``losses`` are the
    mean squared errors of models with 0, 1, ... lags."""

    cols: tuple[str, ...]
    means: np.ndarray
    weights: np.ndarray
    losses: tuple[float, ...]

    @property
    def lags(self) -> int:
        return len(self.weights)


def whittle(covariances: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(weights of each lag, remaining covariance after 0, 1, ... lags).

    ``covariances[h]`` is that of a row with the row h before it. Combinations of columns
    without any variance get the weight 0.
    """
    lags, p = len(covariances) - 1, covariances.shape[1]
    ahead, behind = np.zeros((lags, p, p)), np.zeros((lags, p, p))  # weights by the rows before, and after
    left, right = covariances[0].copy(), covariances[0].copy()
    rest = [left]
    for m in range(lags):
        new = covariances[m + 1].copy()
        for j in range(m):
            new -= ahead[j] @ covariances[m - j]
        last_ahead, last_behind = _over(new, right), _over(new.T, left)
        older, later = ahead[:m].copy(), behind[:m].copy()
        for j in range(m):
            ahead[j] = older[j] - last_ahead @ later[m - 1 - j]
            behind[j] = later[j] - last_behind @ older[m - 1 - j]
        ahead[m], behind[m] = last_ahead, last_behind
        left, right = left - last_ahead @ new.T, right - last_behind @ new
        left, right = (left + left.T) / 2, (right + right.T) / 2
        rest.append(left)
    return ahead, rest


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a x inverse of the symmetric b."""
    return a @ np.linalg.pinv(b, rcond=1e-12, hermitian=True)


def _chunk(part: pa.Table, means: np.ndarray) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(rows in order, values off the mean, whether a row belongs to the chunk)."""
    part = part.sort_by("idx")
    flat = part["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    off = flat.reshape(-1, len(means)) - means
    return part, np.where(np.isnan(off), 0.0, off), part["_home"].to_numpy(zero_copy_only=False)


def _values(cols: Sequence[str]) -> Column:
    # null as NaN, which the sums leave out
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])


def _ordered(df: DataFrame, order: Sequence[str], cols: Sequence[str]) -> tuple[DataFrame, int]:
    ship_package(df.sparkSession)
    return number_rows(df.withColumn("x", _values(cols)), order)


def _chunks(indexed: DataFrame, lags: int, columns: int):
    """Rows by chunk; chunks are long enough for the blocks they send to be fewer than their rows."""
    return spread(indexed, lags, 0, max(CHUNK_ROWS, 8 * columns)).groupBy("_chunk")


def lag_covariances(indexed: DataFrame, means: np.ndarray, lags: int, total: int) -> np.ndarray:
    """Covariances (lags + 1 blocks) of numbered rows (idx, x)."""
    p = len(means)

    def add(part: pa.Table) -> pa.Table:
        _, off, home = _chunk(part, means)
        first = int(np.argmax(home))
        lag, row, sums = [], [], []
        for h in range(lags + 1):
            low = max(first, h)
            block = off[low:].T @ off[low - h : len(off) - h]
            lag += [h] * p
            row += range(p)
            sums += list(block)
        chunk = [part["_chunk"][0].as_py()] * len(lag)
        return pa.table({
            "lag": pa.array(lag, pa.int32()), "row": pa.array(row, pa.int32()), "chunk": pa.array(chunk, pa.int64()),
            "v": pa.array(sums, pa.list_(pa.float64())),
        })

    def total_of(part: pa.Table) -> pa.Table:
        part = part.sort_by("chunk")
        sums = np.zeros(p)
        for v in part["v"]:
            sums += v.values.to_numpy(zero_copy_only=False)
        v = pa.array([sums], pa.list_(pa.float64()))
        return pa.table({"lag": part["lag"][:1], "row": part["row"][:1], "v": v})

    parts = _chunks(indexed.select("idx", "x"), lags, p).applyInArrow(
        add, "lag int, row int, chunk long, v array<double>")
    sums = parts.groupBy("lag", "row").applyInArrow(total_of, "lag int, row int, v array<double>")
    out = np.zeros((lags + 1, p, p))
    for r in sums.collect():  # a checked number of blocks
        out[r.lag, r.row] = r.v
    return out / max(1, total)


def fit_lag_model(df: DataFrame, order: Sequence[str], cols: Sequence[str], lags: int) -> LagModel:
    """Fit over rows in ``order``."""
    p = len(cols)
    if (lags + 1) * p * p > MAX_LAG_NUMBERS:
        raise ValueError(f"{lags + 1} lags x {p} x {p} columns exceed {MAX_LAG_NUMBERS} numbers")
    indexed, total = _ordered(df.select(*dict.fromkeys([*order, *cols])), order, cols)
    if not total:
        raise ValueError("no rows to fit")
    means = indexed.agg(*[F.avg(F.col(c).cast("double")) for c in cols]).first()
    means = np.array([0.0 if m is None else m for m in means])
    weights, rest = whittle(lag_covariances(indexed, means, lags, total))
    return LagModel(tuple(cols), means, weights, tuple(float(np.trace(r)) / p for r in rest))


def score_lag_model(model: LagModel, df: DataFrame, order: Sequence[str], name: str = "ai_rmse") -> DataFrame:
    """Adds ``predicted`` (array in column order) and the mean squared error of each row."""
    indexed, _ = _ordered(df, order, model.cols)
    out = [*df.columns]

    def predict(part: pa.Table) -> pa.Table:
        part, off, home = _chunk(part, model.means)
        guess = np.zeros_like(off)
        for j, weight in enumerate(model.weights):
            guess[j + 1 :] += off[: len(off) - j - 1] @ weight.T
        error, own = ((guess - off) ** 2).mean(axis=1)[home], pa.array(np.flatnonzero(home))
        rows = list(guess[home] + model.means)
        kept = part.select(out).take(own)
        return kept.append_column("predicted", pa.array(rows, pa.list_(pa.float64()))).append_column(
            name, pa.array(error))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    scored = _chunks(indexed, model.lags, len(model.cols)).applyInArrow(
        predict, f"{schema}, predicted array<double>, `{name}` double")
    return scored.withColumn(name, stable(F.col(name)))


def save_lag_model(model: LagModel, df: DataFrame, path: str) -> None:
    """A row per column and lag (lag 0: the means and losses); ``df`` gives the session."""
    rows = [(c, i, j + 1, w[i].tolist(), None) for j, w in enumerate(model.weights) for i, c in enumerate(model.cols)]
    rows += [(c, i, 0, [float(model.means[i])], list(model.losses)) for i, c in enumerate(model.cols)]
    kind = "column string, place int, lag int, weights array<double>, losses array<double>"
    df.sparkSession.createDataFrame(rows, kind).write.mode("overwrite").parquet(path)


def load_lag_model(df: DataFrame) -> LagModel:
    """The model of a stored table (see ``save_lag_model``)."""
    rows = sorted(df.collect(), key=lambda r: (r.lag, r.place))  # the checked number of weights
    first = [r for r in rows if r.lag == 0]
    p = len(first)
    weights = np.array([r.weights for r in rows if r.lag]).reshape(-1, p, p)
    return LagModel(tuple(r["column"] for r in first), np.array([r.weights[0] for r in first]), weights,
                    tuple(first[0].losses))

