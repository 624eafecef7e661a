"""Non-linear reconstruction: dense autoencoders fitted by distributed gradients.

A network is a chain of dense layers whose last one has the width of the input. The loss is the
mean squared difference between input and output, over all rows and columns. An epoch is one
job: every task adds up the loss and the gradient of its rows, Spark adds the tasks up piece by
piece, in the order of their numbers, and the driver takes one step of a limited-memory
quasi-Newton method. Only the weights are on the driver and in every task; their number is
checked. Losses of all epochs go to the fit history.

Rows are arrays of numbers, or the positions of the ones of a one-hot row (``size`` given); they
may be counted several times (``weight``). A null position counts as none, a null number as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.operators.scoring import stable
from pairwarden.session import ship_package, stage

MAX_WEIGHTS = 4_000_000  # of a network; the driver and each task hold a few arrays of this length
_PIECE = 8192  # numbers of a gradient that are added up in one group
_CELLS = 1_000_000  # numbers of input that a task spreads out at once


def _hard_sigmoid(x: np.ndarray) -> np.ndarray:
    return np.clip(0.2 * x + 0.5, 0.0, 1.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


#: Function, and its derivative by input and output.
ACTIVATIONS: dict[str, tuple[Callable, Callable]] = {
    "identity": (lambda x: x, lambda x, y: np.ones_like(x)),
    "relu": (lambda x: np.maximum(x, 0.0), lambda x, y: (x > 0).astype(float)),
    "tanh": (np.tanh, lambda x, y: 1 - y * y),
    "sigmoid": (_sigmoid, lambda x, y: y * (1 - y)),
    "hard_sigmoid": (_hard_sigmoid, lambda x, y: np.where(np.abs(x) < 2.5, 0.2, 0.0)),
}


@dataclass(frozen=True)
class Network:
    """Layers from the input's width back to it. ``weights`` holds, layer by layer, the matrix
    (inputs x outputs) and the offsets."""

    sizes: tuple[int, ...]
    activations: tuple[str, ...]
    weights: np.ndarray

    @classmethod
    def fresh(cls, width: int, hidden: Sequence[tuple[int, str]], last: str, seed: int = 7) -> Network:
        """Random start: uniform within sqrt(6 / (inputs + outputs)), offsets 0."""
        sizes = (width, *[n for n, _ in hidden], width)
        total = sum(a * b + b for a, b in zip(sizes, sizes[1:]))
        if total > MAX_WEIGHTS:
            raise ValueError(f"{total} weights exceed {MAX_WEIGHTS}")
        rng, parts = np.random.default_rng(seed), []
        for a, b in zip(sizes, sizes[1:]):
            parts += [rng.uniform(-1, 1, a * b) * np.sqrt(6 / (a + b)), np.zeros(b)]
        return cls(sizes, (*[f for _, f in hidden], last), np.concatenate(parts))

    def with_weights(self, weights: np.ndarray) -> Network:
        return Network(self.sizes, self.activations, weights)

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in zip(self.sizes, self.sizes[1:]):
            out.append((self.weights[at : at + a * b].reshape(a, b), self.weights[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def restore(self, rows: np.ndarray) -> np.ndarray:
        """Reconstruction of each row."""
        for (matrix, offsets), name in zip(self.layers(), self.activations, strict=True):
            rows = ACTIVATIONS[name][0](rows @ matrix + offsets)
        return rows

    def gradient(self, rows: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum over counted rows of the squared difference, and its gradient by the weights."""
        passed, inputs, layers = [rows], [], self.layers()
        for (matrix, offsets), name in zip(layers, self.activations, strict=True):
            inputs.append(passed[-1] @ matrix + offsets)
            passed.append(ACTIVATIONS[name][0](inputs[-1]))
        off = passed[-1] - rows
        back, parts = 2 * off * counts[:, None], []
        for i in range(len(layers) - 1, -1, -1):
            back = back * ACTIVATIONS[self.activations[i]][1](inputs[i], passed[i + 1])
            parts += [back.sum(axis=0), (passed[i].T @ back).ravel()]
            back = back @ layers[i][0].T
        return float((off * off).sum(axis=1) @ counts), np.concatenate(parts[::-1])


def _blocks(column: pa.Array, width: int, sparse: bool):
    """(first row, dense rows) of an array column, a bounded number of cells at a time."""
    step = max(1, _CELLS // max(1, width))
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = part.flatten()
        if not sparse:
            if len(sizes) and (sizes != width).any():
                raise ValueError(f"rows must have {width} numbers")
            yield at, flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
            continue
        rows, places = np.repeat(np.arange(len(sizes)), sizes), flat.fill_null(-1).to_numpy(zero_copy_only=False)
        dense = np.zeros((len(sizes), width))
        dense[rows[places >= 0], places[places >= 0]] = 1.0
        yield at, dense


def _task_gradient(network: Network, sparse: bool):
    """One task's sums, cut into pieces: piece -1 is (loss, rows)."""

    def add_up(batches):
        loss, rows, gradient = 0.0, 0.0, np.zeros(len(network.weights))
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for at, dense in _blocks(batch.column(0), network.sizes[0], sparse):
                own = counts[at : at + len(dense)]
                more, slope = network.gradient(dense, own)
                loss, rows, gradient = loss + more, rows + own.sum(), gradient + slope
        if not rows:
            return
        pieces = [np.array([loss, rows]), *np.split(gradient, range(_PIECE, len(gradient), _PIECE))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int64()),
             pa.array(range(-1, len(pieces) - 1), pa.int64()), pa.array(pieces, pa.list_(pa.float64()))],
            names=["task", "piece", "v"],
        )

    return add_up


def _add_tasks(part: pa.Table) -> pa.Table:
    """Sum of the tasks' pieces in the order of the tasks, so that every run adds alike."""
    part = part.sort_by("task")
    total = np.zeros(len(part["v"][0]))
    for piece in part["v"].to_pylist():
        total += piece
    return pa.table({"piece": part["piece"][:1], "v": pa.array([total], pa.list_(pa.float64()))})


def total_gradient(rows: DataFrame, network: Network, sparse: bool) -> tuple[float, float, np.ndarray]:
    """(mean squared difference, counted rows, gradient of the mean) over ``rows`` (x, n)."""
    parts = rows.mapInArrow(_task_gradient(network, sparse), "task long, piece long, v array<double>")
    sums = parts.groupBy("piece").applyInArrow(_add_tasks, "piece long, v array<double>")
    found = {r.piece: np.array(r.v) for r in sums.collect()}  # the checked number of weights
    if not found:
        raise ValueError("no rows to fit")
    loss, n = found[-1]
    cells = n * network.sizes[0]
    return float(loss / cells), float(n), np.concatenate([found[i] for i in range(len(found) - 1)]) / cells


@dataclass(frozen=True)
class Training:
    """``patience`` epochs in a row that gain less than ``least_gain`` end the fit."""

    epochs: int = 100
    patience: int = 15
    least_gain: float = 1e-5
    memory: int = 10
    seed: int = 7


def _direction(slope: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Quasi-Newton direction from the last steps and the changes of the gradient along them."""
    out, kept = slope.copy(), []
    for s, y in zip(reversed(steps), reversed(turns)):
        a = (s @ out) / (s @ y)
        kept.append(a)
        out -= a * y
    if steps:
        out *= (steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
    for s, y, a in zip(steps, turns, reversed(kept)):
        out += (a - (y @ out) / (s @ y)) * s
    return -out


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray,
             how: Training) -> tuple[np.ndarray, list[float]]:
    """(weights, loss of each epoch). An epoch is one accepted step; no step raises the loss."""
    at = start
    loss, slope = evaluate(at)
    losses, steps, turns, still = [loss], [], [], 0
    while len(losses) < how.epochs and still < how.patience:
        way = _direction(slope, steps, turns)
        down = slope @ way
        if down >= 0:
            way, down, steps, turns = -slope, -(slope @ slope), [], []
        length = 1.0 if steps else min(1.0, 1.0 / max(np.abs(slope).sum(), 1e-300))
        for _ in range(30):
            new = at + length * way
            new_loss, new_slope = evaluate(new)
            if new_loss <= loss + 1e-4 * length * down:
                break
            length *= 0.5 if length * abs(down) > 1e-16 * abs(loss) else 0.0
            if not length:
                return at, losses
        else:
            return at, losses
        step, turn = new - at, new_slope - slope
        if step @ turn > 1e-12 * np.sqrt((step @ step) * (turn @ turn)):
            steps, turns = [*steps, step][-how.memory :], [*turns, turn][-how.memory :]
        still = still + 1 if loss - new_loss < how.least_gain else 0
        at, loss, slope = new, new_loss, new_slope
        losses.append(loss)
    return at, losses


def _inputs(df: DataFrame, features: str, weight: str | None, sparse: bool) -> DataFrame:
    x = F.col(features).cast("array<long>" if sparse else "array<double>")
    n = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return df.filter(F.col(features).isNotNull()).select(x.alias("x"), n.alias("n")).filter("n > 0")


def fit_network(
    df: DataFrame, features: str = "features", size: int | None = None, weight: str | None = None,
    hidden: Sequence[tuple[int, str]] = ((16, "relu"), (32, "relu")), last: str = "hard_sigmoid",
    how: Training = Training(), start: Network | None = None,
) -> tuple[Network, list[float], int]:
    """(network, loss of each epoch, counted rows).

    ``size`` is the width of one-hot rows given by positions; rows of numbers have their own.
    ``df`` is read once and staged.
    """
    ship_package(df.sparkSession)
    sparse = size is not None
    rows = stage(_inputs(df, features, weight, sparse), "network-rows")
    if not sparse:
        size = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not size:
        raise ValueError("no columns to fit")
    network = Network.fresh(size, hidden, last, how.seed) if start is None else start
    counted = []

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        loss, n, slope = total_gradient(rows, network.with_weights(weights), sparse)
        counted[:] = [n]
        return loss, slope

    weights, losses = minimise(evaluate, network.weights, how)
    return network.with_weights(weights), losses, int(counted[0])


def _errors(network: Network, sparse: bool, column: pa.Array) -> pa.Array:
    out = np.zeros(len(column))
    for at, dense in _blocks(column, network.sizes[0], sparse):
        off = network.restore(dense) - dense
        out[at : at + len(dense)] = np.sqrt((off * off).mean(axis=1))
    return pa.array(out, mask=column.is_null().to_numpy(zero_copy_only=False))


def _restored(network: Network, column: pa.Array) -> pa.Array:
    parts = [network.restore(dense) for _, dense in _blocks(column, network.sizes[0], False)]
    rows = np.concatenate(parts) if parts else np.zeros((0, network.sizes[0]))
    ends = np.arange(len(rows) + 1, dtype=np.int32) * network.sizes[0]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def _arrow(of: Callable, kind: str):
    ship_package(SparkSession.active())

    def run(column: pa.Array) -> pa.Array:
        return of(column)

    return F.arrow_udf(run, kind)


def network_rmse(network: Network, features: Column, sparse: bool) -> Column:
    """Root mean squared reconstruction error of each row."""
    return stable(_arrow(partial(_errors, network, sparse), "double")(
        features.cast("array<long>" if sparse else "array<double>")))


def restore_rows(network: Network, features: Column) -> Column:
    """Reconstruction of rows of numbers."""
    return _arrow(partial(_restored, network), "array<double>")(features.cast("array<double>"))


def score_network(
    network: Network, df: DataFrame, features: str = "features", name: str = "ai_rmse", sparse: bool = True
) -> DataFrame:
    return df.withColumn(name, network_rmse(network, F.col(features), sparse))
