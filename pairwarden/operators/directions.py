"""Principal directions of tables with many columns, without a matrix of columns x columns.

A random block of a few directions is multiplied with the covariance, one job a round, and
the products are kept as a growing basis (a block Krylov space). On the basis the problem is a
small one; when the wanted directions no longer change by what the rows say, it ends. A basis
that has reached its size starts anew from the better half of the directions found. What is on the driver
and in every task is a block of columns x a few directions, whose size is checked.

``tall_factor`` is the R of a QR factorisation of rows projected on a block: each task factors
its rows, and the factors are joined in a tree, so nothing is squared on the way. The
last step of a dense fit takes the variances from it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.session import ship_package

MAX_BLOCK_NUMBERS = 8_000_000  # of a block of columns x directions, and of the basis on the driver
_EXTRA, _MOST_ROUNDS, _CLOSE = 4, 300, 1e-8
_BLOCKS = 32  # of the basis before it starts anew
_JOINED, _LEVELS = 32, 2  # factors that are joined at once, and how often
_PIECE_ROWS = 512  # rows of a block that are added up in one group
_CELLS = 1_000_000


class NotConverged(ArithmeticError):
    """The directions still change after the most rounds."""


def principal_directions(
    multiply: Callable[[np.ndarray], np.ndarray], size: int, k: int, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """(variances, directions): the ``k`` largest of a covariance of ``size`` columns.

    ``multiply`` gives the covariance times a block (size x a few). Directions point to their
    largest weight. Stops when no direction is off by more than 1e-8 of the largest variance.
    """
    k = min(k, size)
    width = min(size, k + _EXTRA)
    most = min(size, max(2 * width, min(_BLOCKS * width, MAX_BLOCK_NUMBERS // max(1, size))))
    if size * most > MAX_BLOCK_NUMBERS:
        raise ValueError(f"{size} columns x {most} directions exceed {MAX_BLOCK_NUMBERS} numbers")
    new, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    basis, image = np.empty((size, 0)), np.empty((size, 0))
    for _ in range(_MOST_ROUNDS):
        basis, image = np.hstack([basis, new]), np.hstack([image, multiply(new)])
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        best, best_image = basis @ turn[:, :width], image @ turn[:, :width]
        off = best_image - best * values[:width]
        far = np.sqrt((off[:, :k] ** 2).sum(axis=0)).max(initial=0.0)
        if far <= _CLOSE * max(values[0], 1e-300):
            return np.maximum(values[:k], 0.0), _pointed(best[:, :k])
        if basis.shape[1] + width > most:  # start anew from the best directions
            kept = turn[:, : max(width, most // 2)]
            basis, image = basis @ kept, image @ kept
        for _ in range(2):  # twice, against what rounding leaves
            off = off - basis @ (basis.T @ off)
        new, size_of = np.linalg.qr(off)
        new = new[:, np.abs(np.diag(size_of)) > 1e-14 * max(values[0], 1e-300)]
        new = new - basis @ (basis.T @ new)
        if not new.shape[1]:
            return np.maximum(values[:k], 0.0), _pointed(best[:, :k])
        new, _ = np.linalg.qr(new)
    raise NotConverged(f"{k} directions of {size} columns still change after {_MOST_ROUNDS} rounds")


def _pointed(block: np.ndarray) -> np.ndarray:
    first = block[np.abs(block).argmax(axis=0), np.arange(block.shape[1])]
    return block * np.where(first < 0, -1, 1)


def add_blocks(parts: DataFrame) -> np.ndarray:
    """Sum of the tasks' blocks (task, piece, v: rows one after the other), in the order of the tasks."""
    summed = parts.groupBy("piece").applyInArrow(_add_tasks, "piece long, v array<double>")
    found = {r.piece: r.v for r in summed.collect()}  # one checked block
    return np.array([x for i in sorted(found) for x in found[i]])


def _add_tasks(part: pa.Table) -> pa.Table:
    part = part.sort_by("task")
    total = np.zeros(len(part["v"][0]))
    for piece in part["v"]:
        total += piece.values.to_numpy(zero_copy_only=False)
    return pa.table({"piece": part["piece"][:1], "v": pa.array([total], pa.list_(pa.float64()))})


PIECES = "task long, piece long, v array<double>"


def block_pieces(block: np.ndarray) -> pa.RecordBatch:
    """A task's block as rows of ``PIECES``."""
    pieces = [p.ravel() for p in np.split(block, range(_PIECE_ROWS, len(block), _PIECE_ROWS))]
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([task] * len(pieces), pa.int64()), pa.array(range(len(pieces)), pa.int64()),
         pa.array(pieces, pa.list_(pa.float64()))],
        names=["task", "piece", "v"],
    )


def dense_rows(column: pa.Array, width: int):
    """Rows of numbers (null: 0), a bounded number of cells at a time."""
    step = max(1, _CELLS // max(1, width))
    for at in range(0, len(column), step):
        flat = column.slice(at, step).flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
        yield flat.reshape(-1, width)


def dense_product(rows: DataFrame, means: np.ndarray, total: float) -> Callable[[np.ndarray], np.ndarray]:
    """Covariance of ``rows`` (x) times a block, one job each."""
    ship_package(rows.sparkSession)

    def multiply(block: np.ndarray) -> np.ndarray:
        def task(batches):
            out = np.zeros_like(block)
            for batch in batches:
                for dense in dense_rows(batch.column(0), len(means)):
                    dense = dense - means
                    out += dense.T @ (dense @ block)
            yield block_pieces(out)

        return add_blocks(rows.mapInArrow(task, PIECES)).reshape(block.shape) / total

    return multiply


def tall_factor(rows: DataFrame, means: np.ndarray, block: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of (rows - means) x block."""
    width = block.shape[1]

    def task(batches):
        factor = np.zeros((0, width))
        for batch in batches:
            for dense in dense_rows(batch.column(0), len(means)):
                factor = np.linalg.qr(np.vstack([factor, (dense - means) @ block]), mode="r")
        yield _factor_row(TaskContext.get().partitionId(), factor)

    def join(part: pa.Table) -> pa.Table:
        part = part.sort_by("task")
        stacked = np.vstack([np.array(v).reshape(-1, width) for v in part["v"].to_pylist()])
        joined = _factor_row(part["task"][0].as_py() // _JOINED, np.linalg.qr(stacked, mode="r"))
        return pa.Table.from_batches([joined])

    kind = "task long, v array<double>"
    factors = rows.mapInArrow(task, kind)
    for _ in range(_LEVELS):
        factors = factors.groupBy(F.expr(f"task div {_JOINED}")).applyInArrow(join, kind)
    found = factors.collect()  # a factor of width x width for each thousand tasks
    stacked = np.vstack([np.zeros((1, width)), *[np.array(r.v).reshape(-1, width) for r in found]])
    return np.linalg.qr(stacked, mode="r")


def _factor_row(task: int, factor: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([task], pa.int64()), pa.array([factor.ravel()], pa.list_(pa.float64()))], names=["task", "v"]
    )


def dense_directions(rows: DataFrame, means: np.ndarray, total: float, k: int) -> np.ndarray:
    """First ``k`` principal directions of rows of numbers (columns x k), largest variance first."""
    _, block = principal_directions(dense_product(rows, means, total), len(means), k)
    _, _, turn = np.linalg.svd(tall_factor(rows, means, block))
    return _pointed(block @ turn.T)
