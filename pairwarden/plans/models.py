"""Fitted models and their versioned storage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pairwarden.operators.autoencoder import Network
from pairwarden.operators.features import OneHot
from pairwarden.operators.reconstruct import Linear, Sparse
from pairwarden.operators.scoring import minmax_of
from pairwarden.sources.versions import load_version, publish


@dataclass(frozen=True)
class PairModel:
    """Encoders by kind, reconstruction model, threshold and error range."""

    encoders: dict[str, OneHot]
    fitted: Sparse | Network
    threshold: float
    error_range: tuple[float, float]

    def scaled(self, score: str):
        return minmax_of(score, self.error_range)


@dataclass(frozen=True)
class DenseModel:
    """Model over named columns: scaling, reconstruction, threshold, error range."""

    cols: list[str]
    bounds: dict[str, tuple[float, float]]
    linear: Linear | Network
    threshold: float
    error_range: tuple[float, float]


_PIECE = 8192  # weights of a network in one stored row
_SHAPE = "sizes array<int>, activations array<string>"


def _pieces(network: Network) -> list[tuple[int, None, list[float]]]:
    """Weights as rows of the tables that hold the means and directions of linear models."""
    w = network.weights
    return [(i, None, w[at : at + _PIECE].tolist()) for i, at in enumerate(range(0, len(w), _PIECE))]


def _shape(model) -> tuple[list[int] | None, list[str] | None]:
    return (list(model.sizes), list(model.activations)) if isinstance(model, Network) else (None, None)


def _network(rows, numbers) -> Network:
    """``rows``: pieces by place."""
    weights = np.array([w for r in rows for w in r.weights])
    return Network(tuple(numbers.sizes), tuple(numbers.activations), weights)


def save_pair_model(spark: SparkSession, model: PairModel, root: str, version: datetime) -> None:
    """Publish a pair model as a version of four artefacts."""
    vocab = None
    for kind, encoder in model.encoders.items():
        part = encoder.vocab.withColumn("kind", F.lit(kind))
        vocab = part if vocab is None else vocab.unionByName(part)
    cols = [(k, i, c, e.values[i]) for k, e in model.encoders.items() for i, c in enumerate(e.cols)]
    columns = spark.createDataFrame(cols, "kind string, place int, column string, values long")
    fitted, linear = model.fitted, isinstance(model.fitted, Sparse)
    weights = fitted.weights if linear else spark.createDataFrame(
        _pieces(fitted), "position long, mean double, weights array<double>"
    )
    own = (fitted.size, fitted.base, fitted.shift) if linear else (fitted.sizes[0], None, None)
    numbers = [(*own, model.threshold, *model.error_range, *_shape(fitted))]
    schema = f"size long, base double, shift array<double>, threshold double, lo double, hi double, {_SHAPE}"
    tables = {
        "vocab": vocab, "columns": columns, "weights": weights, "numbers": spark.createDataFrame(numbers, schema),
    }
    publish(tables, root, version, replace=True)


PAIR_MODEL_FILES = 4


def load_pair_model(spark: SparkSession, root: str, version: datetime) -> PairModel:
    tables = load_version(spark, root, version)
    vocab, settings = tables["vocab"], tables["columns"].collect()
    encoders = {}
    for kind in {r.kind for r in settings}:
        mine = sorted((r for r in settings if r.kind == kind), key=lambda r: r.place)
        words = vocab.filter(F.col("kind") == kind).drop("kind")
        encoders[kind] = OneHot(
            tuple(r["column"] for r in mine), words, tuple(r["values"] for r in mine)
        )
    n, weights = tables["numbers"].first(), tables["weights"]
    if n.sizes is None:
        fitted = Sparse(n.size, weights, n.base, list(n.shift))
    else:
        fitted = _network(sorted(weights.collect(), key=lambda r: r.position), n)  # a checked number
    return PairModel(encoders, fitted, n.threshold, (n.lo, n.hi))


DENSE_MODEL_FILES = 3  # of each model


def save_dense_models(
    spark: SparkSession, models: dict[str, DenseModel], root: str, version: datetime
) -> None:
    """Publish dense models by name (unit type or kind) as one version, three artefacts each."""
    scaling, parts, numbers = [], [], []
    for name, m in models.items():
        scaling += [(name, i, c, *m.bounds.get(c, (None, None))) for i, c in enumerate(m.cols)]
        if isinstance(m.linear, Network):
            parts += [(name, *piece) for piece in _pieces(m.linear)]
        else:
            weights = list(zip(*m.linear.components, strict=True)) or [()] * len(m.linear.means)
            parts += [(name, i, mean, list(map(float, w))) for i, (mean, w) in
                      enumerate(zip(m.linear.means, weights, strict=True))]
        numbers.append((name, m.threshold, *m.error_range, *_shape(m.linear)))
    tables = {
        "scaling": (scaling, "name string, place int, column string, lo double, hi double"),
        "parts": (parts, "name string, place int, mean double, weights array<double>"),
        "numbers": (numbers, f"name string, threshold double, lo double, hi double, {_SHAPE}"),
    }
    frames = {artefact: spark.createDataFrame(rows, schema) for artefact, (rows, schema) in tables.items()}
    publish(frames, root, version, DENSE_MODEL_FILES * len(models), replace=True)


def load_dense_models(spark: SparkSession, root: str, version: datetime) -> dict[str, DenseModel]:
    tables = load_version(spark, root, version)

    def rows(artefact):
        return tables[artefact].collect()  # a row per input column

    scaling, parts = (sorted(rows(a), key=lambda r: r.place) for a in ("scaling", "parts"))
    models = {}
    for n in rows("numbers"):
        cols = [r for r in scaling if r.name == n.name]
        bounds = {r["column"]: (r.lo, r.hi) for r in cols if r.lo is not None}
        mine = [r for r in parts if r.name == n.name]
        if n.sizes is None:
            components = [list(c) for c in zip(*(r.weights for r in mine), strict=True)]
            linear = Linear([r["mean"] for r in mine], components)
        else:
            linear = _network(mine, n)
        models[n.name] = DenseModel([r["column"] for r in cols], bounds, linear, n.threshold, (n.lo, n.hi))
    return models
