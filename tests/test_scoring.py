"""Thresholds, scaling, reconstruction, encoding and balancing on small inputs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairwarden.operators import features as P
from pairwarden.operators import reconstruct as M
from pairwarden.operators import scoring as S


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def nearest(points):
    median = np.median(points)
    deviation = np.abs(points - median)
    z = 0.976 * deviation / np.median(deviation)
    return points[np.abs(z - 2.5).argmin()]


def test_mad_threshold_is_a_data_value(spark):
    points = np.random.default_rng(3).gamma(2.0, size=501)
    assert S.mad_threshold(column(spark, points.tolist()), "x") == nearest(points)


def test_mad_threshold_can_lie_below_the_median(spark):
    points = np.array([0.0, 9.0, 10.0, 11.0, 10.5, 9.5])
    assert S.mad_threshold(column(spark, points.tolist()), "x") == nearest(points)


def test_without_spread_the_threshold_is_the_median(spark):
    df = column(spark, [2.0, 2.0, 2.0, 7.0])
    assert S.mad_threshold(df, "x") == 2.0
    scores = {r.x: r.z_score for r in S.mad_score(df, "x").collect()}
    assert scores == {2.0: None, 7.0: math.inf}


def test_weights_count_like_copies(spark):
    rows = [(1.0, 3), (2.0, 1), (5.0, 4), (9.0, 1)]
    weighted = spark.createDataFrame(rows, "x double, n long")
    copies = column(spark, [x for x, n in rows for _ in range(n)])
    assert S.mad_threshold(weighted, "x", weight="n") == S.mad_threshold(copies, "x")


@pytest.mark.parametrize("size", [1, 2, 1000, 1001])
def test_median_by_narrowing_is_exact(spark, size):
    points = np.random.default_rng(size).lognormal(sigma=4.0, size=size)
    df = column(spark, points.tolist())
    assert S.exact_median(df, F.col("x")) == pytest.approx(np.median(points), rel=1e-15)


@pytest.mark.parametrize("extra, want", [
    ([float("inf")], "finite"), ([float("-inf")], "finite"), ([float("nan")], "finite"),
    ([float("inf")] * 70_001, float("inf")), ([float("-inf")] * 70_001, float("-inf")),
    ([float("nan")] * 70_001, float("nan")), ([1e308, -1e308, 5e-324, 1e15, 1e15 + 0.125], "finite"),
])
def test_median_ends_on_any_input(spark, extra, want):
    points = np.random.default_rng(1).normal(size=70_000).tolist() + extra
    got = S.exact_median(spark.createDataFrame(pd.DataFrame({"x": points})), F.col("x"))
    if want == "finite":
        middle = sorted(points, key=lambda v: (v != v, v))
        n = len(points)
        want = middle[n // 2] if n % 2 else middle[n // 2 - 1] / 2 + middle[n // 2] / 2
    assert got == want or got != got and want != want


@pytest.mark.parametrize("points", [[7.0], [1e308, -1e308], [1e15, 1e15 + 0.125, 1e15 + 0.25], [5e-324, 0.0, 1e-323],
                                    [float("inf"), float("-inf"), 2.0], [float("nan")], [-0.0, 0.0]])
def test_median_of_few_odd_values(spark, points):
    got = S.exact_median(column(spark, points), F.col("x"))
    middle = sorted(points, key=lambda v: (v != v, v))
    n = len(middle)
    want = middle[n // 2] if n % 2 else middle[n // 2 - 1] / 2 + middle[n // 2] / 2
    assert got == want or got != got and want != want


def test_median_with_a_hot_value_and_nulls(spark):
    df = column(spark, [None, *[3.0] * 400, *[float(i) for i in range(100)]])
    assert S.exact_median(df, F.col("x")) == 3.0
    assert S.exact_median(df.limit(0), F.col("x")) is None


def test_minmax_shifts_a_constant_and_does_not_clip(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    bounds = S.minmax_fit(train, ["a", "b"])
    new = spark.createDataFrame([(5.0, 5.0)], "a double, b double")
    assert tuple(S.minmax_apply(new, bounds).first()) == (2.0, 0.0)


def test_labels(spark):
    df = column(spark, [1.0, 2.0, 25.0])
    assert [r.ai_label for r in S.label(df, "x", 2.0, "within").collect()] == [True, True, False]
    assert [r.ai_label for r in S.label(df, "x", 2.0, "above", 10).collect()] == [False, False, True]


def test_errors_of_rows_and_windows(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(S.row_rmse(F.col("a"), F.col("b"))).first()[0] == pytest.approx(math.sqrt(2))
    nested = df.select(S.window_mse(F.array("a", "b"), F.array("b", "b"))).first()[0]
    assert nested == pytest.approx(1.0)


def matrix(spark, rows=60, width=4):
    values = np.random.default_rng(5).normal(size=(rows, width))
    cols = [f"c{i}" for i in range(width)]
    return spark.createDataFrame(values.tolist(), cols), values, cols


def test_reconstruction_matches_numpy(spark):
    df, values, cols = matrix(spark)
    mean = values.mean(axis=0)
    _, _, directions = np.linalg.svd(values - mean, full_matrices=False)
    last = None
    for k in range(len(cols) + 1):
        model = M.fit_reconstructor(df, cols, k)
        restored = M.reconstruct(model, df, cols)
        error = restored.select(F.sum(S.row_rmse(F.col("x"), F.col("xhat")))).first()[0]
        v = directions[:k]
        want = mean + (values - mean) @ v.T @ v
        assert error == pytest.approx(np.sqrt(((want - values) ** 2).mean(axis=1)).sum(), abs=1e-8)
        assert last is None or error <= last + 1e-9
        last = error
    assert last == pytest.approx(0.0, abs=1e-7)


@pytest.mark.parametrize("k", [0, 1, 3, 6])
def test_sparse_model_matches_the_dense_one(spark, k):
    rng = np.random.default_rng(8)
    picks = [(sorted({int(a), 3 + int(b)}), int(w)) for a, b, w in
             zip(rng.integers(0, 3, 40), rng.integers(0, 3, 40), rng.integers(1, 4, 40), strict=True)]
    df = spark.createDataFrame(picks, "features array<long>, copies long")
    model = M.fit_sparse(df, 6, weight="copies", k=k)
    scored = M.score_sparse(model, df).collect()
    dense = np.zeros((len(picks), 6))
    for i, (ones, _) in enumerate(picks):
        dense[i, ones] = 1
    weights = np.array([w for _, w in picks], dtype=float)
    mean = weights @ dense / weights.sum()
    centred = dense - mean
    _, vectors = np.linalg.eigh(centred.T @ (centred * weights[:, None]) / weights.sum())
    v = vectors[:, ::-1][:, :k]
    error = np.sqrt(((centred - centred @ v @ v.T) ** 2).mean(axis=1))
    want = {tuple(ones): e for (ones, _), e in zip(picks, error, strict=True)}
    for r in scored:
        assert r.ai_rmse == pytest.approx(want[tuple(r.features)], abs=1e-6)


def test_rows_without_ones_are_scored(spark):
    df = spark.createDataFrame([([0],), ([],)], "features array<long>")
    model = M.fit_sparse(df, 2)
    scores = sorted(r.ai_rmse for r in M.score_sparse(model, df).collect())
    assert scores == pytest.approx([math.sqrt(0.125)] * 2)


def test_onehot_unknown_and_missing(spark):
    train = spark.createDataFrame([("b", 1), ("a", 10), (None, 2)], "p string, q int")
    model = P.onehot_fit(train, ["p", "q"])
    words = [(r["column"], r.value) for r in model.vocab.orderBy("position").collect()]
    assert words == [("p", "a"), ("p", "b"), ("p", "nan"), ("q", "1"), ("q", "10"), ("q", "2")]
    new = spark.createDataFrame([("a", 2), ("zzz", 99), (None, 1)], "p string, q int")
    assert sorted(r.positions for r in P.onehot_apply(model, new).collect()) == [[], [0, 5], [2, 3]]


def test_balance_fills_up_to_the_largest_pattern(spark):
    rows = [("x", i) for i in range(9000)] + [("y", i) for i in range(10)] + [("z", 0)]
    df = spark.createDataFrame(rows, "k string, i int")
    drawn = P.balance(df, ["k"], ["i"])
    sums = {r.k: (r.n, r.rows) for r in drawn.groupBy("k").agg(
        F.sum("copies").alias("n"), F.count("*").alias("rows")).collect()}
    assert sums["x"] == (9000, 9000) and sums["y"][0] == 9000 and sums["z"] == (9000, 1)
    assert sums["y"][1] == 10
    assert {r.copies for r in drawn.filter("k = 'y'").collect()} == {900}
    written = P.replicate(drawn, "copies")
    assert {r.k: r["count"] for r in written.groupBy("k").count().collect()} == dict.fromkeys("xyz", 9000)
    kept = P.balance(df, ["k"], ["i"], keep_original=True)
    assert {r.k: r.n for r in kept.groupBy("k").agg(F.sum("copies").alias("n")).collect()} == {
        "x": 18000, "y": 9010, "z": 9001}


def test_rule_space_is_lazy_and_ordered(spark):
    rows = [tuple(r) for r in P.rule_space(spark, [5, 9]).collect()]
    assert rows == [(0, 0), (0, 1), (1, 0), (1, 1)]
    many = P.rule_space(spark, range(40))
    assert len(many.columns) == 40 and many.first() == tuple([0] * 40)
    with pytest.raises(ValueError, match="long"):
        P.rule_space(spark, range(63))


def test_tokens(spark):
    df = spark.createDataFrame([(1, "A bb BB, c_d 호기 x"), (2, "!"), (3, None)], "i int, t string")
    found = {(r.i, r.token): r.tf for r in P.token_counts(df, ["i"], "t").collect()}
    assert found == {(1, "bb"): 2, (1, "c_d"): 1, (1, "호기"): 1}


@pytest.mark.parametrize("k", [0, 1, 4])
def test_window_directions_match_numpy(spark, k):
    points = np.random.default_rng(3).normal(size=(60, 4)) @ np.diag([3.0, 2.0, 1.0, 0.5])
    rows = [(i, [[float(a), float(b)], [float(c), float(d)]]) for i, (a, b, c, d) in enumerate(points)]
    df = spark.createDataFrame([*rows, (99, None)], "i int, window array<array<double>>")
    model = M.fit_window_reconstructor(df, "window", k)
    found = M.reconstruct_window(model, df, 2, 2).withColumn(
        "mse", S.window_mse(F.col("window"), F.col("window_hat"))).collect()
    centred = points - points.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    top = vectors[:, ::-1][:, :k]
    want = ((centred - centred @ top @ top.T) ** 2).mean(axis=1)
    for r in found:
        assert r.mse is None if r.i == 99 else r.mse == pytest.approx(want[r.i], abs=1e-9)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_block_power_iteration_matches_numpy(spark, k):
    rng = np.random.default_rng(5)
    x = (rng.random((400, 7)) < [0.5, 0.4, 0.1, 0.8, 0.3, 0.05, 0.6]).astype(float)
    x[:, 4] = np.where(rng.random(400) < 0.9, x[:, 0], x[:, 4])
    rows = [([int(j) for j in np.flatnonzero(r)], int(n)) for r, n in zip(x, rng.integers(1, 4, 400), strict=True)]
    df = spark.createDataFrame(rows, "features array<long>, n long").repartition(3)
    model = M.fit_sparse(df, 7, weight="n", k=k)
    weight = np.array([n for _, n in rows], float)
    mean = (weight[:, None] * x).sum(0) / weight.sum()
    centred = x - mean
    _, vectors = np.linalg.eigh((centred * weight[:, None]).T @ centred / weight.sum())
    top = vectors[:, ::-1][:, :k]
    got = np.array([r.weights for r in model.weights.orderBy("position").collect()])
    assert np.abs(got @ got.T - top @ top.T).max() < 1e-4
    error = M.score_sparse(model, df).select("features", "ai_rmse").distinct().collect()
    want = {tuple(f): np.sqrt(((c - c @ top @ top.T) ** 2).mean()) for (f, _), c in zip(rows, centred, strict=True)}
    for r in error:
        assert r.ai_rmse == pytest.approx(want[tuple(r.features)], abs=1e-4)
