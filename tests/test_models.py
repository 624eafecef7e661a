"""Directions, networks and lag models against numpy; draws and medians of groups against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwarden.catalog import QUERIES
from pairwarden.catalog import model_queries as MQ
from pairwarden.catalog import standins as t
from pairwarden.operators import autoencoder as A
from pairwarden.operators import features as P
from pairwarden.operators import lag_model as L
from pairwarden.operators import reconstruct as M
from pairwarden.operators import scoring as S
from pairwarden.operators.directions import NotConverged, principal_directions, tall_factor
from pairwarden.plans import correlation, models, rulecount
from pairwarden.operators import rules as R

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---- directions ----------------------------------------------------------------------


def _exact(table, k):
    values, vectors = np.linalg.eigh(np.cov(table.T, bias=True))
    return values[::-1][:k], vectors[:, ::-1][:, :k]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_dense_directions_equal_the_full_decomposition(spark, k):
    table = np.random.default_rng(2).standard_normal((300, 10)) @ np.diag(np.arange(1, 11)) + 5
    df = spark.createDataFrame([(r.tolist(),) for r in table], "x array<double>").repartition(5)
    model = M.fit_arrays(df, "x", k)
    values, vectors = _exact(table, k)
    block = np.array(model.components).T
    assert np.allclose(np.abs((block * vectors).sum(axis=0)), 1, atol=1e-9)
    total, along = M.variances_along(df, "x", model)
    assert np.allclose(along, values) and total == pytest.approx(np.trace(np.cov(table.T, bias=True)))
    factor = tall_factor(df.select("x"), table.mean(axis=0), block)
    assert np.allclose(np.linalg.svd(factor)[1] ** 2 / 300, values)


def test_directions_of_thousands_of_columns(spark):
    """5,000 columns: a covariance of 25 million numbers is never built."""
    rng = np.random.default_rng(3)
    width, rows = 5000, 120
    strong = np.linalg.qr(rng.standard_normal((width, 3)))[0]
    table = rng.standard_normal((rows, 3)) * [40, 20, 10] @ strong.T + 0.01 * rng.standard_normal((rows, width))
    df = spark.createDataFrame([(r.tolist(),) for r in table], "x array<double>").repartition(4)
    model = M.fit_arrays(df, "x", 3)
    _, _, vectors = np.linalg.svd(table - table.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs((np.array(model.components) * vectors[:3]).sum(axis=1)), 1, atol=1e-8)


def test_directions_of_flat_and_endless_spectra():
    assert principal_directions(lambda b: np.zeros_like(b), 6, 2)[0].tolist() == [0, 0]
    values, block = principal_directions(lambda b: b * 2.0, 50, 4)
    assert np.allclose(values, 2) and np.allclose(block.T @ block, np.eye(4))
    rng = np.random.default_rng(0)
    with pytest.raises(NotConverged):
        principal_directions(lambda b: rng.standard_normal(b.shape), 400, 2)
    with pytest.raises(ValueError, match="exceed"):
        principal_directions(lambda b: b, 9_000_000, 2)


# ---- networks ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(4)
    hidden = rng.standard_normal((200, 2))
    table = 1 / (1 + np.exp(-hidden @ rng.standard_normal((2, 6))))
    return table, spark.createDataFrame([(r.tolist(),) for r in table], "features array<double>").repartition(3)


@pytest.mark.parametrize("name", sorted(A.ACTIVATIONS))
def test_gradient_equals_differences(name):
    rng = np.random.default_rng(5)
    network = A.Network.fresh(4, [(3, name), (5, "tanh")], name)
    rows, counts = rng.uniform(0.1, 0.9, (7, 4)), rng.integers(0, 4, 7).astype(float)
    loss, slope = network.gradient(rows, counts)
    assert loss == pytest.approx(float((((network.restore(rows) - rows) ** 2).sum(axis=1) * counts).sum()))
    for i in rng.integers(0, len(slope), 25):
        step = np.zeros(len(slope))
        step[i] = 1e-6
        ends = [network.with_weights(network.weights + s * step).gradient(rows, counts)[0] for s in (1, -1)]
        assert slope[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-5)


def test_distributed_gradient_equals_one_of_all_rows(dense):
    table, df = dense
    network = A.Network.fresh(6, [(16, "relu"), (900, "tanh")], "sigmoid")  # more than one piece
    rows = df.select(F.col("features").alias("x"), F.lit(2.0).alias("n"))
    loss, n, slope = A.total_gradient(rows, network, False)
    want, want_slope = network.gradient(table, np.full(len(table), 2.0))
    assert n == 400 and loss == pytest.approx(want / (400 * 6)) and np.allclose(slope, want_slope / (400 * 6))


def test_losses_fall_and_scores_are_those_of_the_network(dense):
    table, df = dense
    network, losses, n = A.fit_network(df, hidden=[(8, "tanh"), (2, "identity")], last="sigmoid",
                                       how=A.Training(epochs=40))
    assert n == 200 and len(losses) <= 40
    assert all(b <= a for a, b in zip(losses, losses[1:])) and losses[-1] < 0.2 * losses[0]
    got = sorted(r.ai_rmse for r in A.score_network(network, df, sparse=False).collect())
    want = np.sqrt(((network.restore(table) - table) ** 2).mean(axis=1))
    assert np.allclose(got, np.sort(want), atol=1e-8)
    again = A.fit_network(df, hidden=[(8, "tanh"), (2, "identity")], last="sigmoid", how=A.Training(epochs=40))
    assert losses == again[1]


def test_identity_network_reaches_the_principal_directions(dense):
    table, _ = dense
    network = A.Network.fresh(6, [(2, "identity")], "identity")

    def evaluate(weights):
        loss, slope = network.with_weights(weights).gradient(table, np.ones(len(table)))
        return loss / table.size, slope / table.size

    how = A.Training(epochs=600, least_gain=0.0, patience=600)
    _, losses = A.minimise(evaluate, network.weights, how)
    values = np.linalg.eigvalsh(np.cov(table.T, bias=True))[::-1]
    assert losses[-1] == pytest.approx(values[2:].sum() / 6, rel=1e-3)


def test_one_hot_rows_and_odd_input(spark):
    rows = [([0, 3], 5), ([1, 3], 2), ([2], 1), ([], 4), ([None, 1], 1), (None, 9), ([1, 3], 0)]
    df = spark.createDataFrame(rows, "features array<long>, copies long")
    network, losses, n = A.fit_network(df, size=4, weight="copies", hidden=[(5, "tanh")], how=A.Training(epochs=25))
    assert n == 13 and losses[-1] < losses[0]
    table = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 1, 0], [0, 0, 0, 0], [0, 1, 0, 0]], float)
    want = dict(enumerate(np.sqrt(((network.restore(table) - table) ** 2).mean(axis=1))))
    got = A.score_network(network, df).collect()
    assert [r.ai_rmse for r in got][:5] == pytest.approx([want[i] for i in range(5)], abs=1e-8)
    assert got[5].ai_rmse is None
    with pytest.raises(ValueError, match="no rows"):
        A.fit_network(df.limit(0), size=4, weight="copies")
    with pytest.raises(ValueError, match="weights exceed"):
        A.Network.fresh(3000, [(3000, "relu")], "relu")
    with pytest.raises(Exception, match="rows must have"):
        A.fit_network(spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>"))


def test_network_models_in_the_plans(spark, tmp_path):
    tables, hidden, how = t.tables(spark, SMALL), [(6, "relu")], A.Training(epochs=8)
    fit = correlation.train_correlation(
        tables, t.SETTINGS, t.START, t.END, t.RUN_TIME, seed=3, hidden=hidden, how=how)
    epochs = fit.history.orderBy("epoch").collect()
    assert [r.epoch for r in epochs] == list(range(1, len(epochs) + 1)) and epochs[-1].loss < epochs[0].loss
    models.save_pair_model(spark, fit.model, str(tmp_path / "pair"), t.RUN_TIME)
    loaded = models.load_pair_model(spark, str(tmp_path / "pair"), t.RUN_TIME)
    assert np.array_equal(loaded.fitted.weights, fit.model.fitted.weights) and loaded.threshold == fit.model.threshold
    args = (tables, t.SETTINGS, loaded, t.START, t.END, t.RUN_TIME)
    pairs = correlation.predict_correlation(*args).pairs
    assert pairs.count() > 0 and pairs.filter("ai_rmse is null").count() == 0
    model, history = rulecount.train_rule_space(
        spark, t.rules(spark), t.mapping(spark), R.LOG, "log", t.RUN_TIME, hidden=[(16, "relu"), (32, "relu")], how=how)
    assert history.count() > 1
    models.save_dense_models(spark, {"log": model}, str(tmp_path / "rule"), t.RUN_TIME)
    again = models.load_dense_models(spark, str(tmp_path / "rule"), t.RUN_TIME)["log"]
    hits = MQ.match_rules_index(spark, SMALL).join(t.sourced_events(spark, SMALL), "event_id")
    scores = [rulecount.bucket_scores(hits, m, "ts").select("bucket", "ai_rmse").orderBy("bucket").collect()
              for m in (model, again)]
    assert scores[0] == scores[1] and scores[0]


# ---- lag models ----------------------------------------------------------------------


def _series(rows=400, columns=3, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, columns))
    for i in range(2, rows):
        x[i] += 0.5 * x[i - 1] - 0.3 * x[i - 2][::-1]
    return x + [1, 20, -5][:columns]


def _normal_equations(table, lags):
    off = table - table.mean(axis=0)
    n, p = off.shape
    cov = [off[h:].T @ off[: n - h] / n for h in range(lags + 1)]
    big = np.block([[cov[h - j] if h >= j else cov[j - h].T for h in range(1, lags + 1)] for j in range(1, lags + 1)])
    weights = np.hstack(cov[1:]) @ np.linalg.inv(big)
    left = cov[0] - weights @ np.vstack([c.T for c in cov[1:]])
    guess = np.zeros_like(off)
    for j in range(lags):
        guess[j + 1:] += off[: n - j - 1] @ weights[:, j * p:(j + 1) * p].T
    return weights, np.trace(left) / p, guess + table.mean(axis=0)


@pytest.mark.parametrize("chunk", [24, 8192])
def test_lag_model_equals_the_normal_equations(spark, chunk, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_ROWS", chunk)
    table = _series()
    df = spark.createDataFrame([(i, *r.tolist()) for i, r in enumerate(table)], "i long, a double, b double, c double")
    model = L.fit_lag_model(df.repartition(4), ["i"], ["a", "b", "c"], 4)
    weights, loss, guess = _normal_equations(table, 4)
    assert np.allclose(np.hstack(list(model.weights)), weights, atol=1e-9)
    assert model.losses[-1] == pytest.approx(loss) and all(b <= a for a, b in zip(model.losses, model.losses[1:]))
    got = L.score_lag_model(model, df, ["i"]).orderBy("i").collect()
    assert np.allclose([r.predicted for r in got], guess)
    assert np.allclose([r.ai_rmse for r in got], ((guess - table) ** 2).mean(axis=1), atol=1e-8)
    L.save_lag_model(model, df, f"{spark.conf.get('spark.sql.warehouse.dir')}/lag-{chunk}-{random.random()}")


def test_lag_model_of_odd_tables(spark, tmp_path):
    rows = [(1, 5.0, 1.0), (2, 5.0, None), (2, 5.0, 3.0), (2, 5.0, 3.0), (None, 5.0, 2.0), (9, 5.0, NAN)]
    df = spark.createDataFrame(rows, "i long, constant double, b double")
    model = L.fit_lag_model(df.filter("b is null or not isnan(b)"), ["i"], ["constant", "b"], 2)
    assert np.isfinite(model.weights).all() and not model.weights[:, 0].any()  # no variance, no weight
    scored = L.score_lag_model(model, df, ["i"])
    assert scored.count() == 6 and scored.filter("ai_rmse is null").count() == 0
    L.save_lag_model(model, df, str(tmp_path / "lag"))
    loaded = L.load_lag_model(spark.read.parquet(str(tmp_path / "lag")))
    assert loaded.cols == model.cols and np.array_equal(loaded.weights, model.weights) and loaded.losses == model.losses
    with pytest.raises(ValueError, match="no rows"):
        L.fit_lag_model(df.limit(0), ["i"], ["b"], 2)
    with pytest.raises(ValueError, match="exceed"):
        L.fit_lag_model(df, ["i"], ["b"] * 3000, 2)


def test_lag_scores_of_all_types_against_numpy(spark):
    rows = MQ.hourly_matrix(spark, SMALL).orderBy("date_time").collect()
    table = np.array([[r[c] for c in MQ._TYPES] for r in rows])
    _, _, guess = _normal_equations(table, 4)
    got = {r.date_time: r for r in QUERIES["lag_scores_all"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r, g, x in zip(rows, guess, table):
        assert np.allclose(got[r.date_time].predicted, g)
        assert got[r.date_time].ai_rmse == pytest.approx(((g - x) ** 2).mean(), abs=1e-8)


def test_network_query_against_numpy(spark):
    got = QUERIES["network_history"](spark, SMALL).orderBy("epoch").collect()
    assert all(b.loss <= a.loss for a, b in zip(got, got[1:])) and got[-1].loss < got[0].loss


# ---- draws ---------------------------------------------------------------------------


def test_draws_with_replacement(spark):
    rows = [("a", 1, i) for i in range(50)] + [("b", None, i) for i in range(7)] + [(None, 2, 0)] + [("c", 1, 3)] * 2
    df = spark.createDataFrame(rows, "k string, l long, v long").repartition(3)
    got = P.balance(df, ["k", "l"], ["v"], seed=5).collect()
    totals = defaultdict(int)
    for r in got:
        totals[r.k, r.l] += r.copies
    assert len(got) == len(rows) and set(totals.values()) == {50}
    for key, n in ((("b", "nan"), 7), ):
        want = Counter(int(hashlib.md5(f"5|{','.join(key)}|{k}".encode()).hexdigest()[:15], 16) % n for k in range(1, 51))
        assert {r.v: r.copies for r in got if r.k == "b"} == {i: want[i] for i in range(n)}
    assert any(r.copies == 0 for r in got if r.k == "b") or len({r.copies for r in got if r.k == "b"}) > 1
    kept = P.balance(df, ["k", "l"], ["v"], keep_original=True, seed=5)
    assert kept.agg(F.sum("copies")).first()[0] == 4 * 50 + len(rows)
    other = P.balance(df, ["k", "l"], ["v"], seed=6).collect()
    assert Counter(map(tuple, other)) != Counter(map(tuple, got))
    assert P.balance(df.limit(0), ["k", "l"], ["v"], seed=5).count() == 0


def test_draws_of_a_large_pattern_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "_BLOCK", 10)
    df = spark.range(95).selectExpr("'big' as k", "id").union(spark.createDataFrame([("one", 0), ("two", 1)], "k string, id long"))
    got = P.balance(df, ["k"], ["id"], seed=1).groupBy("k").agg(F.sum("copies").alias("n")).collect()
    assert {r.k: r.n for r in got} == {"big": 95, "one": 95, "two": 95}


# ---- medians of groups ---------------------------------------------------------------


def _median(values):
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    low, high = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
    return low if low == high else low / 2 + high / 2


@pytest.mark.parametrize("most", [50_000, 5])
def test_grouped_median_with_odd_values(spark, most, monkeypatch):
    monkeypatch.setattr(S, "BRACKET_VALUES", most)  # 5: groups are bracketed again and again
    rng = random.Random(8)
    rows = [("big", 1, rng.gauss(0, 1)) for _ in range(3001)] + [("ties", 1, float(rng.randint(0, 3))) for _ in range(900)]
    for name in ("x", "y", None):
        for n in (1, 2, 3, 8):
            rows += [(name, n, rng.choice([NAN, INF, -INF, 0.0, -0.0, 1.5, 1e308, -1e308, 5e-324])) for _ in range(n)]
    rows += [("nan", 1, NAN)] * 3 + [("inf", 1, INF)] * 3 + [("both", 1, INF), ("both", 1, -INF), ("gone", 1, None)]
    df = spark.createDataFrame(rows, "g string, h long, v double").repartition(4).cache()
    groups = defaultdict(list)
    for g, h, v in rows:
        if v is not None:
            groups[g, h].append(v)
    got = {(r.g, r.h): r["median"] for r in S.grouped_median(df, ["g", "h"], F.col("v")).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        want = _median(values)
        assert got[key] == want or (math.isnan(want) and math.isnan(got[key])), (key, sorted(map(str, values)))


def test_grouped_thresholds_equal_single_ones(spark):
    rng = random.Random(9)
    rows = [(g, rng.gauss(g, 1 + g)) for g in range(4) for _ in range(101)] + [(8, 2.0)] * 5 + [(9, 1.0), (9, 1.0), (9, 4.0)]
    df = spark.createDataFrame(rows, "g long, v double").cache()
    got = {r.g: r for r in S.grouped_mad_threshold(df, ["g"], "v").collect()}
    scored = S.grouped_mad_score(df, ["g"], "v")
    for g in (0, 1, 2, 3, 8, 9):
        own = df.filter(F.col("g") == g)
        median, mad = S.mad_parts(own, "v")
        assert (got[g].median, got[g].mad, got[g].threshold) == (median, mad, S.mad_threshold(own, "v"))
        want = sorted(map(repr, (r.z_score for r in S.mad_score(own, "v").collect())))
        assert sorted(map(repr, (r.z_score for r in scored.filter(F.col("g") == g).collect()))) == want


def test_a_hundred_thousand_groups(spark):
    df = spark.range(300_000).selectExpr("id % 100000 as g", "cast((id * 7919) % 1000 as double) as v").cache()
    got = S.grouped_median(df, ["g"], F.col("v"))
    want = df.groupBy("g").agg(F.median("v").alias("want"))
    assert got.count() == 100_000
    assert got.join(want, "g").filter("median <> want").count() == 0

