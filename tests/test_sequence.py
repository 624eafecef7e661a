"""Pairs, look-back windows and firsts against plain Python on small inputs."""

import pytest
from pyspark.sql import functions as F

from pairwarden.operators import ordering
from pairwarden.operators.sequence import (
    adjacent_pairs,
    keep_first,
    lookback,
    merge_excess,
    shift_ones,
    skip_pairs,
    split_pairs,
)


def appended_pairs(rows, n):
    """Neighbours in the list that results from appending (i, i+x+1) for each skip x."""
    long = list(rows)
    for x in range(1, n):
        for i in range(len(rows) - x - 1):
            long += [rows[i], rows[i + x + 1]]
    return sorted(zip(long, long[1:], strict=False))


def got(df):
    return sorted((r.f_v, r.b_v) for r in df.collect())


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 9])
@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_junctions_reproduce_the_appended_list(spark, size, n):
    df = spark.createDataFrame([(i, i) for i in range(size)], "t int, v int")
    assert got(skip_pairs(df, ["t"], ["v"], n, junctions=True)) == appended_pairs(list(range(size)), n)


@pytest.mark.parametrize("n", [1, 3])
def test_skip_pairs_over_many_chunks(spark, monkeypatch, n):
    monkeypatch.setattr(ordering, "CHUNK_ROWS", 7)
    monkeypatch.setattr(ordering.spread, "__defaults__", (7,))
    size = 100
    df = spark.range(size).selectExpr("id as v", "cast(id div 3 as int) as t").repartition(5)
    expected = sorted((i, i + k) for k in range(1, n + 1) for i in range(size - k))
    assert got(skip_pairs(df, ["t", "v"], ["v"], n)) == expected


def test_groups_do_not_mix_and_null_is_a_group(spark):
    rows = [("a", 1), ("a", 2), (None, 3), ("b", 4), (None, 5)]
    df = spark.createDataFrame(rows, "g string, v int")
    assert got(skip_pairs(df, ["v"], ["v"], 2, by=["g"])) == [(1, 2), (3, 5)]


def test_equal_times_are_ordered_by_hash(spark):
    df = spark.createDataFrame([(1, "c", 1), (1, "a", 2), (1, "b", 3)], "t int, hash string, v int")
    assert got(adjacent_pairs(df, ["t", "hash"], ["v"])) == [(2, 3), (3, 1)]


def test_one_row_has_no_pair(spark):
    df = spark.createDataFrame([(1, 1)], "t int, v int")
    assert got(adjacent_pairs(df, ["t"], ["v"])) == []


def test_hot_time_is_split_and_stays_whole(spark):
    df = spark.range(3000).selectExpr("id as v", "if(id % 3 = 0, id, 7) as t")
    numbered, total = ordering.number_rows(df, ["t"])
    assert total == 3000
    assert sorted(r.idx for r in numbered.collect()) == list(range(3000))


def windows(df):
    return [r.window for r in df.orderBy("t").collect()]


def test_lookback_starts_with_zero_windows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 5)], "t int, x double")
    assert windows(lookback(df, ["t"], ["x"], 2)) == [
        [[0.0], [0.0]], [[0.0], [0.0]], [[1.0], [2.0]], [[2.0], [3.0]],
    ]
    assert windows(lookback(df, ["t"], ["x"], 2, inclusive=True)) == [
        [[0.0], [0.0]], [[1.0], [2.0]], [[2.0], [3.0]],
    ]


@pytest.mark.parametrize("steps", [4, 9])
def test_lookback_needs_more_rows_than_steps(spark, steps):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "t int, x double")
    assert windows(lookback(df, ["t"], ["x"], steps)) == [None] * 4


def test_lookback_over_chunks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(ordering.spread, "__defaults__", (5,))
    rows = [(g, i, float(i)) for g in "ab" for i in range(60)]
    df = spark.createDataFrame(rows, "g string, t int, x double").repartition(3)
    for r in lookback(df, ["t"], ["x"], 3, by=["g"]).collect():
        want = [[0.0]] * 3 if r.t < 3 else [[float(r.t - k)] for k in (3, 2, 1)]
        assert r.window == want


def test_shift_ones(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "t int, x double")
    assert [r.x for r in shift_ones(df, ["t"], ["x"]).orderBy("t").collect()] == [1.0, 5.0, 6.0]


def test_keep_first_and_merge_excess(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), (None, 1, "d"), (None, 1, "c"), ("k", 2, "z"), ("k", 2, "y")]
    df = spark.createDataFrame(rows, "id string, single_rule int, hash string")
    first = keep_first(df, ["id", "single_rule"], ["hash"])
    assert sorted(r.hash for r in first.collect()) == ["a", "c", "y"]
    merged = merge_excess(df, [1], ["id"])
    assert sorted(r.hash for r in merged.collect()) == ["a", "c", "y", "z"]


def test_split_pairs(spark):
    rows = [("log", "packet", 1), ("log", "packet", None), ("log", "log", None)]
    df = spark.createDataFrame(rows, "f_type string, b_type string, corr int")
    train, held = split_pairs(df)
    assert (train.count(), held.count()) == (1, 1)
    assert split_pairs(df, cross_only=False)[1].count() == 2


def test_plan_has_no_single_partition_window(spark):
    df = spark.range(100).withColumn("v", F.col("id"))
    plan = adjacent_pairs(df, ["id"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_copies_of_one_row_are_spread(spark):
    """Half of all rows are the same: no partition of the order holds them all, and places are unique."""
    from pairwarden.operators.ordering import number_rows

    df = spark.range(20_000).selectExpr("id as a", "id % 50 as b").union(
        spark.range(20_000).selectExpr("7 as a", "1 as b")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    numbered, total = number_rows(df, ["b", "a"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert total == 40_000 and numbered.select("idx").distinct().count() == 40_000
    sizes = [r["count"] for r in numbered.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 0.5 * 40_000
    pairs = skip_pairs(df, ["b", "a"], ["a"], 2)
    assert pairs.count() == 2 * 40_000 - 3
