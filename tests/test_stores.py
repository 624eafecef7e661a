"""Keyed store, atomic versions: repeats, failures midway, two writers, damage."""

import threading
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwarden.sources import versions as V
from pairwarden.sources.keyed_store import KeyedStore, build_filter, may_hold
from pairwarden.sources.sinks import latest_version, load_snapshot, save_snapshot


def _rows(spark, low, high):
    return spark.range(low, high).selectExpr("md5(cast(id as string)) as hash", "id % 7 as k", "id as v")


def test_filter_knows_its_keys():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 20_000)
    bits = build_filter(keys[:10_000])
    assert may_hold(bits, keys[:10_000]).all()
    assert may_hold(bits, keys[10_000:]).mean() < 0.005
    assert not may_hold(build_filter(keys[:0]), keys).any()


def test_second_run_adds_nothing(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ("hash", "k"), 4)
    first = _rows(spark, 0, 500)
    assert store.new_rows(first).count() == 500  # before the first write
    twins = first.limit(3).withColumn("v", F.col("v") + 1000)  # rows of one batch may share a key
    store.append_new(first.union(twins).union(first))
    assert store.read().count() == 503
    store.append_new(first)
    store.append_new(first.withColumn("v", F.lit(-1).cast("long")))  # the key is stored
    assert store.read().count() == 503
    more = _rows(spark, 400, 700)
    assert sorted(r.v for r in store.new_rows(more).collect()) == list(range(500, 700))
    store.append_new(more)
    later = KeyedStore(spark, str(tmp_path / "s"), ("hash", "k"), 99)  # the stored number of buckets counts
    later.append_new(more)
    later.append_new(more.limit(0))
    assert later.read().count() == 703
    with pytest.raises(ValueError, match="kept by"):
        KeyedStore(spark, str(tmp_path / "s"), ("k",)).append_new(more)


def test_files_of_a_failed_writer_are_completed(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ("hash",), 4)
    store.append_new(_rows(spark, 0, 100))
    name, _, buckets = store._table()
    written = _rows(spark, 100, 200).repartition(buckets, "hash")
    written.write.mode("append").insertInto(name)  # and no sidecars
    store.append_new(_rows(spark, 50, 250))
    assert sorted(r.v for r in store.read().collect()) == list(range(250))


def test_only_known_files_are_read_and_the_store_is_not_shuffled(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ("hash",), 4)
    for i in range(5):
        store.append_new(_rows(spark, 100 * i, 100 * i + 100))
    name = store._table()[0]
    files = [r.file for r in store.filters().collect()]
    assert len(files) == 20
    held = store.held(name, files[:3])
    assert held.count() == sum(r["keys"] for r in store.filters().filter(F.col("file").isin(files[:3])).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = _rows(spark, 0, 40).join(held.hint("merge"), ["hash"], "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    left, _, right = plan.partition("FileScan parquet")
    assert "Bucketed: true" in right and plan.count("Exchange") == 1 and "Exchange" not in right
    assert left.index("Exchange") < left.index("Range")  # the one exchange is over the new rows


def test_snapshot_is_replaced_at_once(spark, tmp_path):
    root = str(tmp_path / "snap")
    save_snapshot(spark.range(5), root, "v1")
    old = load_snapshot(spark, root, "v1")
    save_snapshot(spark.range(7), root, "v1")
    assert load_snapshot(spark, root, "v1").count() == 7
    assert old.count() == 5  # a reader keeps what it has opened
    with pytest.raises(V.VersionMissing):
        load_snapshot(spark, root, "v2")


def test_a_writer_that_stops_midway_is_invisible(spark, tmp_path):
    root, first = str(tmp_path / "m"), datetime(2024, 1, 1, 5)
    V.publish({"a": spark.range(3), "b": spark.range(2).limit(0)}, root, first)

    def fails(df):
        raise RuntimeError("killed")

    broken = spark.range(4).mapInPandas(fails, "id long")
    with pytest.raises(Exception):
        V.publish({"a": spark.range(9), "b": broken}, root, datetime(2024, 1, 1, 6))
    found = V.list_versions(spark, root).collect()
    assert [(r.version, r.n_files) for r in found] == [(first, 2)]
    assert latest_version(V.list_versions(spark, root), datetime(2025, 1, 1), 2).first().version == first
    loaded = V.load_version(spark, root, first)
    assert loaded["a"].count() == 3 and loaded["b"].count() == 0 and loaded["b"].columns == ["id"]
    V.verify_version(spark, root, first)


def test_of_two_writers_one_wins(spark, tmp_path):
    root, version, ends = str(tmp_path / "m"), datetime(2024, 1, 1), []

    def write(n):
        try:
            V.publish({"a": spark.range(n)}, root, version)
            ends.append(n)
        except V.VersionTaken:
            ends.append(None)

    writers = [threading.Thread(target=write, args=(n,)) for n in (3, 4, 5)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    (winner,) = [n for n in ends if n]
    assert len(ends) == 3 and V.load_version(spark, root, version)["a"].count() == winner
    assert len(list((tmp_path / "m" / "data").iterdir())) == 1  # the losers' files are gone
    with pytest.raises(V.VersionTaken):
        V.publish({"a": spark.range(1)}, root, version)


def test_damage_is_found(spark, tmp_path):
    root = str(tmp_path / "m")
    V.publish({"a": spark.range(100).repartition(2)}, root, "v")
    V.verify_version(spark, root, "v")
    path = Path(V._manifest(spark, root, "v").tables[0].path)
    files = sorted(path.glob("part-*"))
    files[0].write_bytes(files[0].read_bytes()[:-20])
    with pytest.raises(V.VersionDamaged, match="files of a"):
        V.verify_version(spark, root, "v")
    files[0].unlink()
    with pytest.raises(V.VersionDamaged, match="files of a"):
        V.verify_version(spark, root, "v")
