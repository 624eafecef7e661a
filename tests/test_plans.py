"""Training and prediction plans end to end, and the streams behind them."""

import math
import re
from collections import Counter
from datetime import datetime, timedelta
from hashlib import md5
from itertools import combinations, product

import duckdb
import numpy as np
import pytest
from compare import ROOT, compare
from pyspark.sql import functions as F

from pairwarden.catalog import ORACLES, QUERIES
from pairwarden.catalog import plan_queries as PQ
from pairwarden.catalog import standins as t
from pairwarden.functions.columns import clean_value
from pairwarden.operators import rules as R
from pairwarden.plans import correlation, models, rulecount, samekind, tags
from pairwarden.operators.reshape import complete_rows, to_wide
from pairwarden.plans import runs as whole_runs
from pairwarden.sources import sinks
from pairwarden.sources.versions import list_versions
from pairwarden.streaming import streams as K

SMALL, MIDDLE = str(ROOT / "sf0.001"), str(ROOT / "sf0.01")


def test_correlation_round_trip(spark, tmp_path):
    tables = t.tables(spark, SMALL)
    fitted = correlation.train_correlation(tables, t.SETTINGS, t.START, t.END, t.RUN_TIME, k=1)
    assert [r.epoch for r in fitted.history.collect()] == [1, 2]
    assert fitted.holdout_scores.agg(F.sum("n")).first()[0] > 0
    root = str(tmp_path / "models")
    models.save_pair_model(spark, fitted.model, root, t.RUN_TIME)
    versions = list_versions(spark, root)
    newest = sinks.latest_version(versions, datetime(2024, 3, 1), models.PAIR_MODEL_FILES).first().version
    assert newest == t.RUN_TIME
    assert sinks.latest_version(versions, datetime(2024, 1, 1), 4).first().version is None
    loaded = models.load_pair_model(spark, root, newest)
    runs = [
        correlation.predict_correlation(tables, t.SETTINGS, m, t.START, t.END, t.RUN_TIME).pairs
        for m in (fitted.model, loaded)
    ]
    first, second = (sorted(map(str, df.collect())) for df in runs)
    assert first and first == second
    again = correlation.predict_correlation(
        tables, t.SETTINGS, loaded, t.START, t.END, t.RUN_TIME, stored=correlation.Stored(pairs=runs[0]))
    assert again.pairs.count() == 0
    assert again.single_logs.count() and again.single_packets.count() and again.prepared.count()
    texts = [c for c, kind in again.prepared.dtypes if kind == "string"]
    assert again.prepared.filter(" or ".join(f"{c} is null" for c in texts)).count() == 0
    stamps = again.single_logs.groupBy("version").count().orderBy("version").collect()
    assert all(s["count"] == 1000 for s in stamps[:-1]) and stamps[0].version == t.RUN_TIME


def test_more_directions_do_not_raise_the_error(spark):
    tables = t.tables(spark, SMALL)
    fitted = correlation.train_correlation(
        tables, t.SETTINGS, t.START, t.END, t.RUN_TIME, k=3, balanced=False)
    losses = [r.loss for r in fitted.history.orderBy("epoch").collect()]
    assert losses[-1] < losses[0]


def test_similarity_bound_finds_the_pairs_that_stay_true(spark):
    rules, mapping = t.rules(spark), t.mapping(spark)
    fits = {
        name: rulecount.train_rule_space(spark, rules, mapping, kind, name, t.RUN_TIME)[0]
        for name, kind in (("log", R.LOG), ("packet", R.PACKET))
    }
    events = PQ._active(spark, MIDDLE)
    every = rulecount.predict_bucket_similarity(events, fits, mapping, t.RUN_TIME, min_sim=0.0)
    near = rulecount.predict_bucket_similarity(events, fits, mapping, t.RUN_TIME)
    kept = {(r.f_hash, r.b_hash, r["corr"]) for r in every.filter("ai_label").collect()}
    assert kept and kept == {(r.f_hash, r.b_hash, r["corr"]) for r in near.collect()}


@pytest.mark.parametrize("k", [0, 1])
def test_long_form_tag_scores_equal_the_dense_model(spark, k):
    rows = t.readings(spark, MIDDLE)
    fit = tags.train_tags(rows, t.catalogue(spark), ["Turbine1"], t.START, t.END, t.RUN_TIME, k=k)["Turbine1"]
    scores = tags.score_tags(rows, {"Turbine1": fit.model}, t.START, t.END, t.RUN_TIME, t.READING_UNITS)
    found = {(r.date_time, r.tag_name): r.ai_rmse for r in scores.result.collect()}
    cells = tags.training_cells(rows, t.catalogue(spark)).filter(F.col("tag_name").isin(fit.model.cols))
    every = rows.filter(F.col("tag_name").isin(fit.model.cols)).withColumn("v", clean_value("tag_value"))
    assert cells.count() <= every.count()
    wide = complete_rows(to_wide(every, "date_time", "tag_name", "v", fit.model.cols)).collect()
    lo = np.array([fit.model.bounds[c][0] for c in fit.model.cols])
    hi = np.array([fit.model.bounds[c][1] for c in fit.model.cols])
    v = np.array(fit.model.linear.components).reshape(k, len(lo))
    for r in wide:
        d = (np.array([r[c] for c in fit.model.cols]) - lo) / (hi - lo) - np.array(fit.model.linear.means)
        want = ((d - d @ v.T @ v) ** 2).mean()
        for c in fit.model.cols:
            assert found[r.date_time, c] == pytest.approx(want, abs=1e-8)
    assert len(found) == len(wide) * len(lo)
    assert scores.prepared.count() == len(found)
    again = tags.score_tags(
        rows, {"Turbine1": fit.model}, t.START, t.END, t.RUN_TIME, t.READING_UNITS, stored=scores.result)
    assert again.result.count() == 0


def test_readings_contain_texts_to_clean(spark):
    rows = t.readings(spark, MIDDLE)
    assert rows.filter("tag_value in ('null', 'True')").count() > 0
    assert rows.filter(clean_value("tag_value").isNull()).count() == 0


def test_stream_equals_batch_after_restart(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    events = t.sourced_events(spark, SMALL)
    schema = events.schema
    rules = R.load_rules(t.rules(spark))

    def run():
        stream = K.stream_match_rules(K.read_stream(spark, source, schema), rules)
        K.stream_append_new(stream.select("hash", "single_rule"), out, progress, ["hash", "single_rule"])

    events.filter("event_id % 2 = 0").write.parquet(source)
    run()
    events.filter("event_id % 2 = 1").write.mode("append").parquet(source)
    run()
    run()
    batch = R.match_rules(events, rules, "ts").select("hash", "single_rule")
    stored = spark.read.parquet(out)
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


def test_stream_dedup_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", datetime(2024, 1, 1, 0, 0, i)) for i in range(5)] + [("b", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "hash string, ts timestamp_ntz")
    df.write.parquet(source)
    found = K.run_available(K.stream_dedup(K.read_stream(spark, source, df.schema)), "dedup-test")
    assert sorted(r.hash for r in found.collect()) == ["a", "b"]


def test_keys_that_lie_in_two_batches_are_both_stored(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    day = datetime(2024, 1, 1)
    schema = "date_time timestamp_ntz, tag string"
    for tag in ("a", "b"):  # one time, two micro-batches
        spark.createDataFrame([(day, tag), (day, tag)], schema).write.mode("append").parquet(source)
        stream = K.read_stream(spark, source, spark.createDataFrame([], schema).schema)
        K.stream_append_new(stream, out, progress, ["date_time", "tag"], "date_time")
    assert sorted(r.tag for r in spark.read.parquet(out).collect()) == ["a", "b"]
    with pytest.raises(Exception, match="apart"):
        spark.createDataFrame([(day, "c"), (day, "d")], schema).write.mode("append").parquet(source)
        K.stream_append_new(K.read_stream(spark, source, spark.createDataFrame([], schema).schema),
                            out, progress, ["date_time"], "date_time")


def test_append_reads_the_days_of_the_new_rows_only(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "hash string, time timestamp_ntz"
    first = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2))], schema)
    sinks.append_new(first, path, ["hash"], "time")
    more = spark.createDataFrame([("b", datetime(2024, 1, 2)), ("c", datetime(2024, 1, 2))], schema)
    sinks.append_new(more, path, ["hash"], "time")
    assert sorted(r.hash for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    stored = sinks.read_stored(spark, path, more, [datetime(2024, 1, 2).date()])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert sorted(r.hash for r in stored.collect()) == ["b", "c"]


def _counts(spark, results):
    return {p.name: spark.read.parquet(str(p)).count() for p in results.iterdir()}


def test_runs_load_the_newest_model_and_add_nothing_twice(spark, tmp_path):
    tables, times = t.tables(spark, SMALL), (t.START, t.END, t.RUN_TIME)
    mapping, rules = t.mapping(spark), t.rules(spark)
    roots = {n: str(tmp_path / n) for n in ("pair", "log", "rule", "tag")}
    models.save_pair_model(
        spark, correlation.train_correlation(tables, t.SETTINGS, *times).model, roots["pair"], t.RUN_TIME)
    models.save_pair_model(
        spark, samekind.train_same_kind(tables, t.LOG_COLS, *times).model, roots["log"], t.RUN_TIME)
    models.save_dense_models(spark, {
        name: rulecount.train_rule_space(spark, rules, mapping, kind, name, t.RUN_TIME)[0]
        for name, kind in (("log", R.LOG), ("packet", R.PACKET))}, roots["rule"], t.RUN_TIME)
    readings = t.readings(spark, MIDDLE)
    fits = tags.train_tags(readings, t.catalogue(spark), ["Turbine1", "Turbine2"], *times)
    models.save_dense_models(spark, {n: f.model for n, f in fits.items()}, roots["tag"], t.RUN_TIME)
    loaded = models.load_dense_models(spark, roots["tag"], t.RUN_TIME)
    assert loaded == {n: f.model for n, f in fits.items()}
    results = tmp_path / "results"
    found = []
    for _ in range(2):
        whole_runs.run_correlation(tables, t.SETTINGS, roots["pair"], str(results), *times)
        whole_runs.run_same_kind(tables, roots["log"], str(results), *times)
        whole_runs.run_bucket_similarity(PQ._active(spark, MIDDLE), mapping, roots["rule"], str(results), t.RUN_TIME)
        whole_runs.run_tags(readings, 2, roots["tag"], str(results), *times, t.READING_UNITS)
        found.append(_counts(spark, results))
    assert found[0] == found[1]
    assert set(found[0]) == {"single_logs", "single_packets", "prepared", "pairs", "log_pairs", "similar",
                             "tag_prepared", "tag_result"}
    assert all(found[0].values())
    with pytest.raises(whole_runs.NoModelError):
        whole_runs.run_same_kind(tables, roots["log"], str(results), t.START, t.END, datetime(2023, 1, 1))


def test_milli_time_of_both_kinds(spark):
    """Seconds in single events; thousandths in the joint column of pairs; by kind in similar events."""
    tables = t.tables(spark, SMALL)
    fitted = correlation.train_correlation(tables, t.SETTINGS, t.START, t.END, t.RUN_TIME, balanced=False)
    found = correlation.predict_correlation(tables, t.SETTINGS, fitted.model, t.START, t.END, t.RUN_TIME)
    for singles in (found.single_logs, found.single_packets):
        assert singles.filter("milli_time not rlike '^[-0-9]{10} [0-9:]{8}$'").count() == 0
    pairs = found.prepared.select("type", "milli_time").collect()
    assert {r.type for r in pairs} == {"log", "packet"}
    assert all(len(r.milli_time) == 23 and r.milli_time[19] == "." for r in pairs)
    assert all(r.milli_time.endswith("000") for r in pairs if r.type == "log")
    events = PQ._active(spark, SMALL)
    assert {len(r.milli_time) for r in events["log"].select("milli_time").collect()} == {19}
    assert {len(r.milli_time) for r in events["packet"].select("milli_time").collect()} == {23}


def test_no_single_partition_exchange_in_the_joins(spark):
    from pairwarden.catalog import QUERIES

    for name in ("attach_address", "label_pairs", "same_asset", "attach_multi", "corr_pairs"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def test_classes_and_links_hold_every_pair_of_events(spark, tmp_path):
    """Query and SQL: each link with both its classes and its similarity, not their number alone."""
    events = [
        (i, datetime(2024, 1, 1) + timedelta(seconds=12 * i), i * 7 % 30, "click" if i % 5 else "view",
         float(i * 13 % 120), f"text {('abc', 'def')[i % 2]} word{i % 3 % 2}") for i in range(90)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, i % 5) for i in range(30)], "s_suppkey long, s_nationkey long"
                          ).write.parquet(f"{tmp_path}/supplier.parquet")
    hits: dict[tuple, list] = {}
    for i, ts, user, kind, value, props in events:
        words = [props, None if user % 7 == 0 else f"user {user % 20}", "large" if value > 50 else "small", None,
                 None if user % 11 == 0 else kind]
        bag = Counter(re.findall(r"\w\w+", ",".join(x or "," for x in words)))
        rules = {1: kind == "click", 2: kind == "click" and value > 50, 4: kind == "view"}
        for rule in (r for r, hit in rules.items() if hit and user % 17 != 3):
            key = ts.replace(minute=ts.minute // 10 * 10, second=0), rule
            hits.setdefault(key, []).append((md5(f"{i}|{user}|{kind}".encode()).hexdigest(), user % 3, bag))
    marked = {b for (b, _), rows in hits.items() if len(rows) > 1}
    want = {}
    for key, rows in hits.items():
        for (f, one, x), (b, two, y) in combinations(sorted(rows, key=lambda r: r[0]), 2):
            norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
            sim = sum(x[w] * y[w] for w in x) / norm
            if key[0] in marked and one != two and sim > 0.5:
                want[*key, f, b] = round(sim, 6)

    df = QUERIES["bucket_classes"](spark, str(tmp_path))
    assert set(df.columns) == {"bucket", "single_rule", "part", "f_hash", "b_hash", "site", "cos_sim"}
    members, links = {}, {}
    for r in df.collect():
        if r.part == "member":
            members.setdefault((r.bucket, r.single_rule, r.f_hash), []).append((r.b_hash, r.site))
        else:
            links[r.bucket, r.single_rule, r.f_hash, r.b_hash] = r.cos_sim
    met = [(key, c, 1.0) for key, rows in members.items() for c in combinations(rows, 2)]
    met += [(k, c, sim) for k, sim in links.items() for c in product(members[k[:3]], members[*k[:2], k[3]])]
    got = {(*key[:2], *sorted((f, b))): sim for key, ((f, one), (b, two)), sim in met if one != two}
    assert got == want and 1.0 in want.values() and len(links) > 20

    con = duckdb.connect()
    for name in ("events", "supplier"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert compare(df, con, ORACLES["bucket_classes"])[1] is None
