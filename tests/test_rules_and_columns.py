"""Rules, scalar operators, joins and sinks at their edges."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pairwarden.functions import columns as C
from pairwarden.functions import times
from pairwarden.operators import joins as J
from pairwarden.operators import reshape as E
from pairwarden.operators import rules as R
from pairwarden.operators.lookup import lookup_join
from pairwarden.operators.rules import Rule, match_rules
from pairwarden.schemas import RULE_MAP
from pairwarden.session import stage
from pairwarden.sources import scan, sinks


def events(spark):
    rows = [("h1", "L005", 5), ("h2", "L009", 50), ("h3", None, 500)]
    return spark.createDataFrame(rows, "hash string, source string, value int")


def test_one_row_per_event_and_rule(spark):
    rules = [
        R.Rule(1, R.LOG, None, "A", "value > 10"),
        R.Rule(2, R.LOG, None, "A", "value > 100 or value = 50"),
        R.Rule(3, R.LOG, "L005", "A", "value > 100 or value < 10"),
        R.Rule(4, R.LOG, "L009", "A", None),
        R.Rule(5, R.LOG, None, "A", "cast(null as boolean)"),
    ]
    hits = R.match_rules(events(spark).withColumn("time", F.lit("t")), rules)
    assert sorted((r.hash, r.single_rule) for r in hits.collect()) == [
        ("h1", 3), ("h2", 1), ("h2", 2), ("h2", 4), ("h3", 1), ("h3", 2)]
    assert R.match_rules(events(spark).withColumn("time", F.lit("t")), []).count() == 0


def test_match_is_one_scan(spark):
    rules = [R.Rule(i, R.LOG, None, "A", f"value > {i}") for i in range(20)]
    plan = R.match_rules(events(spark).withColumn("time", F.lit("t")), rules)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Scan ExistingRDD") == 1


def test_rule_states(spark):
    rules = [R.Rule(i, R.LOG, None, s, "true") for i, s in enumerate(["A", "D", "DE", None])]
    frame = R.rules_frame(spark, rules)
    assert [r.rule_id for r in R.load_rules(R.select_rules(frame, R.LOG, active_only=True))] == [0]
    assert R.select_rules(frame, R.LOG).count() == 4
    assert R.select_rules(frame, R.PACKET).count() == 0


def test_mapping_fills_missing_sides(spark):
    rows = [(1, 10, 2, "A"), (1, 20, 1, "A"), (1, 10, 2, "A"), (2, 11, 2, "A"), (3, 21, 1, "D")]
    mapping = spark.createDataFrame(rows, RULE_MAP)
    mapped = R.rule_mapping(mapping)
    assert sorted(tuple(r) for r in mapped.collect()) == [(1, 10, 20), (2, 11, 0), (3, 0, 21)]
    assert R.symmetric_pairs(mapped).count() == 6
    assert sorted(tuple(r) for r in R.same_kind_pairs(mapping).collect()) == [(1, 10, 10), (2, 11, 11)]


def test_hash_leaves_out_the_rule(spark):
    df = spark.createDataFrame([(1, "a", 7), (1, "a", 8)], "i int, t string, single_rule int")
    assert df.select(C.row_hash(["i", "t"])).distinct().count() == 1


def test_cleaning_is_strict(spark):
    df = spark.createDataFrame([("False",), ("null",), ("True",), ("1.5",)], "v string")
    assert [r[0] for r in df.select(C.clean_value("v")).collect()] == [0.0, 0.0, 0.0, 1.5]
    bad = spark.createDataFrame([("oops",)], "v string").select(C.clean_value("v"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_patterns_are_regular_expressions(spark):
    df = spark.createDataFrame([("10.1.0.2",), ("10x1.0.2",), ("9.9.9.9",), (None,)], "ip string")
    assert [r.ip for r in C.exclude_patterns(df, "ip", ["10.1"]).collect()] == ["9.9.9.9"]


def test_nonempty_counts_null_as_empty(spark):
    df = spark.createDataFrame([("", None), (None, "x"), ("y", "")], "a string, b string")
    assert C.any_nonempty(df, ["a", "b"]).count() == 2


def test_times(spark):
    df = spark.createDataFrame([("2024010203040578", "bad")], "t string, b string")
    row = df.select(times.parse_second("t"), times.parse_fraction("t"), times.parse_lenient("b")).first()
    assert row[0] == datetime(2024, 1, 2, 3, 4, 5)
    assert row[1] == datetime(2024, 1, 2, 3, 4, 5, 780000)
    assert row[2] == datetime(1970, 1, 1)


def test_cron_and_deltas():
    assert times.cron_unit("*/1 * * * *") == "minute"
    assert times.cron_unit("0 */1 * * *") == "hour"
    assert times.cron_unit("* * *") == "hour"
    assert times.parse_delta("weeks=2") == timedelta(weeks=2)
    assert times.parse_delta("years=1") == timedelta(days=1)
    assert times.parse_delta("hours") == timedelta(days=1)
    assert times.parse_delta(None) == timedelta(days=1)
    assert times.run_range(datetime(2024, 1, 2), "hours=1", "days=1") == (
        datetime(2023, 12, 31, 23), datetime(2024, 1, 1, 23))


def test_sites_and_texts(spark):
    rows = [("P_1_a", "P_2_a", None, "x"), ("P_1_a", "P_1_b", "u", None), ("P_1", "P_1", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    assert [r[0] for r in df.select(C.different_site("a", "b")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(C.text_of(["c", "d"])).collect()] == [",,x", "u,,", ","]


def test_label_follows_the_rule_and_demotion(spark):
    df = spark.createDataFrame([(5, 0.99, True), (0, 1.0, True), (None, 0.5, False)], "corr int, s double, ai_label boolean")
    assert [r.ai_label for r in C.label_by_rule(df).collect()] == [True, False, False]
    assert [r.ai_label for r in C.demote(df, "s", 0.99).collect()] == [False, True, False]


def test_filling_and_products(spark):
    df = spark.createDataFrame([(None, "nan", 2.0, 3.0)], "a int, b string, c double, d double")
    assert tuple(C.fill_missing(df, {"a": 0}, ["b"]).first())[:2] == (0, " ")
    assert df.select(C.row_product(["c", "d"])).first()[0] == 6.0


def test_address_fans_out_and_unknown_devices_go(spark):
    logs = spark.createDataFrame([("h1", "d1"), ("h2", "d2")], "hash string, device_id string")
    dim = spark.createDataFrame([("d1", "1.1"), ("d1", "1.2"), ("d1", "nan")], "device_id string, ip_address string")
    assert sorted(r.ip for r in J.attach_address(logs, dim).collect()) == ["1.1", "1.2"]


def test_assets_with_null_are_never_equal(spark):
    pairs = spark.createDataFrame([("1", "2", 5), ("1", "1", 0), ("1", "1", 5)], "f_ip string, b_ip string, corr int")
    assets = spark.createDataFrame([("1", None), ("2", None), ("1", "A")], "asset_ip string, asset string")
    found = J.same_asset(pairs, assets).collect()
    assert [(r.f_ip, r.b_ip, r.f_asset) for r in found] == [("1", "1", "A")]


def test_features_put_the_log_first(spark):
    pairs = spark.createDataFrame(
        [("log", "l", "packet", "p"), ("packet", "p", "log", "l"), ("log", "x", "packet", "p")],
        "f_type string, f_hash string, b_type string, b_hash string")
    logs = spark.createDataFrame([("l", [0, 1]), ("l", [0, 1])], "hash string, positions array<long>")
    packets = spark.createDataFrame([("p", [0])], "hash string, positions array<long>")
    found = J.attach_features(pairs, logs, packets, 3).collect()
    assert sorted(r.features for r in found) == [[0, 1, 3], [0, 1, 3], [3]]
    same = spark.createDataFrame([("l", "l")], "f_hash string, b_hash string")
    assert J.attach_same_kind_features(same, logs, 3).first().features == [0, 1, 3, 4]


def test_lookup_join_is_left_to_spark(spark):
    left = spark.range(50).selectExpr("id % 3 as k", "id")
    right = stage(spark.createDataFrame([(0, "a"), (1, "b"), (None, "n")], "k long, v string"), "lookup")
    joined = lookup_join(left, right, ["k"])
    assert joined.count() == 34
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
    safe = lookup_join(left.unionByName(left.limit(1).selectExpr("cast(null as long) as k", "id")), right, ["k"],
                       null_safe=True)
    assert safe.filter("v = 'n'").count() == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_conditions_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("a", 5.0, "x"), ("b", 500.0, "y"), ("c", None, None)],
                          "hash string, value double, source string").write.parquet(path)
    rules = [Rule(1, 2, None, "A", "value > 400"), Rule(2, 2, "x", "A", None)]
    hits = match_rules(spark.read.parquet(path), rules, "hash")
    pushed = next(line for line in _plan(hits).splitlines() if "PushedFilters" in line)
    assert "Or(" in pushed and "GreaterThan(value,400.0)" in pushed
    assert sorted((r.hash, r.single_rule) for r in hits.collect()) == [("a", 2), ("b", 1)]
    every = match_rules(spark.read.parquet(path), [*rules, Rule(3, 2, None, "A", None)], "hash")
    assert every.filter("single_rule = 3").count() == 3


def test_value_rates_ignore_null_and_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    found = [(r.rank, r.value, r.n, r.rate) for r in E.value_rates(df, ["v"], top=2).orderBy("rank").collect()]
    assert found == [(1, "c", 2, 0.5), (2, "a", 1, 0.25)]
    assert {(r.value, r.n) for r in E.value_rates(df, ["v"]).collect()} == {("a", 1), ("b", 1), ("c", 2)}


def test_value_rates_keep_every_value(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as v")
    assert E.value_rates(df, ["v"]).count() == 1000


def test_wide_cells(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (2, "b", 3.0)], "t int, tag string, v double")
    wide = E.to_wide(df, "t", "tag", "v", ["a", "b"])
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 0.0, 2.0), (2, None, 3.0)]
    assert E.complete_rows(wide).count() == 1
    assert E.to_long(wide, ["t"]).count() == 3


def test_append_new_is_idempotent_and_keeps_rows_of_one_key(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "k int, v string")
    sinks.append_new(first, path, ["k"])
    assert spark.read.parquet(path).count() == 3
    sinks.append_new(first, path, ["k"])
    sinks.append_new(spark.createDataFrame([(2, "d"), (3, "e")], "k int, v string"), path, ["k"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "b", "c", "e"]


def test_catalogue_snapshot_and_history(spark, tmp_path):
    (tmp_path / "tags.csv").write_text("tag_name,type\nT1_a,Turbine1\nB,Boiler1\n")
    catalogue = scan.read_catalogue(spark, str(tmp_path / "tags.csv"))
    assert E.tags_of_type(catalogue, "Turbine1") == ["T1_a"]
    sinks.save_snapshot(catalogue, str(tmp_path / "snap"), "v1")
    assert sinks.load_snapshot(spark, str(tmp_path / "snap"), "v1").count() == 2
    now = datetime(2024, 1, 1)
    history = sinks.fit_history(spark, 1, "corr", now, now, [0.5, 0.25], (10, 3)).collect()
    assert [(r.epoch, r.loss, r.data_shape) for r in history] == [(1, 0.5, "(10, 3)"), (2, 0.25, "(10, 3)")]


def test_text_range_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("20240101000000",), ("2024010100000099",), ("20240101000001",), ("20231231235959",)]
    spark.createDataFrame(rows, "t string").write.parquet(path)
    found = scan.scan_range_text(spark.read.parquet(path), "t", "2024-01-01 00:00:00", "2024-01-01 00:00:00")
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,20240101000000)" in plan


def test_ranges_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 1, 1, 13),)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
        assert scan.scan_range(df, "t", "2024-01-01 12:00:00", "2024-01-01 12:30:00").count() == 1
        assert df.select(times.at(datetime(2024, 1, 1, 12))).first()[0] == datetime(2024, 1, 1, 12)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
