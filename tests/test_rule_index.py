"""The rule index against the one-expression match, on odd values and random rules."""

import random
import time
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest

from pairwarden.catalog import standins as t
from pairwarden.operators import rule_index
from pairwarden.operators.rule_index import RuleIndex, build_index, match_rules_indexed
from pairwarden.operators.rules import Rule, match_rules

SCHEMA = "hash string, event_type string, user_id long, value double, ts timestamp_ntz, small int, `odd name` string, source string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        rows.append((
            f"h{i}", rng.choice(["click", "view", "é", "", "clic", "clicks", None]), rng.choice([None, *range(-5, 40)]),
            rng.choice([None, NAN, INF, -INF, -0.0, 0.0, 0.1, 1.0, 1.5, 2.0, rng.uniform(-5, 30)]),
            rng.choice([None, datetime(2024, 1, rng.randint(1, 28), rng.randint(0, 23))]),
            rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), rng.choice(["L1", "L'2", None]),
        ))
    rows += rows[:20]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


CONDITIONS = [
    None, "true", "false", "cast(null as boolean)", "event_type = 'click'", "'click' = event_type and value > 1", "value >= 1.5",
    "2 > value", "value <= 0", "value = 0", "value = 0.1", "value <> 1", "user_id = 3.0", "user_id = 3.5",
    "user_id > 2.5 and user_id < 3.5", "user_id >= 2.5", "user_id < 2.5", "user_id between 3 and 5",
    "user_id not between 3 and 5", "not (value > 1)", "event_type in ('view', 'é', 'view')", "user_id in (1, 2, null)",
    "event_type not in ('view')", "event_type like 'cl%'", "event_type like 'cl%' and user_id > 10 and value < 3",
    "event_type > 'click'", "event_type >= 'click' and event_type < 'd'", "event_type <= ''", "length(event_type) = 5",
    "value is null", "value is not null and user_id = 7", "ts >= timestamp_ntz'2024-01-10 00:00:00'",
    "ts < timestamp_ntz'2024-01-03 12:00:00' or value > 20", "ts > '2024-01-20'", "small = 2 and `odd name` = 'a'",
    "small > 1.5", "small = 99999999999999999999", "user_id = 1 and user_id = 2", "user_id > 3 and user_id > 5",
    "(event_type = 'click' or event_type = 'view') and (user_id < 5 or value > 2) and small in (1, 3)",
    "user_id + 1 = 4", "user_id = small", "value > 1e0", "value < double('nan')", "value = user_id and user_id > 0",
    " or ".join(f"(user_id = {i} and small = {i % 3})" for i in range(70)), "true and user_id = 4", "EVENT_TYPE = 'é'",
]


def _same(got, want):
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_every_kind_of_condition(events):
    rules = [Rule(i, 1, None, "A", c) for i, c in enumerate(CONDITIONS)]
    _same(match_rules_indexed(events, rules, "ts"), match_rules(events, rules, "ts"))


@pytest.mark.parametrize("n", range(0, len(CONDITIONS), 3))
def test_few_rules_with_a_pushed_filter(events, n):
    """Without a condition-free rule among them, a hull of all conditions limits the scan."""
    rules = [Rule(i, 1, None, "A", c) for i, c in enumerate(CONDITIONS)][n : n + 2]
    _same(match_rules_indexed(events, rules, "ts"), match_rules(events, rules, "ts"))


def test_sources_and_no_rules(events):
    rules = [Rule(1, 1, "L1", "A", "value > 1 or value < 0"), Rule(2, 1, "L1", "A", None), Rule(3, 1, "L'2", "A", "user_id > 3"), Rule(4, 1, "L'2", "A", None)]
    _same(match_rules_indexed(events, rules, "ts"), match_rules(events, rules, "ts"))
    assert match_rules_indexed(events, [], "ts").count() == 0
    assert match_rules_indexed(events.limit(0), rules, "ts").count() == 0


def random_condition(rng, depth=0):
    kind = rng.random()
    if depth < 2 and kind < 0.55:
        parts = [random_condition(rng, depth + 1) for _ in range(rng.randint(2, 3))]
        return "(" + rng.choice([" and ", " and ", " or "]).join(parts) + ")"
    column, value = rng.choice([
        ("event_type", repr(rng.choice(["click", "view", "clic", "x"]))), ("user_id", rng.randint(-5, 40)),
        ("value", rng.choice([0, 0.1, 1.5, 20, rng.randint(-5, 30)])), ("small", rng.randint(0, 4)),
        ("user_id", rng.randint(0, 80) / 2),
    ])
    if kind > 0.93:
        return f"{column} is not null"
    return f"{column} {rng.choice(['=', '=', '<', '<=', '>', '>=', '<>'])} {value}"


@pytest.mark.parametrize("seed", range(3))
def test_random_rules(events, seed, monkeypatch):
    monkeypatch.setattr(rule_index, "_AT_ONCE", 500)  # rows are matched in several slices
    rng = random.Random(seed)
    rules = [Rule(i, 1, None, "A", random_condition(rng)) for i in range(60)]
    _same(match_rules_indexed(events, rules, "ts"), match_rules(events, rules, "ts"))


def test_the_eleven_rules(spark):
    folder = "/root/testdata/sf0.001"
    events = t.sourced_events(spark, folder)
    _same(match_rules_indexed(events, t.RULES, "ts"), match_rules(events, t.RULES, "ts"))


def test_matches_on_a_stream(spark, tmp_path):
    from pairwarden.streaming.streams import read_stream, run_available, stream_match_rules_indexed

    folder = "/root/testdata/sf0.001"
    whole = t.table(spark, folder, "events")
    rules = [Rule(1, 1, None, "A", "event_type = 'click' and value > 50"), Rule(2, 1, None, "A", "user_id between 3 and 9")]
    stream = read_stream(spark, f"{folder}/events.parquet", whole.schema)
    got = run_available(stream_match_rules_indexed(stream, rules), "indexed-hits", 120)
    _same(got, match_rules(whole, rules, "ts"))


def _many(n):
    return [Rule(i, 1, None, "A", f"event_type = 'e{i % 7}' and user_id between {10 * i} and {10 * i + 15} and value > {i % 90}")
            for i in range(n)]


def test_work_follows_matches_not_rules(spark):
    """Ten times the rules over the same rows, with about as many matches: far less than ten times the time."""
    rng = np.random.default_rng(1)
    n = 100_000
    schema = spark.createDataFrame([], "event_type string, user_id long, value double").schema
    taken = {}
    for rules in (500, 5000):
        index, partly = build_index(spark, _many(rules), schema)
        assert not partly and index.columns == ["event_type", "user_id", "value"]
        columns = [
            pa.array([f"e{i}" for i in rng.integers(0, 7, n)]), pa.array(rng.integers(0, 10 * rules, n)),
            pa.array(rng.uniform(0, 100, n)),
        ]
        begin = time.process_time()
        row, rule = index.match(columns, n)
        taken[rules] = time.process_time() - begin
        at = rng.integers(0, len(row), 200)
        types, users, values = (c.to_pylist() for c in columns)
        for i, r in zip(row[at].tolist(), rule[at].tolist()):
            assert types[i] == f"e{r % 7}" and 10 * r <= users[i] <= 10 * r + 15 and values[i] > r % 90
    assert taken[5000] < 4 * taken[500]


def test_index_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(rule_index, "MAX_INDEX_NUMBERS", 10)
    schema = spark.createDataFrame([], "event_type string, user_id long, value double").schema
    with pytest.raises(ValueError, match="match the rules in parts"):
        build_index(spark, _many(50), schema)
    assert isinstance(RuleIndex([], [], schema), RuleIndex)
