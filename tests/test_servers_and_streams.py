"""Servers as a data source, pairs on streams, routing by large tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pairwarden.operators.routing import prefix_ranges, route_by_table
from pairwarden.operators.sequence import skip_pairs
from pairwarden.sources.scan import scan_range
from pairwarden.sources.servers import read_servers, stream_servers
from pairwarden.streaming.pairs import stream_skip_pairs
from pairwarden.streaming.streams import run_available

START = datetime(2024, 1, 1)


def _sorted(df):
    return sorted(map(repr, df.collect()))


# ---- servers -------------------------------------------------------------------------


def _server(spark, path, low, high):
    rows = spark.range(low, high).selectExpr(
        "id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int)) as at", "id % 5 as v")
    rows.coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


@pytest.fixture
def pushed(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_range_is_read_at_the_source(pushed, tmp_path):
    spark = pushed
    servers = {"a": _server(spark, tmp_path / "a", 0, 100), "b": _server(spark, tmp_path / "b", 50, 150)}
    schema = spark.read.parquet(servers["a"]).schema
    whole = spark.read.parquet(servers["a"]).withColumn("clickhouse_server", F.lit("a")).union(
        spark.read.parquet(servers["b"]).withColumn("clickhouse_server", F.lit("b")))
    low, high = START + timedelta(minutes=60), START + timedelta(minutes=90)
    got = scan_range(read_servers(spark, servers, schema), "at", low, high)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ">=" not in plan and "<=" not in plan  # both ends of the range are the source's
    assert _sorted(got) == _sorted(scan_range(whole, "at", low, high))
    assert got.rdd.getNumPartitions() == 2
    for test in ("v = 3", "v > 3 and id < 70", "v in (1, 2)", "clickhouse_server = 'b' and v <= 1", "v is null",
                 "clickhouse_server = 'c'", "id + 1 = 60", "v <> 2 or id = 3"):
        assert _sorted(read_servers(spark, servers, schema).filter(test)) == _sorted(whole.filter(test)), test
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert _sorted(scan_range(read_servers(spark, servers, schema), "at", low, high)) == _sorted(got)


def _store(stream, out, progress):
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(
        availableNow=True).start()
    assert query.awaitTermination(120)
    if query.exception():
        raise query.exception()


def test_stream_of_servers_equals_the_batch_and_goes_on(spark, tmp_path):
    servers = {"a": _server(spark, tmp_path / "a", 0, 40), "b": _server(spark, tmp_path / "b", 10, 20)}
    schema = spark.read.parquet(servers["a"]).schema
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    counts = []
    for step in range(3):  # the second run finds nothing new, the third what one server has added
        if step == 2:
            _server(spark, tmp_path / "b", 20, 35)
        _store(stream_servers(spark, servers, schema, "at"), out, progress)
        counts.append(spark.read.parquet(out).count())
    assert counts == [50, 50, 65]
    assert _sorted(spark.read.parquet(out)) == _sorted(read_servers(spark, servers, schema))


# ---- pairs on streams ----------------------------------------------------------------

EVENTS = "unit string, at timestamp_ntz, hash string, v long"


def _files(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(path))


def _stream(spark, path):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(path))


def _rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), START + timedelta(seconds=rng.randint(0, 3000)), f"h{i:04}", i)
            for i in range(n)]


def test_stream_pairs_equal_the_batch_over_final_rows(spark, tmp_path):
    rows = sorted(_rows(300), key=lambda r: r[1])
    batches = [rows[:100], rows[100:110], rows[110:250], rows[250:]]
    batches[1], batches[2] = batches[2][:90], batches[1] + batches[2][90:]  # some arrive late, but in time
    batches = [*batches, [("a", None, "none", -1)]]
    _files(spark, tmp_path / "in", batches)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        pairs = stream_skip_pairs(_stream(spark, tmp_path / "in"), "at", ["hash"], ["hash", "v"], ["unit"], 3, "50 minutes")
        _store(pairs, out, progress)
        return spark.read.parquet(out)

    def wanted(rows, last):
        final = [r for r in rows if r[1] < last]
        return skip_pairs(spark.createDataFrame(final, EVENTS), ["at", "hash"], ["hash", "v"], 3, by=["unit"])

    newest = max(r[1] for r in rows)
    assert _sorted(run()) == _sorted(wanted(rows, newest - timedelta(minutes=50)))
    assert _sorted(run()) == _sorted(wanted(rows, newest - timedelta(minutes=50)))  # a restart adds nothing
    more = [("a", newest + timedelta(hours=2), "later", 1000), ("b", newest + timedelta(hours=2), "later", 1001)]
    _files(spark, tmp_path / "in", [more])
    assert _sorted(run()) == _sorted(wanted(rows, newest + timedelta(hours=1)))
    too_late = [("a", START + timedelta(seconds=5), "late", 2000)]
    _files(spark, tmp_path / "in", [too_late])
    assert _sorted(run()) == _sorted(wanted(rows, newest + timedelta(hours=1)))


def test_ties_and_an_empty_stream(spark, tmp_path):
    same = [("a", START, f"h{i}", i) for i in range(5)] + [("a", START + timedelta(days=1), "end", 9)]
    _files(spark, tmp_path / "in", [same[3:5], same[:3], same[5:]])
    pairs = stream_skip_pairs(_stream(spark, tmp_path / "in"), "at", ["hash"], ["hash"], ["unit"], 1, "1 minute")
    got = {(r.f_hash, r.b_hash) for r in run_available(pairs, "ties", 120).collect()}
    assert got == {(f"h{i}", f"h{i + 1}") for i in range(4)}
    _files(spark, tmp_path / "none", [[]])
    none = stream_skip_pairs(_stream(spark, tmp_path / "none"), "at", ["hash"], ["hash"], ["unit"], 1)
    assert run_available(none, "none", 120).count() == 0


# ---- routing -------------------------------------------------------------------------


def test_longest_prefix_of_nested_ones():
    rng = random.Random(2)
    alphabet = ["a", "b", "é", "翿", "\U0010ffff"]
    prefixes = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4))) for _ in range(60)})
    starts, owners = prefix_ranges([(p.encode(), i) for i, p in enumerate(prefixes)])
    assert starts == sorted(set(starts))
    from bisect import bisect_right

    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6)))
        want = max((p for p in prefixes if text.startswith(p)), key=len, default=None)
        found = owners[bisect_right(starts, text.encode()) - 1]
        assert (prefixes[found] if found >= 0 else None) == want


def test_routes_of_a_hundred_thousand_prefixes(spark):
    routes = spark.range(100_000).selectExpr(
        "concat('T', lpad(cast(id as string), 5, '0')) as prefix", "id as route").union(
        spark.createDataFrame([("T", -1), ("T0001", -2), ("T00012345", -3), (None, -4)], "prefix string, route long"))
    values = spark.createDataFrame(
        [("T00012xyz",), ("T00012345x",), ("T0001",), ("T",), ("Tx",), ("U1",), (None,), ("",), ("T99999",)] * 50, "tag string")
    got = {(r.tag, r.route) for r in route_by_table(values, "tag", routes).collect()}
    assert got == {("T00012xyz", 12), ("T00012345x", -3), ("T0001", -2), ("T", -1), ("Tx", -1), ("T99999", 99999)}
    assert route_by_table(values, "tag", routes).count() == 300
    everything = spark.createDataFrame([("", 7)], "prefix string, route long")
    assert route_by_table(values, "tag", everything).count() == 400
    assert route_by_table(values, "tag", everything.limit(0)).count() == 0
    with pytest.raises(ValueError, match="twice"):
        route_by_table(values, "tag", everything.union(everything))
