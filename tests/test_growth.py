"""Steps that must not grow faster than their rows: what is met, held and repeated."""

import pyarrow as pa
from pyspark.sql import functions as F

from pairwarden.catalog import standins as t
from pairwarden.operators.rules import same_kind_pairs
from pairwarden.operators.similarity import similar_pairs
from pairwarden.plans import correlation
from pairwarden.streaming import pairs as stream_pairs


def test_same_kind_pairs_are_met_once(spark):
    rows = [(1, 10, 2, "A"), (1, 10, 2, "A"), (1, 11, 2, "A"), (1, None, 2, "A"), (None, 10, 2, "A"), (2, 10, 2, "D")]
    found = same_kind_pairs(spark.createDataFrame(rows, "multi_id long, rule_id long, kind int, state string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
    want = [(1, a, b) for a in (10, 11, None) for b in (10, 11, None)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_copies_of_one_place_are_not_paired_up(spark):
    rows = [(i, "g", "the same words", "one") for i in range(40)]
    rows += [(100 + i, "g", "some other words", ("one", "two", None)[i % 3]) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, g string, t string, place string")
    found = similar_pairs(df, ["g"], "id", ["id", "place"], "t", 0.99, apart=F.col("place"))
    assert found.count() == 15
    assert found.filter("f_place <> b_place").count() == 4


def test_stream_pairs_leave_in_pieces():
    rows = pa.table({"_at": range(150_000), "v": range(150_000)})
    parts = list(stream_pairs._pair_up(rows, 149_998, 2, ["v"], 2))
    assert len(parts) > 2 and max(len(p) for p in parts) <= stream_pairs.PAIR_ROWS
    assert sum(len(p) for p in parts) == 2 * 149_998
    assert all((p.b_v - p.f_v == p.step).all() for p in parts)


def test_events_of_a_run_are_enriched_once(spark, tmp_path):
    kinds = "array('view', 'error', 'signup', 'click', 'purchase')"
    spark.range(50).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id)) as ts", "id % 9 as user_id",
        f"{kinds}[int(id % 5)] as event_type", "double(id * 3) as value", "'text' as props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(9).selectExpr("id as s_suppkey", "id as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(9).selectExpr("id as c_custkey", "id as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    tables = t.tables(spark, str(tmp_path))
    for df in correlation._run_events(tables, t.SETTINGS, t.START, t.END):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "Join" not in plan and "props" not in df.columns
        assert df.count()
