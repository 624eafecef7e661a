"""Queries for the rule index, seeded draws, medians per group, fitted models, routing and servers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pairwarden.catalog import standins as t
from pairwarden.catalog.registry import query
from pairwarden.operators import features as P
from pairwarden.operators import reconstruct as M
from pairwarden.operators import scoring as S
from pairwarden.operators.autoencoder import Training, fit_network, network_rmse
from pairwarden.operators.lag_model import fit_lag_model, score_lag_model
from pairwarden.operators.reshape import to_wide
from pairwarden.operators.routing import route_by_table
from pairwarden.operators.rule_index import match_rules_indexed
from pairwarden.operators.rules import Rule
from pairwarden.session import fresh_path
from pairwarden.sources.keyed_store import KeyedStore
from pairwarden.sources.scan import scan_range
from pairwarden.sources.servers import read_servers
from pairwarden.streaming.pairs import stream_skip_pairs
from pairwarden.streaming.streams import read_stream, run_available, stream_append_new

# ---- rules by the thousand -----------------------------------------------------------

MANY_RULES = 5000
_TYPES = ("click", "view", "error", "purchase", "signup")


def many_rules() -> list[Rule]:
    """Rules that differ in type, range of users and least value."""
    return [
        Rule(i, 1, None, "A", f"event_type = '{_TYPES[i % 5]}' and user_id between {7 * i % 1500} and "
             f"{7 * i % 1500 + 20} and value >= {i % 60}")
        for i in range(MANY_RULES)
    ]


@query("match_rules_many", f"""with rules as (select range as i, 7 * range % 1500 as first,
    case range % 5 {' '.join(f"when {i} then '{name}'" for i, name in enumerate(_TYPES))} end as wanted
  from range({MANY_RULES}))
select event_id, i as single_rule from events join rules
  on event_type = wanted and user_id between first and first + 20 and value >= i % 60""")
def match_rules_many(spark, folder):
    events = t.table(spark, folder, "events")
    return match_rules_indexed(events, many_rules(), "ts").select("event_id", "single_rule")


@query("match_rules_index", t.with_ctes("ev", f"""select event_id, single_rule from ({' union all '.join(
    f"select event_id, {r.rule_id}::bigint as single_rule from ev where {r.condition()}" for r in t.RULES)})"""))
def match_rules_index(spark, folder):
    """The rules of ``match_rules`` through the index."""
    return match_rules_indexed(t.sourced_events(spark, folder), t.RULES, "ts").select("event_id", "single_rule")


# ---- draws and medians ---------------------------------------------------------------

_SEED = 20240201


@query("balance_drawn", f"""with r as (select event_id, event_type, user_id % 7 = 0 as seventh,
    row_number() over (partition by event_type, user_id % 7 = 0 order by ts, event_id) - 1 as place from events),
  c as (select event_type, seventh, count(*) as n from r group by all),
  top as (select max(n) as t from c),
  draws as (select event_type, seventh, unnest(range(1, t + 1)) as k, n from c, top where n < t),
  places as (select event_type, seventh, ('0x' || substr(md5('{_SEED}|' || event_type || ',' ||
    seventh::varchar || '|' || k::varchar), 1, 15))::bigint % n as place from draws),
  drawn as (select event_type, seventh, place, count(*) as d from places group by all)
select event_id, event_type, seventh, case when n = t then 1 else coalesce(d, 0) end as copies
from r join c using (event_type, seventh) left join drawn using (event_type, seventh, place), top""")
def balance_drawn(spark, folder):
    events = t.table(spark, folder, "events").selectExpr(
        "event_id", "ts", "event_type", "user_id % 7 = 0 as seventh")
    return P.balance(events, ["event_type", "seventh"], ["ts", "event_id"], seed=_SEED).drop("ts")


def _group_medians(rel: str, by: str, col: str) -> str:
    return f"""with m as (select {by}, median({col}) as median from {rel} group by {by}),
  d as (select {by}, abs({col} - median) as off, {col} as v, median from {rel} join m using ({by})),
  p as (select {by}, any_value(median) as median, median(off) as mad from d group by {by})
select {by}, round(p.median, 6) as median, round(mad, 6) as mad,
  round(case when mad = 0 then p.median else
    arg_min(v, struct_pack(a := round(abs(0.976 * off / mad - 2.5), 9), b := v)) end, 6) as threshold
from d join p using ({by}) group by {by}, p.median, mad"""


def _grouped(df, by, col):
    out = S.grouped_mad_threshold(df, [by], col)
    return out.select(by, *[F.round(c, 6).alias(c) for c in ("median", "mad", "threshold")])


@query("grouped_mad", _group_medians("lineitem", "l_orderkey", "l_extendedprice"))
def grouped_mad(spark, folder):
    """Many small groups."""
    return _grouped(t.table(spark, folder, "lineitem"), "l_orderkey", "l_extendedprice")


@query("grouped_mad_few", _group_medians("lineitem", "l_returnflag", "l_quantity"))
def grouped_mad_few(spark, folder):
    """Few large groups with many ties."""
    return _grouped(t.table(spark, folder, "lineitem"), "l_returnflag", "l_quantity")


# ---- fitted models -------------------------------------------------------------------

_HOURLY = """hours as (select date_trunc('hour', ts) as date_time, cast(sum(cast(value as decimal(18,2))) as double) as v
    from events group by 1),
  c as (select date_time, v - (select avg(v) from hours) as x from hours),
  l as (select date_time, x, coalesce(lag(x) over (order by date_time), 0) as x1,
    coalesce(lag(x, 2) over (order by date_time), 0) as x2 from c)"""


def _hours(spark, folder):
    return t.table(spark, folder, "events").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time")
    ).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"))


@query("lag_model", f"""with {_HOURLY},
  g as (select sum(x * x1) / sum(x * x) as r1, sum(x * x2) / sum(x * x) as r2, avg(x * x) as g0 from l),
  w as (select *, r1 * (1 - r2) / (1 - r1 * r1) as a1, (r2 - r1 * r1) / (1 - r1 * r1) as a2 from g)
select 0 as lag, null::double as weight, round(g0, 4) as loss from w
union all select 1, round(a1, 6), round(g0 * (1 - r1 * r1), 4) from w
union all select 2, round(a2, 6), round(g0 * (1 - a1 * r1 - a2 * r2), 4) from w""")
def lag_model(spark, folder):
    """Weights of a model of the hourly sum by the two hours before, and the loss by lags."""
    model = fit_lag_model(_hours(spark, folder), ["date_time"], ["v"], 2)
    rows = [(j, None if j == 0 else float(model.weights[j - 1, 0, 0]), loss) for j, loss in enumerate(model.losses)]
    found = spark.createDataFrame(rows, "lag int, weight double, loss double")
    return found.select("lag", F.round("weight", 6).alias("weight"), F.round("loss", 4).alias("loss"))


@query("lag_scores", f"""with {_HOURLY}, w as (select sum(x * x1) / sum(x * x) as a from l)
select date_time, round((select avg(v) from hours) + a * x1, 4) as predicted, round(pow(x - a * x1, 2), 4) as ai_rmse
from l, w""")
def lag_scores(spark, folder):
    hours = _hours(spark, folder)
    scored = score_lag_model(fit_lag_model(hours, ["date_time"], ["v"], 1), hours, ["date_time"])
    return scored.select("date_time", F.round(F.col("predicted")[0], 4).alias("predicted"),
                         F.round("ai_rmse", 4).alias("ai_rmse"))


def hourly_matrix(spark, folder):
    """Sums by hour and event type, 0 without events, scaled to 0..1."""
    cells = t.table(spark, folder, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time"), "event_type", "value")
    wide = to_wide(cells, "date_time", "event_type", "value", _TYPES).na.fill(0.0)
    return S.minmax_apply(wide, S.minmax_fit(wide, _TYPES))


@query("lag_scores_all")
def lag_scores_all(spark, folder):
    """Each hour of all event types predicted from the four hours before; checked against numpy in the tests."""
    matrix = hourly_matrix(spark, folder)
    model = fit_lag_model(matrix, ["date_time"], _TYPES, 4)
    return score_lag_model(model, matrix, ["date_time"]).select("date_time", "predicted", "ai_rmse")


@query("dense_direction", """with m as (select var_pop(l_quantity) as a, var_pop(l_tax * 1000) as c,
    covar_pop(l_quantity, l_tax * 1000) as b from lineitem),
  e as (select *, (a + c + sqrt((a - c) * (a - c) + 4 * b * b)) / 2 as top from m)
select round(top / (a + c), 9) as share, round(abs(b) / sqrt(b * b + (top - a) * (top - a)), 6) as quantity from e""")
def dense_direction(spark, folder):
    """Share of the variance along the first principal direction of two columns, and a weight of it."""
    rows = t.table(spark, folder, "lineitem").selectExpr(
        "array(cast(l_quantity as double), cast(l_tax * 1000 as double)) as x")
    model = M.fit_arrays(rows, "x", 1)
    total, variances = M.variances_along(rows, "x", model)
    found = [(variances[0] / total, abs(model.components[0][0]))]
    return spark.createDataFrame(found, "share double, quantity double").select(
        F.round("share", 9).alias("share"), F.round("quantity", 6).alias("quantity"))


@query("network_history")
def network_history(spark, folder):
    """Loss of each epoch of an autoencoder over the hourly matrix; gradients are checked in the tests."""
    rows = hourly_matrix(spark, folder).select(F.array(*_TYPES).alias("features"))
    _, losses, n = fit_network(rows, hidden=[(16, "relu"), (3, "tanh")], last="sigmoid", how=Training(epochs=30))
    return spark.createDataFrame([(i, loss, n) for i, loss in enumerate(losses, 1)], "epoch int, loss double, n int")


@query("network_scores")
def network_scores(spark, folder):
    """Reconstruction error of each hour by the autoencoder."""
    matrix = hourly_matrix(spark, folder)
    rows = matrix.select("date_time", F.array(*_TYPES).alias("features"))
    network, _, _ = fit_network(rows, hidden=[(3, "tanh")], last="identity", how=Training(epochs=20))
    return rows.select("date_time", network_rmse(network, F.col("features"), False).alias("ai_rmse"))



# ---- routing, servers, pairs on streams ----------------------------------------------


@query("prefix_route_table", """with routes as (select distinct substr(c_name, 1, 9 + c_custkey % 10) as prefix from customer
    union select 'Cust' union select 'Customer#0000000'),
  hits as (select c_custkey, prefix, row_number() over (partition by c_custkey order by length(prefix) desc) as place
    from customer join routes on starts_with(c_name, prefix))
select c_custkey, md5(prefix) as unit_type, length(prefix) as size from hits where place = 1""")
def prefix_route_table(spark, folder):
    """Customers routed by a table of nested prefixes taken from their names."""
    customers = t.table(spark, folder, "customer")
    prefixes = customers.select(F.expr("substring(c_name, 1, cast(9 + c_custkey % 10 as int))").alias("prefix"))
    more = spark.createDataFrame([("Cust",), ("Customer#0000000",)], "prefix string")
    routes = prefixes.union(more).distinct().select(
        "prefix", F.md5("prefix").alias("unit_type"), F.length("prefix").cast("long").alias("size"))
    return route_by_table(customers.select("c_custkey", "c_name"), "c_name", routes).drop("c_name")


_SERVERS = {"first": "events", "second": "events"}
_LOW, _HIGH = datetime(2024, 1, 5), datetime(2024, 1, 20)


@query("federated_servers", f"""select event_id, ts, value, s as clickhouse_server from events, (values ('first'), ('second')) v(s)
where ts between '{_LOW}' and '{_HIGH}' and not (s = 'first' and value > 100)""")
def federated_servers(spark, folder):
    """A time range over two servers, filtered at the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = t.table(spark, folder, "events").select("event_id", "ts", "value").schema
    servers = {name: f"{folder}/{table}.parquet" for name, table in _SERVERS.items()}
    rows = scan_range(read_servers(spark, servers, schema), "ts", _LOW, _HIGH)
    return rows.filter(~((F.col("clickhouse_server") == "first") & (F.col("value") > 100)))


@query("stream_skip_pairs", """with last as (select date_trunc('milliseconds', max(ts)) - interval 10 minute as w from events),
  o as (select event_id, user_id % 2 as unit, user_id % 4 < 2 as maker, row_number() over (
    partition by user_id % 2, user_id % 4 < 2 order by ts, event_id) as i from events, last where ts < w)
select f.event_id as f_event_id, b.event_id as b_event_id, b.i - f.i as step
from o f join o b on f.unit = b.unit and f.maker = b.maker and b.i - f.i between 1 and 3""")
def stream_skip_pairs_query(spark, folder):
    """Pairs within unit and maker on a stream, over the rows before its last watermark."""
    schema = t.table(spark, folder, "events").schema
    events = read_stream(spark, f"{folder}/events.parquet", schema).selectExpr(
        "event_id", "ts", "user_id % 2 as unit", "user_id % 4 < 2 as maker")
    pairs = stream_skip_pairs(events, "ts", ["event_id"], ["event_id"], ["unit", "maker"], 3)
    return run_available(pairs, "stream-pairs")


@query("keyed_append", """select event_id, user_id, value from events""")
def keyed_append(spark, folder):
    """Two thirds of the events stored by key, then all of them, twice: the store holds each once."""
    events = t.table(spark, folder, "events").select("event_id", "user_id", "value")
    store = KeyedStore(spark, fresh_path(spark, "keyed"), ("event_id", "user_id"), 8)
    store.append_new(events.filter("event_id % 3 < 2"))
    for _ in range(2):
        store.append_new(events)
    return store.read()


@query("stream_keyed_append", """select event_id, user_id from events""")
def stream_keyed_append(spark, folder):
    """The same stream stored twice by key, as after a lost checkpoint."""
    path, schema = fresh_path(spark, "stream-keyed"), t.table(spark, folder, "events").schema
    for _ in range(2):
        events = read_stream(spark, f"{folder}/events.parquet", schema).select("event_id", "user_id")
        stream_append_new(events, path, fresh_path(spark, "keyed-progress"), ["event_id"], buckets=8)
    return KeyedStore(spark, path, ("event_id",)).read()
