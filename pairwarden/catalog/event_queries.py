"""Queries for joins, reshaping and sequence operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairwarden.catalog import standins as t
from pairwarden.catalog.registry import query
from pairwarden.catalog.standins import with_ctes
from pairwarden.functions import columns as C
from pairwarden.functions.times import bucket
from pairwarden.operators import joins as J
from pairwarden.operators import reshape as E
from pairwarden.operators import rules as R
from pairwarden.operators import sequence as S
from pairwarden.plans.events import enrich_logs, log_hits, packet_events, pair_rows, unit_of, without_source

# ---- shared frames -----------------------------------------------------------------


def raw_log_hits(spark, folder):
    rules = R.load_rules(R.select_rules(t.rules(spark), R.LOG))
    return log_hits(t.logs(spark, folder), rules, t.START, t.END)


def all_logs(spark, folder):
    return enrich_logs(raw_log_hits(spark, folder), t.devices(spark, folder))


def kept_logs(spark, folder):
    hits = raw_log_hits(spark, folder)
    return without_source(enrich_logs(hits, t.devices(spark, folder)), "L009")


def kept_packets(spark, folder):
    rules = R.load_rules(R.select_rules(t.rules(spark), R.PACKET))
    return packet_events(t.packets(spark, folder), rules, t.START, t.END)


def event_rows(spark, folder):
    """Logs and packets as the rows that pairs are made of."""
    logs = kept_logs(spark, folder).withColumn("unit", unit_of())
    packets = kept_packets(spark, folder).withColumn("unit", F.expr("right(unit_id, 1)"))
    return pair_rows([logs, packets], ["unit", "manufacturer_name", "src_ip", "dst_ip"])


ORDER = ["time", "hash", "single_rule"]
ROWS_SQL = """select type, single_rule, hash, time, time_text, ip, id, milli_time, substr(unit_id, -1) as unit,
    manufacturer_name, cast(null as varchar) as src_ip, cast(null as varchar) as dst_ip from log_e
  union all select type, single_rule, hash, time, time_text, ip, id, milli_time, substr(unit_id, -1),
    manufacturer_name, src_ip, dst_ip from packet_e"""


def numbered_pairs_sql(n: int, order: str = "time", by: str = "") -> str:
    """Pairs of the common table ``rows`` as tables f and b, 1 to n rows apart."""
    part = f"partition by {by}" if by else ""
    same = "".join(f" and f.{c} = b.{c}" for c in by.split(", ") if c)
    return f"""from (select *, row_number() over ({part} order by {order}, hash, single_rule) as rn from rows) f
    cross join (select unnest(range(1, {n + 1})) as step) s
    join (select *, row_number() over ({part} order by {order}, hash, single_rule) as rn from rows) b
      on b.rn = f.rn + s.step{same}"""


# ---- joins -------------------------------------------------------------------------


@query("attach_address", with_ctes("all_logs", "select hash, single_rule, device_id, ip from all_logs"))
def attach_address(spark, folder):
    joined = J.attach_address(raw_log_hits(spark, folder), t.devices(spark, folder))
    return joined.select("hash", "single_rule", "device_id", "ip")


@query("exclude_seen", with_ctes("log_e", "select hash, single_rule, ip from log_e"))
def exclude_seen(spark, folder):
    seen = raw_log_hits(spark, folder).filter("source = 'L009'")
    return J.exclude_seen(all_logs(spark, folder), seen).select("hash", "single_rule", "ip")


@query("exclude_seen_time", with_ctes("readings", """select tag_name, date_time, tag_value from readings
where date_time not in (select date_time from readings where tag_name = 'click' and hash < '8')"""))
def exclude_seen_time(spark, folder):
    rows = t.readings(spark, folder)
    stored = rows.filter("tag_name = 'click' and hash < '8'")
    return J.exclude_seen(rows, stored, "date_time").select("tag_name", "date_time", "tag_value")


@query("label_pairs", with_ctes("log_e packet_e known", f"""
select f.type as f_type, f.single_rule as f_single_rule, f.hash as f_hash,
  b.type as b_type, b.single_rule as b_single_rule, b.hash as b_hash, k.corr
{numbered_pairs_sql(2)} left join known k on k.f_single_rule = f.single_rule and k.b_single_rule = b.single_rule
where f.type <> b.type""", rows=ROWS_SQL))
def label_pairs(spark, folder):
    pairs = S.skip_pairs(event_rows(spark, folder), ORDER, ["type", "single_rule", "hash"], 2).drop("step")
    known = R.symmetric_pairs(R.rule_mapping(t.mapping(spark))).distinct()
    return J.label_pairs(C.cross_kind(pairs), known).select(
        "f_type", "f_single_rule", "f_hash", "b_type", "b_single_rule", "b_hash", "corr")


@query("natural_join", """select * from orders natural join
  (select o_orderkey, o_custkey, sum(o_totalprice) over (partition by o_custkey) > 500000 as big from orders)""")
def natural_join(spark, folder):
    orders = t.table(spark, folder, "orders")
    totals = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    flagged = orders.select("o_orderkey", "o_custkey").join(totals, "o_custkey").selectExpr(
        "o_orderkey", "o_custkey", "s > 500000 as big")
    return J.natural_join(orders, flagged)


_PAIR_IPS = """select f.type as f_type, f.hash as f_hash, f.ip as f_ip, b.type as b_type, b.hash as b_hash,
  b.ip as b_ip, f.single_rule as f_single_rule, b.single_rule as b_single_rule """
_PACKET_IPS = "select distinct hash, src_ip, dst_ip from packet_e"
_ORIENTED = """select f_type, f_hash, dst_ip as f_ip, b_type, b_hash, b_ip, f_single_rule, b_single_rule, src_ip, dst_ip
    from pairs join packet_ips on f_hash = hash where b_ip is not null and dst_ip is not null and src_ip is not null
  union all select f_type, f_hash, f_ip, b_type, b_hash, src_ip as b_ip, f_single_rule, b_single_rule, src_ip, dst_ip
    from pairs join packet_ips on b_hash = hash where f_ip is not null and src_ip is not null and dst_ip is not null"""


def _oriented(spark, folder):
    cols = ["type", "hash", "ip", "single_rule"]
    pairs = C.cross_kind(S.adjacent_pairs(event_rows(spark, folder), ORDER, cols))
    return J.orient_packet_ip(pairs, kept_packets(spark, folder))


@query("orient_ip", with_ctes("log_e packet_e", _ORIENTED, rows=ROWS_SQL, packet_ips=_PACKET_IPS,
                              pairs=f"{_PAIR_IPS} {numbered_pairs_sql(1)} where f.type <> b.type"))
def orient_ip(spark, folder):
    return _oriented(spark, folder)


@query("same_asset", with_ctes("log_e packet_e known assets", """
select o.f_hash, o.b_hash, k.corr, fa.asset as f_asset, ba.asset as b_asset
from oriented o join known k using (f_single_rule, b_single_rule)
join assets fa on fa.asset_ip = f_ip join assets ba on ba.asset_ip = b_ip
where k.corr <> 0 and fa.asset = ba.asset""", rows=ROWS_SQL, packet_ips=_PACKET_IPS,
    pairs=f"{_PAIR_IPS} {numbered_pairs_sql(1)} where f.type <> b.type", oriented=_ORIENTED))
def same_asset(spark, folder):
    known = R.symmetric_pairs(R.rule_mapping(t.mapping(spark))).distinct()
    labelled = J.label_pairs(_oriented(spark, folder), known)
    return J.same_asset(labelled, t.assets(spark, folder)).select(
        "f_hash", "b_hash", "corr", "f_asset", "b_asset")


@query("attach_multi", with_ctes("log_hits mapping", """select hash, single_rule as f_single_rule,
  coalesce(multi_id, 0) as corr
from log_hits left join (select distinct multi_id, rule_id from mapping) on rule_id = single_rule"""))
def attach_multi(spark, folder):
    hits = raw_log_hits(spark, folder).select("hash", F.col("single_rule").alias("f_single_rule"))
    return J.attach_multi(hits, t.mapping(spark))


@query("events_in_buckets", """select event_id, time_bucket(interval 10 minute, ts) as bucket from events
where time_bucket(interval 10 minute, ts) in (
  select time_bucket(interval 10 minute, ts) from events group by 1 having sum(value > 100) >= 1)""")
def events_in_buckets(spark, folder):
    events = t.table(spark, folder, "events").withColumn("bucket", bucket("ts"))
    marked = events.groupBy("bucket").agg(F.max(F.col("value") > 100).alias("hit")).filter("hit")
    return J.events_in(events, marked, ["bucket"]).select("event_id", "bucket")


@query("restore_meta", with_ctes("clean", """select tag_name, date_time, v as tag_value, hash, send_time, tag_time
from clean"""))
def restore_meta(spark, folder):
    rows = t.readings(spark, folder)
    wide = E.to_wide(rows.withColumn("v", C.clean_value("tag_value")), "date_time", "tag_name", "v", _TAGS)
    source = rows.select("tag_name", "date_time", "hash", "send_time", "tag_time")
    return J.restore_meta(E.to_long(wide, ["date_time"]), source)


# ---- reshaping ---------------------------------------------------------------------

_TAGS = ["click", "error", "purchase", "signup", "view"]
_WIDE = "select date_time, " + ", ".join(
    f"sum(coalesce(v, 0)) filter (tag_name = '{x}') as {x}" for x in _TAGS) + " from clean group by 1"


def wide_readings(spark, folder):
    rows = t.readings(spark, folder).withColumn("v", C.clean_value("tag_value"))
    return E.to_wide(rows, "date_time", "tag_name", "v", _TAGS)


@query("pivot_sum", with_ctes("clean", _WIDE))
def pivot_sum(spark, folder):
    return wide_readings(spark, folder)


@query("pivot_text", with_ctes("readings", "select date_time, " + ", ".join(
    f"min(hash) filter (tag_name = '{x}') as {x}" for x in _TAGS) + " from readings group by 1"))
def pivot_text(spark, folder):
    return E.to_wide_text(t.readings(spark, folder), "date_time", "tag_name", "hash", _TAGS)


@query("count_matrix", with_ctes("log_hits", """select time_bucket(interval 10 minute, ts) as bucket,
  count(*) filter (single_rule = 1) as r1, count(*) filter (single_rule = 2) as r2,
  count(*) filter (single_rule = 99) as r99 from log_hits group by 1"""))
def count_matrix(spark, folder):
    return E.count_matrix(raw_log_hits(spark, folder), "ts", "single_rule", [1, 2, 99])


_COMPLETE = " and ".join(f"{x} is not null" for x in _TAGS)


@query("complete_rows", with_ctes("clean", f"select * from wide where {_COMPLETE}", wide=_WIDE))
def complete_rows(spark, folder):
    return E.complete_rows(wide_readings(spark, folder))


@query("select_type", with_ctes("clean", "select date_time, click, error from wide", wide=_WIDE))
def select_type(spark, folder):
    return E.select_type(wide_readings(spark, folder), t.catalogue(spark), "Turbine1", ["date_time"])


@query("unpivot_long", with_ctes("clean", """select date_time, tag_name, tag_value
from (unpivot wide on click, error, purchase, signup, view into name tag_name value tag_value)""", wide=_WIDE))
def unpivot_long(spark, folder):
    return E.to_long(wide_readings(spark, folder), ["date_time"])


_RATE_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_partkey"]


def _rates_sql(by: str = "", where: str = "") -> str:
    keys = f"{by}, " if by else ""
    values = " union all ".join(
        f"select {keys}'{c}' as \"column\", cast({c} as varchar) as value from lineitem {where}" for c in _RATE_COLS)
    return f"""with v as ({values}), c as (select {keys}"column", value, count(*) as n from v
      where value is not null group by all),
    r as (select *, sum(n) over (partition by {keys}"column") as n_all from c)
    select {keys}"column", value, n, round(n / n_all, 9) as rate from r"""


def _rounded(df):
    return df.withColumn("rate", F.round("rate", 9))


@query("value_rates", _rates_sql())
def value_rates(spark, folder):
    return _rounded(E.value_rates(t.table(spark, folder, "lineitem"), _RATE_COLS))


@query("value_rates_by", _rates_sql("l_suppkey", "where l_suppkey in (select s_suppkey from supplier where s_acctbal > 5000)"))
def value_rates_by(spark, folder):
    keys = t.table(spark, folder, "supplier").filter("s_acctbal > 5000").selectExpr("s_suppkey as l_suppkey")
    return _rounded(E.value_rates_by(t.table(spark, folder, "lineitem"), "l_suppkey", keys, _RATE_COLS))


@query("distinct_rows", "select distinct l_partkey, l_suppkey, l_returnflag from lineitem")
def distinct_rows(spark, folder):
    return t.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("score_counts", "select round(l_discount + l_tax, 6) as score, count(*) as n from lineitem group by 1")
def score_counts(spark, folder):
    items = t.table(spark, folder, "lineitem").select((F.col("l_discount") + F.col("l_tax")).alias("score"))
    return E.score_counts(items, "score")


_SINGLE = """select distinct time, ip, type, single_rule, hash, timestamp '2024-02-01 09:30:00' as version, id,
  strftime(time, '{}') as milli_time from {}"""


@query("single_events", with_ctes("all_logs packet_e", _SINGLE.format("%Y-%m-%d %H:%M:%S", "all_logs")
       + " union all " + _SINGLE.format("%Y-%m-%d %H:%M:%S", "packet_e")))
def single_events(spark, folder):
    return E.stack([
        E.single_events(all_logs(spark, folder), "log", t.RUN_TIME),
        E.single_events(kept_packets(spark, folder), "packet", t.RUN_TIME),
    ])


@query("merge_sources", with_ctes("all_logs packet_e", """
select hash, single_rule, id, ip, device_id, cast(null as varchar) as protocol_type,
  single_rule as single_rule_log, cast(null as bigint) as single_rule_packet from all_logs
union all select hash, single_rule, id, ip, null, protocol_type, null, single_rule from packet_e"""))
def merge_sources(spark, folder):
    logs = all_logs(spark, folder).drop("id").select("hash", "single_rule", "plant_id", "ip", "device_id")
    packets = kept_packets(spark, folder).select("hash", "single_rule", "make_id", "src_ip", "protocol_type")
    return E.merge_sources(logs, packets).drop("src_ip")


@query("stack_kinds", with_ctes("log_hits packet_hits", """select hash, single_rule, source from log_hits
union all select hash, single_rule, 'packet' from packet_hits"""))
def stack_kinds(spark, folder):
    packet_rules = R.load_rules(R.select_rules(t.rules(spark), R.PACKET))
    packets = R.match_rules(t.packets(spark, folder), packet_rules, "packet_time")
    return E.stack([
        raw_log_hits(spark, folder).select("hash", "single_rule", "source"),
        packets.select("hash", "single_rule", F.lit("packet").alias("source")),
    ])


# ---- sequence ----------------------------------------------------------------------


@query("merge_excess", with_ctes("log_hits", """select min(hash) as hash, plant_id, day, single_rule from h
  where single_rule in (2, 4) group by plant_id, day, single_rule
union all select hash, plant_id, day, single_rule from h where single_rule not in (2, 4)""",
    h="select hash, plant_id, substr(loged_time, 1, 8) as day, single_rule from log_hits"))
def merge_excess(spark, folder):
    rows = raw_log_hits(spark, folder).select(
        "hash", "plant_id", F.substring("loged_time", 1, 8).alias("day"), "single_rule")
    return S.merge_excess(rows, [2, 4], ["plant_id", "day"])


@query("keep_first", """select l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity from (
  select *, row_number() over (partition by l_partkey, l_suppkey order by l_shipdate, l_orderkey, l_linenumber) as n
  from lineitem) where n = 1""")
def keep_first(spark, folder):
    items = t.table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    first = S.keep_first(items, ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return first.drop("l_shipdate")


@query("adjacent_pairs", """select event_id as f_event_id, event_type as f_event_type, b_event_id, b_event_type
from (select event_id, event_type, lead(event_id) over w as b_event_id, lead(event_type) over w as b_event_type
  from events window w as (order by ts, event_id)) where b_event_id is not null""")
def adjacent_pairs(spark, folder):
    return S.adjacent_pairs(t.table(spark, folder, "events"), ["ts", "event_id"], ["event_id", "event_type"])


def _skip_sql(by: str = "") -> str:
    part = f"partition by {by}" if by else ""
    return " union all ".join(
        f"""select event_id as f_event_id, b_event_id, {k}::bigint as step from (select event_id,
          lead(event_id, {k}) over ({part} order by ts, event_id) as b_event_id from events)
        where b_event_id is not null""" for k in (1, 2, 3))


@query("skip_pairs", _skip_sql())
def skip_pairs(spark, folder):
    return S.skip_pairs(t.table(spark, folder, "events"), ["ts", "event_id"], ["event_id"], 3)


@query("skip_pairs_by_unit", _skip_sql("user_id % 2, user_id % 4 < 2"))
def skip_pairs_by_unit(spark, folder):
    events = t.table(spark, folder, "events").selectExpr(
        "event_id", "ts", "user_id % 2 as unit", "user_id % 4 < 2 as maker")
    return S.skip_pairs(events, ["ts", "event_id"], ["event_id"], 3, by=["unit", "maker"])


_JUNCTIONS = """with o as (select event_id, row_number() over (order by ts, event_id) - 1 as i, count(*) over () as n
  from events)
select f.event_id as f_event_id, b.event_id as b_event_id, k.step from o f
  join (select unnest([1, 2, 3])::bigint as step) k on true join o b on b.i = f.i + k.step
union all select f.event_id, b.event_id, -k.x from o f join (select unnest([1, 2])::bigint as x) k on true
  join o b on b.i = f.i - k.x where f.i >= k.x + 1 and f.i <= f.n - 2
union all select f.event_id, b.event_id, 1 - f.n from o f join o b on f.i = f.n - 1 and b.i = 0
  join (select unnest([1, 2])::bigint as x) k on k.x <= f.n - 2"""


@query("skip_pairs_junctions", _JUNCTIONS)
def skip_pairs_junctions(spark, folder):
    events = t.table(spark, folder, "events")
    return S.skip_pairs(events, ["ts", "event_id"], ["event_id"], 3, junctions=True)


@query("lookback", """with o as (select *, row_number() over (order by ts, event_id) as i from events)
select a.event_id, s.step, coalesce(b.value, 0.0) as value, coalesce(cast(b.user_id as double), 0.0) as user_id
from o a cross join (select unnest(range(4)) as step) s left join o b on b.i = a.i - 4 + s.step and a.i > 4""")
def lookback(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "ts", "value", "user_id")
    windows = S.lookback(events, ["ts", "event_id"], ["value", "user_id"], 4)
    return windows.select("event_id", F.posexplode("window").alias("step", "v")).select(
        "event_id", F.col("step").cast("long").alias("step"),
        F.col("v")[0].alias("value"), F.col("v")[1].alias("user_id"))


@query("shift_ones", """select event_id, coalesce(lag(value) over (order by ts, event_id), 1.0) as value
from events""")
def shift_ones(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "ts", "value")
    return S.shift_ones(events, ["ts", "event_id"], ["value"]).drop("ts")


@query("ordered_topn", "select event_id, ts, value from events order by value desc, event_id limit 50")
def ordered_topn(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "ts", "value")
    return events.orderBy(F.desc("value"), "event_id").limit(50)


_SPLIT_PAIRS = f"""select f.hash as f_hash, b.hash as b_hash, f.type as f_type, b.type as b_type, k.corr
{numbered_pairs_sql(1)} left join known k on k.f_single_rule = f.single_rule and k.b_single_rule = b.single_rule"""


@query("split_pairs", with_ctes("log_e packet_e known", """
select f_hash, b_hash, corr, 'train' as part from pairs where corr is not null
union all select f_hash, b_hash, corr, 'held' from pairs where corr is null and f_type <> b_type""",
    rows=ROWS_SQL, pairs=_SPLIT_PAIRS))
def split_pairs(spark, folder):
    pairs = S.adjacent_pairs(event_rows(spark, folder), ORDER, ["type", "single_rule", "hash"])
    known = R.symmetric_pairs(R.rule_mapping(t.mapping(spark))).distinct()
    train, held = S.split_pairs(J.label_pairs(pairs, known))
    both = train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held")))
    return both.select("f_hash", "b_hash", "corr", "part")


@query("cross_kind", with_ctes("ev", """select f_event_id, b_event_id from (select event_id as f_event_id,
    lead(event_id) over w as b_event_id, message_id[1] as f_type, lead(message_id[1]) over w as b_type
  from ev window w as (order by ts, event_id)) where f_type <> b_type"""))
def cross_kind(spark, folder):
    events = t.sourced_events(spark, folder).withColumn("type", C.event_kind("message_id"))
    pairs = S.adjacent_pairs(events, ["ts", "event_id"], ["event_id", "type"])
    return C.cross_kind(pairs).select("f_event_id", "b_event_id")


@query("label_by_rule", with_ctes("log_hits mapping", """select hash, single_rule, coalesce(corr <> 0, false) as ai_label
from log_hits left join (select distinct rule_id, case when multi_id = 104 then 0 else multi_id end as corr
  from mapping where kind = 1 or multi_id in (103, 104)) on rule_id = single_rule"""))
def label_by_rule(spark, folder):
    ids = t.mapping(spark).filter("kind = 1 or multi_id in (103, 104)").selectExpr(
        "rule_id as single_rule", "case when multi_id = 104 then 0 else multi_id end as corr").distinct()
    hits = raw_log_hits(spark, folder).select("hash", "single_rule").join(F.broadcast(ids), "single_rule", "left")
    return C.label_by_rule(hits).select("hash", "single_rule", "ai_label")


@query("demote_label", """select l_orderkey, l_linenumber,
  case when l_discount <= 0.05 then false else l_tax > 0.03 end as ai_label, cast(0.05 as double) as threshold
from lineitem""")
def demote_label(spark, folder):
    items = t.table(spark, folder, "lineitem").withColumn("ai_label", F.col("l_tax") > 0.03)
    return C.demote(items, "l_discount", 0.05).select("l_orderkey", "l_linenumber", "ai_label", "threshold")
