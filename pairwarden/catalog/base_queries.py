"""Queries for sources, rules and scalar operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pairwarden.catalog import standins as t
from pairwarden.catalog.registry import query
from pairwarden.catalog.standins import with_ctes
from pairwarden.functions import columns as C
from pairwarden.functions import times
from pairwarden.operators import rules as R
from pairwarden.schemas import VERSIONS, _struct
from pairwarden.sources import scan, sinks

# ---- sources and sinks -------------------------------------------------------------


@query("scan_range", "select event_id, ts, event_type from events where ts between "
       "timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 12:00:00'")
def scan_range(spark, folder):
    events = t.table(spark, folder, "events")
    hit = scan.scan_range(events, "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")
    return hit.select("event_id", "ts", "event_type")


_TIMES = """select event_id, case when event_id % 5 = 0 then 'bad' else strftime(ts, '%Y%m%d%H%M%S') end as loged_time,
  case when event_id % 7 = 0 then null else strftime(ts + interval 12 hour, '%Y%m%d%H%M%S') end as packet_time
from events"""


@query("scan_range_any", f"""with x as ({_TIMES}) select event_id, loged_time, packet_time from x
where coalesce(try_strptime(substr(loged_time, 1, 14), '%Y%m%d%H%M%S'), timestamp '1970-01-01')
    between timestamp '2024-01-10' and timestamp '2024-01-12'
  or coalesce(try_strptime(substr(packet_time, 1, 14), '%Y%m%d%H%M%S'), timestamp '1970-01-01')
    between timestamp '2024-01-10' and timestamp '2024-01-12'""")
def scan_range_any(spark, folder):
    stamp = "date_format({}, 'yyyyMMddHHmmss')"
    rows = t.table(spark, folder, "events").selectExpr(
        "event_id",
        f"case when event_id % 5 = 0 then 'bad' else {stamp.format('ts')} end as loged_time",
        f"case when event_id % 7 = 0 then null else {stamp.format('ts + interval 12 hours')} end as packet_time",
    )
    return scan.scan_range_any(rows, ["loged_time", "packet_time"], "2024-01-10", "2024-01-12")


@query("federated_union", """select event_id, user_id, event_type,
  'server' || cast(user_id % 3 as varchar) as clickhouse_server from events""")
def federated_union(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "user_id", "event_type")
    parts = {f"server{i}": events.filter(F.col("user_id") % 3 == i) for i in range(3)}
    return scan.federated_union(parts)


@query("scan_dim", with_ctes("devices", "select ip_address, device_id from devices"))
def scan_dim(spark, folder):
    return t.devices(spark, folder)


@query("append_new", with_ctes("ev", """select distinct hash, event_id, source from ev
where hash not in (select hash from ev where value > 50)"""))
def append_new(spark, folder):
    events = t.sourced_events(spark, folder)
    stored = events.filter("value > 50")
    return sinks.new_rows(events.select("hash", "event_id", "source"), stored, ["hash"])


@query("batch_stamp", """select event_id, ts, cast(floor((n - 1) / 1000) as bigint) as batch_no,
  timestamp '2024-02-01 09:30:00' + to_seconds(cast(floor((n - 1) / 1000) as bigint)) as version
from (select event_id, ts, row_number() over (order by ts, event_id) as n from events)""")
def batch_stamp(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "ts")
    numbered = sinks.with_batch_no(events, ["ts", "event_id"], 1000)
    return sinks.stamp_batches(numbered, times.at(t.RUN_TIME))


@query("latest_version", """select max(version) as version from (
  select date_trunc('hour', ts) as version, count(distinct event_type) as n_files from events group by 1)
where n_files = 4 and version <= timestamp '2024-01-25 09:00:00'""")
def latest_version(spark, folder):
    versions = (
        t.table(spark, folder, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("version"))
        .agg(F.countDistinct("event_type").alias("n_files"))
    )
    return sinks.latest_version(C.conform(versions, VERSIONS), datetime(2024, 1, 25, 9), 4)


# ---- rules -------------------------------------------------------------------------


@query("match_rules", with_ctes("log_hits", "select hash, loged_time as time, single_rule from log_hits"))
def match_rules(spark, folder):
    rules = R.load_rules(R.select_rules(t.rules(spark), R.LOG))
    hits = R.match_rules(t.logs(spark, folder), rules, "loged_time")
    return hits.select("hash", "time", "single_rule")


def _hits_per_rule(spark, folder, rules):
    hits = R.match_rules(t.sourced_events(spark, folder), R.load_rules(rules), "ts")
    return hits.groupBy("single_rule").agg(F.count(F.lit(1)).alias("n"))


def _count_sql(keep) -> str:
    parts = [
        f"select {r.rule_id}::bigint as single_rule from ev where {r.condition()}" for r in t.RULES if keep(r)
    ]
    return with_ctes("ev", f"select single_rule, count(*) as n from ({' union all '.join(parts)}) group by 1")


@query("select_rules", _count_sql(lambda r: r.kind == R.LOG and r.state not in ("D", "DE", None)))
def select_rules(spark, folder):
    return _hits_per_rule(spark, folder, R.select_rules(t.rules(spark), R.LOG, active_only=True))


@query("route_rules", _count_sql(lambda r: r.source in ("L005", "L009", "L011")))
def route_rules(spark, folder):
    return _hits_per_rule(spark, folder, R.route_rules(t.rules(spark)))


@query("rules_in_use", _count_sql(lambda r: r.rule_id in {m[1] for m in t.MAPPING}))
def rules_in_use(spark, folder):
    return _hits_per_rule(spark, folder, R.rules_in_use(t.rules(spark), t.mapping(spark)))


# Orders and line items stand in for a mapping that grows with the data: a multi-rule
# is an order, its log rules are its parts, its packet rules its suppliers.
_BIG_MAP = """select l_orderkey as multi_id, l_partkey as rule_id, 2 as kind, 'A' as state from lineitem
  where l_returnflag <> 'R'
union all select l_orderkey, l_suppkey, 1, 'A' from lineitem where l_returnflag <> 'A'"""
_BIG_MAPPED = """select distinct coalesce(l.multi_id, p.multi_id) as corr, coalesce(l.rule_id, 0) as single_rule_log,
  coalesce(p.rule_id, 0) as single_rule_packet
from (select * from big where kind = 2) l full join (select * from big where kind = 1) p on l.multi_id = p.multi_id"""


def _big_map(spark, folder):
    items = t.table(spark, folder, "lineitem")
    log = items.filter("l_returnflag <> 'R'").selectExpr(
        "l_orderkey as multi_id", "l_partkey as rule_id", "2 as kind", "'A' as state")
    packet = items.filter("l_returnflag <> 'A'").selectExpr(
        "l_orderkey as multi_id", "l_suppkey as rule_id", "1 as kind", "'A' as state")
    return log.unionByName(packet)


@query("rule_mapping", f"with big as ({_BIG_MAP}) {_BIG_MAPPED}")
def rule_mapping(spark, folder):
    return R.rule_mapping(_big_map(spark, folder))


@query("symmetric_pairs", f"""with big as ({_BIG_MAP}), mapped as ({_BIG_MAPPED})
select corr, single_rule_log as f_single_rule, single_rule_packet as b_single_rule from mapped
union all select corr, single_rule_packet, single_rule_log from mapped""")
def symmetric_pairs(spark, folder):
    return R.symmetric_pairs(R.rule_mapping(_big_map(spark, folder)))


@query("same_kind_pairs", f"""with big as ({_BIG_MAP})
select distinct f.multi_id as corr, f.rule_id as f_single_rule, b.rule_id as b_single_rule
from big f join big b on f.multi_id = b.multi_id where f.kind = 2 and b.kind = 2""")
def same_kind_pairs(spark, folder):
    return R.same_kind_pairs(_big_map(spark, folder))


# ---- scalar operators --------------------------------------------------------------


@query("row_hash", with_ctes("ev", "select event_id, hash from ev"))
def row_hash(spark, folder):
    events = t.table(spark, folder, "events")
    return events.select("event_id", C.row_hash(t.HASH_COLS).alias("hash"))


@query("event_kind", with_ctes("ev", """select message_id, case when message_id like 'H%' then 'packet'
  when message_id like 'L%' then 'log' end as kind
from (select case when user_id % 9 = 0 then 'X' || message_id else message_id end as message_id from ev)"""))
def event_kind(spark, folder):
    ids = t.sourced_events(spark, folder).selectExpr(
        "case when user_id % 9 = 0 then 'X' || message_id else message_id end as message_id")
    return ids.select("message_id", C.event_kind("message_id").alias("kind"))


@query("substr_class", with_ctes("packets", """select make_id,
  case when substr(make_id, 14, 2) = 'GE' then 'GE' else 'ABB' end as maker from packets"""))
def substr_class(spark, folder):
    return t.packets(spark, folder).select("make_id", C.maker("make_id").alias("maker"))


@query("prefix_route", with_ctes("readings", """select tag_name, date_time, tag_value,
  case when tag_name[1:2] in ('cl', 'er') then 'Turbine1' else 'Turbine2' end as unit_type,
  case when tag_name[1:2] in ('cl', 'er') then 'UN_01' else 'UN_02' end as unit_id,
  case when tag_name[1:2] in ('cl', 'er') then 'OI_01' else 'OI_02' end as operate_info_id
from readings where tag_name[1:2] in ('cl', 'er', 'pu', 'si')"""))
def prefix_route(spark, folder):
    rows = t.readings(spark, folder).select("tag_name", "date_time", "tag_value")
    return C.route_by_prefix(rows, "tag_name", t.READING_UNITS)


@query("any_nonempty", with_ctes("packets", """select hash, src_ip, dst_ip from packets
where coalesce(src_ip, '') <> '' or coalesce(dst_ip, '') <> ''"""))
def any_nonempty(spark, folder):
    return C.any_nonempty(t.packets(spark, folder).select("hash", "src_ip", "dst_ip"), ["src_ip", "dst_ip"])


@query("exclude_patterns", with_ctes("all_logs", """select hash, single_rule, ip from all_logs
where not regexp_matches(ip, '10.1.0') and not regexp_matches(ip, '10.2..')"""))
def exclude_patterns(spark, folder):
    return C.exclude_patterns(_all_logs(spark, folder), "ip", ["10.1.0", "10.2.."]).select(
        "hash", "single_rule", "ip")


def _all_logs(spark, folder):
    from pairwarden.plans.events import enrich_logs, log_hits

    rules = R.load_rules(R.select_rules(t.rules(spark), R.LOG))
    return enrich_logs(log_hits(t.logs(spark, folder), rules, t.START, t.END), t.devices(spark, folder))


@query("clean_value", with_ctes("clean", "select tag_name, date_time, v as tag_value from clean"))
def clean_value(spark, folder):
    rows = t.readings(spark, folder)
    return rows.select("tag_name", "date_time", C.clean_value("tag_value").alias("tag_value"))


@query("parse_second", with_ctes("logs", """select event_id,
  strptime(substr(loged_time, 1, 14), '%Y%m%d%H%M%S') as time from logs"""))
def parse_second(spark, folder):
    return t.logs(spark, folder).select("event_id", times.parse_second("loged_time").alias("time"))


@query("parse_fraction", with_ctes("packets", """select event_id,
  strptime(substr(packet_time, 1, 14), '%Y%m%d%H%M%S')
    + to_milliseconds(10 * cast(substr(packet_time, 15, 2) as bigint)) as milli_time from packets"""))
def parse_fraction(spark, folder):
    return t.packets(spark, folder).select("event_id", times.parse_fraction("packet_time").alias("milli_time"))


@query("bucket_10m", "select event_id, time_bucket(interval 10 minute, ts) as bucket from events")
def bucket_10m(spark, folder):
    return t.table(spark, folder, "events").select("event_id", times.bucket("ts").alias("bucket"))


_CRONS = {
    "* * * * *": "date_trunc('minute', ts)",
    "*/1 * * * *": "date_trunc('minute', ts)",
    "*/5 * * * *": "time_bucket(interval 5 minute, ts)",
    "*/15 * * * *": "time_bucket(interval 15 minute, ts)",
    "0 */1 * * *": "date_trunc('hour', ts)",
    "0 0 */1 * *": "date_trunc('day', ts)",
    "0 0 */4 * *": "date_trunc('quarter', ts)",
    "0 0 1 */1 *": "date_trunc('month', ts)",
    "0 0 1 1 */1": "date_trunc('year', ts)",
    "other": "date_trunc('hour', ts)",
}


@query("bucket_cron", " union all ".join(
    f"select '{cron}' as cron, {cut} as bucket, count(*) as n from events group by 2"
    for cron, cut in _CRONS.items()))
def bucket_cron(spark, folder):
    events = t.table(spark, folder, "events")
    per_cron = F.array(*[
        F.struct(F.lit(c).alias("cron"), times.bucket_for_cron(c, "ts").alias("bucket"))
        for c in _CRONS if " " not in times.cron_unit(c)
    ])
    cut = events.select(F.explode(per_cron).alias("c")).select("c.*")
    for cron in _CRONS:
        if " " in times.cron_unit(cron):
            cut = cut.unionByName(
                events.select(F.lit(cron).alias("cron"), times.bucket_for_cron(cron, "ts").alias("bucket")))
    return cut.groupBy("cron", "bucket").agg(F.count(F.lit(1)).alias("n"))


_RUNS = [("hours=1", "days=3"), ("weeks=1", "hours=4"), ("nonsense", "days=13"), ("minutes=30", "years=1")]


@query("run_range", " union all ".join(
    f"""select '{a}' as now_delta, '{b}' as prev_delta, event_type, count(*) as n from events
    where ts between timestamp '2024-01-30 00:00:00' - interval {x} - interval {y}
      and timestamp '2024-01-30 00:00:00' - interval {x} group by 3"""
    for (a, b), (x, y) in zip(_RUNS, [("1 hour", "3 day"), ("7 day", "4 hour"), ("1 day", "13 day"),
                                      ("30 minute", "1 day")], strict=True)))
def run_range(spark, folder):
    events = t.table(spark, folder, "events")
    parts = {}
    for now_delta, prev_delta in _RUNS:
        start, end = times.run_range(datetime(2024, 1, 30), now_delta, prev_delta)
        parts[(now_delta, prev_delta)] = scan.scan_range(events, "ts", start, end).select(
            F.lit(now_delta).alias("now_delta"), F.lit(prev_delta).alias("prev_delta"), "event_type")
    from pairwarden.operators.reshape import stack

    ranged = stack(list(parts.values()))
    return ranged.groupBy("now_delta", "prev_delta", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("pair_key", """select l_orderkey, l_linenumber,
  cast(l_partkey as varchar) || ',' || cast(l_suppkey as varchar) as hash_sum from lineitem""")
def pair_key(spark, folder):
    items = t.table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", C.pair_key("l_partkey", "l_suppkey").alias("hash_sum"))


@query("text_of", with_ctes("logs", """select hash, coalesce(msg, ',') || ',' || coalesce(value01, ',') || ',' ||
  coalesce(value02, ',') || ',' || coalesce(value03, ',') || ',' || coalesce(type01, ',') as text from logs"""))
def text_of(spark, folder):
    cols = ["msg", "value01", "value02", "value03", "type01"]
    return t.logs(spark, folder).select("hash", C.text_of(cols).alias("text"))


@query("different_site", with_ctes("logs packets", """select l.hash as f_hash, p.hash as b_hash
from logs l join packets p on l.event_id + 1 = p.event_id
where string_split(l.plant_id, '_')[1:2] <> string_split(p.make_id, '_')[1:2] and l.plant_id <> p.make_id"""))
def different_site(spark, folder):
    front = t.logs(spark, folder).selectExpr("event_id + 1 as event_id", "hash as f_hash", "plant_id as f_id")
    back = t.packets(spark, folder).selectExpr("event_id", "hash as b_hash", "make_id as b_id")
    return front.join(back, "event_id").filter(C.different_site("f_id", "b_id")).select("f_hash", "b_hash")


@query("conform", """select cast(event_id as varchar) as id, ts as time, cast(user_id as bigint) as single_rule,
  cast(value as double) as score, cast(value > 50 as varchar) as label from events""")
def conform(spark, folder):
    rows = t.table(spark, folder, "events").selectExpr(
        "event_id as id", "cast(ts as string) as time", "cast(user_id as string) as single_rule",
        "cast(value as string) as score", "value > 50 as label")
    return C.conform(rows, _struct("id:s time:t single_rule:l score:d label:s"))


@query("fill_missing", with_ctes("logs", """select hash, coalesce(value01, ',') as value01,
  case when coalesce(type01, 'nan') = 'nan' then ' ' else type01 end as type01,
  coalesce(nullif(user_id, 8), 0) as user_id from logs"""))
def fill_missing(spark, folder):
    rows = t.logs(spark, folder).selectExpr("hash", "value01", "type01", "nullif(user_id, 8) as user_id")
    return C.fill_missing(rows, {"value01": ",", "user_id": 0}, ["type01"])


@query("row_product", """select l_orderkey, l_linenumber,
  round(l_quantity * (1 - l_discount) * (1 + l_tax), 6) as product from lineitem""")
def row_product(spark, folder):
    items = t.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity as a", "1 - l_discount as b", "1 + l_tax as c")
    return items.select("l_orderkey", "l_linenumber", F.round(C.row_product(["a", "b", "c"]), 6).alias("product"))
