"""Event, rule and sensor tables derived from the test tables, in Spark and in SQL.

The column definitions are shared text; only time formatting differs by dialect.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairwarden.operators.rules import LOG, PACKET, Rule, rules_frame
from pairwarden.plans.correlation import CorrelationSettings, Tables
from pairwarden.schemas import RULE_MAP
from pairwarden.sources.scan import scan_dim

START, END = datetime(1970, 1, 1), datetime(2200, 1, 1)  # whatever the tables hold
RUN_TIME = datetime(2024, 2, 1, 9, 30)

RULES = [
    Rule(1, LOG, "L005", "A", "event_type = 'click'"),
    Rule(2, LOG, "L005", "A", "value > 50 and event_type = 'click'"),
    Rule(3, LOG, "L009", "A", "event_type = 'signup' and value > 100"),
    Rule(4, LOG, "L011", "A", "event_type = 'view' or value > 100"),
    Rule(5, LOG, "L011", "D", "value < 10"),
    Rule(6, LOG, "L011", "DE", "value < 20"),
    Rule(7, LOG, "L011", None, "value < 30"),
    Rule(8, PACKET, None, "A", "event_type = 'error'"),
    Rule(9, PACKET, None, "A", "event_type = 'purchase' and value > 20"),
    Rule(10, PACKET, None, "A", "value > 100"),
    Rule(11, PACKET, None, "D", "event_type = 'purchase'"),
]
MAPPING = [
    (101, 1, LOG, "A"), (101, 8, PACKET, "A"),
    (102, 2, LOG, "A"), (102, 8, PACKET, "A"), (102, 9, PACKET, "A"),
    (103, 4, LOG, "A"), (103, 9, PACKET, "A"), (103, 10, PACKET, "A"),
    (104, 1, LOG, "A"), (104, 8, PACKET, "A"),
    (105, 4, LOG, "A"),
    (106, 10, PACKET, "A"),
    (107, 1, LOG, "A"), (107, 2, LOG, "A"), (107, 4, LOG, "A"),
    (108, 5, LOG, "D"),
    (109, 7, LOG, None),
]
LOG_COLS = ("unit_id", "manufacturer_name", "type01")
PACKET_COLS = ("unit_id", "protocol_type", "anomaly_type")
SETTINGS = CorrelationSettings(
    LOG_COLS, PACKET_COLS, skip_n=2, excess_rules=(2, 4), security_servers=("10.3.", "10.1.0.2"),
    exclusion_source="L009", units=("1", "2"), makers=("ABB", "GE"),
)

HASH_COLS = ("event_id", "user_id", "event_type")
_HASH = "md5(concat_ws('|', cast(event_id as string), cast(user_id as string), event_type))"
_UNIT = "cast(user_id % 2 + 1 as string)"
_MAKER = "case when user_id % 4 < 2 then 'GE' else 'ABB' end"
_SITE = "'PLT_0' || cast(user_id % 3 + 1 as string)"


def _net(prefix: str, key: str) -> str:
    high = f"cast(cast(floor({key} / 250) as bigint) as string)"
    return f"'{prefix}.' || {high} || '.' || cast({key} % 250 as string)"


_LOG_COLUMNS = [
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "value",
    "props",
    f"{_HASH} as hash",
    "'L' || cast(event_id as string) as message_id",
    "'D' || cast(user_id as string) as device_id",
    f"{_SITE} || '_PL_' || cast(user_id as string) as plant_id",
    f"{_UNIT} || '호기' as machine_no",
    f"{_MAKER} as manufacturer_name",
    f"'UNIT_0' || {_UNIT} as unit_id",
    "props as msg",
    "case when user_id % 7 = 0 then null else 'user ' || cast(user_id % 20 as string) end as value01",
    "case when value > 50 then 'large' else 'small' end as value02",
    "cast(null as string) as value03",
    "case when user_id % 11 = 0 then null else event_type end as type01",
    "case event_type when 'click' then 'L005' when 'signup' then 'L009' else 'L011' end as source",
]
_PACKET_COLUMNS = [
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "value",
    "props",
    f"{_HASH} as hash",
    "'H' || cast(event_id as string) as message_id",
    f"case when user_id % 10 = 0 then '' else {_net('172.16', 'user_id')} end as src_ip",
    f"case when user_id % 15 = 0 then '' else {_net('172.17', 'user_id')} end as dst_ip",
    f"{_SITE} || '_MK_000' || case when user_id % 4 < 2 then 'GE' else 'AB' end || cast(user_id as string) as make_id",
    f"'UNIT_0' || {_UNIT} as unit_id",
    "case event_type when 'error' then 'modbus' else 'dnp3' end as protocol_type",
    "props as protocol_detail",
    "case when user_id % 13 = 0 then null else 'kind' || cast(user_id % 3 as string) end as anomaly_type",
]
_LOG_TYPES = "event_type in ('click', 'view', 'signup')"
_PACKET_TYPES = "event_type in ('error', 'purchase')"

_DEVICE = [
    "'D' || cast(s_suppkey as string) as device_id",
    "case when s_suppkey % 17 = 3 then '' else '10.' || cast(s_nationkey as string) || '.' || cast(cast(floor(s_suppkey / 250) as bigint) as string) || '.' || cast(s_suppkey % 250 as string) end as ip_address",
]
EVENT_COLUMNS = [
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "value",
    "props",
    f"{_HASH} as hash",
    f"case when {_PACKET_TYPES} then 'H' else 'L' end || cast(event_id as string) as message_id",
    "case event_type when 'click' then 'L005' when 'signup' then 'L009' when 'view' then 'L011' end as source",
]
_ASSETS = [
    ("supplier", "'10.' || cast(s_nationkey as string) || '.' || cast(cast(floor(s_suppkey / 250) as bigint)"
     " as string) || '.' || cast(s_suppkey % 250 as string)", "'A' || cast(s_nationkey % 5 as string)"),
    ("customer", _net("172.16", "c_custkey"), "'A' || cast(c_nationkey % 5 as string)"),
    ("customer", _net("172.17", "c_custkey"), "'A' || cast(c_nationkey % 5 as string)"),
]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is looked up once."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter(_LOG_TYPES)
        .selectExpr(*_LOG_COLUMNS, "date_format(ts, 'yyyyMMddHHmmss') as loged_time")
    )


def packets(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter(_PACKET_TYPES)
        .selectExpr(*_PACKET_COLUMNS, "date_format(ts, 'yyyyMMddHHmmssSS') as packet_time")
    )


def raw_devices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(*_DEVICE)


def devices(spark: SparkSession, folder: str) -> DataFrame:
    return scan_dim(
        raw_devices(spark, folder), ["ip_address", "device_id"], ["ip_address", "device_id"]
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        table(spark, folder, source).selectExpr(f"{ip} as asset_ip", f"{name} as asset")
        for source, ip, name in _ASSETS
    ]
    return scan_dim(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["asset_ip", "asset"])


def rules(spark: SparkSession) -> DataFrame:
    return rules_frame(spark, RULES)


def mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MAPPING, RULE_MAP)


def tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        logs(spark, folder), packets(spark, folder), devices(spark, folder),
        rules(spark), mapping(spark), assets(spark, folder),
    )


def sourced_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events with hash, source and id, logs and packets in one frame."""
    return table(spark, folder, "events").selectExpr(*EVENT_COLUMNS)



READING_UNITS = (
    ("cl", "Turbine1", "UN_01", "OI_01"),
    ("er", "Turbine1", "UN_01", "OI_01"),
    ("pu", "Turbine2", "UN_02", "OI_02"),
    ("si", "Turbine2", "UN_02", "OI_02"),
)
CATALOGUE = [("click", "Turbine1"), ("error", "Turbine1"), ("purchase", "Turbine2"), ("signup", "Turbine2")]


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sensor readings: one tag per event type, value as text."""
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("tag_name"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_time"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("s"), F.max("event_id").alias("m"))
        .select(
            "date_time", "tag_name",
            F.when(F.col("m") % 97 == 0, "null").when(F.col("m") % 89 == 0, "True")
            .otherwise(F.col("s").cast("string")).alias("tag_value"),
            F.date_format("date_time", "yyyyMMddHHmmss").alias("tag_time"),
            F.concat(F.lit("S"), F.col("m").cast("string")).alias("send_time"),
            F.md5(F.concat_ws("|", "tag_name", F.col("m").cast("string"))).alias("hash"),
        )
    )


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOGUE, "tag_name string, type string")


# ---- the same in SQL -------------------------------------------------------------

_SQL_LOG_TIME = "strftime(ts, '%Y%m%d%H%M%S')"
_SQL_FRACTION = "substr(strftime(ts, '%f'), 1, 2)"


def _list(columns) -> str:
    return ", ".join(columns)


def _literal(value) -> str:
    return "null" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


def _hits(source: str, kind: int, active_only: bool = False) -> str:
    chosen = [
        r for r in RULES
        if r.kind == kind and (not active_only or r.state not in ("D", "DE", None))
    ]
    return " union all ".join(
        f"select *, {r.rule_id}::bigint as single_rule from {source} where {r.condition()}" for r in chosen
    )


def _rule_values() -> str:
    rows = [
        (r.rule_id, r.kind, r.source, r.state, r.predicate and r.predicate.replace("'", "''")) for r in RULES
    ]
    return _values(rows)


def _enriched_logs(hits: str) -> str:
    return f"""select distinct h.*, d.ip_address, d.ip_address as ip, plant_id as id, 'log' as type,
      loged_time as time_text, date_trunc('second', ts) as time,
      strftime(ts, '%Y-%m-%d %H:%M:%S') as milli_time
    from {hits} h join devices d using (device_id)"""


def _enriched_packets(hits: str) -> str:
    return f"""select distinct *, make_id as id, src_ip as ip, 'packet' as type,
      case when substr(make_id, 14, 2) = 'GE' then 'GE' else 'ABB' end as manufacturer_name,
      packet_time as time_text, date_trunc('second', ts) as time,
      strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || {_SQL_FRACTION} || '0' as milli_time
    from {hits} where src_ip <> '' or dst_ip <> ''"""


CTES: dict[str, str] = {
    "ev": f"select {_list(EVENT_COLUMNS)} from events",
    "logs": f"select {_list(_LOG_COLUMNS)}, {_SQL_LOG_TIME} as loged_time from events where {_LOG_TYPES}",
    "packets": f"select {_list(_PACKET_COLUMNS)}, {_SQL_LOG_TIME} || {_SQL_FRACTION} as packet_time "
               f"from events where {_PACKET_TYPES}",
    "raw_devices": f"select {_list(_DEVICE)} from supplier",
    "devices": "select distinct ip_address, device_id from raw_devices where ip_address <> '' and device_id <> ''",
    "assets": " union ".join(f"select {ip} as asset_ip, {name} as asset from {t}" for t, ip, name in _ASSETS),
    "rules": f"select * from (values {_rule_values()}) r(rule_id, kind, source, state, predicate)",
    "mapping": f"select * from (values {_values(MAPPING)}) m(multi_id, rule_id, kind, state)",
    "log_hits": _hits("logs", LOG),
    "packet_hits": _hits("packets", PACKET),
    "all_logs": _enriched_logs("log_hits"),
    "log_e": "select * from all_logs where hash not in (select hash from log_hits where source = 'L009')",
    "packet_e": _enriched_packets("packet_hits"),
    "active_hits": _hits("logs", LOG, active_only=True),
    "active_logs": _enriched_logs("active_hits"),
    "active_e": "select * from active_logs where hash not in (select hash from active_hits where source = 'L009')",
    "packet_act_hits": _hits("packets", PACKET, active_only=True),
    "packet_act": _enriched_packets("packet_act_hits"),
    "mapped": """select distinct coalesce(l.multi_id, p.multi_id) as corr,
      coalesce(l.rule_id, 0) as single_rule_log, coalesce(p.rule_id, 0) as single_rule_packet
    from (select * from mapping where kind = 2) l full join (select * from mapping where kind = 1) p
      on l.multi_id = p.multi_id""",
    "rule_pairs": """select corr, single_rule_log as f_single_rule, single_rule_packet as b_single_rule from mapped
    union all select corr, single_rule_packet, single_rule_log from mapped""",
    "known": "select distinct * from rule_pairs",
    "same_kind": """select distinct f.multi_id as corr, f.rule_id as f_single_rule, b.rule_id as b_single_rule
    from mapping f join mapping b on f.multi_id = b.multi_id
    where f.kind = 2 and b.kind = 2 and f.state not in ('D', 'DE') and b.state not in ('D', 'DE')""",
    "readings": """select date_trunc('hour', ts) as date_time, event_type as tag_name,
      case when max(event_id) % 97 = 0 then 'null' when max(event_id) % 89 = 0 then 'True'
        else cast(sum(cast(value as decimal(18,2))) as varchar) end as tag_value,
      strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') as tag_time,
      'S' || cast(max(event_id) as varchar) as send_time,
      md5(concat_ws('|', event_type, cast(max(event_id) as varchar))) as hash
    from events group by 1, 2""",
    "clean": """select *, cast(case when tag_value in ('False', 'null', 'True') then '0' else tag_value end as double) as v
    from readings""",
    "catalogue": f"select * from (values {_values(CATALOGUE)}) c(tag_name, type)",
}

_NEEDS = {
    "devices": ["raw_devices"], "log_hits": ["logs"], "packet_hits": ["packets"],
    "all_logs": ["log_hits", "devices"], "log_e": ["all_logs"], "packet_e": ["packet_hits"],
    "mapped": ["mapping"], "rule_pairs": ["mapped"], "known": ["rule_pairs"], "same_kind": ["mapping"],
    "clean": ["readings"], "active_hits": ["logs"], "active_logs": ["active_hits", "devices"],
    "active_e": ["active_logs"], "packet_act_hits": ["packets"], "packet_act": ["packet_act_hits"],
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """SQL text with the named common tables, what they build on, and further ones."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} as ({CTES[n]})" for n in ordered] + [f"{n} as ({t})" for n, t in extra.items()]
    if body.startswith("with "):
        return f"with {', '.join(parts)}, {body[5:]}"
    return f"with {', '.join(parts)} {body}"
