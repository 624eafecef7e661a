"""Queries for features, scoring, similarity, streams and stored artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairwarden.catalog import event_queries as EQ
from pairwarden.catalog import standins as t
from pairwarden.catalog.registry import query
from pairwarden.catalog.standins import with_ctes
from pairwarden.functions.times import bucket
from pairwarden.operators import features as P
from pairwarden.operators import joins as J
from pairwarden.operators import reconstruct as M
from pairwarden.operators import rules as R
from pairwarden.operators import scoring as S
from pairwarden.operators import sequence as Q
from pairwarden.operators import similarity as W
from pairwarden.session import fresh_path
from pairwarden.sources import scan, sinks
from pairwarden.streaming import streams as K

# ---- features ----------------------------------------------------------------------

# an uneven key: every seventh user apart
@query("balance_counts", """with r as (select event_id, event_type, user_id % 7 = 0 as seventh,
    row_number() over (partition by event_type, user_id % 7 = 0 order by ts, event_id) - 1 as place from events),
  c as (select event_type, seventh, count(*) as n from r group by all),
  top as (select max(n) as t from c)
select event_id, event_type, seventh, n as pattern_rows,
  case when n = t then 1 else t // n + (place < t % n)::int end as copies
from r join c using (event_type, seventh), top""")
def balance_counts(spark, folder):
    events = t.table(spark, folder, "events").selectExpr(
        "event_id", "ts", "event_type", "user_id % 7 = 0 as seventh")
    key = ["event_type", "seventh"]
    drawn = P.balance(events, key, ["ts", "event_id"])
    sizes = events.groupBy(*key).agg(F.count(F.lit(1)).alias("pattern_rows"))
    return drawn.join(sizes, key).drop("ts")


def vocab_sql(rel: str, cols) -> str:
    cells = " union ".join(
        f"select {i} as place, '{c}' as \"column\", coalesce(cast({c} as varchar), 'nan') as value from {rel}"
        for i, c in enumerate(cols))
    return f"select \"column\", value, row_number() over (order by place, value) - 1 as position from ({cells})"


@query("onehot_vocab", with_ctes("log_e", vocab_sql("log_e", t.LOG_COLS)))
def onehot_vocab(spark, folder):
    return P.onehot_fit(EQ.kept_logs(spark, folder), t.LOG_COLS).vocab


_PART_COLS = ["p_brand", "p_type", "p_size"]


@query("onehot_apply", f"""with vocab as ({vocab_sql("(select * from part where p_size < 40 and p_partkey > 20)", _PART_COLS)}),
ones as (select p_partkey, position from part join vocab on ("column" = 'p_brand' and value = p_brand)
  or ("column" = 'p_type' and value = p_type) or ("column" = 'p_size' and value = cast(p_size as varchar)))
select p_partkey, coalesce(string_agg(cast(position as varchar), ',' order by position), '') as ones
from (select p_partkey, position from part left join ones using (p_partkey)) group by 1""")
def onehot_apply(spark, folder):
    parts = t.table(spark, folder, "part")
    model = P.onehot_fit(parts.filter("p_size < 40 and p_partkey > 20"), _PART_COLS)
    return P.onehot_apply(model, parts).select(
        "p_partkey", F.array_join(F.array_sort("positions"), ",").alias("ones"))


_ONES = """select hash, list_sort(list(position)) as ones from (
    select distinct e.hash, v.position from {rel} e join {vocab} v on {test}) group by 1"""


def _ones_sql(rel, vocab, cols):
    test = " or ".join(f"(v.\"column\" = '{c}' and v.value = coalesce(cast(e.{c} as varchar), 'nan'))" for c in cols)
    return _ONES.format(rel=rel, vocab=vocab, test=test)


@query("attach_features", with_ctes("log_e packet_e", """
select f.hash as f_hash, b.hash as b_hash, f.single_rule as f_single_rule, b.single_rule as b_single_rule,
  array_to_string(list_concat(l.ones, p.ones), ',') as features
""" + EQ.numbered_pairs_sql(1) + """
join lo l on l.hash = case when f.type = 'log' then f.hash else b.hash end
join po p on p.hash = case when f.type = 'log' then b.hash else f.hash end
where f.type <> b.type""", rows=EQ.ROWS_SQL, lv=vocab_sql("log_e", t.LOG_COLS), pv=vocab_sql("packet_e", t.PACKET_COLS),
    moved="select \"column\", value, position + (select count(*) from lv) as position from pv",
    lo=_ones_sql("log_e", "lv", t.LOG_COLS), po=_ones_sql("packet_e", "moved", t.PACKET_COLS)))
def attach_features(spark, folder):
    logs, packets = EQ.kept_logs(spark, folder), EQ.kept_packets(spark, folder)
    log_model, packet_model = P.onehot_fit(logs, t.LOG_COLS), P.onehot_fit(packets, t.PACKET_COLS)
    pairs = Q.adjacent_pairs(EQ.event_rows(spark, folder), EQ.ORDER, ["type", "single_rule", "hash"])
    joined = J.attach_features(
        pairs.filter("f_type <> b_type"), P.onehot_apply(log_model, logs),
        P.onehot_apply(packet_model, packets), log_model.size)
    return joined.select("f_hash", "b_hash", "f_single_rule", "b_single_rule",
                         F.array_join("features", ",").alias("features"))


@query("replicate", """select l_orderkey, l_linenumber, l_partkey from lineitem cross join range(4)""")
def replicate(spark, folder):
    return P.replicate(t.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), 4)


_SPACE_RULES = (1, 2, 4, 7)


@query("rule_space", with_ctes("log_hits", f"""with s as (select {', '.join(
    f"(i >> {len(_SPACE_RULES) - 1 - p}) & 1 as r{r}" for p, r in enumerate(_SPACE_RULES))} from range({1 << len(_SPACE_RULES)}) x(i)),
b as (select {', '.join(f"max(single_rule = {r})::int as r{r}" for r in _SPACE_RULES)} from log_hits
  group by time_bucket(interval 10 minute, ts))
select s.*, count(b.r1) as n_buckets from s left join b using ({', '.join(f"r{r}" for r in _SPACE_RULES)}) group by all"""))
def rule_space(spark, folder):
    names = [f"r{r}" for r in _SPACE_RULES]
    hits = EQ.raw_log_hits(spark, folder).groupBy(bucket("ts").alias("bucket")).agg(
        *[F.max(F.col("single_rule") == r).cast("int").alias(f"r{r}") for r in _SPACE_RULES])
    seen = hits.groupBy(*names).agg(F.count(F.lit(1)).alias("n_buckets"))
    space = P.rule_space(spark, _SPACE_RULES)
    return space.join(seen, names, "left").na.fill(0, ["n_buckets"])


_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')"


@query("token_counts", f"""select doc_id, token, count(*) as tf
from (select doc_id, unnest({_TOKENS}) as token from documents) group by all""")
def token_counts(spark, folder):
    return P.token_counts(t.table(spark, folder, "documents"), ["doc_id"], "text")


# ---- scoring -----------------------------------------------------------------------

_LINE = ["l_quantity", "l_discount", "l_tax"]


@query("minmax_scale", """select l_orderkey, l_linenumber, l_partkey,
  round((l_quantity - (select min(l_quantity) from lineitem)) / (select max(l_quantity) - min(l_quantity) from lineitem), 9) as l_quantity,
  round((l_tax - (select min(l_tax) from lineitem)) / (select max(l_tax) - min(l_tax) from lineitem), 9) as l_tax,
  cast(0 as double) as same from lineitem""")
def minmax_scale(spark, folder):
    items = t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax", F.lit(3.0).alias("same"))
    cols = ["l_quantity", "l_tax", "same"]
    scaled = S.minmax_apply(items, S.minmax_fit(items, cols))
    return scaled.withColumns({c: F.round(c, 9) for c in cols})


@query("row_rmse", """select l_orderkey, l_linenumber, l_partkey,
  round(sqrt((pow(l_discount - l_quantity, 2) + pow(l_tax - l_discount, 2)) / 2), 6) as rmse from lineitem""")
def row_rmse(spark, folder):
    error = S.row_rmse(F.array("l_quantity", "l_discount"), F.array("l_discount", "l_tax"))
    return t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(error, 6).alias("rmse"))


@query("window_mse", """select l_orderkey, l_linenumber, l_partkey, round((pow(l_discount - l_quantity, 2)
  + pow(l_tax - l_discount, 2) + pow(l_quantity - l_tax, 2) + pow(l_tax - 1, 2)) / 4, 6) as mse from lineitem""")
def window_mse(spark, folder):
    x = F.array(F.array("l_quantity", "l_discount"), F.array("l_tax", F.lit(1.0)))
    y = F.array(F.array("l_discount", "l_tax"), F.array("l_quantity", "l_tax"))
    return t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(S.window_mse(x, y), 6).alias("mse"))


@query("masked_rmse", """select round(sqrt(avg(pow(y - x, 2))), 6) as masked_rmse from (
  select case when l_returnflag = 'R' then -1 else l_discount end as x, l_tax as y from lineitem
  union all select l_tax, l_discount from lineitem) where x <> -1""")
def masked_rmse(spark, folder):
    items = t.table(spark, folder, "lineitem").select(
        F.array(F.expr("case when l_returnflag = 'R' then -1D else l_discount end"), "l_tax").alias("x"),
        F.array("l_tax", "l_discount").alias("y"))
    return S.masked_rmse(items, "x", "y").select(F.round("masked_rmse", 6).alias("masked_rmse"))


@query("reconstruct_mean", """with m as (select avg(l_quantity) a, avg(l_discount) b, avg(l_tax) c from lineitem)
select l_orderkey, l_linenumber, l_partkey,
  round(sqrt((pow(a - l_quantity, 2) + pow(b - l_discount, 2) + pow(c - l_tax, 2)) / 3), 6) as rmse from lineitem, m""")
def reconstruct_mean(spark, folder):
    items = t.table(spark, folder, "lineitem")
    restored = M.reconstruct(M.fit_reconstructor(items, _LINE), items, _LINE)
    return restored.select("l_orderkey", "l_linenumber", "l_partkey",
                           F.round(S.row_rmse(F.col("x"), F.col("xhat")), 6).alias("rmse"))


@query("reconstruct_parts", """with m as (select avg(l_quantity) as mq, avg(l_tax * 100) as mt,
    var_pop(l_quantity) as a, var_pop(l_tax * 100) as c, covar_pop(l_quantity, l_tax * 100) as b from lineitem),
  e as (select *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) as top from m),
  w as (select *, atan2(top - a, b) as angle from e)
select l_orderkey, l_linenumber, l_partkey, round(sqrt((pow(l_quantity - mq, 2) + pow(l_tax * 100 - mt, 2)
  - pow((l_quantity - mq) * cos(angle) + (l_tax * 100 - mt) * sin(angle), 2)) / 2), 5) as rmse from lineitem, w""")
def reconstruct_parts(spark, folder):
    """Error of each row after one of two principal directions; the direction has a closed form."""
    items = t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (F.col("l_tax") * 100).alias("tax"))
    cols = ["l_quantity", "tax"]
    restored = M.reconstruct(M.fit_reconstructor(items, cols, 1), items, cols)
    return restored.select("l_orderkey", "l_linenumber", "l_partkey",
                           F.round(S.row_rmse(F.col("x"), F.col("xhat")), 5).alias("rmse"))


@query("window_reconstruct_mean", """with o as (select event_id, row_number() over (order by ts, event_id) as i,
  value as v3, lag(value) over w as v2, lag(value, 2) over w as v1 from events window w as (order by ts, event_id)),
x as (select event_id, case when i < 3 then 0 else v1 end as a, case when i < 3 then 0 else v2 end as b,
  case when i < 3 then 0 else v3 end as c from o where i < (select max(i) from o)),
m as (select avg(a) ma, avg(b) mb, avg(c) mc from x)
select event_id, round((pow(ma - a, 2) + pow(mb - b, 2) + pow(mc - c, 2)) / 3, 6) as mse from x, m""")
def window_reconstruct_mean(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "ts", "value")
    windows = Q.lookback(events, ["ts", "event_id"], ["value"], 3, inclusive=True)
    restored = M.reconstruct_window(M.fit_window_reconstructor(windows), windows, 3, 1)
    return restored.select(
        "event_id", F.round(S.window_mse(F.col("window"), F.col("window_hat")), 6).alias("mse"))


def mad_sql(rel: str, col: str, mark: str = "") -> dict[str, str]:
    """Common tables med, mad and thr (one row: x) for a column of a relation."""
    med, mad = f"med{mark}", f"mad{mark}"
    return {
        med: f"select median({col}) as m from {rel}",
        mad: f"select median(abs({col} - m)) as d from {rel}, {med}",
        f"thr{mark}": f"""select case when (select d from {mad}) = 0 then (select m from {med}) else
          (select {col} from {rel}, {med}, {mad} where {col} is not null
           order by round(abs(0.976 * abs({col} - m) / nullif(d, 0) - 2.5), 9), {col} limit 1) end as x""",
    }


@query("mad_threshold", with_ctes("", "select x as threshold from thr", **mad_sql("lineitem", "l_extendedprice")))
def mad_threshold(spark, folder):
    items = t.table(spark, folder, "lineitem")
    threshold = S.mad_threshold(items, "l_extendedprice")
    # the fitted number is a data value: show it as the rows that have it
    return items.filter(F.col("l_extendedprice") == threshold).select(
        F.col("l_extendedprice").alias("threshold")).distinct()


@query("mad_score", with_ctes("", """select l_orderkey, l_linenumber, l_partkey,
  round(0.976 * abs(l_extendedprice - m) / d, 6) as z_score from lineitem, med, mad""",
    **mad_sql("lineitem", "l_extendedprice")))
def mad_score(spark, folder):
    items = t.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return S.mad_score(items, "l_extendedprice").withColumn("z_score", F.round("z_score", 6)).drop("l_extendedprice")


@query("label_scores", """select l_orderkey, l_linenumber, l_partkey, l_tax > 0.05 as above, l_tax <= 0.05 as within,
  l_quantity > 3.0 * 10 as far from lineitem""")
def label_scores(spark, folder):
    items = t.table(spark, folder, "lineitem")
    for name, (score, threshold, mode, factor) in {
        "above": ("l_tax", 0.05, "above", 1.0), "within": ("l_tax", 0.05, "within", 1.0),
        "far": ("l_quantity", 3.0, "above", 10.0),
    }.items():
        items = S.label(items, score, threshold, mode, factor).withColumnRenamed("ai_label", name)
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "above", "within", "far")


# ---- similarity --------------------------------------------------------------------

# Documents of one language and source stand in for those of a time bucket.
_DOC_BUCKET = ["lang", "source"]
_DOC_TOKENS = f"""select lang, source, doc_id, token, count(*) as tf
  from (select *, unnest({_TOKENS}) as token from documents) group by all"""
_DOC_PAIRS = """select lang, source, a.doc_id as f_doc_id, b.doc_id as b_doc_id,
    sum(a.tf * b.tf) / sqrt(cast(max(na.n2) * max(nb.n2) as double)) as sim
  from tok a join tok b using (lang, source, token) join norms na on na.doc_id = a.doc_id
    join norms nb on nb.doc_id = b.doc_id
  where a.doc_id < b.doc_id group by all"""
_DOC_CTES = {
    "tok": _DOC_TOKENS,
    "norms": "select doc_id, sum(tf * tf) as n2 from tok group by 1",
    "found": _DOC_PAIRS,
}
_CLASSES = """select lang, source, bag_id as f_id, doc_id as b_id, cast(1 as double) as sim from bags
  where doc_id <> bag_id
union all select lang, source, f_doc_id, b_doc_id, round(sim, 6) from found
  where f_doc_id in (select bag_id from bags) and b_doc_id in (select bag_id from bags)
    and (f_doc_id, b_doc_id) not in (select (f.doc_id, b.doc_id) from bags f join bags b using (bag_id)){}"""
_DOC_CTES["bags"] = """select lang, source, doc_id, min(doc_id) over (partition by lang, source, bag) as bag_id
  from (select lang, source, doc_id, string_agg(token || tf, ' ' order by token) as bag from tok group by all)"""
_ASKED = "(select bag_id from bags where doc_id % 50 = 0)"


def _similar(spark, folder, min_sim, asked=None):
    documents = t.table(spark, folder, "documents")
    found = W.similar_classes(documents, _DOC_BUCKET, "doc_id", "text", min_sim, asked=asked)
    return found.withColumn("sim", F.round("sim", 6))


@query("similar_pairs", with_ctes(
    "", _CLASSES.format(f" and (f_doc_id in {_ASKED} or b_doc_id in {_ASKED})"), **_DOC_CTES))
def similar_pairs(spark, folder):
    """A search: every document with an id divisible by 50 against all of its language and source."""
    return _similar(spark, folder, 0.0, F.col("doc_id") % 50 == 0)


@query("similar_pairs_above", with_ctes("", _CLASSES.format(" and sim > 0.95"), **_DOC_CTES))
def similar_pairs_above(spark, folder):
    return _similar(spark, folder, 0.95)


# ---- streams -----------------------------------------------------------------------


def _event_stream(spark, folder):
    schema = t.table(spark, folder, "events").schema
    stream = K.read_stream(spark, f"{folder}/events.parquet", schema)
    return stream.selectExpr(*t.EVENT_COLUMNS)


def _event_rules(spark):
    return R.load_rules(t.rules(spark))


_EVENT_HITS = " union all ".join(
    f"select hash, ts as time, {r.rule_id}::bigint as single_rule from ev where {r.condition()}" for r in t.RULES)


@query("stream_match_rules", with_ctes("ev", _EVENT_HITS))
def stream_match_rules(spark, folder):
    hits = K.stream_match_rules(_event_stream(spark, folder), _event_rules(spark))
    return K.run_available(hits.select("hash", "time", "single_rule"), "stream-match")


@query("stream_rule_counts", with_ctes("ev", """select bucket, single_rule, count(*) as n from (
  select time_bucket(interval 10 minute, time) as bucket, single_rule from hits) group by 1, 2
having bucket + interval 10 minute <= (select max(ts) from events) - interval 10 minute""", hits=_EVENT_HITS))
def stream_rule_counts(spark, folder):
    # a rule that is always true carries the watermark to the last event
    hits = K.stream_match_rules(_event_stream(spark, folder), [*_event_rules(spark), R.Rule(0, R.LOG, None, None, None)])
    counts = K.stream_rule_counts(hits, "single_rule", "time")
    return K.run_available(counts, "stream-counts").filter("single_rule <> 0")


@query("stream_dedup", with_ctes("ev", "select distinct hash, event_id from ev"))
def stream_dedup(spark, folder):
    events = _event_stream(spark, folder)
    doubled = events.withColumn("_twice", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_twice")
    return K.run_available(K.stream_dedup(doubled).select("hash", "event_id"), "stream-dedup")


@query("stream_append_new", with_ctes("ev", "select hash, event_id from ev"))
def stream_append_new(spark, folder):
    """The same stream stored twice, as after a lost checkpoint: the table holds it once."""
    path = fresh_path(spark, "stream-append")
    for _ in range(2):
        events = _event_stream(spark, folder).select("hash", "event_id", "ts")
        K.stream_append_new(events, path, fresh_path(spark, "append-progress"), ["hash"], "ts")
    return spark.read.parquet(path).select("hash", "event_id")


# ---- stored artefacts --------------------------------------------------------------


@query("snapshot", """select event_id as f_event_id, b_event_id from (
  select event_id, lead(event_id) over (order by ts, event_id) as b_event_id from events) where b_event_id is not null""")
def snapshot(spark, folder):
    pairs = Q.adjacent_pairs(t.table(spark, folder, "events"), ["ts", "event_id"], ["event_id"])
    root = fresh_path(spark, "snapshots")
    sinks.save_snapshot(pairs, root, f"{t.RUN_TIME:%Y%m%d_%H}")
    return sinks.load_snapshot(spark, root, f"{t.RUN_TIME:%Y%m%d_%H}")


@query("read_catalogue", "select distinct p_brand as tag_name, p_type as type from part")
def read_catalogue(spark, folder):
    path = fresh_path(spark, "catalogue")
    parts = t.table(spark, folder, "part").selectExpr("p_brand as tag_name", "p_type as type").distinct()
    parts.write.option("header", True).csv(path)
    return scan.read_catalogue(spark, path)
