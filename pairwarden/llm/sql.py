"""SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = """
with bytes as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), starts as (
  select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as i from bytes where len(h) >= 100
), windows as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 100)) as w from starts
), first as (
  select w, min(doc_id) as d from windows group by w having count(*) > 1
), gone as (
  select doc_id, i from windows join first on windows.w = first.w where first.d < windows.doc_id
), edges as (
  select doc_id, i as p, 1 as step from gone union all select doc_id, i + 50, -1 from gone
), depth as (
  select doc_id, p, sum(sum(step)) over (partition by doc_id order by p) as n,
    lead(p) over (partition by doc_id order by p) as until from edges group by doc_id, p
), runs as (
  select doc_id, min(p) as a, max(until) as b from (
    select *, sum(case when n > 0 and (before is null or before = 0) then 1 else 0 end)
      over (partition by doc_id order by p) as run
    from (select *, lag(n) over (partition by doc_id order by p) as before from depth))
  where n > 0 group by doc_id, run
), pieces as (
  select runs.doc_id, a, b, substr(h, 2 * coalesce(lag(b) over (partition by runs.doc_id order by a), 0) + 1,
    2 * (a - coalesce(lag(b) over (partition by runs.doc_id order by a), 0))) as kept
  from runs join bytes on runs.doc_id = bytes.doc_id
), cut as (
  select doc_id, count(*) as n_spans, sum(b - a) as n_removed, string_agg(kept, '' order by a) as kept, max(b) as last
  from pieces group by doc_id
)
select bytes.doc_id, len(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when n_spans is null then h else kept || substr(h, 2 * last + 1) end)) as kept_sha256
from bytes left join cut on bytes.doc_id = cut.doc_id
"""

OP2 = rf"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), lines as (
  select doc_id, unnest(parts) as line, unnest(range(1, len(parts) + 1)) as i from split
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) as k
  from lines
), frequent as (
  select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10
), marked as (
  select doc_id, i, line, frequent.k is not null as gone from keyed left join frequent on keyed.k = frequent.k
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP6 = f"""
with normal as (
  select doc_id, translate(coalesce(text, ''), {_LOWER}) as t from documents
), sets as (
  select t, max(doc_id) as keep_id, count(*) as group_size from normal group by t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(normal.t) as text_sha256
from normal join sets on normal.t = sets.t
"""

OP9 = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), starts as (
  select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from words where len(ws) >= 13
), windows as (
  select doc_id, i, array_to_string(ws[i:i + 12], ' ') as w from starts
), first as (
  select w, min(doc_id) as d from windows group by w
), gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from windows join first on windows.w = first.w where first.d < windows.doc_id
), each as (
  select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from words
), kept as (
  select each.doc_id, count(*) as n, count(gone.i) as removed,
    string_agg(word, ' ' order by each.i) filter (where gone.i is null) as rest
  from each left join gone on each.doc_id = gone.doc_id and each.i = gone.i group by each.doc_id
)
select words.doc_id, coalesce(n, 0) as n_words, coalesce(removed, 0) as n_removed,
  sha256(coalesce(rest, '')) as kept_sha256
from words left join kept on words.doc_id = kept.doc_id
"""

OP10 = rf"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), sized as (
  select item_id, ws, least(10, len(ws)) as m from item where len(ws) > 0
), places as (
  select item_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from sized
), patterns as (
  select distinct item_id, m, array_to_string(ws[i:i + m - 1], ' ') as p from places
), lengths as (
  select distinct m from patterns
), starts as (
  select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from doc, lengths where len(ws) >= m
), found as (
  select doc_id, i, starts.m, item_id
  from starts join patterns on starts.m = patterns.m and array_to_string(ws[i:i + starts.m - 1], ' ') = p
), hits as (
  select doc_id, count(distinct w) as n_hit
  from (select doc_id, unnest(range(i, i + m)) as w from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id
)
select doc.doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hits on doc.doc_id = hits.doc_id left join items on doc.doc_id = items.doc_id
"""

_CRC = """
xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::bigint)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)),
    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)
"""


def _tree(name: str, levels: int) -> str:
    """Levels of binary trees above ``name``0 (tree, idx, hash), one after the other."""
    steps = (
        f"""{name}{k + 1} as (
  select tree, idx // 2 as idx, case when max(n) > 1 then sha256(string_agg(hash, '' order by idx)) else max(hash) end as hash
  from (select *, count(*) over (partition by tree) as n from {name}{k}) group by tree, idx // 2
)"""
        for k in range(levels)
    )
    return ", ".join(steps)


def _fold(name: str, tree: str, levels: int) -> str:
    """``name``0 (r, tree, idx, node, proof) folded along the siblings of each level."""
    steps = (
        f"""{name}{k + 1} as (
  select r, p.tree, p.idx // 2 as idx, proof || coalesce(s.hash, '') as proof,
    case when t.n = 1 then node when s.hash is null then sha256(node)
      when p.idx % 2 = 1 then sha256(s.hash || node) else sha256(node || s.hash) end as node
  from {name}{k} p join (select tree, count(*) as n from {tree}{k} group by tree) t on p.tree = t.tree
  left join {tree}{k} s on p.tree = s.tree and xor(p.idx, 1) = s.idx
)"""
        for k in range(levels)
    )
    return ", ".join(steps)


_TREE_LEVELS, _TOP_LEVELS = 17, 6  # enough for 2^17 rows a language and 2^6 languages


def _field(name: str) -> str:
    return f"case when {name} is null then '-' else strlen({name}::varchar)::varchar || ':' || {name}::varchar end"


OP12 = f"""
with rows as (
  select *, row_number() over () as r, case when lang is null then '' else '=' || lang end as tree from documents
), hashed as (
  select r, tree, doc_id, sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) as leaf,
    case when doc_id is not null and ({_CRC}) % 7 = 0 then sha256({" || ".join(
        map(_field, ("doc_id", "source", "lang", "(n_chars + 1)", "text")))}) end as tampered from rows
), leaves as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf, r) - 1 as idx from hashed
), t0 as (
  select tree, idx, leaf as hash from leaves
), {_tree("t", _TREE_LEVELS)}, u0 as (
  select '' as tree, tree as name, row_number() over (order by tree) - 1 as idx, hash from t{_TREE_LEVELS}
), {_tree("u", _TOP_LEVELS)}, f0 as (
  select r, tree, idx, coalesce(tampered, leaf) as node, '' as proof from leaves
), {_fold("f", "t", _TREE_LEVELS)}, g0 as (
  select r, '' as tree, u0.idx as idx, node, proof from f{_TREE_LEVELS} f join u0 on f.tree = u0.name
), {_fold("g", "u", _TOP_LEVELS)}
select doc_id, leaf, u0.hash as subroot, top.hash as root, sha256(proof) as proof_sha256, node as folded_root,
  node = top.hash as verified
from leaves join g{_TOP_LEVELS} g on leaves.r = g.r join u0 on leaves.tree = u0.name cross join u{_TOP_LEVELS} top
"""

OP13 = rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), {_LOWER}) as t from documents
), words as (
  select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term from words group by lang, term having count(distinct r) >= 30
), cells as (
  select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all
), groups as (
  select lang, source, coalesce(sum(c), 0) as n from (select distinct lang, source from docs)
  left join cells using (lang, source) group by all
), sizes as (
  select lang, count(*) as v from kept group by lang
), dense as (
  select lang, source, term, coalesce(c, 0) as c,
    1 + (1000000000::hugeint * (coalesce(c, 0) + 5)) // (n + 5 * v) as p
  from groups join kept using (lang) join sizes using (lang) left join cells using (lang, source, term)
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (sum(c) + 5)) // (max(n) + 5 * max(v)) as q
  from dense join (select lang, sum(n) as n from groups group by lang) using (lang) join sizes using (lang)
  group by lang, term
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(d, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (
    select x.lang, x.source, y.source as other, sum(abs(x.p - y.p)) as d
    from dense x join dense y on x.lang = y.lang and x.term = y.term group by all
  ) far on far.lang = a.lang and far.source = a.source and far.other = b.source
  union all
  select lang, source, 'term', term, p - q from dense join whole using (lang, term) where c > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 50
"""
