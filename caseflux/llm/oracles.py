"""DuckDB SQL for the pN queries that SQL can express over whole tables."""

from __future__ import annotations

from caseflux.llm.fusion import FILLERS

_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'))"
_SIM = "len(list_intersect(a.w, b.w)) * 1.0 / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.6"
_TEXTS = f"(select * from (select distinct enriched_event_id as id, {_WORDS.format('summary')} as w from extracted_event_details where summary is not null and enriched_event_id is not null) where len(w) > 0)"

# two summaries with 0.6 of their words in common share a word that at most 2 % of the rows have
_PAIRS = f"""t as (select * from {_TEXTS}), u as (select id, unnest(w) as x from t), o as (select x from u group by 1 having count(*) between 2 and greatest(40, (select count(*) from t) / 50)), k as (select u.id, u.x from u join o using (x)),
c as (select distinct a.id as i, b.id as j from k a join k b on a.x = b.x and a.id < b.id), p as (select i, j from c join t a on a.id = c.i join t b on b.id = c.j where {_SIM})"""

P3 = f"""with {_PAIRS} select 'summary' as field, i as left_id, j as right_id from p
union all select distinct 'title', least(l, r), greatest(l, r) from (select a.l, a.r, a.w, b.w as v from (select left_enriched_event_id as l, right_enriched_event_id as r, {_WORDS.format('title_left')} as w, {_WORDS.format('title_right')} as v from match_evidence where title_left is not null and title_right is not null) a,
 (select 1) one(x), lateral (select a.v as w) b where len(a.w) > 0 and len(b.w) > 0 and {_SIM}) where l <> r"""

P1 = f"""with s as (select distinct x.batch_id, x.enriched_event_id as id, b.opened_at, b.state from decisions x join batches b using (batch_id) where x.enriched_event_id is not null and b.opened_at is not null), f as (select id, min(opened_at) as first_open from s group by 1),
{_PAIRS}, q as (select i, j from p union all select j, i from p), n as (select q.i as id, min(f.first_open) as near_open from q join f on f.id = q.j group by 1)
select distinct s.batch_id, s.id as enriched_event_id from s join f using (id) left join n using (id) where s.state = 'new' and least(f.first_open, coalesce(n.near_open, f.first_open)) < s.opened_at"""

P5 = """with recursive e as (select distinct enriched_event_id as a, deduplicated_event_id as g from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null and enriched_event_id is not null),
m as (select g, min(a) as m from e group by 1), l as (select distinct a as s, m as t from e join m using (g) where a <> m), b as (select s, t from l union select t, s from l), r(s, t) as (select s, t from b union select r.s, b.t from r join b on r.t = b.s)
select s as enriched_event_id, least(s, min(t)) as group_id from r group by s"""

_FILL = ", ".join("'" + f + "'" for f in FILLERS)
_TEXT = "case when lower(trim(regexp_replace({0}, '[\\s\\x{{00A0}}]+', ' ', 'g'))) not in (" + _FILL + ") then trim({0}) end"
_DAY = """coalesce(try_cast(nullif(regexp_extract(trim(date_left), '^(\\d{4}-\\d{1,2}-\\d{1,2})([T ].*)?$', 1), '') as date), try_strptime(trim(date_left), '%d %B %Y')::date, try_strptime(trim(date_left), '%d %b %Y')::date, try_strptime(trim(date_left), '%B %d, %Y')::date, try_strptime(trim(date_left), '%b %d, %Y')::date)"""
P4 = f"""with s as (select deduplicated_event_id, arg_max(payload_json, (created_at, snapshot_id)) as p from snapshots where json_valid(payload_json) group by 1), m as (select deduplicated_event_id, unnest(json_extract(p, '$.members[*]')) as j from s),
v as (select left_enriched_event_id as id, max(case when {_DAY} <= date '2025-12-31' then {_DAY} end) as event_date, max({_TEXT.format('entity_canonical_left')}) as entity_canonical from match_evidence group by 1),
f as (select deduplicated_event_id, j->>'$.enriched_event_id' as id, (j->>'$.data_source_weight')::double as w, replace(j->>'$.updated_at', 'T', ' ')::timestamp as u, {_TEXT.format("(j->>'$.title')")} as title, {_TEXT.format("(j->>'$.severity')")} as severity,
 case when regexp_matches(replace(j->>'$.records_affected', ',', ''), '^\\d+$') then 'x' end as records_affected, {_TEXT.format("(j->>'$.attack_method')")} as attack_method from m),
g as (select f.*, v.event_date, v.entity_canonical from f left join v using (id)), c as (select deduplicated_event_id, id, w, u, unnest(['title', 'severity', 'records_affected', 'attack_method', 'event_date', 'entity_canonical']) as field_name, unnest([title, severity, records_affected, attack_method, event_date::varchar, entity_canonical]) as value from g)
select deduplicated_event_id, field_name, id as enriched_event_id from (select *, row_number() over (partition by deduplicated_event_id, field_name order by w desc nulls last, u desc nulls last, id) as k from c where value is not null) where k = 1"""

ORACLES = {"p1_found": P1, "p3_found": P3, "p4_found": P4, "p5_found": P5}
