"""Who is meant: candidate tests, canonical groups, merged entities, victims and roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.operators.components import connected_components
from caseflux.plans.dialect import run, sql_query
from caseflux.plans.kernels import ATTACKERS, DESCRIPTIVE, INCIDENT, NEUTRAL, NON_ORGANISATION, PAIRS, PERSON, REGULATORS, SUBUNITS, core, jaccard, structured, word_set, words
from caseflux.plans.registry import query
from caseflux.plans.resolution import KEY, TOKENS
from caseflux.plans.series import EV, MEMBERS, RISKED
from caseflux.session import Workspace

#: Every organisation an article names, with its part in the article.
LINKS = "(select distinct enriched_event_id, primary_entity as name, 'victim' as role from extracted_event_details where trim(primary_entity) <> '' union select distinct enriched_event_id, name, 'affected' as role from (select enriched_event_id, unnest(affected_entities) as name from extracted_event_details) where trim(name) <> '')"

# D02: aliases learned from evidence; the latest and surest spelling of a raw name stays
ALIASES = "(select raw_name, max_by(canonical, (n, canonical)) as canonical, sum(n)::bigint as support from (select entity_left as raw_name, entity_canonical_left as canonical, count(distinct decision_id) as n from match_evidence where trim(entity_left) <> '' and trim(entity_canonical_left) <> '' group by 1, 2) group by 1)"
sql_query("d02_learned_aliases", f"select raw_name, canonical, support from {ALIASES}", "Upsert of aliases by raw name: the spelling with most support stays.")

# D03 / D04 on the pairs of the evidence
RARE = f"(select token from (select unnest(list_distinct({TOKENS.format('entity_name')})) as token from entities) group by token having count(*) <= greatest(3, (select floor(count(*) * 0.005) from entities)))"
_TOKEN_PAIRS = f"(select l, r, {KEY.format('l')} as kl, {KEY.format('r')} as kr, list_distinct({TOKENS.format('l')}) as a, list_distinct({TOKENS.format('r')}) as b from {PAIRS})"
sql_query(
    "d03_loose_candidates",
    f"select l, r, coalesce(kl = kr, false) or (len(a) > 0 and len(b) > 0 and array_to_string(list_slice(a, 1, 2), ' ') = array_to_string(list_slice(b, 1, 2), ' ')) or greatest({jaccard('a', 'b')}, case when least(len(a), len(b)) = 0 then 0.0 else 0.95 * len(list_intersect(a, b)) / least(len(a), len(b)) end) >= 0.9 as candidates from (select l, r, kl, kr, list_sort(a) as a, list_sort(b) as b from {_TOKEN_PAIRS})",
    "Loose test for blocking: same key, a shared block (the first two telling words in text order) or similarity of at least 0.9.",
)
QUALIFIERS = "'singtel', 'pty', 'limited', 'airways', 'online', 'digital', 'retail', 'operations', 'enterprises', 'trading', 'australasia', 'apac', 'asia', 'pacific', 'worldwide', 'brands'"
sql_query(
    "d04_same_organisation",
    f"""with t as (select l, r, kl, kr, list_sort(a) as a, list_sort(b) as b from {_TOKEN_PAIRS}), s as (select *, case when len(a) <= len(b) then a else b end as small, case when len(a) <= len(b) then b else a end as big from t), x as (select l, r, kl, kr, a, b, small, len(list_intersect(a, b)) = len(small) as inside, len(list_filter(big, lambda w: not list_contains(small, w) and w not in ({QUALIFIERS}))) = 0 as qualified from s)
    select l, r, coalesce(kl = kr and kl <> '', false) or (len(a) > 0 and len(b) > 0 and (a = b or (inside and (qualified or (len(small) = 1 and exists (select 1 from {RARE} q where q.token = list_extract(small, 1))))))) as same from x""",
    "Strict test: equal words, or a subset where the rest only qualifies or the one word is rare.",
)

# D05 / D06: blocks, then structure, then components
sql_query("d05_items_by_block", f"with k as (select entity_id, {KEY.format('entity_name')} as key, {TOKENS.format('entity_name')} as t from entities), b as (select entity_id, key as block from k union select entity_id, array_to_string(t, ' ') from k union select entity_id, array_to_string(list_slice(t, 1, 2), ' ') from k where len(t) >= 2 union select entity_id, unnest(t) from k) select block, entity_id from b where block <> '' and block in (select block from b group by block having count(distinct entity_id) between 2 and 200)", "Items under every block key that two to 200 of them share; wider blocks tell nothing apart.")
#: Edges of names: equal key, or one structure within the block of an identifying word (at most as many names as there are spellings of one word).
_CORE = f"(select distinct name, unnest({core(words('name'))}) as block from (select distinct name from {LINKS}))"
NAME_EDGES = f"(select l, r from (select a.name as l, b.name as r from (select distinct name, {KEY.format('name')} as k from {LINKS}) a join (select k, min(name) as name from (select distinct name, {KEY.format('name')} as k from {LINKS}) group by k) b on a.k = b.k where a.name <> b.name) union select l, r from {structured('(select distinct a.name as l, b.name as r from ' + _CORE + ' a join (select block, min(name) as name from ' + _CORE + ' group by block) b on a.block = b.block where a.name <> b.name)')} where same)"
USAGE = f"(select name, count(distinct enriched_event_id) as used from {LINKS} group by name)"


@query(
    "d06_canonical_groups",
    f"""with recursive e as (select l, r from {NAME_EDGES} union select r, l from {NAME_EDGES}), n as (select name from {USAGE}), reach(s, t) as (select name, name from n union select reach.s, e.r from reach join e on reach.t = e.l), g as (select s as name, min(t) as label from reach group by s),
    m as (select g.label, g.name, u.used from g join {USAGE} u on u.name = g.name) select label, max_by(name, (not (name = upper(name)), not (name = lower(name)), used, length(name), name)) as preferred, count(*) as variants, sum(used)::bigint as used from m group by label""",
)
def d06(spark, d):
    """Names of one organisation: edges by key and by structure, joined over any number of steps, with the preferred spelling."""
    edges = run(spark, d, f"select l, r from {NAME_EDGES}")
    used = run(spark, d, f"select name, used from {USAGE}")
    labels = connected_components(edges, Workspace(spark, "d06"), "l", "r").withColumnRenamed("node", "name")
    groups = used.join(labels, "name", "left").withColumn("label", F.coalesce("label", "name"))
    best = F.struct(F.col("name") != F.upper("name"), F.col("name") != F.lower("name"), "used", F.length("name"), "name")
    return groups.groupBy("label").agg(F.max_by("name", best).alias("preferred"), F.count("*").alias("variants"), F.sum("used").alias("used"))


#: Winner of each key: the spelling that is used most.
WINNERS = f"(select k, max_by(name, (used, length(name), name)) as keep from (select u.name, u.used, {KEY.format('u.name')} as k from {USAGE} u) group by k)"
sql_query(
    "d07_merged_entities",
    f"select keep as entity, l.role, count(distinct l.enriched_event_id) as links, count(distinct l.name) - 1 as dropped from (select name, enriched_event_id, role, {KEY.format('name')} as k from {LINKS}) l join {WINNERS} w on w.k = l.k group by keep, l.role",
    "Links of losing spellings point to the winner; links that then say the same count once.",
)
sql_query(
    "d08_inherited_attributes",
    f"select k, max_by(entity_name, (employee_count is not null, length(entity_name), entity_name)) as keep, max_by(industry, (industry is not null, entity_id)) as industry, max(employee_count) as employee_count, max_by(turnover, (turnover is not null, entity_id)) as turnover, count(*) as merged from (select *, {KEY.format('entity_name')} as k from entities) group by k",
    "Blanks of the survivor filled from those merged into it.",
)
sql_query("z07_entities_to_insert", f"select distinct l.name from {LINKS} l where not exists (select 1 from entities e where e.entity_name = l.name)", "Names that an upsert by unique name would add.")
sql_query("z73_renamed_links", f"select l.name, w.keep, count(distinct l.enriched_event_id) as events from (select name, enriched_event_id, {KEY.format('name')} as k from {LINKS}) l join {WINNERS} w on w.k = l.k where l.name <> w.keep group by l.name, w.keep", "What a run over all names renames.")

# victims: mentions by incident, folded by key
MENTIONS = f"(select m.deduplicated_event_id as g, {KEY.format('l.name')} as k, l.name, l.enriched_event_id as a from {MEMBERS} m join {LINKS} l on l.enriched_event_id = m.enriched_event_id)"
SIZES = f"(select deduplicated_event_id as g, count(*) as members from {MEMBERS} group by 1)"
SHARES = f"(select x.g, x.k, max_by(x.name, (regexp_matches(x.name, '(?i)(pty|ltd|limited|inc)\\.?$')::int, length(x.name), x.name)) as name, least(1.0, count(distinct x.a)::double / max(s.members)) as share from {MENTIONS} x join {SIZES} s on s.g = x.g where x.k <> '' group by x.g, x.k)"
sql_query("z33_mention_shares", f"select g as deduplicated_event_id, k as name_key, name, round(share, 6) as share from {SHARES}", "Share of an incident's articles that mention a name in any variant, at most one.")
_UBIQUITOUS = f"(select k from {SHARES} group by k having count(*) > greatest(8, (select floor(count(distinct g) * 0.02) from {SHARES})))"
_TITLES = f"(select m.deduplicated_event_id as g, min(e.title) as title from {MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id group by 1)"
SCORE = f"""(10 * share + case when title is not null and contains(lower(title), k) then 6 when title is not null and contains(lower(title), list_extract(string_split(k, ' '), 1)) then 4 else 0 end - case when common then 8 else 0 end - case when regexp_matches(lower(name), '\\b({REGULATORS})\\b') then 12 else 0 end - case when {PERSON.format(x='name')} then 3 else 0 end - case when length(k) < 4 then 5 else 0 end - case when {NON_ORGANISATION.format(x='name')} then 100 when regexp_matches(lower(name), '\\b({ATTACKERS})\\b') then 80 when {DESCRIPTIVE.format(x='name')} then 50 else 0 end)::double"""
SCORED = f"(select s.g, s.k, s.name, s.share, {SCORE} as score from (select s.*, t.title, q.k is not null as common from {SHARES} s left join {_TITLES} t on t.g = s.g left join {_UBIQUITOUS} q on q.k = s.k) s)"
sql_query("x38_victim_scores", f"select g as deduplicated_event_id, name, round(score, 6) as score from {SCORED}", "How well a name fits as an incident's victim: share, title, and what speaks against it.")
_CURRENT = f"(select deduplicated_event_id as g, max(victim_organization_name) as current_name from {RISKED} group by 1)"
BEST = f"(select g, max_by(name, (score, share, name)) as name, max(score) as score, max_by(share, (score, share, name)) as share from {SCORED} group by g)"
sql_query(
    "d10_derived_victims",
    f"select b.g as deduplicated_event_id, case when b.score < 0 then c.current_name when c.current_name is not null and {KEY.format('c.current_name')} = {KEY.format('b.name')} then c.current_name else b.name end as victim, round(b.score, 6) as score from {BEST} b left join {_CURRENT} c on c.g = b.g",
    "Victim with the best score; the current name stays where it means the same or nothing scores.",
)
sql_query(
    "d11_replacement_policy",
    f"""select b.g as deduplicated_event_id, case when c.current_name is null then 'fill' when {KEY.format('c.current_name')} = {KEY.format('b.name')} then 'keep: same name' when {NON_ORGANISATION.format(x='c.current_name')} then 'replace: no organisation' when regexp_matches(lower(c.current_name), '\\b({ATTACKERS})\\b') then 'replace: attacker' when coalesce(s.share, 0) = 0 and b.share >= 0.5 then 'replace: never mentioned' when b.share >= coalesce(s.share, 0) + 0.3 then 'replace: far better support' else 'keep: not enough support' end as decision
    from {BEST} b left join {_CURRENT} c on c.g = b.g left join {SHARES} s on s.g = b.g and s.k = {KEY.format('c.current_name')} where b.score >= 0""",
    "Whether a derived victim replaces the stored one, and why.",
)
# Words that decide the kind of a name.
KIND = f"case when regexp_matches(lower({{x}}), '\\b({REGULATORS})\\b') then 'regulator' when regexp_matches(lower({{x}}), '\\b({ATTACKERS})\\b') then 'attacker' when regexp_matches(lower({{x}}), 'department|council|government|authority') then 'government' when {PERSON.format(x='{x}')} then 'individual' when {NON_ORGANISATION.format(x='{x}')} then 'descriptive' else 'organisation' end"
sql_query("d38_entity_kinds", f"select distinct name, {KIND.format(x='name')} as kind from {LINKS}", "Kind of a name by rules.")
ROLES = f"(select g, k, name, share, case when kind in ('regulator', 'attacker') then kind when share = max(share) over (partition by g) then 'victim' when regexp_matches(lower(name), 'software|systems|technology|cloud|hosting|analytics') then 'vendor' when kind = 'descriptive' then 'mentioned' else 'affected' end as role from (select *, {KIND.format(x='name')} as kind from {SHARES}))"
sql_query("m08_role_assignments", f"select g as deduplicated_event_id, name, role from {ROLES}", "Role of every name of an incident by rules: the stand-in of a model.")
VICTIM = f"(select g, max_by(name, (share, name)) filter (where role = 'victim') as victim, max_by(name, (share, name)) filter (where role = 'vendor') as vendor from {ROLES} group by g)"
sql_query("d39_victim_and_vendor", f"select g as deduplicated_event_id, victim, vendor from {VICTIM}", "Victim and vendor from the roles, the best supported of each.")
sql_query(
    "d40_localised_victims",
    f"""select v.g as deduplicated_event_id, case when e.is_australian is false and l.name is not null then l.name else v.victim end as victim, case when e.is_australian is false and l.name is not null then v.victim else v.vendor end as vendor, case when e.is_australian is false and l.name is not null then 'foreign name demoted' when v.victim is null then 'none' else 'kept' end as reason
    from {VICTIM} v left join entities e on e.entity_name = v.victim left join (select r.g, max_by(r.name, (r.share, r.name)) as name from {ROLES} r join entities a on a.entity_name = r.name and a.is_australian group by r.g) l on l.g = v.g and l.name <> v.victim""",
    "A foreign victim gives way to a local one and becomes the vendor.",
)
sql_query(
    "d37_reconciled_by_victim",
    f"select k, count(*) as incidents, min(g) as keep, sum(members)::bigint as members from (select r.deduplicated_event_id as g, {KEY.format('r.victim_organization_name')} as k, coalesce(s.members, 0) as members from {RISKED} r left join {SIZES} s on s.g = r.deduplicated_event_id where trim(r.victim_organization_name) <> '') where k <> '' group by k having count(*) >= 2",
    "Incidents of one victim, to be looked at together.",
)
sql_query(
    "z36_named_descriptions",
    f"select d.g as deduplicated_event_id, d.name as phrase, coalesce(s.name, '') as replacement from (select g, name from {SHARES} where {DESCRIPTIVE.format(x='name')}) d left join (select g, max_by(name, (share, name)) as name from {SHARES} where not {DESCRIPTIVE.format(x='name')} group by g) s on s.g = d.g",
    "A descriptive name gives way to the best supported proper name beside it.",
)
sql_query(
    "z37_invalid_stored_victims",
    f"select r.deduplicated_event_id, coalesce(case when a.role in ('regulator', 'attacker', 'vendor') then 'role: ' || a.role end, case when {KIND.format(x='r.victim_organization_name')} in ('regulator', 'attacker', 'descriptive') then 'kind: ' || {KIND.format(x='r.victim_organization_name')} end, case when length(trim(r.victim_organization_name)) < 3 then 'name: short' end) as reason from (select deduplicated_event_id, max(victim_organization_name) as victim_organization_name from {RISKED} where victim_organization_name is not null group by 1) r left join (select g, k, min(role) as role from {ROLES} group by g, k) a on a.g = r.deduplicated_event_id and a.k = {KEY.format('r.victim_organization_name')}",
    "Why a stored victim cannot be one: by role, then kind, then name.",
)
sql_query("z38_role_links", f"select x.name, x.role, count(distinct x.a) as links from (select r.g, r.name, r.role, m.a from {ROLES} r join {MENTIONS} m on m.g = r.g and m.k = r.k) x group by x.name, x.role", "Roles carried over to the links of articles.")
sql_query("z39_stored_sizes", "select entity_id, coalesce(size_employees, employee_count) as employee_count, coalesce(size_method, 'none') as method, employee_count is null and size_employees is not null as written_through from entities", "Estimates stored; a missing headcount is written through.")
sql_query("z40_shared_lookups", f"select name_key, count(*) as variants, max(found) as employee_count from (select distinct l.name, {KEY.format('l.name')} as name_key, e.employee_count as found from {LINKS} l left join (select {KEY.format('entity_name')} as k, max(employee_count) as employee_count from entities group by 1) e on e.k = {KEY.format('l.name')}) group by name_key", "One lookup for all spellings of a key.")
sql_query("z74_displayed_organisations", f"select m.deduplicated_event_id, coalesce(max(case when r.victim_organization_name is not null and not {NON_ORGANISATION.format(x='r.victim_organization_name')} then r.victim_organization_name end), min(case when e.primary_entity is not null and not {NON_ORGANISATION.format(x='e.primary_entity')} then e.primary_entity end)) as shown from {MEMBERS} m left join {RISKED} r on r.deduplicated_event_id = m.deduplicated_event_id left join {EV} e on e.enriched_event_id = m.enriched_event_id group by 1", "The stored organisation, else the first usable one of the members.")
sql_query(
    "d16_best_titles",
    f"""with c as (select m.deduplicated_event_id as g, e.enriched_event_id as a, trim(regexp_replace(e.title, '\\s+', ' ', 'g')) as t, {KEY.format('e.primary_entity')} as k from {MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id where trim(e.title) <> ''),
    p as (select g, a, k, t, regexp_split_to_array(t, ' [|] ') as bars from c), q as (select g, a, k, case when len(bars) > 1 and length(list_extract(bars, len(bars))) between 2 and 40 and length(list_extract(bars, 1)) >= 20 and regexp_matches(lower(list_extract(bars, 1)), '{INCIDENT}') then list_extract(bars, 1) else t end as t from p),
    s as (select g, a, t, (2 * least(3, len(list_distinct(regexp_extract_all(lower(t), '{INCIDENT}', 0)))) + case when k is not null and k <> '' and contains(lower(t), list_extract(string_split(k, ' '), 1)) then 3 else 0 end + case when length(t) between 20 and 95 then 2 when length(t) < 20 then -3 else -1 end - case when t = upper(t) then 2 else 0 end + case when regexp_matches(t, '\\(([A-Z][a-z]+ )?[0-9]{{4}}\\)$') then 1.5 else 0 end)::double as score from q),
    u as (select r.deduplicated_event_id as g, min(r.title) as stored from asd_risk_classifications_20251118_154100 r group by 1)
    select s.g as deduplicated_event_id, case when coalesce(max(case when s.t = u.stored then s.score end), -99) >= max(s.score) then min(u.stored) else max_by(s.t, (s.score, -length(s.t), s.t)) end as title, max(s.score) as score from s left join u on u.g = s.g group by s.g""",
    "Best title over the members: incident words, the victim, length, no shouting; the stored one stays on a tie.",
)
