"""Ledger, lineage, intake, scans and exports (SURVEY L, K, S rows and the Z rows around them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.plans.dialect import run, sql_query
from caseflux.plans.identity import LINKS
from caseflux.plans.kernels import INCIDENT, hits
from caseflux.plans.ledger import NOW_MEMBERS
from caseflux.plans.registry import query
from caseflux.plans.resolution import KEY
from caseflux.plans.series import EV, MEMBERS, RISK, RISKED
from caseflux.session import Workspace
from caseflux.sources import sinks
from caseflux.sources.tables import table

LIVE = "(select distinct decision_id, batch_id, enriched_event_id, deduplicated_event_id, cluster_key, action, decided_by, certainty, created_at from decisions where superseded_by is null and decision_id is not null)"
sql_query("l01_live_decisions", f"select decision_id, enriched_event_id, deduplicated_event_id, action from {LIVE}", "Live view of the append-only ledger: what nothing supersedes, rows delivered twice once.")
# L02: incidents that one article ties together are merged into the least of them
_TIED = f"(select a.deduplicated_event_id as source, min(b.target) as target from {NOW_MEMBERS} a join (select enriched_event_id, min(deduplicated_event_id) as target from {NOW_MEMBERS} group by 1) b on b.enriched_event_id = a.enriched_event_id group by 1)"
sql_query(
    "l02_merged_incidents",
    f"""select t.source, t.target, 'Merged' as source_status, count(distinct m.enriched_event_id) as moved, array_to_string(list_sort(list(distinct m.enriched_event_id)), '|') as snapshot, min(e.event_date)::varchar as event_date from {_TIED} t join {NOW_MEMBERS} m on m.deduplicated_event_id = t.source left join {EV} e on e.enriched_event_id = m.enriched_event_id where t.source <> t.target group by 1, 2""",
    "Merges of tied incidents: snapshot of the source, members moved, source marked, earliest day.",
)
_GONE = f"(select distinct x.enriched_event_id, x.deduplicated_event_id from {LIVE} x where x.action = 'revert' and x.enriched_event_id is not null and x.deduplicated_event_id is not null)"
_MASTER = f"(select deduplicated_event_id, min(enriched_event_id) as master, count(*) as n from {MEMBERS} group by 1)"
sql_query(
    "l03_split_outcomes",
    f"select g.enriched_event_id, g.deduplicated_event_id, case when o.other is not null then 'reattached' when s.n is null then 'incident closed' when s.master > g.enriched_event_id then 'next member promoted' else 'own incident' end as outcome, coalesce(o.other, substr(sha256(g.enriched_event_id), 1, 32)) as now_in from {_GONE} g left join (select m.enriched_event_id, min(m.deduplicated_event_id) as other from {NOW_MEMBERS} m group by 1) o on o.enriched_event_id = g.enriched_event_id and o.other <> g.deduplicated_event_id left join {_MASTER} s on s.deduplicated_event_id = g.deduplicated_event_id",
    "Where an article goes that is split off: back to another incident, or its own; a master hands over to the next member, an incident without members closes.",
)
sql_query(
    "l05_recomputed_identity",
    f"select m.deduplicated_event_id, max_by(e.title, (len(list_distinct(regexp_extract_all(lower(coalesce(e.title, '')), '{INCIDENT}', 0))), -length(coalesce(e.title, '')), coalesce(e.title, ''))) as title, min(e.event_date)::varchar as first_day, count(*) as members from {NOW_MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id group by 1",
    "Title and earliest day from the remaining members.",
)
sql_query(
    "l06_calibrated_threshold",
    "select n, false_merges, missed_merges, round(case when n < 5 or false_merges = missed_merges then 0.9 else least(0.97, greatest(0.60, 0.9 + case when false_merges > missed_merges then 0.02 else -0.02 end)) end, 4)::double as threshold from (select count(*) as n, count(*) filter (where action = 'revert') as false_merges, count(*) filter (where action = 'merge') as missed_merges from (select distinct decision_id, action from decisions where decided_by = 'human' and action in ('merge', 'revert')))",
    "Merge threshold after what humans corrected: a step of 0.02 where five or more lean one way.",
)
sql_query(
    "l07_ancestry_trees",
    f"""select d.g as deduplicated_event_id, '{{"incident":"' || d.g || '","decisions":[' || d.decisions || '],"members":[' || coalesce(m.members, '') || ']}}' as tree from (select deduplicated_event_id as g, array_to_string(list_sort(list(distinct '{{"id":"' || decision_id || '","action":"' || coalesce(action, '') || '","live":' || (superseded_by is null)::varchar || '}}')), ',') as decisions from decisions where deduplicated_event_id is not null and decision_id is not null group by 1) d
    left join (select deduplicated_event_id as g, array_to_string(list_sort(list('"' || enriched_event_id || '"')), ',') as members from {MEMBERS} group by 1) m on m.g = d.g""",
    "Ancestry of an incident as nested JSON: its decisions and its members.",
)
sql_query("l08_merge_lineage", f"select m.deduplicated_event_id, min(m.enriched_event_id) as master, array_to_string(list_sort(list(m.enriched_event_id || ':' || coalesce(x.decided_by, 'none'))), '|') as lineage, round(avg(x.certainty), 6)::double as certainty from {MEMBERS} m left join (select enriched_event_id, deduplicated_event_id, min(decided_by) as decided_by, max(certainty) as certainty from {LIVE} where action = 'merge' group by 1, 2) x on x.enriched_event_id = m.enriched_event_id and x.deduplicated_event_id = m.deduplicated_event_id group by 1", "Lineage of each incident with who decided.")
_SNAPPED = "(select distinct deduplicated_event_id from snapshots where deduplicated_event_id is not null)"
sql_query(
    "l09_backfill_rows",
    f"select 'lineage' as part, m.deduplicated_event_id, m.enriched_event_id as item from {MEMBERS} m where not exists (select 1 from {_SNAPPED} s where s.deduplicated_event_id = m.deduplicated_event_id) union all select 'entity', m.deduplicated_event_id, l.name from {MEMBERS} m join {LINKS} l on l.enriched_event_id = m.enriched_event_id where not exists (select 1 from {RISKED} r where r.deduplicated_event_id = m.deduplicated_event_id and r.victim_organization_name = l.name) group by 1, 2, 3",
    "Rows that a backfill of lineage and entities would insert; run again after them it finds none.",
)
sql_query("l10_vault", f"select s.master, r.severity_category, r.industry, n.deduplicated_event_id as restored_to from (select deduplicated_event_id, min(severity_category) as severity_category, max(victim_organization_industry) as industry from {RISKED} group by 1) r join {_MASTER} s on s.deduplicated_event_id = r.deduplicated_event_id join (select master, min(deduplicated_event_id) as deduplicated_event_id from {_MASTER} group by 1) n on n.master = s.master", "What a rebuild must not lose, kept under the stable article id and put back by it.")
sql_query("z77_industries_to_restore", f"select n.deduplicated_event_id, a.industry as stored, b.industry as kept from (select deduplicated_event_id, max(victim_organization_industry) as industry from {RISKED} group by 1) a join {_MASTER} n on n.deduplicated_event_id = a.deduplicated_event_id join (select s.master, max(r.industry) as industry from (select deduplicated_event_id, max(victim_organization_industry) as industry from asd_risk_classifications_20251118_153149 group by 1) r join {_MASTER} s on s.deduplicated_event_id = r.deduplicated_event_id group by 1) b on b.master = n.master where a.industry is distinct from b.industry", "Industries put back only where they differ.")
_SNAP_MEMBERS = "(select s.deduplicated_event_id, array_to_string(list_sort(regexp_extract_all(s.payload, '\"enriched_event_id\": \"[0-9a-f-]+\"', 0)), '|') as ids from (select deduplicated_event_id, max_by(payload_json, (created_at, snapshot_id)) as payload from snapshots where deduplicated_event_id is not null and json_valid(payload_json) group by 1) s)"
_NOW_IDS = f"(select deduplicated_event_id, array_to_string(list_sort(list('\"enriched_event_id\": \"' || enriched_event_id || '\"')), '|') as ids from {MEMBERS} group by 1)"
sql_query("l11_refresh_queue", f"select n.deduplicated_event_id, case when s.ids is null then 'never' when s.ids <> n.ids then 'outdated' end as reason from {_NOW_IDS} n left join {_SNAP_MEMBERS} s on s.deduplicated_event_id = n.deduplicated_event_id where s.ids is null or s.ids <> n.ids", "Incidents whose members changed since roles were last derived.")
sql_query("a31_staleness", f"select case when s.ids is null then 'never' when s.ids <> n.ids then 'outdated' else 'current' end as state, count(*) as n from {_NOW_IDS} n left join {_SNAP_MEMBERS} s on s.deduplicated_event_id = n.deduplicated_event_id group by 1", "Current, outdated and never derived incidents.")
sql_query("l12_repaired_mappings", f"select m.deduplicated_event_id as orphan, m.enriched_event_id, coalesce(k.target, m.deduplicated_event_id) as repaired from (select distinct enriched_event_id, deduplicated_event_id, cluster_key from {LIVE} where action = 'merge' and deduplicated_event_id is not null and enriched_event_id is not null) m left join (select x.cluster_key, min(x.deduplicated_event_id) as target from {LIVE} x join {RISKED} r on r.deduplicated_event_id = x.deduplicated_event_id where x.action = 'merge' group by 1) k on k.cluster_key = m.cluster_key where not exists (select 1 from {RISKED} r where r.deduplicated_event_id = m.deduplicated_event_id)", "Mappings to incidents that are gone, pointed to the incident of their cluster.")

# intake
_SEEN = "(select max(discovered_at) as last_seen from extracted_event_details)"
_TRIPLE = "(select coalesce(primary_entity, '') as source, coalesce(title, '') as title, coalesce(event_date::varchar, '') as day, min(discovered_at) as seen from extracted_event_details group by 1, 2, 3)"
sql_query("z01_rows_to_insert", f"select n.source, n.title, n.day from {_TRIPLE} n, {_SEEN} s where date_diff('day', n.seen::date, s.last_seen::date) < 30 and not exists (select 1 from {_TRIPLE} o, {_SEEN} t where date_diff('day', o.seen::date, t.last_seen::date) >= 30 and o.source = n.source and o.title = n.title)", "Rows of the last month whose source and title are not there yet.")
sql_query("z02_processed_marks", "select distinct e.enriched_event_id, x.enriched_event_id is not null as is_processed, case when e.summary is null then 'no text' when e.title is null then 'no title' end as processing_error from extracted_event_details e left join (select distinct enriched_event_id from decisions) x on x.enriched_event_id = e.enriched_event_id where e.enriched_event_id is not null", "Processed marks with the error text.")
sql_query("z03_processing_log", "select log_id, json_object('action', action, 'by', by_whom, 'certain', certain)::varchar as result_data from (select distinct substr(sha256(decision_id), 1, 16) as log_id, coalesce(action, 'none') as action, coalesce(decided_by, 'none') as by_whom, coalesce(certainty >= 0.8, false) as certain from decisions where decision_id is not null)", "Log rows with a JSON payload.")
sql_query("z06_confidence_in_metadata", "select distinct decision_id, case when evidence_json is not null and json_valid(evidence_json) then regexp_replace(evidence_json, '[}] *$', ', \"confidence\": ' || (floor(certainty * 1000) / 1000)::decimal(4,3)::varchar || '}') else '{\"confidence\": ' || (floor(certainty * 1000) / 1000)::decimal(4,3)::varchar || '}' end as metadata from decisions where certainty is not null and decision_id is not null", "Confidence merged into the JSON metadata.")
sql_query("z08_cross_month_pass", f"select k, count(distinct substr(day::varchar, 1, 7)) as months, count(*) as records from (select {KEY.format('primary_entity')} as k, event_date as day from {EV} where event_date is not null and trim(primary_entity) <> '') where day >= (select max(event_date) - 92 from {EV} where event_date <= date '2025-12-31') and day <= date '2025-12-31' group by k having count(distinct substr(day::varchar, 1, 7)) > 1", "Organisations with records in more than one of the last three months.")
sql_query("z09_ids_by_key", f"select m.deduplicated_event_id, m.enriched_event_id, e.raw_event_id from {MEMBERS} m join (select distinct enriched_event_id, raw_event_id from extracted_event_details) e on e.enriched_event_id = m.enriched_event_id", "Ids paired by key, never by position.")
sql_query("z24_flattened_payloads", "select distinct snapshot_id, json_extract_string(payload_json, '$.event.title') as title, json_extract_string(payload_json, '$.event.status') as status, json_extract_string(payload_json, '$.members[0].enriched_event_id') as first_member, json_extract_string(payload_json, '$.members[0].severity') as first_severity from snapshots where payload_json is not null and json_valid(payload_json)", "Nested results as flat rows.")
sql_query("z25_audit_trail", "select decision_id, day, action, place from (select decision_id, created_at::date::varchar as day, action, row_number() over (order by created_at desc, decision_id) as place from (select distinct decision_id, created_at, action from decisions where created_at is not null)) where place <= 50", "The fifty latest audits.")
sql_query("z25_quality_report", "select coalesce(decided_by, 'none') as decided_by, count(distinct decision_id) as n, round(avg(certainty), 6)::double as certainty, count(*) filter (where certainty < 0.85) as low from decisions group by 1", "Quality of decisions by who made them.")
sql_query(
    "z41_recurrence_events",
    f"select m.deduplicated_event_id, coalesce(max(nullif(trim(r.victim_organization_name), '')), min(nullif(trim(e.primary_entity), ''))) as organisation, min(e.event_date)::varchar as day, max(case when starts_with(x.summary, '%PDF') then '' else coalesce(nullif(trim(x.summary), ''), e.title, '') end) as summary, max(n.industry) as industry from {MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id join (select distinct enriched_event_id, summary from extracted_event_details) x on x.enriched_event_id = m.enriched_event_id left join {RISKED} r on r.deduplicated_event_id = m.deduplicated_event_id left join entities n on n.entity_name = e.primary_entity group by 1",
    "Events as recurrence statistics need them: names and texts with fallbacks, raw PDF text blanked.",
)
sql_query("z42_identity_guard", f"select master, count(*) as incidents from {_MASTER} group by 1 having count(*) > 1", "Masters of several incidents, which a unique index would refuse.")
sql_query("z43_source_backfill", f"select m.deduplicated_event_id, u.url, min(substr(e.summary, 1, 400)) as snippet from {MEMBERS} m join (select distinct left_enriched_event_id as id, unnest(shared_urls) as url from match_evidence where left_enriched_event_id is not null) u on u.id = m.enriched_event_id join (select distinct enriched_event_id, coalesce(summary, '') as summary from extracted_event_details) e on e.enriched_event_id = m.enriched_event_id group by 1, 2", "Source rows: each link of an incident once, with a snippet.")
sql_query("z44_events_without_lineage", f"select count(*) as n from {RISKED} r where not exists (select 1 from {MEMBERS} m where m.deduplicated_event_id = r.deduplicated_event_id)", "Incidents that no mapping explains.")
sql_query("j22_missing_lineage", f"select e.enriched_event_id, substr(sha256(e.enriched_event_id), 1, 32) as new_incident, 'primary' as contribution from (select distinct enriched_event_id from extracted_event_details where enriched_event_id is not null) e where not exists (select 1 from {MEMBERS} m where m.enriched_event_id = e.enriched_event_id)", "Lineage rows to insert for articles without one.")
sql_query("z50_coerced_rows", "select distinct enriched_event_id, substr(coalesce(title, ''), 1, 500) as title, substr(coalesce(event_type, 'Other'), 1, 50) as event_type, substr(coalesce(severity, 'Unknown'), 1, 20) as severity, least(1.0, greatest(0.0, coalesce(confidence_score, 0.0)))::double as confidence from extracted_event_details where enriched_event_id is not null", "Rows coerced for storage: clamps and length limits.")
sql_query("z65_backfill_apply", f"select r.deduplicated_event_id, case when o.confidence_score >= 0.8 and o.victim_organization_industry is not null then o.victim_organization_industry else r.victim_organization_industry end as industry, coalesce(o.confidence_score >= 0.8 and o.victim_organization_industry is not null and o.victim_organization_industry is distinct from r.victim_organization_industry, false)::int as changed from (select deduplicated_event_id, max(victim_organization_industry) as victim_organization_industry from {RISKED} group by 1) r left join (select deduplicated_event_id, max(victim_organization_industry) as victim_organization_industry, max(confidence_score) as confidence_score from asd_risk_classifications_20251118_153149 group by 1) o on o.deduplicated_event_id = r.deduplicated_event_id", "A backfill overwrites only above a confidence; what it changes is counted.")
sql_query("z66_unclassified", f"select deduplicated_event_id, place from (select deduplicated_event_id, row_number() over (order by first_day desc nulls last, deduplicated_event_id) as place from (select m.deduplicated_event_id, min(e.event_date) as first_day from {MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id where not exists (select 1 from {RISKED} r where r.deduplicated_event_id = m.deduplicated_event_id) group by 1)) where place <= 100", "The hundred newest incidents without a class.")
sql_query("z75_cached_classes", f"select deduplicated_event_id, max_by(severity_category, (created_at, classification_id)) as severity_category, count(*) as versions from {RISK} where deduplicated_event_id is not null and created_at is not null and classification_id is not null group by 1", "Latest class of each incident; a later one replaces it.")
sql_query("k08_upserted_overrides", "select pair_key, max_by(verdict, (created_at, decision_id)) as verdict, count(*) as versions from (select distinct x.decision_id, x.created_at, x.action as verdict, least(e.left_enriched_event_id, e.right_enriched_event_id) || '|' || greatest(e.left_enriched_event_id, e.right_enriched_event_id) as pair_key from decisions x join match_evidence e on e.decision_id = x.decision_id where x.created_at is not null and e.left_enriched_event_id is not null and e.right_enriched_event_id is not null) group by pair_key", "Overrides by pair; a second one for the pair updates it.")
sql_query("z69_legacy_splits", f"select distinct x.enriched_event_id, x.deduplicated_event_id from {LIVE} x join {MEMBERS} m on m.enriched_event_id = x.enriched_event_id and m.deduplicated_event_id = x.deduplicated_event_id where x.action = 'keep_separate' and x.certainty >= 0.9", "Members that a certain decision keeps apart: splits to apply.")
sql_query("z79_table_counts", "select 'decisions' as name, count(*) as n, 0 as after_wipe from decisions union all select 'snapshots', count(*), 0 from snapshots union all select 'match_evidence', count(*), 0 from match_evidence union all select 'batches', count(*), 0 from batches", "Rows before a wipe, and the zero that must follow.")
sql_query("z78_token_sums", f"select model_used, count(*) as calls, sum(floor(length(title) / 4) + 40)::bigint as tokens_in, sum(floor(length(coalesce(reasoning_json, '')) / 4))::bigint as tokens_out from {RISK} where model_used is not null and title is not null group by 1", "Tokens by model, estimated at four characters each.")
sql_query("z22_filter_stages", f"""with s as (select enriched_event_id, {hits("coalesce(title, '')", INCIDENT)} as a, {hits("coalesce(summary, '')", INCIDENT)} as b, coalesce(is_specific_event, false) and coalesce(is_australian_event, false) as c from (select distinct enriched_event_id, title, summary, is_specific_event, is_australian_event from extracted_event_details))
 select 'discovery' as stage, count(*) as seen, count(*) filter (where a > 0) as passed, count(*) filter (where a = 1) as review from s union all select 'content', count(*) filter (where a > 0), count(*) filter (where a > 0 and b > 0), count(*) filter (where a > 0 and b = 1) from s union all select 'final', count(*) filter (where a > 0 and b > 0), count(*) filter (where a > 0 and b > 0 and c), 0 from s""", "Filters stage by stage, with the band for review.")
sql_query("f18_pre_scrape_drop", f"""select enriched_event_id, not (score < 0 and p < 0.4) as keep from (select enriched_event_id, {hits("coalesce(title, '')", INCIDENT)} - 2 * {hits("coalesce(title, '')", "festival|football|concert|wedding|weather")} - 1 as score, coalesce(confidence_score, 0.5) as p from {EV})""", "Dropped before it is fetched only if the score is negative and the probability low.")
_TERMS = ("breach", "ransomware", "phishing", "police", "insurers", "server")
_TF = " union all ".join(f"select doc_id, '{t}' as term, len(regexp_extract_all(lower(text), '\\b{t}\\b', 0)) as tf from documents where text is not null" for t in _TERMS)
sql_query("z23_features", f"with t as ({_TF}), n as (select count(*) as docs from documents where text is not null), f as (select term, count(*) filter (where tf > 0) as df from t group by term), c as (select source, row_number() over (order by source) as code from (select distinct source from documents where source is not null)) select t.doc_id, coalesce(max(c.code), 0) as source_code, round(sum(case when t.term = 'breach' then t.tf * ln((n.docs + 1.0::double) / (f.df + 1)) end), 6) as breach, round(sum(t.tf * ln((n.docs + 1.0::double) / (f.df + 1))), 6) as total_weight from t join f on f.term = t.term cross join n join documents d on d.doc_id = t.doc_id left join c on c.source = d.source group by t.doc_id", "Features of a filter: source code (unknown 0) and term weights.")

# scans
sql_query("s02_news_scan", f"select doc_id, source, published_at::date::varchar as day from documents where published_at between timestamp '2022-01-01 00:00:00' and timestamp '2025-12-31 00:00:00' and lower(lang) in ('en', 'eng', 'english') and regexp_matches(lower(text), '{INCIDENT}') and starts_with(source_url, 'https://') and not regexp_matches(lower(text), 'festival|football|cricket|recipe|horoscope|lottery|fashion|wedding') and source in (select source from documents group by source having count(*) >= 2) order by published_at desc, doc_id limit 200", "Scan by date, language set, incident words, link prefix, exclusions and number of sources, newest first.")
sql_query("s03_typed_news", "select d.doc_id, case when regexp_matches(low, 'ransom') then 'Ransomware' when regexp_matches(low, 'phish') then 'Phishing' when regexp_matches(low, 'breach|leak|exposed') then 'Data Breach' when regexp_matches(low, 'flood|outage') then 'Denial of Service' else 'Other' end as event_type, case when regexp_matches(low, 'critical|hospital|national') then 'Critical' when regexp_matches(low, 'major|serious') then 'High' else 'Medium' end as severity, least(1.0, greatest(0.3, 0.2 * n.n))::double as credibility from (select doc_id, source, lower(substr(text, 1, 400)) as low from documents where text is not null) d join (select source, count(*) as n from documents where source is not null group by 1) n on n.source = d.source", "News rows as typed events; credibility follows the number of reports.")
_TEMPLATES = "(values (1, 'cyber attack'), (2, 'data breach'), (3, 'ransomware'), (4, 'phishing campaign'), (5, 'privacy incident'), (6, 'system outage'), (7, 'regulator notice')) q(place, words)"
sql_query("s04_search_queries", f"select b.batch_id, q.words || ' ' || substr(b.opened_at::date::varchar, 1, 7) as search, (case when date_diff('day', b.opened_at::date, date '2025-12-31') > 60 then b.opened_at::date - 61 else b.opened_at::date end)::varchar as first_day from (select distinct batch_id, opened_at from batches where opened_at is not null) b, {_TEMPLATES}", "Seven search texts a window; windows older than sixty days reach two months further back. The templates are a fixed list.")
sql_query(
    "s05_json_salvage",
    "select snapshot_id, case when json_valid(closed) then 'closed' else 'fields' end as way, len(regexp_extract_all(case when json_valid(closed) then closed else cut end, '\"enriched_event_id\": \"[^\"]+\"', 0)) as members from (select snapshot_id, cut, case when instr(reverse(cut), '}') > 0 then substr(cut, 1, length(cut) - instr(reverse(cut), '}') + 1) || ']}' else '' end as closed from (select distinct snapshot_id, case when json_valid(payload_json) then substr(payload_json, 1, cast(floor(length(payload_json) * 0.7) as int)) else payload_json end as cut from snapshots where payload_json is not null))",
    "Broken JSON: cut at the last object and closed, else read field by field. Payloads that can be read are cut at 70 % to be broken.",
)


@query("s06_positional_fields", "select snapshot_id, place, title, severity from (select snapshot_id, unnest(generate_series(1, least(len(t), len(s)))) as place, unnest(list_transform(list_zip(t[1:least(len(t), len(s))], s[1:least(len(t), len(s))]), lambda z: z[1])) as title, unnest(list_transform(list_zip(t[1:least(len(t), len(s))], s[1:least(len(t), len(s))]), lambda z: z[2])) as severity from (select distinct snapshot_id, regexp_extract_all(payload_json, '\"title\": \"([^\"]*)\"', 1) as t, regexp_extract_all(payload_json, '\"severity\": \"([^\"]*)\"', 1) as s from snapshots where payload_json is not null))")
def s06(spark, d):
    """Fields of a text that is no JSON, recovered by pattern and put together by position."""
    rows = table(spark, d, "snapshots").where("payload_json is not null").select("snapshot_id", "payload_json").distinct()
    field = lambda name: F.regexp_extract_all("payload_json", F.lit(f'"{name}": "([^"]*)"'), 1)
    both = rows.select("snapshot_id", field("title").alias("t"), field("severity").alias("s")).withColumn("n", F.least(F.size("t"), F.size("s")))
    zipped = F.arrays_zip(F.slice("t", F.lit(1), F.col("n")).alias("title"), F.slice("s", F.lit(1), F.col("n")).alias("severity"))
    return both.where("n > 0").select("snapshot_id", F.posexplode(zipped).alias("pos", "z")).select("snapshot_id", (F.col("pos") + 1).cast("long").alias("place"), "z.title", "z.severity")


sql_query("s07_relevant_results", "select doc_id, source_url, regexp_matches(lower(source_url), '\\.au(/|$)|australia') or regexp_matches(lower(coalesce(text, '')), 'australia|sydney|melbourne|tax file number') as relevant from documents where source_url is not null", "Search results with their relevance by domain or text.")
_LINES = "(values (1, 'March 2024'), (2, 'Acme Health breach'), (3, 'Borumal leak'), (4, 'April 2024'), (5, 'Zenkova outage'), (6, 'notes'), (7, 'May 2023'), (8, 'Kelvarn phishing')) t(ord, line)"
sql_query("s09_section_dates", f"with h as (select ord, line, regexp_matches(line, '^(January|February|March|April|May|June|July|August|September|October|November|December) (19|20)[0-9]{{2}}$') as header from {_LINES}), f as (select *, max(case when header then ord end) over (order by ord rows between unbounded preceding and current row) as section from h) select f.ord, f.line, regexp_extract(s.line, '([0-9]{{4}})', 1) || '-' || case regexp_extract(s.line, '^([A-Za-z]{{3}})', 1) when 'Jan' then '01' when 'Feb' then '02' when 'Mar' then '03' when 'Apr' then '04' when 'May' then '05' when 'Jun' then '06' when 'Jul' then '07' when 'Aug' then '08' when 'Sep' then '09' when 'Oct' then '10' when 'Nov' then '11' else '12' end || '-15' as day from f join h s on s.ord = f.section where not f.header", "List entries dated by the month of their section's header, day 15.")
sql_query("s11_two_column_sheet", "select ord, label, n from (select ord, label, n, lag(label) over (order by ord) as pl, lag(n) over (order by ord) as pn from (values (1, 'Total', 10), (2, 'Total', 10), (3, 'Health', 4), (4, 'Health', 5), (5, null, null), (6, null, null), (7, 'Total', 10)) t(ord, label, n)) where ord = 1 or label is distinct from pl or n is distinct from pn", "Label and count rows without consecutive repeats.")
sql_query("s12_report_tables", "select doc_id, len(regexp_extract_all(text, '[0-9,]+ ?(?:-|–|to) ?[0-9,]+', 0)) as ranges, nullif(regexp_extract(lower(text), 'median (?:of |was )?([0-9,]+)', 1), '') as median from documents where text is not null", "Distribution rows and medians in the text of reports (binary files are read elsewhere).")
sql_query("s13_newest_first", "select name, stamp, row_number() over (order by stamp desc, name) as place from (select name, regexp_extract(name, '([0-9]{8}_[0-9]{6})', 1) as stamp from (values ('stats_20250101_120000.json'), ('stats_20251118_090000.json'), ('stats_20251118_100000.json'), ('old.json')) t(name)) where stamp <> ''", "Files by the stamp in their name, newest first; names without one are left out.")
sql_query("s14_tolerant_json", "select case when payload_json is null then 'null' when json_valid(payload_json) then 'read' else 'bad' end as state, count(distinct snapshot_id) as n from snapshots group by 1", "JSON of many files; bad ones are counted and do not stop the rest.")
sql_query("s16_content_chain", "select doc_id, coalesce(nullif(trim(text), ''), 'see ' || source_url, source, 'none') as content, case when regexp_matches(lower(coalesce(source_url, '')), 'gov') then 1.0 when regexp_matches(lower(coalesce(source, '')), 'courier|observer|gazette|herald') then 0.8 when source is not null then 0.6 else 0.4 end::double as reliability from documents", "Content by four fallbacks, with the reliability of its source.")


@query("s19_columns", "select table_name, column_name from information_schema.columns where table_name in ('decisions', 'batches', 'entities', 'documents', 'snapshots', 'match_evidence')")
def s19(spark, d):
    """Columns of the tables that may be listed."""
    rows = [(name, c) for name in ("decisions", "batches", "entities", "documents", "snapshots", "match_evidence") for c in table(spark, d, name).columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


# Columns without which a table is of no use.
REQUIRED = (("decisions", "decision_id"), ("decisions", "action"), ("batches", "opened_at"), ("entities", "entity_name"), ("snapshots", "payload_json"), ("snapshots", "restored_at"))


@query("z47_schema_validation", "select r.t as table_name, r.c as column_name, count(i.column_name) > 0 as present from (values " + ", ".join(f"('{t}', '{c}')" for t, c in REQUIRED) + ") r(t, c) left join information_schema.columns i on i.table_name = r.t and i.column_name = r.c group by 1, 2")
def z47(spark, d):
    """Does each table have the columns it must have?"""
    rows = [(t, c, c in table(spark, d, t).columns) for t, c in REQUIRED]
    return spark.createDataFrame(rows, "table_name string, column_name string, present boolean")


@query("s01_source_info", "select 'documents' as name, count(*) as rows_read, count(*) filter (where doc_id is not null and text is not null and published_at is not null) as valid, min(published_at)::date::varchar as first_day, max(published_at)::date::varchar as last_day from documents where published_at between timestamp '2022-01-01 00:00:00' and timestamp '2024-12-31 23:59:59'")
def s01(spark, d):
    """A source collects by date range, validates its rows and tells about itself."""
    from caseflux.sources.interface import TableSource

    source = TableSource(spark, d, "documents", "published_at", ("doc_id", "text", "published_at"))
    return source.info("2022-01-01 00:00:00", "2024-12-31 23:59:59")


# sinks: what is written is read again
@query("k01_filtered_export", f"select deduplicated_event_id, event_date::varchar as event_date, severity_category from (select distinct deduplicated_event_id, event_date, severity_category, primary_stakeholder_category from {RISK}) where event_date between date '2024-01-01' and date '2024-12-31' and primary_stakeholder_category = 'Critical infrastructure' and severity_category in ('C1', 'C2', 'C3')")
def k01(spark, d):
    """A table written as CSV under a date range, an equality and a list."""
    rows = table(spark, d, RISK).select("deduplicated_event_id", F.col("event_date").cast("string").alias("event_date"), "severity_category", "primary_stakeholder_category").distinct()
    path = f"{Workspace(spark, 'k01').root}/export"
    sinks.export_table(rows, path, "csv", ("event_date", "2024-01-01", "2024-12-31"), {"primary_stakeholder_category": "Critical infrastructure"}, {"severity_category": ["C1", "C2", "C3"]})
    return spark.read.schema(rows.schema).option("header", True).csv(path).drop("primary_stakeholder_category")


sql_query(
    "k02_denormalised_export",
    f"""select m.deduplicated_event_id, count(*) as sources, coalesce(min(x.n), 0) as entities, '[' || array_to_string(list_sort(list('{{"id":"' || m.enriched_event_id || '","day":"' || coalesce(e.event_date::varchar, '') || '"}}')), ',') || ']' as sources_json, coalesce(min(x.names), '[]') as entities_json from {MEMBERS} m join {EV} e on e.enriched_event_id = m.enriched_event_id left join (select y.g, count(*) as n, '[' || array_to_string(list_sort(list('"' || replace(y.name, '"', '') || '"')), ',') || ']' as names from (select distinct m2.deduplicated_event_id as g, l.name from {MEMBERS} m2 join {LINKS} l on l.enriched_event_id = m2.enriched_event_id) y group by y.g) x on x.g = m.deduplicated_event_id group by 1""",
    "One row an incident with its sources and entities as JSON arrays and their counts.",
)
sql_query(
    "k03_seven_column_export",
    f"select r.deduplicated_event_id, r.event_date::varchar as event_date, r.victim_organization_name as victim, r.event_type, r.records_affected, r.severity_category, case when length(t.text) <= 200 then t.text when instr(reverse(substr(t.text, 1, 200)), '.') between 1 and 60 then substr(t.text, 1, 201 - instr(reverse(substr(t.text, 1, 200)), '.')) else regexp_replace(substr(t.text, 1, 200), ' +[^ ]*$', '') || '…' end as summary from {RISKED} r left join (select m.deduplicated_event_id, max_by(coalesce(nullif(trim(e.summary), ''), e.title), (length(coalesce(e.summary, '')), e.enriched_event_id, coalesce(e.title, ''), coalesce(e.summary, ''))) as text from {MEMBERS} m join (select distinct enriched_event_id, title, summary from extracted_event_details) e on e.enriched_event_id = m.enriched_event_id group by 1) t on t.deduplicated_event_id = r.deduplicated_event_id",
    "Seven columns, the text from the best member and cut to 200 characters at a sentence or word.",
)
sql_query("z55_event_source_text", f"select r.deduplicated_event_id, coalesce(t.text, u.text, 'no text') as text from (select deduplicated_event_id, min(title) as title from {RISK} where deduplicated_event_id is not null group by 1) r left join (select m.deduplicated_event_id, max(e.summary) as text from {MEMBERS} m join extracted_event_details e on e.enriched_event_id = m.enriched_event_id group by 1) t on t.deduplicated_event_id = r.deduplicated_event_id left join (select title, max(summary) as text from extracted_event_details where title is not null group by 1) u on u.title = r.title", "Text of an event: its members, else an article with its title.")
sql_query("x29_cut_texts", "select distinct enriched_event_id, case when length(summary) <= 160 then summary when instr(reverse(substr(summary, 1, 160)), '.') between 1 and 48 then substr(summary, 1, 161 - instr(reverse(substr(summary, 1, 160)), '.')) else regexp_replace(substr(summary, 1, 160), ' +[^ ]*$', '') || '…' end as at_sentence, array_to_string(list_slice(string_split(summary, ' '), 1, 12), ' ') as twelve_words from extracted_event_details where summary is not null", "Cuts at a sentence end in the last 30 %, at a word with an ellipsis, and after twelve words.")


@query("k05_report_sections", f"select 'by_month' as section, count(distinct strftime(event_date, '%Y-%m')) as rows_in from {EV} where event_date is not null union all select 'by_type', count(distinct event_type) from {EV} where event_type is not null union all select 'by_status', count(distinct status) from {EV} where status is not null")
def k05(spark, d):
    """One HTML file with its data embedded as JSON; gives the sections and their sizes as read back from the file."""
    ev = table(spark, d, "extracted_event_details").select("enriched_event_id", "event_date", "event_type", "status").distinct()
    sections = {
        "by_month": ev.where("event_date is not null").groupBy(F.date_format("event_date", "yyyy-MM").alias("month")).count(),
        "by_type": ev.where("event_type is not null").groupBy("event_type").count(),
        "by_status": ev.where("status is not null").groupBy("status").count(),
    }
    path = f"{Workspace(spark, 'k05').root}/report"
    sinks.write_html_report(sections, path)
    page = spark.read.text(path, wholetext=True).select(F.from_json(F.regexp_extract("value", '<script type="application/json">(.*)</script>', 1), "map<string,array<string>>").alias("m"))
    return page.select(F.explode("m")).select(F.col("key").alias("section"), F.size("value").cast("long").alias("rows_in"))


@query("k06_matrix_by_year", f"select year(event_date)::int as y, primary_stakeholder_category as stakeholder, severity_category, count(distinct deduplicated_event_id) as n from {RISKED} where event_date is not null and primary_stakeholder_category is not null and severity_category is not null group by 1, 2, 3")
def k06(spark, d):
    """Risk matrix written in one folder a year."""
    rows = run(spark, d, f"select year(event_date) as y, primary_stakeholder_category as stakeholder, severity_category, count(distinct deduplicated_event_id) as n from {RISKED} where event_date is not null and primary_stakeholder_category is not null and severity_category is not null group by 1, 2, 3")
    path = f"{Workspace(spark, 'k06').root}/matrix"
    sinks.export_table(rows, path, "parquet", partition_by=["y"])
    return spark.read.parquet(path)


@query("k07_classification_export", f"select count(*) as json_rows, count(reasoning_json) as with_reasoning, count(*) as csv_rows, false as csv_has_reasoning from (select distinct deduplicated_event_id, severity_category, reasoning_json from {RISK} where deduplicated_event_id is not null and severity_category is not null)")
def k07(spark, d):
    """Classes as CSV without the reasoning and as JSON with it."""
    rows = table(spark, d, RISK).where("deduplicated_event_id is not null and severity_category is not null").select("deduplicated_event_id", "severity_category", "reasoning_json").distinct()
    root = Workspace(spark, "k07").root
    sinks.export_table(rows, f"{root}/full", "json")
    sinks.export_table(rows.drop("reasoning_json"), f"{root}/short", "csv")
    full, short = spark.read.schema(rows.schema).json(f"{root}/full"), spark.read.option("header", True).csv(f"{root}/short")
    return full.agg(F.count("*").alias("json_rows"), F.count("reasoning_json").alias("with_reasoning")).crossJoin(short.agg(F.count("*").alias("csv_rows"), F.lit("reasoning_json" in short.columns).alias("csv_has_reasoning")))


sql_query("k09_sql_backup", "select batch_id, 'INSERT INTO batches VALUES (''' || replace(batch_id, '''', '''''') || ''', ''' || coalesce(opened_at::date::varchar, '') || ''', ''' || coalesce(state, '') || ''');' as statement from batches where batch_id is not null", "A table as SQL text.")


@query("k10_collector_export", f"select 'csv' as fmt, count(*) as n from {EV} union all select 'json', count(*) from {EV} union all select 'parquet', count(*) from {EV}")
def k10(spark, d):
    """The same rows in three formats, counted as read back."""
    rows = run(spark, d, f"select enriched_event_id, regexp_replace(title, '[\\r\\n]+', ' ', 'g') as title, status from {EV}")
    work, out = Workspace(spark, "k10"), None
    for fmt in ("csv", "json", "parquet"):
        sinks.export_table(rows, f"{work.root}/{fmt}", fmt)
        back = spark.read.schema(rows.schema).format(fmt).options(header="true").load(f"{work.root}/{fmt}").agg(F.count("*").alias("n")).select(F.lit(fmt).alias("fmt"), "n")
        out = back if out is None else out.unionByName(back)
    return out


# Which table refers to which.
REFERS = (("match_evidence", "decisions"), ("decisions", "batches"), ("decisions", "extracted_event_details"), ("snapshots", "batches"), ("asd_risk_classifications_20251118_154100", "decisions"))
_VALUES = "(values " + ", ".join(f"('{a}', '{b}')" for a, b in REFERS) + ") r(child, parent)"
sql_query("k11_wipe_order", f"with recursive e(child, parent) as (select child, parent from {_VALUES}), t(name, depth) as (select parent, 0 from e where parent not in (select child from e) union all select e.child, t.depth + 1 from e join t on e.parent = t.name) select name, max(depth)::int as depth from t group by name", "Tables by depth of reference: the deepest is wiped first.")
