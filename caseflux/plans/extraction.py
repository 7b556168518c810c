"""Stand-ins of model-backed steps: the same columns from rules, joins and stored tables (SURVEY M rows)."""

from __future__ import annotations

from caseflux.plans.dedupe import BUCKETS, CAP, TEMPORAL
from caseflux.plans.dialect import sql_query
from caseflux.plans.kernels import INCIDENT, hits
from caseflux.plans.resolution import KEY
from caseflux.plans.series import EV, RISK, RISKED

_TEXTS = "(select distinct enriched_event_id, coalesce(title, '') as title, coalesce(summary, '') as summary, primary_entity, event_date, records_affected from extracted_event_details where enriched_event_id is not null)"
sql_query("m01_structured_extraction", f"select enriched_event_id, json_object('victim', victim, 'day', day, 'affected', affected, 'kind', kind)::varchar as extraction from (select enriched_event_id, coalesce(nullif(regexp_extract(title, '^(.+?) (?:admits|confirms|denies)', 1), ''), primary_entity, 'none') as victim, coalesce(event_date::varchar, 'none') as day, coalesce(nullif(regexp_extract(summary, '([0-9][0-9,]+) (?:records|customers|patients|passengers|accounts|files)', 1), ''), '0') as affected, case when regexp_matches(lower(title || summary), 'ransom|encrypted') then 'ransomware' when regexp_matches(lower(title || summary), 'phish|invite') then 'phishing' else 'breach' end as kind from {_TEXTS})", "Victim, day, count and kind of a text as JSON.")
sql_query("m02_classified_events", f"select enriched_event_id, {hits('title', INCIDENT)} as title_hits, {hits('summary', INCIDENT)} as text_hits, case when {hits('title', INCIDENT)} + {hits('summary', INCIDENT)} = 0 then 'reject' when {hits('title', INCIDENT)} > 0 then 'accept' else 'review' end as gate from {_TEXTS}", "Gate by incident words in title and text.")
sql_query("m03_entities", f"select enriched_event_id, entity, count(*) as mentions from (select enriched_event_id, unnest(regexp_extract_all(title || '. ' || summary, '[A-Z][a-z]+(?: [A-Z][a-z]+)+', 0)) as entity from {_TEXTS}) group by 1, 2", "Entities of a text: runs of capitalised words.")
sql_query("m04_fact_checks", f"select enriched_event_id, (contains(lower(title || summary), lower(coalesce(nullif(trim(primary_entity), ''), '?'))))::int as victim_ok, (event_date is not null and event_date <= date '2025-12-31')::int as date_ok, (records_affected is null or records_affected >= 0)::int as count_ok, (length(summary) >= 50)::int as text_ok from {_TEXTS}", "Four checks of an extraction against its own text.")
_SCORE = f"(0.4 * coalesce(title_similarity, 0) + 0.3 * (coalesce(entity_match, false))::int + 0.2 * coalesce(embedding_similarity, 0) + 0.1 * ({TEMPORAL.format(g='date_delta_days')}))"
sql_query("m05_arbiter", f"select decision_id, round(score, 6)::double as score, round(case when score between 0.3 and 0.7 then case when score > 0.5 then greatest(0.8, score) else least(0.3, score) end else score end, 6)::double as settled from (select distinct decision_id, {_SCORE} as score from match_evidence where decision_id is not null)", "Scores in the band of doubt are lifted or lowered by one cut; as in the rule it stands for, 0.6 passes and 0.72 does not.")
sql_query("m06_partitions", f"select bucket, id, case when n > {CAP} then id else bucket end as part from (select bucket, id, count(*) over (partition by bucket) as n from {BUCKETS})", "Buckets taken as they are; those above the cap fall back to single records.")
sql_query("m07_recurrence_audit", f"select k, count(*) as records, 'no change' as verdict from (select {KEY.format('primary_entity')} as k from {EV} where trim(primary_entity) <> '') group by k having count(*) >= 2", "Audit of organisations with several records: nothing changes without a model.")
sql_query("m09_researched_sizes", "select entity_id, case when coalesce(size_employees, employee_count) is not null then 'register' when size_revenue_aud is not null then 'revenue' when regexp_matches(lower(entity_name), 'department|university|council') then 'rule' else 'unknown' end as origin, coalesce(case when coalesce(size_employees, employee_count) < 20 then 'SMALL' when coalesce(size_employees, employee_count) < 200 then 'MEDIUM' when coalesce(size_employees, employee_count) < 5000 then 'LARGE' when coalesce(size_employees, employee_count) is not null then 'HUGE' end, size_estimate, 'UNKNOWN') as band from entities", "Size from the figures at hand.")
sql_query("m10_researched_dates", f"select enriched_event_id, coalesce(event_date::varchar, nullif(regexp_extract(summary, '((?:19|20)[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})', 1), ''), nullif(regexp_extract(title || ' ' || summary, '((?:19|20)[0-9]{{2}})', 1), '')) as day_or_year from {_TEXTS}", "Date from the row, its text, or at least the year.")
sql_query("m11_cached_classes", f"select p.prompt_key, count(*) as asked, count(distinct p.deduplicated_event_id) as events, min(r.severity_category) as severity_category from (select distinct deduplicated_event_id, substr(sha256(prompt), 1, 16) as prompt_key from (select deduplicated_event_id, coalesce(title, '') || '|' || coalesce(event_type, '') as prompt from {RISK} where deduplicated_event_id is not null)) p left join {RISKED} r on r.deduplicated_event_id = p.deduplicated_event_id group by p.prompt_key", "Classes by the hash of what would be asked, so equal questions are asked once.")
sql_query("m12_personal_data", f"select enriched_event_id, regexp_matches(lower(summary), 'email addresses|home addresses|dates of birth') as contact, regexp_matches(lower(summary), 'tax file number|passport|licen[cs]e|fingerprint') as identity, regexp_matches(lower(summary), 'vaccination|patient|specialist referrals|medical') as health, regexp_matches(lower(summary), 'payment|invoice|bank|tenders') as financial, case when regexp_matches(lower(summary), 'contractor|staff|insider') then 'human' when regexp_matches(lower(summary), 'misconfigured|outage|not fixed') then 'system' else 'malicious' end as origin from {_TEXTS}", "Kinds of personal data and of the source of a breach, by rules.")
sql_query("m13_repaired_replies", "select snapshot_id, json_valid(closed) as repaired, json_extract_string(case when json_valid(closed) then closed else '{}' end, '$.event.title') as title from (select snapshot_id, substr(cut, 1, length(cut) - instr(reverse(cut), '}') + 1) || ']}' as closed from (select distinct snapshot_id, substr(payload_json, 1, cast(floor(length(payload_json) * 0.8) as int)) as cut from snapshots where payload_json is not null and json_valid(payload_json)) where instr(reverse(cut), '}') > 0)", "Cut replies closed at their last object and read.")
sql_query("m14_validated_by_class", f"select e.enriched_event_id, e.records_affected, c.most, e.records_affected is null or e.records_affected <= c.most as plausible from {EV} e join (select event_type, greatest(1000, 20 * median(records_affected))::double as most from {EV} where records_affected > 0 group by 1) c on c.event_type = e.event_type", "Counts against a ceiling learned from their own kind.")
sql_query("m15_embedded_rows", "select label, count(*) as n, min(len(embedding))::int as dimensions, count(*) filter (where embedding is null) as missing from embeddings group by label", "Vectors come from the stored table.")
