"""Half-year records: consolidation, checks and series (SURVEY R, Q, the period rows of A, U and Z).

The small frames below stand for the files and pages of reports; the series of
incidents come from the two classification runs, which serve as an older and a
newer file of the same periods.
"""

from __future__ import annotations

from caseflux.plans.dialect import sql_query
from caseflux.plans.series import EV, RISKED

HALF = "(case when month(event_date) <= 6 then 'H1' else 'H2' end)"
RUNS = ("asd_risk_classifications_20251118_153149", "asd_risk_classifications_20251118_154100")


def periods(run: str, stamp: int) -> str:
    """(y, period, stamp, total, malicious, human, faults) of the incidents of a run; a missing count is null."""
    kind = "upper(replace(replace(coalesce(event_type, ''), 'CyberEventType.', ''), '_', ' '))"
    count = lambda kinds: f"nullif(count(distinct case when {kind} in ({kinds}) then deduplicated_event_id end), 0)"
    return f"(select year(event_date) as y, {HALF} as period, {stamp} as stamp, count(distinct deduplicated_event_id) as total, {count(chr(39) + 'RANSOMWARE' + chr(39) + ', ' + chr(39) + 'MALWARE' + chr(39) + ', ' + chr(39) + 'DATA BREACH' + chr(39))} as malicious, {count(chr(39) + 'PHISHING' + chr(39) + ', ' + chr(39) + 'INSIDER THREAT' + chr(39))} as human, {count(chr(39) + 'DENIAL OF SERVICE' + chr(39) + ', ' + chr(39) + 'OTHER' + chr(39))} as faults from {run} where event_date is not null group by 1, 2)"


OLD, NEW = periods(RUNS[0], 20251118153149), periods(RUNS[1], 20251118154100)
FIELDS = ("total", "malicious", "human", "faults")
sql_query("r01_newest_first", "select coalesce(n.y, o.y) as y, coalesce(n.period, o.period) as period, " + ", ".join(f"coalesce(n.{f}, o.{f}) as {f}" for f in FIELDS) + f" from {NEW} n full outer join {OLD} o on o.y = n.y and o.period = n.period", "One record a period, each field from the newest file that has it.")
sql_query("r02_both_sides", "select coalesce(n.y, o.y) as y, coalesce(n.period, o.period) as period, n.total as dashboard_total, o.total as report_total, coalesce(n.malicious, o.malicious) as malicious, case when n.y is null then 'report' when o.y is null then 'dashboard' else 'both' end as origin, coalesce(abs(n.total - o.total) > 0, false) as differ " + f"from {NEW} n full outer join {OLD} o on o.y = n.y and o.period = n.period", "Dashboard over report; both sides stay for comparison.")
_QUARTERS = "(values (2024, 'Q1', 100), (2024, 'H1', 210), (2024, 'H2', 230), (2023, 'Q3', 90), (2023, 'H2', 190)) a(y, period, total)"
_STATS = "(values (2024, 'H1', 12.5), (2024, 'H2', 14.0)) b(y, period, mean_days)"
_THIRD = "(values (2022, 'H2', 170), (2024, 'H2', 999)) c(y, period, total)"
sql_query("r03_clean_merge", f"select a.y, a.period, a.total, b.mean_days::double as mean_days from {_QUARTERS} left join {_STATS} on b.y = a.y and b.period = a.period where a.period in ('H1', 'H2') union all select c.y, c.period, c.total, null from {_THIRD} where not exists (select 1 from {_QUARTERS} where a.y = c.y and a.period = c.period)", "Quarters left out, statistics from a second file, a missing period from a third.")
_SECTIONS = "(values ('overview', 'total', 480), ('overview', 'malicious', 0), ('source', 'malicious', 310), ('source', 'human', 120), ('source', 'faults', 50), ('sectors', 'health', 90), ('sectors', 'finance', 70), ('months', 'january', 80), ('months', 'february', 75)) s(sheet, label, n)"
sql_query("s10_workbook_sections", f"select sheet, count(*) as labels, sum(n)::bigint as total from {_SECTIONS} group by sheet", "Sections of a workbook by the name of the sheet.")
sql_query("r04_record_from_sections", f"select max(case when sheet = 'overview' and label = 'total' then n end) as total, coalesce(nullif(max(case when sheet = 'overview' and label = 'malicious' then n end), 0), max(case when sheet = 'source' and label = 'malicious' then n end)) as malicious, max(case when label = 'human' then n end) as human, max_by(label, n) filter (where sheet = 'sectors') as top_sector from {_SECTIONS}", "A record from the sections of a workbook, with fallbacks for zero counts.")
_PAGES = "(values ('2024 H1', 500, 300, null, 60.0), ('2024 H2', 400, null, null, 55.0), ('2023 H1', 350, null, 200, null), ('2023 H2', 420, null, null, null)) p(semester, total, page6, page9, pct)"
sql_query("r05_consolidated_pages", f"select semester, total, coalesce(page6, page9, cast(round(pct * total / 100) as int)) as malicious, case when page6 is not null then 'page 6' when page9 is not null then 'page 9 sums' when pct is not null then 'percent' else 'none' end as origin from {_PAGES}", "Counts of one page before sums of another, then percent times the total.")
_FIXES = "(values (2024, 'H1', 'total', 505)) f(y, period, field, right_value)"
_RAW = "(values (2024, 'H1', 550, 310, 90), (2024, 'H2', 480, 1300, 80), (2023, 'H1', 4000, 200, 60)) r(y, period, total, malicious, sector)"
sql_query("r06_corrected_records", f"select r.y, r.period, case when f.right_value is not null then f.right_value when r.total > 2000 then null else r.total end as total, case when r.malicious > 1000 then null else r.malicious end as malicious from {_RAW} left join {_FIXES} on f.y = r.y and f.period = r.period and f.field = 'total'", "Known corrections, and outliers to null.")
# one period record a row: total, causes, percentages of five buckets, a donut, ranks
FIXTURE = """(values (2023, 'H1', 460, 280, 130, 50, 40.0, 25.0, 20.0, 10.0, 5.0, 60.0, 30.0, 10.0, '1,2,3,4,5'), (2023, 'H2', 460, 280, 130, 50, 40.0, 25.0, 20.0, 10.0, 5.0, 60.0, 30.0, 10.0, '70,60,55,40,30'),
 (2024, 'H1', 520, 330, 150, 60, 44.0, 25.0, 20.0, 10.0, 15.0, 70.0, 30.0, 10.0, '80,71,60,44,31'), (2024, 'H2', 30, 20, 8, 2, 40.0, 25.0, null, 10.0, 5.0, 58.0, 30.0, 10.0, '3,2,1'), (2021, 'H1', 446, 250, 150, 46, 40.0, 22.0, 20.0, 10.0, 5.0, 61.0, 29.0, 9.0, '300,60,9,44,31')) x(y, period, total, malicious, human, faults, b1, b2, b3, b4, b5, d1, d2, d3, sectors)"""
_KEY = "x.y, x.period"
sql_query("q04_identical_halves", f"select a.y from (select * from {FIXTURE}) a join (select * from {FIXTURE}) b on a.y = b.y and a.period = 'H1' and b.period = 'H2' where a.total is not distinct from b.total and a.malicious is not distinct from b.malicious and a.human is not distinct from b.human and a.faults is not distinct from b.faults and coalesce(a.total, a.malicious, a.human) is not null", "Years whose halves say the same.")
sql_query("q21_without_twins", f"select {_KEY} from {FIXTURE} where not (x.period = 'H2' and exists (select 1 from (select y, total, malicious, human from {FIXTURE} where period = 'H1') a where a.y = x.y and a.total = x.total and a.malicious = x.malicious and a.human = x.human))", "Records without the second of twin halves.")
_SECTORS = f"(select x.y, x.period, x.total, unnest(string_split(x.sectors, ',')) as n from {FIXTURE})"
sql_query("q05_sector_range", f"select y, period, n::int as n from {_SECTORS} where n::int <> 0 and not (n::int between 10 and 250)", "Sector counts out of range.")
sql_query("q22_plausible_sectors", f"select y, period, case when n::int <= least(250, total) then n::int end as n from {_SECTORS}", "Sector counts above 250 or the total become null.")
sql_query("q13_period_totals", f"select {_KEY}, x.total from {FIXTURE} where not (x.total between 50 and 2000)", "Totals that no period has.")
sql_query("q15_self_consistency", f"select y, period, problem from (select {_KEY}, case when x.malicious + x.human + x.faults <> x.total then 'causes do not add up' end as problem from {FIXTURE} union all select y, period, 'sector above total' from {_SECTORS} where n::int > total) where problem is not null", "Parts that do not add up to the total.")
sql_query("q16_extracted_ranges", f"select {_KEY}, x.total between 100 and 2000 and x.malicious between 0 and x.total and (x.malicious + x.human + x.faults) between 0.9 * x.total and 1.1 * x.total as valid from {FIXTURE}", "Ranges of extracted figures; the causes within a tenth of the total.")
sql_query("q17_cross_page_totals", f"select {_KEY}, case when gap > case when x.y < 2022 then 0.4 else 0.25 end then 'error' when gap > case when x.y < 2022 then 0.2 else 0.1 end then 'warning' else 'fine' end as verdict from (select *, abs(malicious + human + faults - total)::double / total as gap from {FIXTURE}) x", "Totals of two pages apart: a tenth warns, a quarter is an error; twice that before 2022.")
sql_query("q18_percent_sums", f"select {_KEY}, (b1 is not null)::int + (b2 is not null)::int + (b3 is not null)::int + (b4 is not null)::int + (b5 is not null)::int as buckets, (coalesce(b1, 0) + coalesce(b2, 0) + coalesce(b3, 0) + coalesce(b4, 0) + coalesce(b5, 0))::double as total_pct, coalesce(b1, 0) + coalesce(b2, 0) + coalesce(b3, 0) + coalesce(b4, 0) + coalesce(b5, 0) between 92 and 108 and (b1 is not null)::int + (b2 is not null)::int + (b3 is not null)::int + (b4 is not null)::int + (b5 is not null)::int = 5 as valid from (select * from {FIXTURE}) x", "Five buckets whose shares make a hundred, give or take eight.")
sql_query("q19_donut_sums", f"select {_KEY}, (d1 + d2 + d3)::double as total_pct, d1 + d2 + d3 between 96 and 104 as valid from {FIXTURE}", "Three shares of a donut between 96 and 104.")
sql_query("q20_rank_views", f"select y, period, min(n::int) >= 1 and max(n::int) <= 5 and count(distinct n) >= 3 as rank_view from {_SECTORS} group by y, period", "Cells that are ranks and no counts.")
_ASKED = "(values ('2024 H1', '2023 H2', 10, '2024 H1', 12), ('2024 H2', '2024 H2', 20, '2024 H1', 18), ('2023 H1', '2022 H2', 9, '2022 H1', 8)) p(asked, current_label, current_n, previous_label, previous_n)"
sql_query("q24_swapped_periods", f"select asked, case when previous_label = asked and current_label <> asked then previous_n else current_n end as n, previous_label = asked and current_label <> asked as swapped from {_ASKED}", "Two periods of a page in the wrong order are swapped.")
sql_query("z62_displayed_period", f"select asked, case when lower(replace(current_label, ' ', '')) <> lower(replace(asked, ' ', '')) then 'shows ' || current_label end as problem from {_ASKED}", "Does a page show the period that was asked for?")
_PAYLOADS = "(values ('overview', '{\"total\": 500, \"malicious\": 300}'), ('overview', '{\"malicious\": 300}'), ('sectors', '{\"top\": \"health\"}'), ('sectors', '{broken'), ('strange', '{\"x\": 1}')) p(page, payload)"
sql_query("q25_page_schemas", f"select page, payload, case when page not in ('overview', 'sectors') then 'unknown page' when not json_valid(payload) then 'no JSON' when page = 'overview' and json_extract_string(payload, '$.total') is null then 'no total' when page = 'sectors' and json_extract_string(payload, '$.top') is null then 'no sectors' end as problem from {_PAYLOADS}", "Each page against its own schema; rejects are kept.")
sql_query("z63_quarantined", f"select page, count(*) as rejected from {_PAYLOADS} where not json_valid(payload) or page not in ('overview', 'sectors') group by 1", "Payloads put aside.")
_TOP = f"(select y, period, place, sector from (select year(event_date) as y, {HALF} as period, victim_organization_industry as sector, row_number() over (partition by year(event_date), {HALF} order by count(*) desc, victim_organization_industry) as place from {RISKED} where event_date is not null and victim_organization_industry is not null group by 1, 2, 3) where place <= 5)"
sql_query("u06_top_sector_overlap", f"select a.y, count(b.sector) as shared, count(b.sector) <= 1 as suspicious from {_TOP} a left join {_TOP} b on b.y = a.y and b.period = 'H2' and b.sector = a.sector where a.period = 'H1' group by a.y", "Top sectors that the halves of a year share; one or none is suspicious.")
# outline sheets
_OUTLINE = "(values (1, 'Malicious', 30), (2, 'Phishing', 12), (3, 'Ransomware', 10), (4, 'Ransomware', 10), (5, 'Human error', 20), (6, 'Wrong address', 15), (7, 'Lost paper', 5), (8, 'Total', 50)) t(ord, label, n)"
_FILLED = f"(select o.ord, o.label, o.n, p.label as category from (select ord, label, n, max(case when label in ('Malicious', 'Human error', 'Total') then ord end) over (order by ord rows between unbounded preceding and current row) as parent from (select ord, label, n, lag(label) over (order by ord) as pl, lag(n) over (order by ord) as pn from {_OUTLINE}) where label is distinct from pl or n is distinct from pn) o join {_OUTLINE.replace(' t(ord', ' p(ord')} on p.ord = o.parent)"
sql_query("a42_outline_totals", f"select category, max(case when label = category then n end) as stated, sum(case when label <> category then n else 0 end)::bigint as summed, count(case when label <> category then 1 end) as sub_sources from {_FILLED} group by category", "Category rows and their sub-rows; consecutive repeats count once.")
_MONTHS = "(values (1, 'January', 40), (2, 'Malicious', 25), (3, 'Human error', 15), (4, 'February', 38), (5, 'Malicious', 30), (6, 'Human error', 8)) t(ord, label, n)"
sql_query("a43_monthly_outline", f"select case when label in ('January', 'February') then 'month' else 'source' end as row_class, label, sum(n)::bigint as n from {_MONTHS} group by 1, 2", "Months and source totals of one outline sheet.")
_BLOCKS = "(values (1, '1 - 10', 12), (2, '11 - 100', 9), (3, 'Large scale breaches', null), (4, '5,001 - 10,000', 3), (5, '10,001 or more', 1)) t(ord, label, n)"
sql_query("z59_two_blocks", f"select ord, label, n, case when sum(case when label = 'Large scale breaches' then 1 else 0 end) over (order by ord rows between unbounded preceding and current row) > 0 then 'large scale' else 'distribution' end as block from {_BLOCKS} order by ord", "Two blocks of one sheet, parted by a marker row.")
_LABELS = "(values ('Contact information', 120), ('Identity information', 90), ('Financial details', 70), ('TFN', 20), ('Other', 5)) t(label, n)"
sql_query("z60_label_fields", "select " + ", ".join(f"max(case when label = '{a}' then n end) as {b}" for a, b in (("Contact information", "contact"), ("Identity information", "identity"), ("Financial details", "financial"), ("Health information", "health"))) + f" from {_LABELS}", "Labels mapped to fields; a missing label is null.")
sql_query("z61_resources", "select name, url from (values ('July 2024', 'XLSX', 'https://x.example/a.xlsx'), ('notes', 'PDF', 'https://x.example/b.pdf'), ('Dec 2024', 'xlsx', 'https://x.example/c.xlsx')) t(name, format, url) where upper(format) = 'XLSX'", "Resources of the right format.")
sql_query("z64_report_statistics", "select doc_id, nullif(regexp_extract(text, '([0-9][0-9,]*) (?:notifications|reports|accounts)', 1), '') as notifications, nullif(regexp_extract(text, '([0-9]+) per ?cent', 1), '') as share, len(regexp_extract_all(text, '[0-9]+ per ?cent', 0)) as shares from documents where text is not null", "Figures of a report's text.")
sql_query("z56_sanitised_records", f"select {_KEY}, case when x.malicious > 1.1 * x.total then null else x.malicious end as malicious, len(list_filter(string_split(x.sectors, ','), lambda s: s::int > 250)) as sectors_cut from {FIXTURE}", "Records with implausible counts nulled.")
sql_query("z57_malicious_series", f"select semester, coalesce(nullif(page6, 0), nullif(page9, 0), cast(round(pct / 100 * total) as int)) as malicious from {_PAGES} order by semester", "Series with older fields as fallback.")
_KINDS = f"(select year(event_date) as y, {HALF} as period, count(distinct case when regexp_matches(lower(event_type), 'ransom') then deduplicated_event_id end) as ransomware, count(distinct case when regexp_matches(lower(event_type), 'phish') then deduplicated_event_id end) as phishing, count(distinct case when regexp_matches(lower(event_type), 'malware') then deduplicated_event_id end) as malware from {RISKED} where event_date is not null group by 1, 2)"
sql_query("z58_kind_series", f"select y, period, 'ransomware' as kind, ransomware as n from {_KINDS} union all select y, period, 'phishing', phishing from {_KINDS} union all select y, period, 'malware', malware from {_KINDS}", "Kinds by period as long rows.")
# distributions
_SPINE = "(values (1, '1-100', 1, 100), (2, '101-1000', 101, 1000), (3, '1001-10000', 1001, 10000), (4, '10001-100000', 10001, 100000), (5, '100001-500000', 100001, 500000), (6, '1000001-10000000', 1000001, 10000000)) b(place, label, low, high)"
sql_query("a18_record_ranges", f"select b.place, b.label, count(r.deduplicated_event_id) as n from {_SPINE} left join (select distinct deduplicated_event_id, records_affected from {RISKED}) r on r.records_affected between b.low and b.high group by b.place, b.label", "Counts in fixed buckets on a spine; 500,001 to a million and more than ten million are in none, as in the source of the rule.")
sql_query("a19_top_sector_ratio", f"select sector, n, round(n::double / (sum(n) over ()), 4) as share from (select victim_organization_industry as sector, count(distinct deduplicated_event_id) as n from {RISKED} where victim_organization_industry is not null group by 1) where n between 10 and 250 order by n desc, sector limit 10", "Ten largest sectors within the sane range, and their share.")
sql_query("a22_bucket_matrix", f"with f as (select {HALF} as period, year(event_date) as y, severity_category as bucket, deduplicated_event_id from {RISKED} where event_date is not null and severity_category is not null), o as (select bucket, min(y * 10 + case when period = 'H1' then 1 else 2 end) as first_seen from f group by bucket) select o.bucket, row_number() over (order by o.first_seen, o.bucket) as place, count(distinct case when f.period = 'H1' then f.deduplicated_event_id end) as h1, count(distinct case when f.period = 'H2' then f.deduplicated_event_id end) as h2 from o join f on f.bucket = o.bucket group by o.bucket, o.first_seen", "Buckets by period, in the order in which they first appear.")
sql_query("a23_json_tally", "select year(event_date) as y, " + HALF + " as period, count(distinct case when json_extract_string(reasoning_json, '$.information_quality') = 'good' then deduplicated_event_id end) as good, count(distinct case when json_extract_string(reasoning_json, '$.information_quality') = 'poor' then deduplicated_event_id end) as poor from asd_risk_classifications_20251118_154100 where event_date is not null and json_valid(reasoning_json) group by 1, 2", "A JSON field tallied by period.")
_LOWHIGH = "(select label, n, case label when '1-100' then 50.5 when '101-1000' then 550.5 when '1001-10000' then 5500.5 when '10001-100000' then 55000.5 else 300000.5 end as mid, low, high from (select b.label, b.low, b.high, count(*) as n from " + _SPINE + f" join (select distinct deduplicated_event_id, records_affected from {RISKED}) r on r.records_affected between b.low and b.high group by b.label, b.low, b.high))"
sql_query("a20_grouped_mean_median", f"with c as (select *, sum(n) over (order by low rows between unbounded preceding and current row) as cum, sum(n) over () as total from {_LOWHIGH}), m as (select min(low) as at from c where cum >= total / 2.0) select round(sum(c.n * c.mid)::double / sum(c.n), 4) as mean, round(max(case when c.low = m.at then c.low + (c.high - c.low) * (c.total / 2.0 - (c.cum - c.n)) / c.n end)::double, 4) as median from c cross join m", "Mean of bucket middles and the median interpolated in its bucket.")
sql_query("a24_type_correlation", f"""with k as (select distinct m, kind from (select strftime(event_date, '%Y-%m') as m from {EV} where event_date is not null), (values ('Ransomware'), ('Phishing'), ('Data Breach'), ('Malware')) t(kind)), s as (select k.m, k.kind, count(e.enriched_event_id) as n from k left join {EV} e on strftime(e.event_date, '%Y-%m') = k.m and e.event_type = k.kind group by k.m, k.kind), g as (select kind from s where n > 0 group by kind having count(*) >= 5)
 select a.kind as kind_a, b.kind as kind_b, round(coalesce(corr(a.n, b.n), 0), 3)::double as r from s a join s b on a.m = b.m where a.kind in (select kind from g) and b.kind in (select kind from g) and a.kind < b.kind group by 1, 2""", "Correlation of monthly series that have five months or more; no variance gives zero.")
sql_query("a25_count_histogram", f"with s as (select strftime(event_date, '%Y-%m') as m, count(*) as n from {EV} where event_date is not null group by 1), x as (select min(n) as lo, max(n) as hi, avg(n) as mean, var_pop(n) as v from s) select least(9, floor((s.n - x.lo) * 10.0 / greatest(x.hi - x.lo, 1)))::int as bin, count(*) as months, round(min(x.mean)::double, 6) as mean, round(min(x.v)::double, 6) as variance, round(case when min(x.v) > min(x.mean) then min(x.mean) * min(x.mean) / (min(x.v) - min(x.mean)) end::double, 6) as k from s cross join x group by 1", "Ten equal bins of monthly counts, with variance and the k of a negative binomial.")
sql_query("a12_severity_by_industry", f"select coalesce(victim_organization_industry, 'Unknown') as category, round(sum(w * x)::double / sum(w), 6) as severity, sum(w)::bigint as weight from (select victim_organization_industry, coalesce(try_cast(substr(severity_category, 2, 1) as int), 0) as x, count(*) as w from {RISKED} group by 1, 2) group by 1", "Mean severity by category, weighted by incidents; an unknown one counts as nought.")
sql_query("a13_severity_by_type", f"select kind, round(sum(w * x)::double / sum(w), 6) as severity, sum(w)::bigint as weight from (select event_type as kind, case replace(upper(severity), 'EVENTSEVERITY.', '') when 'CRITICAL' then 4 when 'HIGH' then 3 when 'MEDIUM' then 2 when 'LOW' then 1 else 0 end as x, count(*) as w from {EV} where event_type is not null group by 1, 2) group by kind", "Mean severity by kind of attack, weighted by events.")
_STAKE = "case when primary_stakeholder_category in ('Critical infrastructure', 'State government', 'Federal government') then 'Government and infrastructure' when primary_stakeholder_category in ('Large organisation(s)', 'Medium-sized organisation(s)') then 'Larger organisations' else 'Small organisations and people' end"
sql_query("a26_risk_matrix", f"with g as (select {_STAKE} as stakeholder, severity_category as c, count(distinct deduplicated_event_id) as n from {RISKED} where primary_stakeholder_category is not null and severity_category is not null group by 1, 2), s as (select st.stakeholder, ca.c from (select distinct stakeholder from g) st, (values ('C1'), ('C2'), ('C3'), ('C4'), ('C5'), ('C6')) ca(c)) select s.stakeholder, s.c as severity_category, coalesce(g.n, 0) as n, sum(coalesce(g.n, 0)) over (partition by s.stakeholder)::bigint as row_total from s left join g on g.stakeholder = s.stakeholder and g.c = s.c", "Matrix of stakeholder groups and classes on a full spine.")
sql_query("a34_summary", f"select count(distinct deduplicated_event_id) as incidents, count(distinct victim_organization_name) as organisations, (select count(*) from (select victim_organization_name from {RISKED} where victim_organization_name is not null group by 1 having count(distinct deduplicated_event_id) > 1))::bigint as organisations_with_several, (select count(*) from entities where size_estimate = 'LARGE')::bigint as large_entities from {RISKED}", "Summary of organisations, events and sizes.")
sql_query("a35_audit_statistics", "select count(*) as incidents, count(*) filter (where n > 1) as merged, count(*) filter (where n = 1) as singletons, count(*) filter (where low < 0.85) as low_certainty, count(*) filter (where lineage = 0) as without_lineage from (select x.deduplicated_event_id, count(distinct x.enriched_event_id) as n, min(case when x.superseded_by is null then x.certainty end) as low, max(case when s.deduplicated_event_id is null then 0 else 1 end) as lineage from decisions x left join (select distinct deduplicated_event_id from snapshots) s on s.deduplicated_event_id = x.deduplicated_event_id where x.action = 'merge' and x.deduplicated_event_id is not null group by 1)", "Audit of incidents: merged, single, low certainty, no lineage.")
sql_query("a36_stage_status", "select stage, array_to_string(list_sort(list(status || '=' || n::varchar)), ',') as states from (select coalesce(decided_by, 'none') as stage, coalesce(action, 'none') as status, count(distinct decision_id) as n from decisions group by 1, 2) group by stage", "Counts by stage and status as a nested map.")
sql_query("a38_collection_statistics", f"select 'type' as part, coalesce(event_type, 'none') as label, count(*) as n, round(avg(confidence_score), 6)::double as confidence from {EV} group by 2 union all select 'severity', coalesce(severity, 'none'), count(*), round(avg(confidence_score), 6)::double from {EV} group by 2 union all select 'source', coalesce(source, 'none'), count(*), null from documents group by 2", "Collection by type, severity and source.")
sql_query("a40_cost_by_model", "with p(model_used, price_in, price_out) as (select * from (values ('model-a', 1.5, 6.0), ('model-b', 0.6, 2.4)) t(a, b, c)), u as (select model_used, floor(length(title) / 4) + 40 as tin, floor(length(coalesce(reasoning_json, '')) / 4) as tout from asd_risk_classifications_20251118_154100 where title is not null) select u.model_used, count(*) as calls, sum(u.tin)::bigint as tokens_in, sum(u.tout)::bigint as tokens_out, round((sum(u.tin * p.price_in) + sum(u.tout * p.price_out))::double / 1000000, 8) as cost from u join p on p.model_used = u.model_used group by u.model_used", "Tokens and their cost by model; the prices are parameters of the query.")
sql_query("a45_entity_days", f"select primary_entity as entity, event_date::varchar as day, count(distinct enriched_event_id) as articles, max(records_affected) as records_affected, array_to_string(list_sort(list(enriched_event_id)), '|') as ids, array_to_string(list_slice(list_sort(list(coalesce(title, ''))), 1, 5), ' / ') as titles from {EV} where trim(primary_entity) <> '' and event_date is not null group by 1, 2", "One row an organisation and day: ids, largest count, five titles.")
# the remaining partial rows
sql_query("f20_enum_projection", f"select enriched_event_id, coalesce(replace(upper(replace(replace(severity, 'EventSeverity.', ''), 'CyberEventType.', '')), '_', ' '), 'UNKNOWN') as severity, coalesce(replace(upper(replace(event_type, 'CyberEventType.', '')), '_', ' '), 'OTHER') as event_type, coalesce(nullif(trim(primary_entity), ''), 'Unknown') as victim, coalesce(confidence_score, 0.5) as confidence from {EV}", "Projection with enums unwrapped and defaults.")
sql_query("f04_terms_not_processed", "select distinct e.doc_id from documents e where regexp_matches(lower(coalesce(e.text, '') || ' ' || coalesce(e.source_url, '')), 'australia|breach|ransom|phish') and not exists (select 1 from doc_labels l where l.doc_id = e.doc_id)", "Any of several terms in text or link, and not labelled yet.")
sql_query("f22_source_type", "select doc_id, case when regexp_matches(lower(source), 'police|department|commission') then 'government' when regexp_matches(lower(source), 'gazette|bulletin|courier|observer|herald|times|advertiser') then 'newspaper' when regexp_matches(lower(source_url), 'blog') then 'blog' when regexp_matches(lower(source_url), '^https?://') then 'web' else 'unknown' end as source_type from documents", "Source type by the first name that fits, then the link.")
sql_query("j01_event_bridge_entity", "select distinct l.enriched_event_id, n.entity_id, l.role, n.industry from (select distinct enriched_event_id, primary_entity as name, 'victim' as role from extracted_event_details union select distinct enriched_event_id, name, 'affected' as role from (select enriched_event_id, unnest(affected_entities) as name from extracted_event_details)) l join entities n on n.entity_name = l.name join (select distinct enriched_event_id from extracted_event_details where status = 'Active') e on e.enriched_event_id = l.enriched_event_id where l.role = 'victim'", "Events, their links with a role, and entities, for victims.")
sql_query("u04_united_sources", "select m.deduplicated_event_id, array_to_string(list_sort(list(distinct u.url)), ' ') as urls, count(distinct u.url) as n from (select distinct enriched_event_id, deduplicated_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null) m join (select distinct left_enriched_event_id as id, unnest(shared_urls) as url from match_evidence) u on u.id = m.enriched_event_id group by 1", "Links of all members of an incident.")
sql_query("x40_size_buckets", "select entity_id, case when employee_count is null then 'unknown' when employee_count < 50 then 'small' when employee_count < 250 then 'medium' when employee_count < 1000 then 'large' else 'very large' end as employees, case when size_revenue_aud is null then 'unknown' when size_revenue_aud < 10000000 then 'small' when size_revenue_aud < 100000000 then 'medium' when size_revenue_aud < 1000000000 then 'large' else 'very large' end as turnover from entities", "Buckets of headcount and turnover.")
sql_query("x40_record_buckets", f"select case when records_affected is null then 'unknown' when records_affected < 1000 then 'small' when records_affected < 10000 then 'medium' when records_affected < 100000 then 'large' else 'very large' end as bucket, count(*) as n from {EV} group by 1", "Buckets of affected records.")
_MAP = "(values ('healthcare', 'Health'), ('financial institution', 'Finance'), ('government', 'Government'), ('education', 'Education'), ('retail', 'Retail'), ('technology', 'Technology'), ('telecommunications', 'Technology'), ('energy/utilities', 'Utilities'), ('manufacturing', 'Industry'), ('transportation', 'Transport'), ('media', 'Media'), ('non-profit', 'Charities')) t(raw, canonical)"
sql_query("x43_canonical_sectors", f"select e.industry, coalesce(t.canonical, e.industry) as canonical, count(*) as n from entities e left join {_MAP} on t.raw = lower(trim(e.industry)) where e.industry is not null group by 1, 2", "Sector names by a fixed map, whatever their case.")
sql_query("x44_labels_and_ranks", f"select event_type, replace(lower(replace(event_type, 'CyberEventType.', '')), '_', ' ') as label, case replace(upper(severity), 'EVENTSEVERITY.', '') when 'CRITICAL' then 4 when 'HIGH' then 3 when 'MEDIUM' then 2 when 'LOW' then 1 else 0 end as severity, count(*) as n from {EV} where event_type is not null group by 1, 2, 3", "Type labels without prefix and underscores, severities as numbers.")
_LOCAL = "regexp_matches(lower(coalesce(v, '')), 'australia|council|department|university|district')"
sql_query("x48_validated_counts", f"select id, records_affected, case when records_affected is null or records_affected < 50 then null when records_affected > 1000000000 then null when {_LOCAL} and records_affected > 27000000 then null when regexp_matches(lower(coalesce(v, '')), 'department|government') and records_affected > 30000000 then null when length(coalesce(v, '')) > 0 and records_affected > 20000000 and not regexp_matches(lower(v), 'telecom|insurance|bank|network') then null else records_affected end as plausible from (select enriched_event_id as id, primary_entity as v, records_affected from {EV})", "Counts by tiers: a floor of fifty, ceilings by the kind of victim, a billion at most.")
sql_query("z52_implausible_counts", f"select enriched_event_id, records_affected, case when records_affected < 0 then 'negative' when records_affected < 50 then 'below floor' when records_affected > 1000000000 then 'above ceiling' end as reason from {EV} where records_affected < 50 or records_affected > 1000000000", "Counts that cannot be, and why.")
_EXPECT = "(values ('telecom', 'Telecommunications'), ('hospital', 'Healthcare'), ('university', 'Education'), ('insurance', 'Financial Institution')) t(part, expected)"
sql_query("q10_vendor_industry", f"select e.entity_id, e.industry, min(t.expected) as expected from entities e join {_EXPECT} on contains(lower(e.entity_name), t.part) where e.industry is not null group by 1, 2 having count(*) filter (where t.expected = e.industry) = 0", "Industry against what the name says; the list is fixed.")
sql_query("z53_corrected_industries", f"select r.deduplicated_event_id, r.victim_organization_industry as stored, t.expected as corrected from {RISKED} r join {_EXPECT} on contains(lower(r.victim_organization_name), t.part) where r.victim_organization_industry is distinct from t.expected", "Industries corrected by a part of the name.")
sql_query("q09_master_links", f"select r.deduplicated_event_id from (select distinct deduplicated_event_id from {RISKED}) r where not exists (select 1 from decisions x join extracted_event_details e on e.enriched_event_id = x.enriched_event_id where x.deduplicated_event_id = r.deduplicated_event_id and x.action = 'merge')", "Incidents whose master is no article.")
sql_query("q11_count_outliers", f"select enriched_event_id, records_affected from {EV} where records_affected is not null and not (records_affected between 1 and 1000000000)", "Counts out of range.")
sql_query("q14_storage_integrity", "select check_name, n from (select 'article twice in an incident' as check_name, count(*) as n from (select enriched_event_id, deduplicated_event_id from (select distinct decision_id, enriched_event_id, deduplicated_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null) group by 1, 2 having count(*) > 1) union all select 'decision id twice', count(*) from (select decision_id from decisions group by 1 having count(*) > 1) union all select 'evidence without decision', count(*) from match_evidence m where not exists (select 1 from decisions d where d.decision_id = m.decision_id) union all select 'decision without batch', count(*) from decisions d where not exists (select 1 from batches b where b.batch_id = d.batch_id))", "Two uniqueness and two reference checks.")
# A second half of the dates the statistics need
sql_query("d12_overruled_dates", "select g as deduplicated_event_id, day::varchar as consensus, stored::varchar as stored, case when stored is null then 'fill' when substr(day::varchar, 1, 7) = substr(stored::varchar, 1, 7) then 'keep' when n >= 3 and n >= 0.6 * dated and not contains(coalesce(title, ''), substr(stored::varchar, 1, 4)) then 'overrule' else 'keep' end as decision from (select c.g, c.day, c.n, c.dated, r.event_date as stored, r.title from (select g, min_by(first_day, (-n, m)) as day, max(n) as n, sum(n)::bigint as dated from (select x.deduplicated_event_id as g, strftime(e.event_date, '%Y-%m') as m, count(*) as n, min(e.event_date) as first_day from (select distinct enriched_event_id, deduplicated_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null) x join " + EV + " e on e.enriched_event_id = x.enriched_event_id where e.event_date is not null group by 1, 2) group by g) c join (select deduplicated_event_id, max(event_date) as event_date, min(title) as title from asd_risk_classifications_20251118_154100 group by 1) r on r.deduplicated_event_id = c.g)", "A stored date gives way where three members and 60 % of them agree and the title does not name its year.")
sql_query("z32_month_support", "select g as deduplicated_event_id, max(n) as support, sum(n)::bigint as dated from (select x.deduplicated_event_id as g, strftime(e.event_date, '%Y-%m') as m, count(*) as n from (select distinct enriched_event_id, deduplicated_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null) x join " + EV + " e on e.enriched_event_id = x.enriched_event_id where e.event_date is not null group by 1, 2) group by g", "Members behind the winning month, and all that have a date.")
_MEM = "(select distinct enriched_event_id, deduplicated_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null)"
sql_query("d13_supported_records", f"select g as deduplicated_event_id, stored, case when support > 0 then 'keep' when kinds = 0 then 'clear' when hi > 10 * lo and top = 1 then 'flag' else 'correct' end as outcome, case when support > 0 then stored when kinds = 0 then null when hi > 10 * lo and top = 1 then stored else best end as records_affected from (select r.deduplicated_event_id as g, max(r.records_affected) as stored, coalesce(sum(case when c.v = r.records_affected then c.n end), 0) as support, count(c.v) as kinds, max(c.v) as hi, min(c.v) as lo, max(c.n) as top, max_by(c.v, (c.n, c.v)) as best from {RISKED} r left join (select x.deduplicated_event_id, e.records_affected as v, count(*) as n from {_MEM} x join {EV} e on e.enriched_event_id = x.enriched_event_id where e.records_affected > 0 group by 1, 2) c on c.deduplicated_event_id = r.deduplicated_event_id group by 1)", "A supported count stays; else the commonest, larger on a tie; far disagreement is left alone.")
sql_query("d15_recounted", f"select g as deduplicated_event_id, stored, best, case when stored is not distinct from best then 'same' when best is null then 'cleared' when best < 50 or best > 1000000000 then 'flagged' else 'corrected' end as outcome from (select r.g, r.stored, c.best from (select deduplicated_event_id as g, max(records_affected) as stored from {RISKED} group by 1) r left join (select g, max_by(v, (n, v)) as best from (select x.deduplicated_event_id as g, e.records_affected as v, count(*) as n from {_MEM} x join {EV} e on e.enriched_event_id = x.enriched_event_id where e.records_affected > 0 group by 1, 2) group by g) c on c.g = r.g)", "Counts derived again from the members, held against what is plausible.")
sql_query("d14_redated", f"select r.deduplicated_event_id, coalesce(c.day, t.day, m.day, u.day)::varchar as day, case when c.day is not null then 'consensus' when t.day is not null then 'text' when m.day is not null then 'earliest' when u.day is not null then 'seen' else 'none' end as origin from (select distinct deduplicated_event_id from {RISKED}) r left join (select g, min_by(d, (-n, mo)) as day from (select x.deduplicated_event_id as g, strftime(e.event_date, '%Y-%m') as mo, count(*) as n, min(e.event_date) as d from {_MEM} x join {EV} e on e.enriched_event_id = x.enriched_event_id where e.event_date is not null group by 1, 2) where n >= 2 group by g) c on c.g = r.deduplicated_event_id left join (select x.deduplicated_event_id as g, min(try_cast(nullif(regexp_extract(e.summary, '((?:19|20)[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})', 1), '') as date)) as day from {_MEM} x join extracted_event_details e on e.enriched_event_id = x.enriched_event_id group by 1) t on t.g = r.deduplicated_event_id left join (select x.deduplicated_event_id as g, min(e.event_date) as day from {_MEM} x join {EV} e on e.enriched_event_id = x.enriched_event_id group by 1) m on m.g = r.deduplicated_event_id left join (select x.deduplicated_event_id as g, min(e.discovered_at::date) as day from {_MEM} x join extracted_event_details e on e.enriched_event_id = x.enriched_event_id group by 1) u on u.g = r.deduplicated_event_id", "Date ladder: consensus, text, earliest, day it was seen.")
sql_query("z51_cut_replies", "select snapshot_id, nullif(regexp_extract(cut, '\"title\": \"([^\"]*)\"', 1), '') as title, nullif(regexp_extract(cut, '\"status\": \"([^\"]*)\"', 1), '') as status, json_valid(cut) as whole from (select distinct snapshot_id, substr(payload_json, 1, cast(floor(length(payload_json) * 0.6) as int)) as cut from snapshots where payload_json is not null)", "Replies cut short, read by pattern.")
sql_query("w05_running_totals", f"select label, n, sum(n) over (order by low rows between unbounded preceding and current row)::bigint as cumulative, sum(n) over (order by low rows between unbounded preceding and current row) >= (sum(n) over ()) / 2.0 as at_median from {_LOWHIGH}", "Running totals of buckets, and from where the median lies in them.")
sql_query("q02_malformed_types", "select event_type, count(*) as n from extracted_event_details where event_type like 'CyberEventType.%' or length(event_type) < 3 group by 1", "Types that are qualified or cut off.")
sql_query("q03_severity_domain", "select severity, count(*) as n from extracted_event_details where severity is not null and severity not in ('Critical', 'High', 'Medium', 'Low', 'Unknown') group by 1", "Severities outside the known set.")
sql_query("q07_category_domain", "select coalesce(severity_category, 'none') as severity_category, count(*) as n, severity_category in ('C1', 'C2', 'C3', 'C4', 'C5', 'C6') as known from asd_risk_classifications_20251118_154100 where severity_category is not null group by 1, 3", "Classes, and whether they are of the known six.")
sql_query("q08_size_bands", "select entity_id, size_estimate, band from (select entity_id, size_estimate, case when coalesce(size_employees, employee_count) < 20 then 'SMALL' when coalesce(size_employees, employee_count) < 200 then 'MEDIUM' when coalesce(size_employees, employee_count) < 5000 then 'LARGE' when coalesce(size_employees, employee_count) is not null then 'HUGE' end as band from entities) where size_estimate is not null and size_estimate <> 'UNKNOWN' and (size_estimate not in ('SMALL', 'MEDIUM', 'LARGE', 'HUGE') or band <> size_estimate)", "Size bands outside their domain or against the headcount; unknown ones are exempt.")
sql_query("q12_status_domain", "select coalesce(status, 'none') as status, count(*) as n, coalesce(status in ('Active', 'Merged', 'Rejected'), false) as known from extracted_event_details group by 1, 3", "States, and whether they are known.")
