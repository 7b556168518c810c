"""Kernels of names, titles, dates, links and texts (SURVEY X rows and the smaller Z rows)."""

from __future__ import annotations

from caseflux.plans.dialect import sql_query
from caseflux.plans.resolution import KEY, NORMAL, TOKENS
from caseflux.plans.series import ACTIVE, EV, RISK, RISKED

NAMES = "(select distinct primary_entity as name from extracted_event_details where trim(primary_entity) <> '')"
PAIRS = "(select distinct entity_left as l, entity_right as r from match_evidence where trim(entity_left) <> '' and trim(entity_right) <> '')"
TITLES = "(select distinct enriched_event_id, title, summary, primary_entity, event_date from extracted_event_details where trim(title) <> '')"
DOCS = "(select doc_id, text, source_url, source, published_at from documents where text is not null)"

# Places that trail a name, corporate suffixes, and state names written out.
PLACES = "australia|aust|au|nsw|vic|qld|wa|tas|act|new south wales|victoria|queensland|tasmania|usa|uk|new zealand|nz"
SUFFIXES = "'pty', 'ltd', 'limited', 'inc', 'incorporated', 'corp', 'corporation', 'co', 'company', 'group', 'holdings', 'plc', 'llc'"
STATES = (("nsw", "new south wales"), ("vic", "victoria"), ("qld", "queensland"), ("wa", "western australia"), ("sa", "south australia"), ("tas", "tasmania"), ("nt", "northern territory"), ("act", "australian capital territory"))
# Words that name a kind of institution, a place or nothing in particular.
INSTITUTIONS = "'hospital', 'health', 'healthcare', 'university', 'council', 'school', 'college', 'bank', 'department', 'network', 'services', 'partners', 'centre', 'center', 'authority', 'institute', 'office', 'agency', 'commission'"
NEUTRAL = "'the', 'of', 'and', 'for', 'in', 'at', 'a', 'pty', 'ltd', 'limited', 'inc', 'co', 'company', 'group', 'holdings', 'corporation', 'corp', 'plc', 'llc', 'international', 'australia', 'australian'"
SUBUNITS = "'school', 'faculty', 'campus', 'division', 'branch', 'unit', 'centre', 'center', 'institute', 'college', 'office', 'team', 'hospital'"
JOINING = "'of', 'the', 'and', 'for', 'in', 'at', 'a'"


def canonical(x: str) -> str:
    """Second canonical form: no parentheses, no legal forms, no trailing place unless "of" stands before it."""
    bare = KEY.format(f"regexp_replace({x}, '\\([^)]*\\)', ' ', 'g')")
    return f"case when regexp_matches({bare}, ' of ({PLACES})$') then {bare} else regexp_replace({bare}, '^(.*?\\S)( ({PLACES}))+$', '\\1') end"


def parts(x: str) -> str:
    """Names joined by , ; | or /; "and" and "&" part names of at most six words."""
    cut = f"list_transform(regexp_split_to_array({x}, '[,;|/]'), lambda p: trim(p))"
    finer = f"list_transform({cut}, lambda p: case when len(string_split(p, ' ')) <= 6 then regexp_split_to_array(p, ' (?:and|&) ') else list_value(p) end)"
    return f"list_distinct(list_filter(list_transform(flatten({finer}), lambda p: trim(p)), lambda p: p <> ''))"


def words(x: str) -> str:
    """Lower-case words with states written out, bracketed short forms dropped."""
    ladder = " ".join(f"when t = '{a}' then string_split('{b}', ' ')" for a, b in STATES)
    raw = f"list_filter(regexp_split_to_array(lower(regexp_replace({x}, '\\([^)]{{2,8}}\\)', ' ', 'g')), '[^a-z0-9]+'), lambda t: t <> '')"
    return f"flatten(list_transform({raw}, lambda t: case {ladder} else list_value(t) end))"


def initials(w: str) -> str:
    return f"array_to_string(list_transform(list_filter({w}, lambda t: t not in ({JOINING})), lambda t: substr(t, 1, 1)), '')"


def spelled_initials(w: str) -> str:
    """Initials where a short word without vowels gives all its letters."""
    return f"array_to_string(list_transform(list_filter({w}, lambda t: t not in ({JOINING})), lambda t: case when length(t) <= 4 and not regexp_matches(t, '[aeiou]') then t else substr(t, 1, 1) end), '')"


def core(w: str) -> str:
    """Words that identify: three letters or more, neither neutral, place nor kind of institution."""
    return f"list_sort(list_distinct(list_filter({w}, lambda t: length(t) >= 3 and t not in ({NEUTRAL}) and t not in ({INSTITUTIONS}) and not regexp_matches(t, '^(?:{PLACES}|south|north|western|wales|capital|territory)$'))))"


def jaccard(a: str, b: str) -> str:
    """Of two duplicate-free lists; 0 where both are empty."""
    both = f"len(list_intersect({a}, {b}))"
    return f"(case when len({a}) + len({b}) = 0 then 0.0 else {both}::double / (len({a}) + len({b}) - {both}) end)"


def word_set(x: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(trim(lower(coalesce({x}, ''))), '[ \\t\\r\\n]+'), lambda w: w <> ''))"


def hits(x: str, terms: str) -> str:
    """How many of the terms (separated by |) stand in x as whole words of plain letters, each once."""
    plain = f"' ' || regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g') || ' '"
    return "(" + " + ".join(f"regexp_matches({plain}, ' {t} ')::int" for t in terms.split("|")) + ")"


sql_query("x06_canonical_v2", f"select name, {canonical('name')} as canonical from {NAMES}", "Second canonical form of names.")
sql_query("x07_compound_parts", f"select name, array_to_string(list_sort({parts('name')}), ' | ') as parts, len({parts('name')}) as n from {NAMES}", "Names of several organisations taken apart.")
sql_query(
    "x08_components",
    f"""with p as (select name, unnest({parts('name')}) as part from {NAMES}), c as (select name, {canonical('part')} as c from p), s as (select name, c from c where c <> '' union select name, list_extract(string_split(c, ' '), 1) from c where length(list_extract(string_split(c, ' '), 1)) >= 5 and list_extract(string_split(c, ' '), 1) not in ({INSTITUTIONS}, {NEUTRAL}))
    select name, array_to_string(list_sort(list(c)), ' | ') as components from s group by name""",
    "Canonical components of a name with the brand stem of each (first word of five letters that is no common one).",
)
# Aliases in order; the first that fits wins.
ALIASES = "(values (1, 'metro health', 'Metropolitan Health Network'), (2, 'freight services', 'National Freight'), (3, 'gas networks', 'Gas Networks Operator'), (4, 'legal partners', 'Legal Partners'), (5, 'legal', 'Law Firms')) a(ord, alias, canonical)"
sql_query(
    "x09_alias_names",
    f"select n.name, coalesce(max(case when lower(trim(n.name)) = a.alias then a.canonical end), min_by(a.canonical, a.ord)) as canonical from {NAMES} n join {ALIASES} on contains(lower(n.name), a.alias) or (length(trim(n.name)) >= 3 and contains(a.alias, lower(trim(n.name)))) group by n.name",
    "Alias of a name: exact first, else the first alias that contains the name or is contained in it; the alias list is fixed and small.",
)
sql_query("x10_size_key", f"select name, array_to_string(list_filter(string_split({NORMAL.format('name')}, ' '), lambda w: w <> '' and w not in ({SUFFIXES})), ' ') as size_key from {NAMES}", "Key under which sizes are looked up: normal form without corporate suffixes anywhere.")
sql_query("x11_entity_words", f"select name, array_to_string(list_sort(list_distinct({words('name')})), ' ') as words from {NAMES}", "Words of a name with states written out, repeats dropped (given in text order).")
sql_query("x12_distinctive_core", f"select name, array_to_string({core(words('name'))}, ' ') as core from {NAMES}", "The words that identify an organisation.")
ACRONYM = "(length({s}) between 2 and 6 and regexp_matches({s}, '^[a-z]+$') and len({w}) >= 2 and ({s} = {i} or {s} = {x}))"


def acronym_of(short: str, long: str) -> str:
    return ACRONYM.format(s=f"array_to_string({short}, '')", w=long, i=initials(long), x=spelled_initials(long))


_PAIR_WORDS = f"select l, r, {words('l')} as a, {words('r')} as b from {PAIRS}"
sql_query(
    "x13_acronyms",
    f"with e as (select distinct entity_name from entities), w as (select entity_name, {words('entity_name')} as w from e), i as (select entity_name, w, {initials('w')} as initials, {spelled_initials('w')} as spelled from w) select entity_name, initials, spelled, len(w) >= 2 and length(initials) between 2 and 6 as is_acronym, {acronym_of('list_value(spelled)', 'w')} as of_itself from i",
    "Initialisms of the listed names, with the form in which a word of consonants gives all its letters.",
)
#: One organisation by structure alone; a and b are the word lists of the two names.
SAME_BY_STRUCTURE = f"""(array_to_string(a, '') = array_to_string(b, '') or {acronym_of('a', 'b')} or {acronym_of('b', 'a')} or (len(ca) > 0 and ca = cb)
 or (len(sa) > 0 and len(list_intersect(sa, sb)) = least(len(sa), len(sb)) and len(sa) <> len(sb) and len(case when len(sa) < len(sb) then ca else cb end) > 0
 and (len(list_filter(extra, lambda t: t not in ({NEUTRAL}))) = 0 or len(list_filter(extra, lambda t: t in ({SUBUNITS}))) > 0)))"""


def structured(pairs: str) -> str:
    """l, r with same_by_structure; ``pairs`` has l and r."""
    return f"""(select l, r, coalesce({SAME_BY_STRUCTURE}, false) as same from (select *, {core('a')} as ca, {core('b')} as cb, list_filter(case when len(sa) < len(sb) then sb else sa end, lambda t: not list_contains(case when len(sa) < len(sb) then sa else sb end, t)) as extra
 from (select l, r, a, b, list_sort(list_distinct(a)) as sa, list_sort(list_distinct(b)) as sb from (select l, r, {words('l')} as a, {words('r')} as b from {pairs}))))"""


sql_query("x14_same_by_structure", f"select l, r, same from {structured(PAIRS)}", "Symmetric test: spacing, initialism, equal core, or one name inside the other with neutral or sub-unit words only.")
sql_query(
    "x24_title_asserts_date",
    f"select enriched_event_id, title, len(list_filter(regexp_extract_all(title, '(?:19|20)[0-9][0-9]', 0), lambda y: y = substr(event_date::varchar, 1, 4))) > 0 as names_the_year, regexp_matches(lower(title), '(?:january|february|march|april|may|june|july|august|september|october|november|december) (?:[0-9]+,? )?(?:19|20)[0-9][0-9]') as names_a_month from {TITLES} where event_date is not null",
    "Does the title itself state the year of the event, or a month and year?",
)
PARTIAL = "case when regexp_matches({x}, '^[12][0-9]{{3}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast(substr({x}, 1, 10) as date) when regexp_matches({x}, '^[12][0-9]{{3}}-[0-9]{{2}}$') then try_cast({x} || '-01' as date) when regexp_matches({x}, '^[12][0-9]{{3}}$') then try_cast({x} || '-01-01' as date) end"
_CUT_DATES = "(select distinct decision_id, case when date_left is null then null when date_delta_days is null then substr(trim(date_left), 1, 7) when date_delta_days > 300 then substr(trim(date_left), 1, 4) else trim(date_left) end as t from match_evidence)"
sql_query("x25_partial_dates", f"select decision_id, t, ({PARTIAL.format(x='t')})::varchar as day from {_CUT_DATES} where t is not null", "Days, months (their first day) and years (1 January) as dates; anything else is null.")
sql_query(
    "x31_url_text",
    "select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(source_url), '^[a-z]+://(www\\.)?', '', 'g'), '\\.(com|org|net|gov|edu|au|example|io)\\b', ' ', 'g'), '[-_/.?=&%+]', ' ', 'g'), ' +', ' ', 'g')) as url_text from documents where source_url is not null",
    "A link as words: no scheme, no top-level domain, separators to blanks.",
)
# Words by which a headline, a publisher's page, a regulator, a group of attackers or a description is told.
INCIDENT = "breach|attack|ransomware|hack|leak|exposed|stolen|compromise|phishing|malware|intrusion|outage"
PUBLISHER = "newsletter|subscribe|podcast|press room|home page|weekly digest"
sql_query(
    "x35_title_problems",
    f"select enriched_event_id, title, case when length(trim(title)) < 20 then 'short' when regexp_matches(lower(title), '{PUBLISHER}') then 'publisher' when title = upper(title) and regexp_matches(title, '[A-Z]') then 'shouting' when regexp_matches(title, '(\\.\\.\\.|…)$') then 'cut off' when not regexp_matches(lower(title), '{INCIDENT}') then 'no incident word' end as reason from {TITLES}",
    "Why a title should be written anew; null where it is fine.",
)
_BARS = "regexp_split_to_array(trim(regexp_replace(title, '[ \\t\\r\\n]+', ' ', 'g')), ' [-–—|] ')"
_SPLIT = f"(select enriched_event_id, primary_entity, trim(regexp_replace(title, '[ \\t\\r\\n]+', ' ', 'g')) as t, {_BARS} as bars from {TITLES})"
_CLEAN = f"(select enriched_event_id, primary_entity, case when len(bars) > 1 and length(list_extract(bars, len(bars))) between 2 and 40 and length(t) - length(list_extract(bars, len(bars))) - 3 >= 20 and regexp_matches(lower(substr(t, 1, length(t) - length(list_extract(bars, len(bars))) - 3)), '{INCIDENT}') then trim(substr(t, 1, length(t) - length(list_extract(bars, len(bars))) - 3)) else t end as title from {_SPLIT})"
sql_query("x33_clean_titles", f"select enriched_event_id, title from {_CLEAN}", "Titles without the publisher's name at the end, if a usable headline is left.")
sql_query("x34_title_scores", f"select enriched_event_id, title, (2 * least(3, len(list_distinct(regexp_extract_all(lower(title), '{INCIDENT}', 0)))) + case when length(trim(primary_entity)) >= 4 and contains(lower(title), lower(list_extract(string_split(trim(primary_entity), ' '), 1))) then 3 else 0 end - case when regexp_matches(lower(title), '{PUBLISHER}') then 6 else 0 end + case when length(title) between 20 and 95 then 2 when length(title) < 20 then -3 else -1 end - case when title = upper(title) and regexp_matches(title, '[A-Z]') then 2 else 0 end + case when regexp_matches(title, '[(]([A-Z][a-z]+ )?[0-9]{{4}}[)]$') then 1.5 else 0 end)::double as score from {_CLEAN}", "How well a headline names an incident and its victim.")
REGULATORS = "ombudsman|commissioner|regulator|tribunal|parliament|police|prudential"
ATTACKERS = "gang|hackers?|ransomware|group of criminals|threat actor|collective"
GENERIC_NAMES = "'unknown', 'various', 'multiple', 'undisclosed', 'unnamed', 'n/a', 'none', 'not stated', 'tbc', 'anonymous', 'several organisations', 'customers', 'individuals', 'users'"
NON_ORGANISATION = f"(trim({{x}}) = '' or lower(trim({{x}})) in ({GENERIC_NAMES}) or not regexp_matches({{x}}, '[A-Za-z]') or regexp_matches(lower({{x}}), '^(an?|the|some|several|many|two|three) (unnamed |major |local |large )?(organi[sz]ations?|compan(y|ies)|firms?|businesses|customers)$'))"
PERSON = "regexp_matches(trim({x}), '^((Mr|Mrs|Ms|Dr|Prof)\\.? )?[A-Z][a-z]+ [A-Z][a-z]+$')"
sql_query(
    "x36_name_predicates",
    f"select name, {NON_ORGANISATION.format(x='name')} as no_organisation, regexp_matches(lower(name), '\\b({REGULATORS})\\b') as regulator, regexp_matches(lower(name), '\\b({ATTACKERS})\\b') as attacker, {PERSON.format(x='name')} as person from {NAMES}",
    "What a name is not: no organisation, a regulator, an attacker, a person.",
)
DESCRIPTIVE = "(regexp_matches({x}, '^(An?|The|Some|Several|Unnamed|Multiple|Various) [a-z]') or (not regexp_matches({x}, '[A-Z]') and len(string_split(trim({x}), ' ')) >= 2) or len(list_filter(string_split(trim({x}), ' '), lambda w: regexp_matches(w, '^[a-z]'))) > 2)"
sql_query("x37_descriptive_labels", f"select name, {DESCRIPTIVE.format(x='name')} as descriptive from {NAMES}", "A phrase and no proper name: an article and a small letter, no capital at all, or several words in small letters.")
sql_query(
    "x42_sector_proxy",
    "select entity_id, case when industry in ('Government', 'Healthcare', 'Education', 'Retail', 'Technology', 'Manufacturing', 'Media') then industry when industry = 'Financial Institution' or regexp_matches(lower(entity_name), 'bank|insurance|credit|superannuation|finance') then 'Finance' when regexp_matches(lower(entity_name), 'hospital|health|medical|clinic|pharmacy') then 'Healthcare' when regexp_matches(lower(entity_name), 'university|school|college|academy') then 'Education' when regexp_matches(lower(entity_name), 'council|department|government|authority') then 'Government' when regexp_matches(lower(entity_name), 'energy|water|gas|power') then 'Utilities' when entity_kind = 'individual' then 'Individual' else 'Other' end as sector from entities",
    "Sector by the exact industry, else by the words of the name.",
)
RANGE = "regexp_replace(regexp_replace(regexp_replace(lower(trim({x})), '[, ]', '', 'g'), '(to|–|—)', '-', 'g'), '(ormore|andabove|andover)$', '+', 'g')"
_LABELS = "(values ('1,001 - 5,000'), ('5001 to 10,000'), ('10,001 or more'), ('1'), ('2–10'), ('11 to 100'), ('< 10 days'), ('10 - 20 days'), ('over 12 months'), ('Unknown'), ('')) t(label)"
sql_query(
    "x45_range_labels",
    f"select label, nullif({RANGE.format(x='label')}, '') as range_label, try_cast(nullif(regexp_extract({RANGE.format(x='label')}, '^([0-9]+)', 1), '') as bigint) as low, try_cast(nullif(regexp_extract({RANGE.format(x='label')}, '^[0-9]+-([0-9]+)', 1), '') as bigint) as high, case when regexp_matches(lower(label), '^(<|under|less).*day') then 'first days' when regexp_matches(lower(label), 'day') then 'days' when regexp_matches(lower(label), 'month') then 'months' when lower(trim(label)) in ('', 'unknown') then 'unknown' else 'count' end as kind from {_LABELS}",
    "Range and time-bucket labels in one spelling, with their bounds.",
)
sql_query(
    "x47_row_coercion",
    "select distinct classification_id, try_cast(records_affected as int) as records, cast(floor(coalesce(confidence_score, 0.0) * 100) as int) as percent, coalesce(nullif(trim(victim_organization_name), ''), 'Unknown') as victim, coalesce(event_date, date '1970-01-01')::varchar as day, coalesce(lower(model_used) in ('model-a', 'model-b'), false) as known_model from " + RISK,
    "A row brought to a schema, with defaults for what is missing.",
)
sql_query("x49_local_names", f"select name, regexp_matches(lower(name), '\\b(australia|australian|nsw|victoria|queensland|tasmania|canberra|sydney|melbourne|brisbane|perth|adelaide|hobart|darwin)\\b') as local, regexp_matches(lower(name), '\\b(australia|anz|asia pacific)\\b.*(pty|ltd|limited)') as local_arm from {NAMES}", "Local names, and local arms of foreign ones.")
_NUM = "nullif(regexp_extract({x}, '{p}', 1), '')"
sql_query(
    "x50_text_facts",
    f"""with t as (select distinct enriched_event_id, coalesce(title, '') || '. ' || coalesce(summary, '') as t from extracted_event_details where enriched_event_id is not null), f as (select enriched_event_id, nullif(regexp_extract(t, '([A-Z][a-z]+[A-Z][a-z]+) (?:strikes|posts|raid|attack)', 1), '') as attacker,
    {hits('t', 'injection|api|misconfigured')} as web, {hits('t', 'phishing|invite|reused|password')} as people, {hits('t', 'ransomware|encrypted|flood')} as malware, nullif(regexp_extract(t, '((?:A\\$|\\$|€|£)[0-9][0-9,.]*(?: (?:million|billion|thousand))?)', 1), '') as money,
    replace(nullif(regexp_extract(t, '([0-9][0-9,]*) (?:[a-z]+ ){{0,2}}(?:records|customers|patients|passengers|tenants|accounts|students|members|files)', 1), ''), ',', '') as affected, case when regexp_matches(lower(t), 'critical|catastrophic') then 'critical' when regexp_matches(lower(t), 'serious|major|severe') then 'high' when regexp_matches(lower(t), 'minor|limited') then 'low' end as severity from t)
    select enriched_event_id, attacker, case when greatest(web, people, malware) = 0 then null when web >= people and web >= malware then 'web' when people >= malware then 'people' else 'malware' end as weakness, money, try_cast(affected as bigint) as affected, severity from f""",
    "Attacker, kind of weakness (most words hit), sums, affected counts and severity words of a text.",
)
sql_query(
    "x51_title_entity",
    f"""select enriched_event_id, title, coalesce(nullif(trim(regexp_extract(title, '^(.+?) (?:admits|confirms|denies|discloses|reports) ', 1)), ''), nullif(trim(regexp_extract(title, ' strikes (.+?):', 1)), ''), nullif(trim(regexp_extract(title, ' after (.+?) falls for', 1)), ''), nullif(trim(regexp_extract(title, ' (?:gone|missing) after (.+?) falls', 1)), ''), nullif(trim(regexp_extract(title, ' shows (.+?) ignored ', 1)), ''), nullif(trim(regexp_extract(title, ' examine (.+?) over ', 1)), ''), nullif(trim(regexp_extract(title, ' from (.+?) in [A-Z]', 1)), ''), nullif(trim(regexp_extract(title, ' as (.+?) rebuilds ', 1)), ''), nullif(trim(regexp_extract(title, '((?:[A-Z][A-Za-z&]+ ){{1,4}}(?:Pty|Ltd|Limited|Inc|Network|Partners|Group|Council|University|Hospital))', 1)), ''), nullif(trim(regexp_extract(title, '((?:[A-Z][a-z]+ ){{2,4}})', 1)), '')) as entity from {TITLES}""",
    "Organisation named by a headline: the first of several sentence forms, else a run of capitalised words.",
)
sql_query(
    "x52_capitalised_phrases",
    f"with w as (select enriched_event_id, unnest(list_distinct(regexp_extract_all(title, '[A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*', 0))) as phrase from {TITLES}) select enriched_event_id, count(*) as phrases, max(length(phrase)) as longest, array_to_string(list_sort(list(lower(phrase))), '|') as entities from w where length(phrase) > 3 and lower(phrase) not in ('the', 'and', 'for', 'with', 'from', 'after', 'exclusive', 'how', 'matters') group by 1",
    "Capitalised phrases of a title without stop words.",
)
_MONTHS = "(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec)"
# each form of date, the longest first; what is left of its brackets and prepositions goes with it
DATE_FORMS = (
    f"(?i)\\b(?:on |in |since |by |until |from )?(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday),? [0-9]{{1,2}}(?:st|nd|rd|th)? {_MONTHS}(?:,? (?:19|20)[0-9]{{2}})?\\b",
    f"(?i)\\b(?:on |in |since |by |until |from )?[0-9]{{1,2}}(?:st|nd|rd|th)? (?:of )?{_MONTHS},? (?:19|20)[0-9]{{2}}\\b",
    f"(?i)\\b(?:on |in |since |by |until |from )?{_MONTHS} [0-9]{{1,2}}(?:st|nd|rd|th)?,? (?:19|20)[0-9]{{2}}\\b",
    f"(?i)\\b(?:on |in |since |by |until |from )?(?:early |mid-|mid |late )?{_MONTHS},? (?:19|20)[0-9]{{2}}\\b",
    f"(?i)\\b(?:on |in |since |by |until |from )?[0-9]{{1,2}}(?:st|nd|rd|th)? (?:of )?{_MONTHS}\\b",
    f"(?i)\\b(?:on |in |since |by |until |from )?{_MONTHS} [0-9]{{1,2}}(?:st|nd|rd|th)?\\b",
    "\\b(?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}\\b", "\\b[0-9]{1,2}/[0-9]{1,2}/(?:19|20)?[0-9]{2}\\b", "\\b[0-9]{1,2}\\.[0-9]{1,2}\\.(?:19|20)[0-9]{2}\\b", "(?i)\\bq[1-4],? (?:19|20)[0-9]{2}\\b", "(?i)\\b(?:fy|financial year) ?(?:20)?[0-9]{2}(?:[/-][0-9]{2})?\\b",
    "(?i)\\b(?:on |since |by |until )?(?:last |next |this )?(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday)\\b", "(?i)\\b(?:yesterday|today|tomorrow|last (?:week|month|year))\\b", "(?i)\\b(?:in |since )(?:19|20)[0-9]{2}\\b",
)


def without_dates(x: str) -> str:
    for form in DATE_FORMS:
        x = f"regexp_replace({x}, '{form}', '', 'g')"
    return f"trim(regexp_replace(regexp_replace(regexp_replace({x}, '\\( *\\)', '', 'g'), ' +([,.;:])', '\\1', 'g'), ' +', ' ', 'g'))"


sql_query("x53_texts_without_dates", f"select distinct enriched_event_id, {without_dates('summary')} as summary from extracted_event_details where summary is not null", "Summaries with fourteen forms of date taken out and the punctuation closed up.")
def variants(x: str) -> str:
    """Whole, in capitals, as key, in one word, without its legal form, its first word; four letters at least."""
    forms = (f"trim({x})", f"upper(trim({x}))", KEY.format(x), f"replace(trim({x}), ' ', '')", f"regexp_replace(trim({x}), ' (Pty|Ltd|Limited|Inc|Group|Holdings)\\.?$', '', 'g')", f"list_extract(string_split(trim({x}), ' '), 1)")
    return f"list_distinct(list_filter(list_value({', '.join(forms)}), lambda v: length(v) >= 4))"


sql_query("x54_name_variants", f"select name, array_to_string(list_sort({variants('name')}), ' | ') as variants from {NAMES}", "Forms under which a name may stand in a text.")
sql_query(
    "x55_redacted_titles",
    f"select distinct enriched_event_id, replace(replace(title, trim(primary_entity), '[VICTIM]'), coalesce(nullif(list_extract(string_split(trim(primary_entity), ' '), 1) || ' ' || coalesce(list_extract(string_split(trim(primary_entity), ' '), 2), ''), ''), trim(primary_entity)), '[VICTIM]') as title from {TITLES} where length(trim(primary_entity)) >= 4",
    "Titles with the victim's name redacted, the longest form first.",
)
sql_query("x57_json_rows", "select deduplicated_event_id, json_object('day', day, 'kind', kind, 'n', n)::varchar as payload from (select distinct deduplicated_event_id, coalesce(event_date::varchar, 'none') as day, coalesce(event_type, 'none') as kind, coalesce(records_affected, 0) as n from " + RISK + " where deduplicated_event_id is not null)", "Rows as JSON text, dates and missing values as text.")
sql_query("x61_natural_key_ids", f"select enriched_event_id, substr(sha256(k), 1, 32) as record_key from (select enriched_event_id, coalesce(title, '') || '|' || coalesce(event_date::varchar, '') as k from {EV})", "Ids from the natural key, so that a repeated load gives the same id.")
_CHECKS = "(select distinct decision_id, case when entity_match then 0.9 when entity_match is null then null else 0.4 end as entity_c, coalesce(entity_match, false) as entity_ok, case when date_delta_days is null then null else 0.8 end as date_c, coalesce(date_delta_days <= 30, false) as date_ok, embedding_similarity as vector_c, coalesce(embedding_similarity >= 0.55, false) as vector_ok, title_similarity as title_c, coalesce(title_similarity >= 0.75, false) as title_ok from match_evidence)"
_TERM = "case when {n}_c is null then 0.0 when {n}_ok then {w} * {n}_c else {w} * 0.5 * (1 - {n}_c) end"
sql_query(
    "x62_verification_confidence",
    f"select decision_id, round({' + '.join(_TERM.format(n=n, w=w) for n, w in (('entity', 0.4), ('date', 0.4), ('vector', 0.1), ('title', 0.1)))}, 6)::double as confidence, (entity_ok::int + date_ok::int + vector_ok::int + title_ok::int) as passed from {_CHECKS}",
    "Weighted confidence of four checks; a failed check gives half of what it lacks.",
)
_PEN = "(case when primary_entity is null or trim(primary_entity) = '' then 0.7 else 1.0 end) * (case when event_date is null then 0.8 else 1.0 end) * (case when is_specific_event is not true then 0.5 else 1.0 end)"
sql_query(
    "x63_final_confidence",
    f"select enriched_event_id, confidence, case when confidence >= 0.8 then 'accept' when confidence >= 0.5 then 'review' else 'reject' end as decision from (select enriched_event_id, round((0.3 * coalesce(confidence_score, 0) + 0.3 * (records_affected is not null)::int + 0.2 * (severity is not null)::int + 0.2 * (title is not null)::int) * {_PEN}, 6)::double as confidence from {EV})",
    "Weighted confidence with multiplying penalties, and what follows from it.",
)
_ERRORS = "(title is null or trim(title) = '')::int + (event_date > date '2025-12-31')::int + (coalesce(records_affected, 0) < 0)::int"
_WARN = "(primary_entity is null)::int + (event_date is null)::int + (severity is null)::int"
sql_query("x64_validation_confidence", f"select enriched_event_id, errors, warnings, round((greatest(0.0, 1 - 0.3 * errors - 0.1 * warnings) + coalesce(confidence_score, 0.5)) / 2, 6)::double as confidence from (select enriched_event_id, confidence_score, coalesce({_ERRORS}, 0) as errors, {_WARN} as warnings from {EV})", "One less 0.3 an error and 0.1 a warning, averaged with the score of the checks.")
sql_query(
    "x65_organisation_errors",
    f"select name, array_to_string(list_sort(list_filter(list_value(case when {NON_ORGANISATION.format(x='name')} then 'generic' end, case when {PERSON.format(x='name')} then 'person' end, case when length(trim(name)) < 3 then 'short' end, case when regexp_matches(name, '[<>{{}}]') then 'markup' end, case when {DESCRIPTIVE.format(x='name')} then 'description' end), lambda e: e is not null)), ',') as errors from {NAMES}",
    "What speaks against a name being an organisation's.",
)
sql_query(
    "x66_consistency_rules",
    f"select enriched_event_id, primary_entity is not null and contains(lower(title), lower(trim(primary_entity))) as title_names_victim, event_date is null or event_date <= date '2025-12-31' as date_in_order, records_affected is null or not regexp_matches(title, '[0-9]{{1,3}},[0-9]{{3}}') or contains(title, substr(records_affected::varchar, 1, 1)) as count_consistent, coalesce(is_specific_event, false) and not regexp_matches(lower(title), 'weekly|roundup|statistics|survey|forecast|report finds') as specific from {EV} where title is not null",
    "Rules that hold a row against its own title.",
)
# The kinds of weakness that count as known.
sql_query("x67_known_kinds", f"select event_type, event_type in ('Ransomware', 'Data Breach', 'Phishing', 'Malware', 'Insider Threat', 'Denial of Service', 'Identity Theft', 'Financial Fraud', 'Other') as known, count(*) as n from {EV} where event_type is not null group by 1, 2", "Membership in a fixed list of kinds.")
sql_query("x68_text_without_title", "select distinct enriched_event_id, case when title is not null and starts_with(lower(summary), lower(trim(title))) then ltrim(substr(summary, length(trim(title)) + 1)) else summary end as summary from extracted_event_details where summary is not null", "The summary without the title at its head.")
_HALVES = "(select distinct year(event_date) as y, case when month(event_date) <= 6 then 1 else 2 end as h from extracted_event_details where event_date between date '2015-01-01' and date '2026-12-31')"
sql_query("x69_half_year_calendar", f"select y, h, make_date(y, case when h = 1 then 1 else 7 end, 1)::varchar as first_day, make_date(y, case when h = 1 then 6 else 12 end, case when h = 1 then 30 else 31 end)::varchar as last_day, make_date(case when h = 1 then y else y + 1 end, case when h = 1 then 9 else 3 end, 1) <= date '2025-12-31' as published from {_HALVES}", "Half-years with the day from which their report can be expected.")
sql_query("x70_bands", "select distinct deduplicated_event_id, case when event_date < date '2022-01-01' then 0 when event_date < date '2024-01-01' then 1 else 2 end as calendar_band, case when gap <= 0 then 0 when gap <= 90 then 1 when gap <= 180 then 2 when gap <= 365 then 3 else 4 end as elapsed_band, case when gap <= 90 then '1-90' when gap <= 180 then '91-180' when gap <= 365 then '181-365' else '>365' end as label from (select deduplicated_event_id, event_date, date_diff('day', event_date, date '2025-12-31') as gap from " + RISK + " where event_date is not null)", "Calendar and elapsed bands; elapsed ones are open below and closed above.")
sql_query("x28_semester_labels", "select label, case when regexp_extract(lower(label), '((?:19|20)[0-9]{2})', 1) <> '' and half is not null then regexp_extract(lower(label), '((?:19|20)[0-9]{2})', 1) || ' ' || half end as semester from (select label, case when regexp_matches(lower(label), '\\bh1\\b|jan[a-z]*[^a-z]+(to[^a-z]+)?jun') then 'H1' when regexp_matches(lower(label), '\\bh2\\b|jul[a-z]*[^a-z]+(to[^a-z]+)?dec') then 'H2' end as half from (values ('H1 2025'), ('2024-h2'), ('Jan-Jun 2023'), ('July to December 2022'), ('2021'), ('unknown')) t(label))", "One spelling of half-year labels.")
sql_query("x27_report_period", f"select enriched_event_id, y, case when regexp_matches(low, '\\bq1\\b|\\bq2\\b|\\bh1\\b|first half|january|february|march|april|may|june') then 'H1' when regexp_matches(low, '\\bq3\\b|\\bq4\\b|\\bh2\\b|second half|july|august|september|october|november|december') then 'H2' end as half from (select enriched_event_id, lower(summary) as low, nullif(regexp_extract(summary, '((?:19|20)[0-9]{{2}})', 1), '') as y from (select distinct enriched_event_id, summary from extracted_event_details where summary is not null)) where y is not null", "Half-year that a report's text names.")
_SPANS = "(values ('1 July 2025 to 31 December 2025'), ('January to June 2024'), ('Jul 2023 - Dec 2023'), ('2022'), ('no period')) t(name)"
_FIRST = "lower(substr(regexp_extract(name, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)', 1), 1, 3))"
sql_query("x26_period_of_name", f"select name, nullif(regexp_extract(name, '((?:19|20)[0-9]{{2}})[^0-9]*$', 1), '') as y, case when {_FIRST} in ('jan', 'feb', 'mar', 'apr', 'may', 'jun') then 'H1' when {_FIRST} in ('jul', 'aug', 'sep', 'oct', 'nov', 'dec') then 'H2' end as half from {_SPANS}", "Year and half-year of a sheet's name; the last year and the first month decide.")

# smaller kernels
sql_query("z05_earliest_publication", "select source, min(published_at)::date::varchar as first_published, count(*) as n from documents where published_at is not null group by 1", "Earliest publication in a list of sources.")
sql_query("z04_date_fallback", "select distinct e.enriched_event_id, coalesce(e.event_date, cast(e.discovered_at as date), date '2020-01-01')::varchar as day, case when e.event_date is not null then 'event' when e.discovered_at is not null then 'seen' else 'start' end as origin from extracted_event_details e where e.enriched_event_id is not null", "Event date, else the day it was seen, else the start of the search.")
sql_query("z10_generic_descriptions", "select distinct enriched_event_id, case when summary is null or length(summary) < 40 or regexp_matches(lower(summary), '^(cyber )?(incident|event)( reported)?\\.?$') then substr(coalesce(title, ''), 1, 500) || '...' else summary end as summary from extracted_event_details where enriched_event_id is not null", "A generic description gives way to the snippet.")
sql_query("z11_type_from_text", f"select enriched_event_id, case when regexp_matches(low, 'ransom') then 'Ransomware' when regexp_matches(low, 'phish|invite') then 'Phishing' when regexp_matches(low, 'denial-of-service|flood') then 'Denial of Service' when regexp_matches(low, 'insider|contractor') then 'Insider Threat' when regexp_matches(low, 'malware|worm') then 'Malware' when regexp_matches(low, 'breach|exposed|leak|stolen|missing') then 'Data Breach' else 'Other' end as event_type from (select enriched_event_id, lower(title) as low from {TITLES})", "Kind of event by the words of the text, the first that fits.")
sql_query("z12_unfenced_json", "select snapshot_id, trim(regexp_replace(regexp_replace(fenced, '^ *```[a-z]*', '', 'g'), '``` *$', '', 'g')) = trim(payload_json) as restored from (select distinct snapshot_id, payload_json, '```json' || payload_json || '```' as fenced from snapshots where payload_json is not null)", "Markdown fences around JSON taken off.")
_ERR = "(values ('HTTP 401 unauthorized'), ('429 too many requests'), ('503 service unavailable'), ('404 not found'), ('connection reset by peer'), ('read timeout'), ('strange')) t(message)"
sql_query("z13_error_kinds", f"select message, case when regexp_matches(message, '\\b(401|403)\\b') then 'auth' when regexp_matches(message, '\\b429\\b|too many') then 'rate' when regexp_matches(message, '\\b5[0-9]{{2}}\\b') then 'server' when regexp_matches(message, '\\b4[0-9]{{2}}\\b') then 'client' when regexp_matches(message, 'connection|timeout|dns') then 'network' else 'unknown' end as kind from {_ERR}", "Errors by kind: sign-in, rate, server, client, network.")
sql_query("z14_article_date", "select doc_id, coalesce(published_at::date::varchar, nullif(regexp_extract(text, '\\b((?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})\\b', 1), ''), nullif(regexp_extract(source_url, '/((?:19|20)[0-9]{2}/[0-9]{2})', 1), '')) as day from documents where text is not null", "Date of an article: its own field, else its text, else its link.")
sql_query("z15_headline_entity", f"select enriched_event_id, coalesce(nullif(regexp_extract(title, '(?:ombudsman|commissioner|regulator) to examine (.+?) over ', 1), ''), nullif(regexp_extract(title, 'determination against (.+)$', 1), ''), nullif(regexp_extract(title, '^(.+?) (?:fined|sued|ordered)', 1), '')) as entity from {TITLES}", "Organisation named by a regulator's headline.")
_HTML = "(select doc_id, '<html><head><title>' || coalesce(source, '') || '</title></head><body><nav>menu</nav><p>' || substr(text, 1, 20) || '</p><a href=\"/story/' || doc_id::varchar || '\">x</a><a href=\"' || coalesce(source_url, 'http://none.example/') || '\">y</a><script>var a = 1</script></body></html>' as html from documents where text is not null and not contains(substr(text, 1, 20), '<'))"
sql_query("z16_harvested_links", f"select doc_id, case when starts_with(link, '/') then 'https://base.example' || link else link end as link from (select doc_id, regexp_replace(found, 'href=|\"', '', 'g') as link from (select doc_id, unnest(list_distinct(regexp_extract_all(html, 'href=\"[^\"]+\"', 0))) as found from {_HTML}))", "Links of a page, relative ones resolved.")
sql_query("z18_main_text", f"select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(html, chr(10), ' '), '<(?:script|style|nav|head)[^>]*>.*?</(?:script|style|nav|head)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), ' +', ' ', 'g')) as main_text, regexp_extract(html, '<title>([^<]*)</title>', 1) as page_title from {_HTML}", "Main text and title of a page: no scripts, styles, navigation or tags.")
sql_query("s08_structured_results", f"select doc_id, nullif(trim(regexp_extract(html, '<p>([^<]*)</p>', 1)), '') as snippet, regexp_extract(html, 'href=\"([^\"]+)\"', 1) as link, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title from {_HTML}", "Fields of a result page by its marks.")
sql_query("z17_dates_in_links", "select doc_id, coalesce(case when regexp_matches(source_url, '/[0-9]{4}/[0-9]{2}/') then regexp_extract(source_url, '/([0-9]{4})/', 1) || '-' || regexp_extract(source_url, '/[0-9]{4}/([0-9]{2})/', 1) || '-01' end, case when regexp_matches(source_url, '[0-9]{2}_[0-9]{2}_[0-9]{4}') then regexp_extract(source_url, '[0-9]{2}_[0-9]{2}_([0-9]{4})', 1) || '-' || regexp_extract(source_url, '[0-9]{2}_([0-9]{2})_', 1) || '-' || regexp_extract(source_url, '([0-9]{2})_[0-9]{2}_', 1) end) as day from documents where source_url is not null", "Date of a link in either notation.")
sql_query("z19_pdf_links", "select doc_id, regexp_matches(lower(source_url), '\\.pdf([?#].*)?$|/pdf/') as is_pdf from documents where source_url is not null", "Links to PDF files.")
sql_query("z20_story_hint", "select doc_id, nullif(trim(regexp_replace(regexp_replace(regexp_extract(source_url, '^[a-z]+://[^/]+/(.*)$', 1), '[0-9]+|\\.html?$', ' ', 'g'), '[-_/ ]+', ' ', 'g')), '') as hint, nullif(regexp_extract(source_url, '/((?:19|20)[0-9]{2})/', 1), '') as year_hint from documents where source_url is not null", "What the slug of a link tells of the story, and its year.")
sql_query("z21_urls_in_text", "select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, 'https?://[^ \\n\\t<>\"]+', 0))), ' ') as links from (select doc_id, concat_ws(' ', text, 'Source:', source_url) as t from documents)", "Links harvested from a text and its source line.")
sql_query("z31_evidence_lines", "select distinct decision_id, concat_ws('; ', case when entity_match then 'same organisation' end, case when date_delta_days is not null then date_delta_days::varchar || ' days apart' end, case when embedding_similarity is not null then 'vectors ' || round(embedding_similarity, 1)::varchar end, case when len(shared_urls) > 0 then len(shared_urls)::varchar || ' shared links' end) as line from match_evidence where decision_id is not null", "One line of evidence, skipping what is missing.")
sql_query("z30_evidence_structs", "select distinct decision_id, array_to_string(list_sort(list_concat(coalesce(shared_urls, list_value()::varchar[]), coalesce(supporting_facts, list_value()::varchar[]))), ' | ') as support, len(coalesce(distinguishing_facts, list_value()::varchar[])) as against, coalesce(entity_canonical_left = entity_canonical_right, false) as same_key from match_evidence where decision_id is not null", "Evidence of a pair: what supports it, what speaks against it.")
sql_query("z35_victim_words", f"select name, array_to_string(list_sort(list_filter(list_distinct({TOKENS.format('name')}), lambda w: length(w) >= 4)), ' ') as words from {NAMES}", "Words of a victim's name that may stand in a title.")
sql_query("z34_preferred_variants", f"select name_key, max_by(name, (regexp_matches(name, '(?i)(pty|ltd|limited|inc)\\.?$')::int, length(name), name)) as preferred, count(*) as variants from (select name, {KEY.format('name')} as name_key from {NAMES}) group by 1", "The variant with a legal form, then the longest.")
sql_query("z76_date_ranges", "select r, try_cast(trim(list_extract(string_split(r, ':'), 1)) as date)::varchar as first_day, try_cast(trim(list_extract(string_split(r, ':'), 2)) as date)::varchar as last_day, len(string_split(r, ':')) = 2 as well_formed from (values ('2024-01-01:2024-06-30'), ('2024-01-01'), ('x:y'), ('2023-07-01 : 2023-12-31')) t(r)", "Date ranges of an argument.")
sql_query("x20_term_counts", f"select enriched_event_id, {hits('title', 'ransomware|phishing|breach|attack|outage')} as terms from {TITLES}", "Listed terms that stand in a title as whole words, each counted once.")
