"""Names, text kernels, candidate pairs and clusters (SURVEY X and D rows)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from caseflux.functions import names as nm
from caseflux.functions import text as tx
from caseflux.plans.registry import query
from caseflux.plans.series import EV, MEMBERS, RISKED, active, events, members, risks
from caseflux.sources.tables import table

NORMAL = "trim(regexp_replace(regexp_replace(replace(translate(lower({0}), 'àáâãäåāçćčèéêëēìíîïīñńòóôõöøōùúûüūýÿžźšśł', 'aaaaaaaccceeeeeiiiiinnooooooouuuuuyyzzssl'), '&', ' and '), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"
_FORMS = "|".join(nm.LEGAL_FORMS)
KEY = f"regexp_replace({NORMAL}, '^(.*?\\S)( ({_FORMS}))+$', '\\1')"
_GENERIC = ", ".join(f"'{w}'" for w in nm.GENERIC)
TOKENS = f"list_filter(string_split({KEY}, ' '), lambda w: w not in ({_GENERIC}) and w <> '')"


@query("x01_normal_name", f"select entity_id, {NORMAL.format('entity_name')} as normal from entities")
def x01(spark, d):
    return table(spark, d, "entities").select("entity_id", nm.normal_name(F.col("entity_name")).alias("normal"))


@query("x02_name_key", f"select entity_id, {KEY.format('entity_name')} as key from entities")
def x02(spark, d):
    return table(spark, d, "entities").select("entity_id", nm.name_key(F.col("entity_name")).alias("key"))


@query("x03_name_tokens", f"select entity_id, array_to_string({TOKENS.format('entity_name')}, ' ') as tokens from entities")
def x03(spark, d):
    return table(spark, d, "entities").select("entity_id", F.array_join(nm.name_tokens(F.col("entity_name")), " ").alias("tokens"))


_KEYS = f"(select entity_id, {KEY.format('entity_name')} as k, {TOKENS.format('entity_name')} as w from entities)"


@query("x04_blocking_keys", f"select distinct entity_id, block from (select entity_id, k as block from {_KEYS} union all select entity_id, array_to_string(w, ' ') from {_KEYS} union all select entity_id, w[1] || ' ' || w[2] from {_KEYS} where len(w) >= 2 union all select entity_id, w[1] from {_KEYS} union all select entity_id, array_to_string(list_transform(w, lambda x: substr(x, 1, 1)), '') from {_KEYS} where len(string_split(k, ' ')) >= 3 and len(w) >= 3) where block <> '' and block not in ({_GENERIC})")
def x04(spark, d):
    return table(spark, d, "entities").select("entity_id", F.explode(nm.blocking_keys(F.col("entity_name"))).alias("block"))


@query(
    "x05_name_similarity",
    f"""with t as (select distinct decision_id, list_distinct({TOKENS.format('entity_left')}) as a, list_distinct({TOKENS.format('entity_right')}) as b from match_evidence where entity_left is not null and entity_right is not null),
    s as (select decision_id, len(list_intersect(a, b)) as k, len(a) as na, len(b) as nb from t) select decision_id, round(max(case when k = 0 then 0 else greatest(k / (na + nb - k), 0.95 * k / least(na, nb)) end), 6) as similarity from s group by 1""",
)
def x05(spark, d):
    rows = table(spark, d, "match_evidence").where("entity_left is not null and entity_right is not null").select("decision_id", "entity_left", "entity_right").distinct()
    s = nm.token_similarity(nm.name_tokens(F.col("entity_left")), nm.name_tokens(F.col("entity_right")))
    return rows.groupBy("decision_id").agg(F.round(F.max(s), 6).alias("similarity"))


_W = "list_distinct(list_filter(regexp_split_to_array(trim(lower({0})), '\\s+'), lambda w: w <> ''))"


@query("x16_title_jaccard", f"with t as (select distinct decision_id, {_W.format('title_left')} as a, {_W.format('title_right')} as b from match_evidence where title_left is not null and title_right is not null) select decision_id, round(max(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))), 6) as similarity from t where len(a) + len(b) > 0 group by 1")
def x16(spark, d):
    rows = table(spark, d, "match_evidence").where("title_left is not null and title_right is not null and (trim(title_left) <> '' or trim(title_right) <> '')")
    return rows.groupBy("decision_id").agg(F.round(F.max(tx.word_jaccard(F.col("title_left"), F.col("title_right"))), 6).alias("similarity"))


@query("x17_sequence_ratio", None)
def x17(spark, d):
    """Ratcliff-Obershelp ratio of the titles, in Arrow batches."""
    from difflib import SequenceMatcher

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() for x, y in zip(a, b)])

    rows = table(spark, d, "match_evidence").where("title_left is not null and title_right is not null").select("decision_id", "title_left", "title_right").distinct()
    return rows.select("decision_id", F.round(ratio("title_left", "title_right"), 6).alias("ratio"))


@query("x18_temporal_similarity", "select decision_id, case when date_delta_days is null then 0.5 when abs(date_delta_days) = 0 then 1.0 when abs(date_delta_days) <= 7 then 0.8 when abs(date_delta_days) <= 30 then 0.6 when abs(date_delta_days) <= 90 then 0.4 when abs(date_delta_days) <= 365 then 0.2 else 0.0 end::double as similarity from (select distinct decision_id, date_delta_days from match_evidence)")
def x18(spark, d):
    n = F.abs("date_delta_days")
    s = F.when(n.isNull(), 0.5).when(n == 0, 1.0).when(n <= 7, 0.8).when(n <= 30, 0.6).when(n <= 90, 0.4).when(n <= 365, 0.2).otherwise(0.0)
    return table(spark, d, "match_evidence").select("decision_id", "date_delta_days").distinct().select("decision_id", s.alias("similarity"))


# Weighted terms of the relevance score.
CYBER = ("ransomware", "malware", "phishing", "data breach", "extortion", "denial-of-service")
SUPPORT = ("security", "breach", "incident", "attack", "investigation", "leak")
OTHER = ("festival", "football", "concert", "bushfire", "flood", "wedding")


def _count_sql(c: str, terms: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"regexp_matches(lower({c}), '\\b{t}\\b')::int" for t in terms) + ")"


@query(
    "f13_relevance_score",
    f"with h as (select distinct enriched_event_id, {_count_sql('t', CYBER)} as a, {_count_sql('t', SUPPORT)} as b, {_count_sql('t', OTHER)} as c from (select enriched_event_id, concat_ws(' ', title, summary) as t from extracted_event_details)) select enriched_event_id, max(round(least(1, greatest(0, 0.5 + least(0.4, 0.2 * a) + case when a > 0 then least(0.2, 0.05 * b) else 0 end - least(0.6, 0.2 * c))), 4)::double) as score from h group by 1",
)
def f13(spark, d):
    t = F.concat_ws(" ", "title", "summary")
    a, b, c = (tx.term_count(t, terms) for terms in (CYBER, SUPPORT, OTHER))
    rows = table(spark, d, "extracted_event_details").select("enriched_event_id", a.alias("a"), b.alias("b"), c.alias("c")).distinct()
    score = 0.5 + F.least(F.lit(0.4), 0.2 * F.col("a")) + F.when(F.col("a") > 0, F.least(F.lit(0.2), 0.05 * F.col("b"))).otherwise(0) - F.least(F.lit(0.6), 0.2 * F.col("c"))
    return rows.groupBy("enriched_event_id").agg(F.max(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 4)).alias("score"))


_DAY_SQL = "case when try_cast({y} as int) between 1995 and 2100 and try_cast({m} as int) between 1 and 12 and try_cast({d} as int) >= 1 then {y} || '-' || lpad(({m})::int::varchar, 2, '0') || '-' || lpad(least(({d})::int, case when ({m})::int = 2 then 28 when ({m})::int in (4, 6, 9, 11) then 30 else 31 end)::varchar, 2, '0') end"
_MON = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_YR, _DY, _GAP, _EDGE = "((?:19|20)[0-9]{2})", "([0-9]{1,2})(?:st|nd|rd|th)?", "[^a-z0-9]+", "(?:^|[^a-z0-9])"


def _date_sql(x: str, form: str) -> str:
    """A date of one form by one pattern: the oracle of the word-wise reading."""
    part = {"D": _DY, "M": _MON, "Y": _YR, "N": "(0?[1-9]|1[0-2])"}
    pattern = _EDGE + _GAP.join(part[c] for c in form) + "(?:$|[^a-z0-9])"
    got = {c: f"regexp_extract({x}, '{pattern}', {k + 1})" for k, c in enumerate(form)}
    month = f"((strpos('janfebmaraprmayjunjulaugsepoctnovdec', substr({got['M']}, 1, 3)) + 2) / 3)::int::varchar" if "M" in got else got["N"]
    return "case when " + f"regexp_matches({x}, '{pattern}')" + " then " + _DAY_SQL.format(y=got["Y"], m=month, d=got.get("D", "'1'")) + " end"


_ISO_SQL = "case when regexp_matches({x}, '\\b(?:19|20)[0-9]{{2}}-[0-9]{{1,2}}-[0-9]{{1,2}}\\b') then " + _DAY_SQL.format(y="regexp_extract({x}, '\\b((?:19|20)[0-9]{{2}})-[0-9]{{1,2}}-[0-9]{{1,2}}\\b', 1)", m="regexp_extract({x}, '\\b(?:19|20)[0-9]{{2}}-([0-9]{{1,2}})-[0-9]{{1,2}}\\b', 1)", d="regexp_extract({x}, '\\b(?:19|20)[0-9]{{2}}-[0-9]{{1,2}}-([0-9]{{1,2}})\\b', 1)") + " end"


@query("x21_first_date", "select enriched_event_id, coalesce(" + ", ".join([_ISO_SQL.format(x="t"), *(_date_sql("lower(t)", f) for f in ("DMY", "MDY", "MY"))]) + ") as day from (select distinct enriched_event_id, concat_ws(' ', title, summary) as t from extracted_event_details) where day is not null")
def x21(spark, d):
    rows = table(spark, d, "extracted_event_details").select("enriched_event_id", "title", "summary").distinct()
    return rows.select("enriched_event_id", tx.first_date(F.concat_ws(" ", "title", "summary")).alias("day")).where("day is not null")


@query("x22_url_date", "select doc_id, coalesce(" + ", ".join(_date_sql("p", f) for f in ("YND", "DMY", "MY", "YN")) + ") as day from (select doc_id, lower(regexp_replace(source_url, '^[a-zA-Z]+://[^/]*', '')) as p from documents where source_url is not null) where day is not null")
def x22(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.url_date(F.col("source_url")).alias("day")).where("day is not null")


@query("x30_url_host", "select doc_id, regexp_replace(nullif(regexp_extract(lower(source_url), '^[a-z]+://([^/:?#]+)', 1), ''), '^www\\.', '') as host from documents where source_url is not null")
def x30(spark, d):
    return table(spark, d, "documents").where("source_url is not null").select("doc_id", tx.url_host(F.col("source_url")).alias("host"))


@query("x39_magnitude", "select entity_id, nullif(regexp_extract(t, '[-+]?\\d*\\.?\\d+', 0), '')::double * case when contains(t, 'billion') or ends_with(t, 'b') then 1e9 when contains(t, 'million') or ends_with(t, 'm') then 1e6 when contains(t, 'thousand') or ends_with(t, 'k') then 1e3 else 1 end as amount from (select entity_id, replace(lower(trim(turnover)), ',', '') as t from entities where turnover is not null)")
def x39(spark, d):
    return table(spark, d, "entities").where("turnover is not null").select("entity_id", tx.magnitude(F.col("turnover")).alias("amount"))




@query("x41_size_bands", "select entity_id, case when n is not null then case when n < 20 then 'SMALL' when n < 200 then 'MEDIUM' when n < 5000 then 'LARGE' else 'HUGE' end when size_revenue_aud > 0 then case when size_revenue_aud < 1e7 then 'SMALL' when size_revenue_aud < 1e8 then 'MEDIUM' when size_revenue_aud < 1e9 then 'LARGE' else 'HUGE' end else coalesce(size_estimate, 'UNKNOWN') end as band from (select *, coalesce(size_employees, employee_count) as n from entities)")
def x41(spark, d):
    n, r = F.coalesce("size_employees", "employee_count"), F.col("size_revenue_aud")
    ladder = lambda c, *e: F.when(c < e[0], "SMALL").when(c < e[1], "MEDIUM").when(c < e[2], "LARGE").otherwise("HUGE")
    return table(spark, d, "entities").select("entity_id", F.when(n.isNotNull(), ladder(n, 20, 200, 5000)).when(r > 0, ladder(r, 1e7, 1e8, 1e9)).otherwise(F.coalesce("size_estimate", F.lit("UNKNOWN"))).alias("band"))




@query("x56_json_fields", "select distinct decision_id, json_extract_string(evidence_json, '$.date_delta_days')::int as delta, json_extract_string(evidence_json, '$.entity_match') as entity_match from decisions where evidence_json is not null and json_valid(evidence_json)")
def x56(spark, d):
    rows = table(spark, d, "decisions").where("evidence_json is not null").where(F.try_parse_json("evidence_json").isNotNull())
    return rows.select("decision_id", F.get_json_object("evidence_json", "$.date_delta_days").try_cast("int").alias("delta"), F.get_json_object("evidence_json", "$.entity_match").alias("entity_match")).distinct()


@query("x58_cosine_to_centroid", "with p as (select label, i, avg(x) as m from (select label, unnest(embedding)::double as x, unnest(generate_series(1, len(embedding))) as i from embeddings where embedding is not null) group by 1, 2), c as (select label, list(m order by i) as centre from p group by 1) select e.vec_id, e.label, round(list_cosine_similarity(e.embedding::double[], c.centre), 6) as cosine from embeddings e join c using (label)")
def x58(spark, d):
    from caseflux.operators.vectors import cosine

    e = table(spark, d, "embeddings").where("embedding is not null")
    # one centroid a label: the number of labels bounds the broadcast side
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    centre = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    return e.join(centre, "label").select("vec_id", "label", F.round(cosine(F.col("embedding"), F.col("centre")), 6).alias("cosine"))


@query("x59_pair_keys", "select distinct least(left_enriched_event_id, right_enriched_event_id) || '|' || greatest(left_enriched_event_id, right_enriched_event_id) as pair_key from match_evidence where left_enriched_event_id is not null and right_enriched_event_id is not null")
def x59(spark, d):
    a, b = F.col("left_enriched_event_id"), F.col("right_enriched_event_id")
    return table(spark, d, "match_evidence").where(a.isNotNull() & b.isNotNull()).select(tx.pair_key(a, b).alias("pair_key")).distinct()


@query("x60_hash_ids", f"select enriched_event_id, substr(md5(enriched_event_id || '|' || coalesce(title, '')), 1, 16) as short_id from {EV}")
def x60(spark, d):
    return events(spark, d).select("enriched_event_id", F.substring(F.md5(F.concat("enriched_event_id", F.lit("|"), F.coalesce("title", F.lit("")))), 1, 16).alias("short_id"))


@query("d01_rare_tokens", f"with t as (select unnest(list_distinct({TOKENS.format('entity_name')})) as token from entities), n as (select greatest(3, floor(count(*) * 0.005)) as most from entities) select token, count(*) as n from t group by 1 having count(*) <= (select most from n)")
def d01(spark, d):
    e = table(spark, d, "entities")
    most = max(3, int(e.count() * 0.005))
    return e.select(F.explode(F.array_distinct(nm.name_tokens(F.col("entity_name")))).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") <= most)






@query("d09_ubiquitous_names", f"with n as (select greatest(8, floor(count(distinct deduplicated_event_id) * 0.02)) as most from {RISKED}) select victim_organization_name as name, count(distinct deduplicated_event_id) as incidents from {RISKED} where victim_organization_name is not null group by 1 having count(distinct deduplicated_event_id) > (select most from n)")
def d09(spark, d):
    r = risks(spark, d)
    most = max(8, int(r.select("deduplicated_event_id").distinct().count() * 0.02))
    return r.where("victim_organization_name is not null").groupBy(F.col("victim_organization_name").alias("name")).agg(F.countDistinct("deduplicated_event_id").alias("incidents")).where(F.col("incidents") > most)


@query(
    "d12_consensus_date",
    f"with m as (select x.deduplicated_event_id as g, e.event_date as day, strftime(e.event_date, '%Y-%m') as month from {MEMBERS} x join {EV} e using (enriched_event_id) where e.event_date is not null), c as (select g, month, count(*) as n, min(day) as first_day from m group by 1, 2), k as (select *, row_number() over (partition by g order by n desc, month) as place, sum(n) over (partition by g) as dated from c) select g as deduplicated_event_id, first_day::varchar as event_date, n::bigint as support, dated::bigint as dated from k where place = 1",
)
def d12(spark, d):
    m = members(spark, d).join(events(spark, d).select("enriched_event_id", "event_date"), "enriched_event_id").where("event_date is not null")
    c = m.groupBy("deduplicated_event_id", F.date_format("event_date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.min("event_date").alias("first_day"))
    best = c.groupBy("deduplicated_event_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "month", "first_day")).alias("b"), F.sum("n").alias("dated"))
    return best.select("deduplicated_event_id", F.col("b.first_day").cast("string").alias("event_date"), (-F.col("b.n")).alias("support"), "dated")


@query(
    "d13_consensus_records",
    f"with m as (select x.deduplicated_event_id as g, e.records_affected as v from {MEMBERS} x join {EV} e using (enriched_event_id) where e.records_affected > 0), c as (select g, v, count(*) as n from m group by 1, 2), s as (select g, arg_max(v, (n, v)) as best, max(n) as top, count(*) as kinds, max(v) as hi, min(v) as lo from c group by 1) select g as deduplicated_event_id, case when top = 1 and kinds > 1 and hi > 10 * lo then null else best end as records_affected, top as support from s",
)
def d13(spark, d):
    m = members(spark, d).join(events(spark, d).select("enriched_event_id", F.col("records_affected").alias("v")), "enriched_event_id").where("v > 0")
    c = m.groupBy("deduplicated_event_id", "v").agg(F.count("*").alias("n"))
    s = c.groupBy("deduplicated_event_id").agg(F.max(F.struct("n", "v")).alias("b"), F.count("*").alias("kinds"), F.max("v").alias("hi"), F.min("v").alias("lo"))
    torn = (F.col("b.n") == 1) & (F.col("kinds") > 1) & (F.col("hi") > 10 * F.col("lo"))
    return s.select("deduplicated_event_id", F.when(~torn, F.col("b.v")).alias("records_affected"), F.col("b.n").alias("support"))


@query("d21_master_member", f"select deduplicated_event_id, enriched_event_id from (select x.deduplicated_event_id, e.enriched_event_id, row_number() over (partition by x.deduplicated_event_id order by (e.primary_entity is not null)::int + (e.event_date is not null)::int + (e.records_affected is not null)::int + (e.severity is not null)::int desc, e.event_date desc nulls last, e.enriched_event_id) as k from {MEMBERS} x join {EV} e using (enriched_event_id)) where k = 1")
def d21(spark, d):
    e = events(spark, d)
    full = sum(F.col(c).isNotNull().cast("int") for c in ("primary_entity", "event_date", "records_affected", "severity"))
    rows = members(spark, d).join(e.select("enriched_event_id", full.alias("f"), "event_date"), "enriched_event_id")
    key = F.struct((-F.col("f")).alias("f"), (-F.coalesce(F.unix_date("event_date"), F.lit(-10**6))).alias("day"), "enriched_event_id")
    return rows.groupBy("deduplicated_event_id").agg(F.min(key)["enriched_event_id"].alias("enriched_event_id"))



