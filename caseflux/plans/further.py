"""Further filters, joins, orders and kernels (SURVEY F, J, W, O, U, X, D, S rows)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflux.functions import incidents as inc
from caseflux.functions import names as nm
from caseflux.functions import text as tx
from caseflux.plans.registry import query
from caseflux.plans.resolution import CYBER, OTHER, SUPPORT, _count_sql
from caseflux.plans.series import ACTIVE, EV, HALF, MEMBERS, MONTH, RISK, RISKED, SEV, active, events, members, risks
from caseflux.sources.tables import table


def filtered_events(spark, d, australian_only: bool = False, specific_only: bool = False, least_confidence: float | None = None):
    """Articles under optional predicates; a predicate that is not asked for does not filter."""
    rows = events(spark, d)
    if australian_only:
        rows = rows.where("is_australian_event")
    if specific_only:
        rows = rows.where("is_specific_event")
    return rows if least_confidence is None else rows.where(F.col("confidence_score") >= least_confidence)


@query("f05_optional_predicates", f"select enriched_event_id from {EV} where is_australian_event and is_specific_event and confidence_score >= 0.5")
def f05(spark, d):
    return filtered_events(spark, d, True, True, 0.5).select("enriched_event_id")


@query("f08_half_year_window", f"select event_type, count(*) as n from {EV} where event_date >= date '2024-07-01' and event_date <= date '2024-12-31' group by 1")
def f08(spark, d):
    return events(spark, d).where(F.col("event_date").between("2024-07-01", "2024-12-31")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("f09_not_seen_lately", "select enriched_event_id from extracted_event_details group by 1 having max(discovered_at) is null or max(discovered_at) < (select max(discovered_at) from extracted_event_details) - interval 30 day")
def f09(spark, d):
    rows = table(spark, d, "extracted_event_details").groupBy("enriched_event_id").agg(F.max("discovered_at").alias("seen"))
    # relative to the newest row, not to the clock, so the result is repeatable
    newest = table(spark, d, "extracted_event_details").agg(F.max("discovered_at").alias("newest"))
    return rows.join(F.broadcast(newest)).where(F.col("seen").isNull() | (F.col("seen") < F.col("newest") - F.expr("interval 30 days"))).select("enriched_event_id")


_STAGE = f"(select distinct enriched_event_id, length(trim(coalesce(summary, ''))) as n, {_count_sql('t', CYBER)} as a, {_count_sql('t', SUPPORT)} as b, {_count_sql('t', OTHER)} as c from (select enriched_event_id, summary, concat_ws(' ', title, summary) as t from extracted_event_details))"


def _content_scores(spark, d):
    t = F.concat_ws(" ", "title", "summary")
    a, b, c = (tx.term_count(t, terms) for terms in (CYBER, SUPPORT, OTHER))
    rows = table(spark, d, "extracted_event_details").select("enriched_event_id", F.length(F.trim(F.coalesce("summary", F.lit("")))).alias("n"), a.alias("a"), b.alias("b"), c.alias("c")).distinct()
    penalty = F.least(F.lit(0.5), 0.15 * F.col("c")) * F.when(F.col("a") > 0, 0.5).otherwise(1.0)
    score = 0.5 + F.least(F.lit(0.5), 0.15 * F.col("a")) + F.least(F.lit(0.3), 0.08 * F.col("b")) - penalty + F.when(F.col("n") > 500, 0.05).otherwise(0.0)
    return rows.select("enriched_event_id", F.when(F.col("n") < 50, 0.1).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).alias("score"))


_CONTENT = f"(select enriched_event_id, case when n < 50 then 0.1 else least(1.0, greatest(0.0, 0.5 + least(0.5, 0.15 * a) + least(0.3, 0.08 * b) - least(0.5, 0.15 * c) * case when a > 0 then 0.5 else 1.0 end + case when n > 500 then 0.05 else 0.0 end)) end::double as score from {_STAGE})"


@query("f14_content_stage", f"select enriched_event_id, round(max(score), 4) as score, max(score) >= 0.4 as relevant from {_CONTENT} group by 1")
def f14(spark, d):
    best = _content_scores(spark, d).groupBy("enriched_event_id").agg(F.max("score").alias("s"))
    return best.select("enriched_event_id", F.round("s", 4).alias("score"), (F.col("s") >= 0.4).alias("relevant"))


@query("f15_final_stage", f"select enriched_event_id, case when is_australian_event and is_specific_event then 0.9 else 0.0 end::double as score from {EV}")
def f15(spark, d):
    return events(spark, d).select("enriched_event_id", F.when(F.col("is_australian_event") & F.col("is_specific_event"), 0.9).otherwise(0.0).alias("score"))


@query("f16_stage_counts", f"select case when score < 0.4 then 'rejected' when score < 0.6 then 'review' else 'kept' end as outcome, count(*) as n from (select enriched_event_id, round(max(score), 6) as score from {_CONTENT} group by 1) group by 1")
def f16(spark, d):
    s = _content_scores(spark, d).groupBy("enriched_event_id").agg(F.round(F.max("score"), 6).alias("s"))
    return s.groupBy(F.when(F.col("s") < 0.4, "rejected").when(F.col("s") < 0.6, "review").otherwise("kept").alias("outcome")).agg(F.count("*").alias("n"))










@query("w01_first_by_severity", f"select month, enriched_event_id from (select {MONTH} as month, enriched_event_id, row_number() over (partition by {MONTH} order by {SEV} desc, event_date, enriched_event_id) as k from {ACTIVE}) where k = 1")
def w01(spark, d):
    rows = active(spark, d).groupBy(inc.month(F.col("event_date")).alias("month")).agg(F.min(F.struct((-inc.severity_rank(F.col("severity"))).alias("r"), "event_date", "enriched_event_id")).alias("b"))
    return rows.select("month", "b.enriched_event_id")


@query("w11_best_entity", f"select m.deduplicated_event_id, arg_min(n.entity_name, (case when n.entity_kind = 'organisation' then 0 else 1 end, -coalesce(e.confidence_score, 0), n.entity_name)) as entity_name from {MEMBERS} m join {EV} e using (enriched_event_id) join entities n on n.entity_name = e.primary_entity group by 1")
def w11(spark, d):
    n = table(spark, d, "entities").select(F.col("entity_name").alias("primary_entity"), "entity_kind")
    rows = members(spark, d).join(events(spark, d), "enriched_event_id").join(n, "primary_entity")
    key = F.struct(F.when(F.col("entity_kind") == "organisation", 0).otherwise(1).alias("k"), (-F.coalesce("confidence_score", F.lit(0.0))).alias("c"), F.col("primary_entity").alias("name"))
    return rows.groupBy("deduplicated_event_id").agg(F.min(key)["name"].alias("entity_name"))


@query("w14_worst_category", f"select deduplicated_event_id, min(severity_category) as worst, max(severity_category) as mildest from {RISK} where severity_category is not null and deduplicated_event_id is not null group by 1")
def w14(spark, d):
    return table(spark, d, RISK).where("severity_category is not null and deduplicated_event_id is not null").groupBy("deduplicated_event_id").agg(F.min("severity_category").alias("worst"), F.max("severity_category").alias("mildest"))


@query("o01_severity_order", f"select severity, place from (select severity, row_number() over (order by {SEV} desc, severity) as place from (select distinct severity from {EV} where severity is not null))")
def o01(spark, d):
    kinds = events(spark, d).where("severity is not null").select("severity").distinct()
    return kinds.withColumn("place", F.row_number().over(Window.orderBy(F.desc(inc.severity_rank(F.col("severity"))), "severity")))


@query("o03_latest_nulls_last", f"select enriched_event_id from {EV} order by event_date desc nulls last, enriched_event_id limit 1")
def o03(spark, d):
    return events(spark, d).orderBy(F.desc_nulls_last("event_date"), "enriched_event_id").limit(1).select("enriched_event_id")


@query("o04_case_free_order", "select entity_id, entity_name from entities order by lower(entity_name), entity_id limit 50")
def o04(spark, d):
    return table(spark, d, "entities").orderBy(F.lower("entity_name"), "entity_id").limit(50).select("entity_id", "entity_name")


@query("o06_ranked_entities", f"select enriched_event_id, x as entity from (select enriched_event_id, x, row_number() over (partition by enriched_event_id order by contains(lower(title), lower(x)) desc, length(x), x) as k from (select distinct d.enriched_event_id, coalesce(d.title, '') as title, unnest(d.affected_entities) as x from extracted_event_details d) where x is not null) where k <= 2")
def o06(spark, d):
    rows = table(spark, d, "extracted_event_details").select("enriched_event_id", F.coalesce("title", F.lit("")).alias("title"), F.explode("affected_entities").alias("x")).where("x is not null").distinct()
    w = Window.partitionBy("enriched_event_id").orderBy(F.desc(F.lower("title").contains(F.lower("x"))), F.length("x"), "x")
    return rows.withColumn("k", F.row_number().over(w)).where("k <= 2").select("enriched_event_id", F.col("x").alias("entity"))


@query("o08_longest_first", "select enriched_event_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(affected_entities), lambda x: {'n': -length(x), 'x': x})), lambda s: s.x), '|') as ordered from (select distinct enriched_event_id, affected_entities from extracted_event_details) where len(affected_entities) > 0")
def o08(spark, d):
    keyed = F.transform(F.array_distinct("affected_entities"), lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))
    rows = table(spark, d, "extracted_event_details").where(F.size("affected_entities") > 0).select("enriched_event_id", "affected_entities").distinct()
    return rows.select("enriched_event_id", F.array_join(F.transform(F.array_sort(keyed), lambda s: s["x"]), "|").alias("ordered"))


@query("o10_biggest_incidents", f"select deduplicated_event_id, count(*) as n from {MEMBERS} group by 1 order by 2 desc, 1 limit 50")
def o10(spark, d):
    return members(spark, d).groupBy("deduplicated_event_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "deduplicated_event_id").limit(50)


_RUNS_SQL = f"select deduplicated_event_id, %s as kinds from (select deduplicated_event_id, list(distinct event_type) as a from asd_risk_classifications_20251118_153149 where event_type is not null group by 1) x join (select deduplicated_event_id, list(distinct event_type) as b from {RISK} where event_type is not null group by 1) y using (deduplicated_event_id)"


def _two_runs(spark, d):
    kinds = lambda n, c: table(spark, d, n).where("event_type is not null").groupBy("deduplicated_event_id").agg(F.collect_set("event_type").alias(c))
    return kinds("asd_risk_classifications_20251118_153149", "a").join(kinds(RISK, "b"), "deduplicated_event_id")


@query("u03_shared_kinds", _RUNS_SQL % "len(list_intersect(a, b))")
def u03(spark, d):
    return _two_runs(spark, d).select("deduplicated_event_id", F.size(F.array_intersect("a", "b")).alias("kinds"))


@query("u07_subset_of_later_run", _RUNS_SQL % "(len(list_intersect(a, b)) = len(a))::int")
def u07(spark, d):
    return _two_runs(spark, d).select("deduplicated_event_id", (F.size(F.array_except("a", "b")) == 0).cast("int").alias("kinds"))


@query("u08_union_of_kinds", _RUNS_SQL % "len(list_distinct(list_concat(a, b)))")
def u08(spark, d):
    return _two_runs(spark, d).select("deduplicated_event_id", F.size(F.array_union("a", "b")).alias("kinds"))


@query("x15_preferred_spelling", "select lower(primary_entity) as name_key, arg_max(primary_entity, (case when primary_entity in (upper(primary_entity), lower(primary_entity)) then 0 else 1 end, n, length(primary_entity), primary_entity)) as preferred from (select primary_entity, count(distinct enriched_event_id) as n from extracted_event_details where trim(primary_entity) <> '' group by 1) group by 1")
def x15(spark, d):
    used = table(spark, d, "extracted_event_details").where("trim(primary_entity) <> ''").groupBy("primary_entity").agg(F.countDistinct("enriched_event_id").alias("n"))
    name = F.col("primary_entity")
    rank = F.struct(F.when(name.isin(F.upper(name), F.lower(name)), 0).otherwise(1).alias("mixed"), "n", F.length(name).alias("len"), name.alias("name"))
    return used.groupBy(F.lower(name).alias("name_key")).agg(F.max(rank)["name"].alias("preferred"))


@query("x19_date_factor", "select distinct decision_id, case when date_delta_days is null then 0.8 when date_delta_days <= 1 then 1.0 when date_delta_days <= 7 then 0.98 when date_delta_days <= 30 then 0.9 when date_delta_days <= 90 then 0.8 when date_delta_days <= 180 then 0.7 when date_delta_days <= 365 then 0.6 else greatest(0.4, 1 - date_delta_days / 1000.0) end::double as factor from match_evidence")
def x19(spark, d):
    n = F.col("date_delta_days")
    f = F.when(n.isNull(), 0.8)
    for days, v in ((1, 1.0), (7, 0.98), (30, 0.9), (90, 0.8), (180, 0.7), (365, 0.6)):
        f = f.when(n <= days, v)
    return table(spark, d, "match_evidence").select("decision_id", f.otherwise(F.greatest(F.lit(0.4), 1 - n / 1000.0)).alias("factor")).distinct()


@query("x23_month_of_text", "select distinct decision_id, case when length(trim(date_left)) >= 7 and substr(trim(date_left), 5, 1) = '-' then substr(trim(date_left), 1, 7) end as month from match_evidence where date_left is not null")
def x23(spark, d):
    t = F.trim("date_left")
    return table(spark, d, "match_evidence").where("date_left is not null").select("decision_id", F.when((F.length(t) >= 7) & (F.substring(t, 5, 1) == "-"), F.substring(t, 1, 7)).alias("month")).distinct()




@query("x32_printable_titles", f"select distinct enriched_event_id, trim(regexp_replace(regexp_replace(title, '[\\p{{Cc}}\\p{{Cf}}]', ' ', 'g'), '\\s+', ' ', 'g')) as title from {EV} where title is not null")
def x32(spark, d):
    return events(spark, d).where("title is not null").select("enriched_event_id", tx.printable(F.col("title")).alias("title")).distinct()




@query("x46_safe_casts", "select distinct decision_id, try_cast(replace(json_extract_string(evidence_json, '$.date_delta_days'), ',', '') as bigint) as days, try_cast(json_extract_string(evidence_json, '$.entity_match') as boolean) as entity_match from decisions where json_valid(evidence_json)")
def x46(spark, d):
    rows = table(spark, d, "decisions").where(F.try_parse_json("evidence_json").isNotNull())
    get = lambda p: F.get_json_object("evidence_json", p)
    return rows.select("decision_id", F.replace(get("$.date_delta_days"), F.lit(","), F.lit("")).try_cast("bigint").alias("days"), get("$.entity_match").try_cast("boolean").alias("entity_match")).distinct()


@query(
    "d17_pair_similarity",
    "select decision_id, round(max(0.4 * t + 0.3 * e + 0.2 * s + 0.1 * d), 6) as similarity from (select decision_id, coalesce(title_similarity, 0) as t, case when entity_match then 1.0 else 0.0 end as e, coalesce(embedding_similarity, 0) as s, case when date_delta_days is null then 0.5 when date_delta_days = 0 then 1.0 when date_delta_days <= 7 then 0.8 when date_delta_days <= 30 then 0.6 when date_delta_days <= 90 then 0.4 when date_delta_days <= 365 then 0.2 else 0.0 end as d from match_evidence) group by 1",
)
def d17(spark, d):
    n = F.col("date_delta_days")
    near = F.when(n.isNull(), 0.5).when(n == 0, 1.0).when(n <= 7, 0.8).when(n <= 30, 0.6).when(n <= 90, 0.4).when(n <= 365, 0.2).otherwise(0.0)
    s = 0.4 * F.coalesce("title_similarity", F.lit(0.0)) + 0.3 * F.when(F.col("entity_match"), 1.0).otherwise(0.0) + 0.2 * F.coalesce("embedding_similarity", F.lit(0.0)) + 0.1 * near
    return table(spark, d, "match_evidence").groupBy("decision_id").agg(F.round(F.max(s), 6).alias("similarity"))






@query("s15_rows_with_json_field", "select x.decision_id, d.enriched_event_id is not null as has_article, json_extract_string(x.evidence_json, '$.entity_match') as entity_match from (select distinct decision_id, enriched_event_id, evidence_json from decisions where json_valid(evidence_json)) x left join (select distinct enriched_event_id from extracted_event_details) d using (enriched_event_id)")
def s15(spark, d):
    x = table(spark, d, "decisions").where(F.try_parse_json("evidence_json").isNotNull()).select("decision_id", "enriched_event_id", "evidence_json").distinct()
    e = table(spark, d, "extracted_event_details").select("enriched_event_id").distinct().withColumn("has", F.lit(True))
    return x.join(e, "enriched_event_id", "left").select("decision_id", F.coalesce("has", F.lit(False)).alias("has_article"), F.get_json_object("evidence_json", "$.entity_match").alias("entity_match"))

