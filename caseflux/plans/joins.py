"""Joins, windows, orders and set operations (SURVEY J, W, O, U rows)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflux.functions import incidents as inc
from caseflux.plans.registry import query
from caseflux.plans.series import ACTIVE, EV, HALF, MEMBERS, MONTH, RISK, RISKED, SEV, active, events, members, risks
from caseflux.sources.tables import table

RUN1 = "asd_risk_classifications_20251118_153149"




@query("j02_left_with_filter_in_on", f"select e.enriched_event_id, n.entity_id from {ACTIVE} e left join entities n on n.entity_name = e.primary_entity and n.is_australian")
def j02(spark, d):
    n = table(spark, d, "entities").where("is_australian").select("entity_id", F.col("entity_name").alias("primary_entity"))
    return active(spark, d).join(n, "primary_entity", "left").select("enriched_event_id", "entity_id")


@query(
    "j03_four_way_fallback",
    f"select m.deduplicated_event_id, m.enriched_event_id, coalesce(nullif(trim(r.victim_organization_name), ''), n.entity_name, e.primary_entity) as victim from {MEMBERS} m left join {EV} e using (enriched_event_id) left join (select deduplicated_event_id, max(victim_organization_name) as victim_organization_name from {RISK} group by 1) r using (deduplicated_event_id) left join entities n on n.entity_name = e.primary_entity",
)
def j03(spark, d):
    r = table(spark, d, RISK).groupBy("deduplicated_event_id").agg(F.max("victim_organization_name").alias("v"))
    n = table(spark, d, "entities").select("entity_name", F.col("entity_name").alias("primary_entity"))
    rows = members(spark, d).join(events(spark, d).select("enriched_event_id", "primary_entity"), "enriched_event_id", "left").join(r, "deduplicated_event_id", "left").join(n, "primary_entity", "left")
    return rows.select("deduplicated_event_id", "enriched_event_id", F.coalesce(F.nullif(F.trim("v"), F.lit("")), "entity_name", "primary_entity").alias("victim"))


@query("j04_orphans", f"select distinct r.deduplicated_event_id from {RISK} r left join {MEMBERS} m using (deduplicated_event_id) where m.enriched_event_id is null")
def j04(spark, d):
    return table(spark, d, RISK).select("deduplicated_event_id").distinct().join(members(spark, d), "deduplicated_event_id", "left_anti")


@query("j05_two_anti", f"select e.enriched_event_id from {EV} e where not exists (select 1 from decisions x where x.enriched_event_id = e.enriched_event_id) and not exists (select 1 from match_evidence y where y.left_enriched_event_id = e.enriched_event_id or y.right_enriched_event_id = e.enriched_event_id)")
def j05(spark, d):
    y = table(spark, d, "match_evidence")
    matched = y.select(F.col("left_enriched_event_id").alias("enriched_event_id")).union(y.select("right_enriched_event_id"))
    return events(spark, d).select("enriched_event_id").join(table(spark, d, "decisions"), "enriched_event_id", "left_anti").join(matched, "enriched_event_id", "left_anti")


@query("j06_semi_then_anti", f"select e.enriched_event_id from {EV} e where exists (select 1 from decisions x where x.enriched_event_id = e.enriched_event_id and x.action = 'keep_separate') and not exists (select 1 from decisions x where x.enriched_event_id = e.enriched_event_id and x.action = 'merge')")
def j06(spark, d):
    x = table(spark, d, "decisions")
    return events(spark, d).select("enriched_event_id").join(x.where("action = 'keep_separate'"), "enriched_event_id", "left_semi").join(x.where("action = 'merge'"), "enriched_event_id", "left_anti")


@query("j07_correlated_count", "select n.entity_id, (select count(distinct e.enriched_event_id) from extracted_event_details e where e.primary_entity = n.entity_name) as n_events from entities n")
def j07(spark, d):
    c = table(spark, d, "extracted_event_details").groupBy(F.col("primary_entity").alias("entity_name")).agg(F.countDistinct("enriched_event_id").alias("c"))
    return table(spark, d, "entities").join(c, "entity_name", "left").select("entity_id", F.coalesce("c", F.lit(0)).alias("n_events"))


@query("j08_events_in_periods", f"with p as (select distinct {HALF} as period, make_date(year(event_date)::int, case when month(event_date) <= 6 then 1 else 7 end, 1) as first_day from {ACTIVE}) select period, count(*) as n from p join {ACTIVE} e on e.event_date >= p.first_day and e.event_date < p.first_day + interval 6 month group by 1")
def j08(spark, d):
    # the range condition is an equality on the derived half-year key
    return active(spark, d).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.count("*").alias("n"))


@query("j09_best_entity_per_incident", f"select deduplicated_event_id, primary_entity from (select m.deduplicated_event_id, e.primary_entity, row_number() over (partition by m.deduplicated_event_id order by e.confidence_score desc nulls last, e.enriched_event_id) as k from {MEMBERS} m join {EV} e using (enriched_event_id) where trim(e.primary_entity) <> '') where k = 1")
def j09(spark, d):
    rows = members(spark, d).join(events(spark, d), "enriched_event_id").where("trim(primary_entity) <> ''")
    best = F.min(F.struct((-F.coalesce("confidence_score", F.lit(-1.0))).alias("c"), "enriched_event_id", "primary_entity"))
    return rows.groupBy("deduplicated_event_id").agg(best.alias("b")).select("deduplicated_event_id", "b.primary_entity")


@query(
    "j10_earlier_other_group",
    "with x as (select distinct decision_id, enriched_event_id, deduplicated_event_id, created_at from decisions where action = 'merge' and deduplicated_event_id is not null and enriched_event_id is not null) select a.decision_id, arg_max(b.deduplicated_event_id, (b.created_at, b.decision_id)) as earlier from x a join x b on a.enriched_event_id = b.enriched_event_id and b.created_at < a.created_at and b.deduplicated_event_id <> a.deduplicated_event_id group by 1",
)
def j10(spark, d):
    x = table(spark, d, "decisions").where("action = 'merge' and deduplicated_event_id is not null and enriched_event_id is not null").select("decision_id", "enriched_event_id", "deduplicated_event_id", "created_at").distinct()
    b = x.select(F.col("decision_id").alias("b_id"), "enriched_event_id", F.col("deduplicated_event_id").alias("b_group"), F.col("created_at").alias("b_at"))
    rows = x.join(b, "enriched_event_id").where("b_at < created_at and b_group <> deduplicated_event_id")
    return rows.groupBy("decision_id").agg(F.max_by("b_group", F.struct("b_at", "b_id")).alias("earlier"))


@query("j11_full_outer_periods", f"select coalesce(a.period, b.period) as period, coalesce(a.n, 0) as n_events, coalesce(b.n, 0) as n_risks from (select {HALF} as period, count(*) as n from {ACTIVE} group by 1) a full outer join (select {HALF} as period, count(*) as n from {RISKED} where event_date is not null group by 1) b on a.period = b.period")
def j11(spark, d):
    p = inc.half_year(F.col("event_date")).alias("period")
    a = active(spark, d).groupBy(p).agg(F.count("*").alias("a"))
    b = risks(spark, d).where("event_date is not null").groupBy(p).agg(F.count("*").alias("b"))
    return a.join(b, "period", "full_outer").select("period", F.coalesce("a", F.lit(0)).alias("n_events"), F.coalesce("b", F.lit(0)).alias("n_risks"))


@query("j12_month_spine", f"with s as (select strftime(x, '%Y-%m') as month from generate_series(date '2020-01-01', date '2025-12-01', interval 1 month) t(x)) select s.month, count(e.enriched_event_id) as n from s left join {ACTIVE} e on {MONTH} = s.month group by 1")
def j12(spark, d):
    spine = spark.sql("select date_format(m, 'yyyy-MM') as month from (select explode(sequence(date '2020-01-01', date '2025-12-01', interval 1 month)) as m)")
    c = active(spark, d).groupBy(inc.month(F.col("event_date")).alias("month")).agg(F.count("*").alias("n"))
    return spine.join(c, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


@query("j17_overlapping_entities", f"select distinct m.decision_id from match_evidence m join (select enriched_event_id, unnest(affected_entities) as x from extracted_event_details) a on a.enriched_event_id = m.left_enriched_event_id join (select enriched_event_id, unnest(affected_entities) as x from extracted_event_details) b on b.enriched_event_id = m.right_enriched_event_id and a.x = b.x")
def j17(spark, d):
    e = table(spark, d, "extracted_event_details").select("enriched_event_id", "affected_entities").where(F.size("affected_entities") > 0)
    a, b = e.toDF("left_enriched_event_id", "a"), e.toDF("right_enriched_event_id", "b")
    rows = table(spark, d, "match_evidence").select("decision_id", "left_enriched_event_id", "right_enriched_event_id").join(a, "left_enriched_event_id").join(b, "right_enriched_event_id")
    return rows.where(F.arrays_overlap("a", "b")).select("decision_id").distinct()


PAIR = "least(left_enriched_event_id, right_enriched_event_id) || '|' || greatest(left_enriched_event_id, right_enriched_event_id)"






@query("j21_nearest_by_cosine", "select query_id, vec_id, 1 as place, round(c, 6) as cosine from (select q.vec_id as query_id, v.vec_id, list_cosine_similarity(q.embedding::double[], v.embedding::double[]) as c, row_number() over (partition by q.vec_id order by list_cosine_similarity(q.embedding::double[], v.embedding::double[]) desc, v.vec_id) as k from embeddings q join embeddings v on q.vec_id % 20 = 0 and q.vec_id <> v.vec_id) where k = 1")
def j21(spark, d):
    """Embedding neighbours: every row whose id is divisible by 20 against all rows, in blocks.

    The queries travel in blocks of 500 vectors; each task keeps its best row
    for each query, so a task sends 500 rows whatever it scans.
    """
    from caseflux.operators.vectors import nearest_vectors

    return nearest_vectors(table(spark, d, "embeddings"), every=20, k=1)




@query("w02_next_event", f"select enriched_event_id, lead(event_date) over w - event_date as days_to_next, row_number() over w as ordinal from {ACTIVE} where trim(primary_entity) <> '' window w as (partition by primary_entity order by event_date, enriched_event_id)")
def w02(spark, d):
    w = Window.partitionBy("primary_entity").orderBy("event_date", "enriched_event_id")
    rows = active(spark, d).where("trim(primary_entity) <> ''")
    return rows.select("enriched_event_id", F.date_diff(F.lead("event_date").over(w), "event_date").cast("long").alias("days_to_next"), F.row_number().over(w).alias("ordinal"))


RUNS = f"(select *, sum(fresh) over (partition by primary_entity order by event_date rows unbounded preceding) as run from (select primary_entity, event_date, case when event_date - lag(event_date) over (partition by primary_entity order by event_date) < 90 then 0 else 1 end as fresh, event_date - lag(event_date) over (partition by primary_entity order by event_date) as gap from (select distinct primary_entity, event_date from {ACTIVE} where trim(primary_entity) <> '')))"


@query("w03_gap_chained_runs", f"select primary_entity, min(event_date)::varchar as first_day, count(*) as days, max(event_date) - min(event_date) as span, max(case when fresh = 0 then gap end) as longest_gap from {RUNS} group by primary_entity, run having count(*) >= 2")
def w03(spark, d):
    from caseflux.operators.runs import gap_runs

    days = active(spark, d).where("trim(primary_entity) <> ''").select("primary_entity", "event_date").distinct()
    return gap_runs(days, "primary_entity", "event_date", 90).select("primary_entity", F.col("first_day").cast("string"), F.col("events").alias("days"), F.col("span").cast("long"), F.col("longest_gap").cast("long"))


@query("w07_drop_consecutive_repeats", "select event_id from (select event_id, user_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) where event_type is distinct from before")
def w07(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").withColumn("before", F.lag("event_type").over(w)).where(~F.col("event_type").eqNullSafe(F.col("before"))).select("event_id")


@query("w08_forward_fill", "select event_id, last_value(v ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as filled from (select *, case when event_type = 'purchase' then value end as v from events)")
def w08(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "events").select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), True).over(w).alias("filled"))


@query("w09_period_swing", f"with p as (select {HALF} as period, count(*) as n from {ACTIVE} group by 1) select period, n, lag(n) over (order by period) as prior, round(abs(n - lag(n) over (order by period)) * 1.0 / lag(n) over (order by period), 4) as swing from p")
def w09(spark, d):
    # one row a half-year reaches the single window task
    w = Window.orderBy("period")
    p = active(spark, d).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.count("*").alias("n"))
    return p.withColumn("prior", F.lag("n").over(w)).withColumn("swing", F.round(F.abs(F.col("n") - F.col("prior")) / F.col("prior"), 4))


@query("w10_date_anchors", f"with recursive d as (select primary_entity, event_date, row_number() over (partition by primary_entity order by event_date) as i from (select distinct primary_entity, event_date from {ACTIVE} where trim(primary_entity) <> '')), r as (select primary_entity, event_date, i, event_date as anchor from d where i = 1 union all select d.primary_entity, d.event_date, d.i, case when date_diff('day', r.anchor, d.event_date) > 3 then d.event_date else r.anchor end from r join d on d.primary_entity = r.primary_entity and d.i = r.i + 1) select primary_entity, event_date::varchar as day, anchor::varchar as anchor from r")
def w10(spark, d):
    """Greedy anchors of each entity's days: the earliest day not within 3 days of an earlier anchor."""
    from caseflux.operators.runs import greedy_anchors

    days = active(spark, d).where("trim(primary_entity) <> ''").select("primary_entity", "event_date").distinct()
    return greedy_anchors(days, "primary_entity", "event_date", 3)


@query("w12_latest_value", "select batch_id, arg_max(certainty, (created_at, decision_id)) as latest from decisions where certainty is not null and batch_id is not null group by 1")
def w12(spark, d):
    rows = table(spark, d, "decisions").where("certainty is not null and batch_id is not null")
    return rows.groupBy("batch_id").agg(F.max_by("certainty", F.struct("created_at", "decision_id")).alias("latest"))


@query("w13_first_per_title_day", f"select min(enriched_event_id) as enriched_event_id, lower(trim(title)) as title_key, event_date::varchar as day from {EV} where title is not null and event_date is not null group by 2, 3")
def w13(spark, d):
    rows = events(spark, d).where("title is not null and event_date is not null")
    return rows.groupBy(F.lower(F.trim("title")).alias("title_key"), F.col("event_date").cast("string").alias("day")).agg(F.min("enriched_event_id").alias("enriched_event_id"))


@query("o02_newest", f"select enriched_event_id, event_date::varchar as day from {EV} where event_date is not null order by event_date desc, enriched_event_id desc limit 100")
def o02(spark, d):
    return events(spark, d).where("event_date is not null").orderBy(F.desc("event_date"), F.desc("enriched_event_id")).limit(100).select("enriched_event_id", F.col("event_date").cast("string").alias("day"))


@query("o05_unclassified_first", f"select x.deduplicated_event_id, case when r.deduplicated_event_id is null then 0 else 1 end as classified from (select distinct deduplicated_event_id from {MEMBERS}) x left join (select distinct deduplicated_event_id from {RISK}) r using (deduplicated_event_id) order by 2, 1 desc limit 100")
def o05(spark, d):
    r = table(spark, d, RISK).select("deduplicated_event_id").distinct().withColumn("r", F.lit(1))
    rows = members(spark, d).select("deduplicated_event_id").distinct().join(r, "deduplicated_event_id", "left").select("deduplicated_event_id", F.when(F.col("r").isNull(), 0).otherwise(1).alias("classified"))
    return rows.orderBy("classified", F.desc("deduplicated_event_id")).limit(100)


@query("o07_top_industries", f"select victim_organization_industry as industry, count(*) as n from {RISKED} where victim_organization_industry is not null group by 1 order by 2 desc, 1 limit 10")
def o07(spark, d):
    rows = risks(spark, d).where("victim_organization_industry is not null").groupBy(F.col("victim_organization_industry").alias("industry")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "industry").limit(10)


@query("o09_three_urls_per_source", "select source, string_agg(source_url, '|' order by source_url) as urls from (select source, source_url, row_number() over (partition by source order by source_url) as k from (select distinct source, source_url from documents where source is not null and source_url is not null)) where k <= 3 group by 1")
def o09(spark, d):
    rows = table(spark, d, "documents").where("source is not null and source_url is not null").select("source", "source_url").distinct()
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("source_url"))).where("k <= 3")
    return ranked.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("source_url")), "|").alias("urls"))


@query("u01_distinct_names", f"select distinct name from (select primary_entity as name from extracted_event_details union all select victim_organization_name from {RISK} union all select entity_name from entities) where trim(name) <> ''")
def u01(spark, d):
    parts = [table(spark, d, "extracted_event_details").select(F.col("primary_entity").alias("name")), table(spark, d, RISK).select("victim_organization_name"), table(spark, d, "entities").select("entity_name")]
    return parts[0].union(parts[1]).union(parts[2]).where("trim(name) <> ''").distinct()


@query("u02_set_difference", "select enriched_event_id from extracted_event_details except select enriched_event_id from decisions where action = 'merge'")
def u02(spark, d):
    return table(spark, d, "extracted_event_details").select("enriched_event_id").subtract(table(spark, d, "decisions").where("action = 'merge'").select("enriched_event_id"))




@query("u05_months_to_process", f"with s as (select strftime(x, '%Y-%m') as month from generate_series(date '2020-01-01', date '2025-12-01', interval 1 month) t(x)) select month from s where month not in (select distinct {MONTH} from {ACTIVE}) or month >= '2025-10'")
def u05(spark, d):
    spine = spark.sql("select date_format(m, 'yyyy-MM') as month from (select explode(sequence(date '2020-01-01', date '2025-12-01', interval 1 month)) as m)")
    done = active(spark, d).select(inc.month(F.col("event_date")).alias("month"))
    return spine.join(done, "month", "left_anti").union(spine.where("month >= '2025-10'")).distinct()


@query("u09_new_replaces_old", f"select deduplicated_event_id, severity_category from (select distinct deduplicated_event_id, severity_category from {RISK}) union all select deduplicated_event_id, severity_category from (select distinct deduplicated_event_id, severity_category from {RUN1}) o where deduplicated_event_id not in (select deduplicated_event_id from {RISK} where deduplicated_event_id is not null)")
def u09(spark, d):
    c = ("deduplicated_event_id", "severity_category")
    new, old = table(spark, d, RISK).select(*c).distinct(), table(spark, d, RUN1).select(*c).distinct().where("deduplicated_event_id is not null")
    return old.join(new, "deduplicated_event_id", "left_anti").unionByName(new)
