"""Series, distributions and summaries of incidents (SURVEY A and F rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflux.functions import incidents as inc
from caseflux.plans.registry import query
from caseflux.sources.tables import table

RISK = "asd_risk_classifications_20251118_154100"
EVENT_COLUMNS = ("enriched_event_id", "title", "primary_entity", "event_date", "event_type", "severity", "records_affected", "status", "confidence_score", "is_australian_event", "is_specific_event")
EV = f"(select distinct {', '.join(EVENT_COLUMNS)} from extracted_event_details)"
ACTIVE = f"(select * from {EV} where status = 'Active' and event_date between date '2020-01-01' and date '2025-12-31')"
SEV = "case replace(upper(severity), 'EVENTSEVERITY.', '') when 'CRITICAL' then 4 when 'HIGH' then 3 when 'MEDIUM' then 2 when 'LOW' then 1 else 0 end"
MONTH = "strftime(event_date, '%Y-%m')"
RISKED = f"(select distinct deduplicated_event_id, event_date, event_type, victim_organization_name, victim_organization_industry, records_affected, severity_category, primary_stakeholder_category, impact_type, confidence_score, model_used from {RISK})"


def events(spark: SparkSession, d: str) -> DataFrame:
    """Articles, rows delivered twice counted once."""
    return table(spark, d, "extracted_event_details").select(*EVENT_COLUMNS).distinct()


def active(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where((F.col("status") == "Active") & F.col("event_date").between("2020-01-01", "2025-12-31"))


def risks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, RISK).select(
        "deduplicated_event_id", "event_date", "event_type", "victim_organization_name", "victim_organization_industry", "records_affected", "severity_category", "primary_stakeholder_category", "impact_type", "confidence_score", "model_used"
    ).distinct()


@query("f01_active_in_range", f"select enriched_event_id, event_date::varchar as event_date from {ACTIVE}")
def f01(spark, d):
    return active(spark, d).select("enriched_event_id", F.col("event_date").cast("string"))


@query("f02_default_true", f"select coalesce(is_specific_event, true) as specific, count(*) as n from {EV} where coalesce(is_specific_event, true) and coalesce(status, 'Active') = 'Active' group by 1")
def f02(spark, d):
    rows = events(spark, d).where(F.coalesce("is_specific_event", F.lit(True)) & (F.coalesce("status", F.lit("Active")) == "Active"))
    return rows.groupBy(F.coalesce("is_specific_event", F.lit(True)).alias("specific")).agg(F.count("*").alias("n"))


@query("f03_first_non_blank", f"select enriched_event_id, coalesce(nullif(trim(primary_entity), ''), nullif(trim(title), '')) as label from {EV} where coalesce(nullif(trim(primary_entity), ''), nullif(trim(title), '')) is not null")
def f03(spark, d):
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return events(spark, d).select("enriched_event_id", F.coalesce(blank(F.col("primary_entity")), blank(F.col("title"))).alias("label")).where("label is not null")




@query("f06_plausible_records", f"select enriched_event_id, records_affected from {EV} where records_affected between 1 and 1000000000")
def f06(spark, d):
    return events(spark, d).where(inc.plausible_records(F.col("records_affected"))).select("enriched_event_id", "records_affected")


@query("f07_known_severity", f"select severity, count(*) as n from {EV} where severity not in ('Unknown', 'EventSeverity.UNKNOWN', 'None') group by 1")
def f07(spark, d):
    return events(spark, d).where(~F.col("severity").isin("Unknown", "EventSeverity.UNKNOWN", "None")).groupBy("severity").agg(F.count("*").alias("n"))


@query(
    "f10_missing_flags",
    f"select (primary_entity is null or trim(primary_entity) = '') as no_entity, (records_affected is null) as no_records, (event_date is null) as no_date, (title is null or length(title) < 50) as short_title, count(*) as n from {EV} group by 1, 2, 3, 4",
)
def f10(spark, d):
    flags = {
        "no_entity": F.col("primary_entity").isNull() | (F.trim("primary_entity") == ""),
        "no_records": F.col("records_affected").isNull(),
        "no_date": F.col("event_date").isNull(),
        "short_title": F.col("title").isNull() | (F.length("title") < 50),
    }
    return events(spark, d).groupBy(*(c.alias(k) for k, c in flags.items())).agg(F.count("*").alias("n"))


@query("f11_placeholder_dates_first", f"select enriched_event_id, event_date::varchar as event_date, row_number() over (order by case when day(event_date) = 1 then 0 else 1 end, event_date desc nulls last, enriched_event_id) as place from {EV} where status = 'Active' order by 3 limit 200")
def f11(spark, d):
    # the limit is the feature: the next 200 to be enriched
    rows = events(spark, d).where("status = 'Active'").select("enriched_event_id", "event_date", (F.dayofmonth("event_date") != 1).alias("later"))
    order = [F.coalesce("later", F.lit(True)), F.col("event_date").desc_nulls_last(), F.col("enriched_event_id")]
    return rows.orderBy(*order).limit(200).withColumn("place", F.row_number().over(Window.orderBy(*order))).select("enriched_event_id", F.col("event_date").cast("string"), "place")


@query("f12_blocked_domains", "select doc_id from documents where source_url is not null and not regexp_matches(lower(source_url), '(facebook|twitter|linkedin|example)\\.')")
def f12(spark, d):
    return table(spark, d, "documents").where(F.col("source_url").isNotNull() & ~F.lower("source_url").rlike("(facebook|twitter|linkedin|example)\\.")).select("doc_id")


@query("f19_confident", f"select enriched_event_id, confidence_score from {EV} where confidence_score >= 0.6")
def f19(spark, d):
    return events(spark, d).where("confidence_score >= 0.6").select("enriched_event_id", "confidence_score")


@query("f21_content_for_analysis", "select enriched_event_id, max(length(c)) as content_length from (select distinct enriched_event_id, concat_ws(chr(10) || chr(10), title, summary) as c from extracted_event_details) where length(c) >= 100 group by 1")
def f21(spark, d):
    rows = table(spark, d, "extracted_event_details").select("enriched_event_id", F.concat_ws("\n\n", "title", "summary").alias("c"))
    return rows.where(F.length("c") >= 100).groupBy("enriched_event_id").agg(F.max(F.length("c")).cast("long").alias("content_length"))


@query("a01_monthly_distinct", f"select {MONTH} as month, count(distinct enriched_event_id) as n_events from {ACTIVE} group by 1")
def a01(spark, d):
    return active(spark, d).groupBy(inc.month(F.col("event_date")).alias("month")).agg(F.countDistinct("enriched_event_id").alias("n_events"))


@query(
    "a02_dispersion",
    f"""with m as (select {MONTH} as month, count(distinct enriched_event_id) as c from {ACTIVE} group by 1), s as (select count(*) as months, avg(c) as mu, var_samp(c) as v from m)
    select months, round(mu, 2) as mean, round(v, 2) as variance, round(v / mu, 3) as overdispersion, round(case when v > mu then mu * mu / (v - mu) else mu end, 2) as nb_n, round(case when v > mu then mu / v else 0.5 end, 3) as nb_p,
    case when v / mu > 1.5 then 'Negative Binomial' when v / mu < 1.2 then 'Poisson' else 'Mixed' end as interpretation from s""",
)
def a02(spark, d):
    s = a01(spark, d).agg(F.count("*").alias("months"), F.avg("n_events").alias("mu"), F.var_samp("n_events").alias("v"))
    mu, v = F.col("mu"), F.col("v")
    return s.select(
        "months", F.round(mu, 2).alias("mean"), F.round(v, 2).alias("variance"), F.round(v / mu, 3).alias("overdispersion"),
        F.round(F.when(v > mu, mu * mu / (v - mu)).otherwise(mu), 2).alias("nb_n"), F.round(F.when(v > mu, mu / v).otherwise(0.5), 3).alias("nb_p"),
        F.when(v / mu > 1.5, "Negative Binomial").when(v / mu < 1.2, "Poisson").otherwise("Mixed").alias("interpretation"),
    )


@query("a03_severity_by_month", f"select {MONTH} as month, " + ", ".join(f"count(distinct enriched_event_id) filter (where {SEV} = {4 - k}) as {s.lower()}" for k, s in enumerate(inc.SEVERITIES)) + f" from {ACTIVE} group by 1")
def a03(spark, d):
    rows = active(spark, d).select("enriched_event_id", inc.month(F.col("event_date")).alias("month"), inc.severity_label(F.col("severity")).alias("s"))
    wide = rows.groupBy("month").pivot("s", list(inc.SEVERITIES)).agg(F.countDistinct("enriched_event_id")).fillna(0)
    return wide.select("month", *(F.col(s).alias(s.lower()) for s in inc.SEVERITIES))


@query(
    "a04_records_by_month",
    f"select {MONTH} as month, round(avg(records_affected), 4) as average, median(records_affected) as median, count(distinct enriched_event_id) as n, min(records_affected) as least, max(records_affected) as most, round(greatest(0, avg(records_affected) * 0.8), 4) as low, round(avg(records_affected) * 1.2, 4) as high from {ACTIVE} where records_affected between 1 and 1000000000 group by 1",
)
def a04(spark, d):
    r = F.col("records_affected")
    rows = active(spark, d).where(inc.plausible_records(r)).groupBy(inc.month(F.col("event_date")).alias("month"))
    avg = F.avg(r)
    return rows.agg(F.round(avg, 4).alias("average"), F.median(r).alias("median"), F.countDistinct("enriched_event_id").alias("n"), F.min(r).alias("least"), F.max(r).alias("most"), F.round(F.greatest(F.lit(0.0), avg * 0.8), 4).alias("low"), F.round(avg * 1.2, 4).alias("high"))


@query("a05_type_by_month", f"select {MONTH} as month, event_type, count(distinct enriched_event_id) as n from {ACTIVE} group by 1, 2")
def a05(spark, d):
    return active(spark, d).groupBy(inc.month(F.col("event_date")).alias("month"), "event_type").agg(F.countDistinct("enriched_event_id").alias("n"))


@query("a06_type_mix", f"select event_type, count(distinct enriched_event_id) as n from {ACTIVE} group by 1")
def a06(spark, d):
    return active(spark, d).groupBy("event_type").agg(F.countDistinct("enriched_event_id").alias("n"))


# Categories by display order, with the words that put an industry there.
CATEGORIES = ((1, "Health", ("health", "medical")), (2, "Finance", ("financ", "bank", "insur")), (3, "Public sector", ("government", "council", "education")), (4, "Services", ("techno", "telecom", "energy", "transport")))
_WORDS = ", ".join(f"({k}, '{c}', '{w}')" for k, c, ws in CATEGORIES for w in ws)


@query(
    "a07_industry_categories",
    f"""with r as (select coalesce(nullif(trim(victim_organization_industry), ''), 'Unknown') as industry, count(distinct deduplicated_event_id) as n from {RISKED} group by 1), w(display_order, category, word) as (values {_WORDS}),
    m as (select industry, n, arg_min(category, display_order) as category from r left join w on contains(lower(industry), word) group by industry, n)
    select case when industry = 'Unknown' then 'Unknown' else coalesce(category, 'Others') end as category, sum(n)::bigint as n from m group by 1""",
)
def a07(spark, d):
    counts = risks(spark, d).groupBy(F.coalesce(F.nullif(F.trim("victim_organization_industry"), F.lit("")), F.lit("Unknown")).alias("industry")).agg(F.countDistinct("deduplicated_event_id").alias("n"))
    category = F.when(F.col("industry") == "Unknown", "Unknown")
    for _, name, ws in CATEGORIES:
        category = category.when(F.lower("industry").rlike("|".join(ws)), name)
    return counts.groupBy(category.otherwise("Others").alias("category")).agg(F.sum("n").alias("n"))


@query(
    "a08_records_histogram",
    "with b(bin, k) as (values " + ", ".join(f"('{b}', {k})" for k, b in enumerate(inc.RECORD_BINS)) + f") select b.bin, b.k::int as place, count(e.enriched_event_id) as n from b left join {ACTIVE} e on e.records_affected > 0 and b.k = least(7, greatest(0, ceil(log10(e.records_affected) - 1e-12)::int - 1)) group by 1, 2",
)
def a08(spark, d):
    spine = spark.createDataFrame([(b, k) for k, b in enumerate(inc.RECORD_BINS)], "bin string, place int")
    found = active(spark, d).groupBy(inc.record_bin(F.col("records_affected")).alias("bin")).agg(F.count("*").alias("n"))
    return spine.join(found, "bin", "left").fillna(0, ["n"])


@query(
    "a09_worst_by_month",
    f"select month, enriched_event_id, severity_rank, mean_rank from (select {MONTH} as month, enriched_event_id, {SEV} as severity_rank, round(avg({SEV}) over (partition by {MONTH}), 2) as mean_rank, row_number() over (partition by {MONTH} order by {SEV} desc, enriched_event_id) as k from {ACTIVE}) where k = 1",
)
def a09(spark, d):
    rows = active(spark, d).select(inc.month(F.col("event_date")).alias("month"), "enriched_event_id", inc.severity_rank(F.col("severity")).alias("r"))
    best = rows.groupBy("month").agg(F.min(F.struct((-F.col("r")).alias("r"), "enriched_event_id")).alias("b"), F.round(F.avg("r"), 2).alias("mean_rank"))
    return best.select("month", "b.enriched_event_id", (-F.col("b.r")).alias("severity_rank"), "mean_rank")


@query("a10_median_severity", f"select {MONTH} as month, median({SEV}) as median_rank from {ACTIVE} where {SEV} > 0 group by 1")
def a10(spark, d):
    rows = active(spark, d).select(inc.month(F.col("event_date")).alias("month"), inc.severity_rank(F.col("severity")).alias("r")).where("r > 0")
    return rows.groupBy("month").agg(F.median("r").alias("median_rank"))


@query("a11_most_records_by_month", f"select month, enriched_event_id, records_affected from (select {MONTH} as month, enriched_event_id, records_affected, row_number() over (partition by {MONTH} order by records_affected desc, event_date, enriched_event_id) as k from {ACTIVE} where records_affected between 1 and 1000000000) where k = 1")
def a11(spark, d):
    rows = active(spark, d).where(inc.plausible_records(F.col("records_affected")))
    best = rows.groupBy(inc.month(F.col("event_date")).alias("month")).agg(F.min(F.struct((-F.col("records_affected")).alias("r"), "event_date", "enriched_event_id")).alias("b"))
    return best.select("month", "b.enriched_event_id", (-F.col("b.r")).alias("records_affected"))






@query("a14_records_by_type", f"select event_type, sum(records_affected)::bigint as total, round(sum(records_affected) / count(*), 4) as mean, count(*) as n from {ACTIVE} where records_affected between 1 and 1000000000 group by 1")
def a14(spark, d):
    rows = active(spark, d).where(inc.plausible_records(F.col("records_affected")))
    return rows.groupBy("event_type").agg(F.sum("records_affected").alias("total"), F.round(F.sum("records_affected") / F.count("*"), 4).alias("mean"), F.count("*").alias("n"))


HALF = "strftime(event_date, '%Y') || case when month(event_date) <= 6 then ' H1' else ' H2' end"


@query("a15_half_year_counts", f"select {HALF} as period, count(distinct enriched_event_id) as n from {ACTIVE} group by 1")
def a15(spark, d):
    return active(spark, d).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.countDistinct("enriched_event_id").alias("n"))


@query(
    "a16_prorated_last_period",
    f"with p as (select {HALF} as period, count(*) as n, max(event_date) as last_day from {ACTIVE} group by 1), l as (select *, (month(last_day) - 1) % 6 + 1 as months, row_number() over (order by period desc) as k from p) select period, n, case when k = 1 and months < 6 then round(n * 6.0 / months)::bigint else n end as projected from l",
)
def a16(spark, d):
    p = active(spark, d).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.count("*").alias("n"), F.max("event_date").alias("last_day"))
    # a handful of periods: the newest one is found on their aggregate
    newest = p.agg(F.max("period").alias("newest"))
    months = (F.month("last_day") - 1) % 6 + 1
    return p.join(F.broadcast(newest)).select("period", "n", F.when((F.col("period") == F.col("newest")) & (months < 6), F.round(F.col("n") * 6.0 / months).cast("long")).otherwise(F.col("n")).alias("projected"))


@query("a17_source_split", f"select {HALF} as period, sum(case when event_type in ('Malware', 'Ransomware', 'Phishing') then 1 else 0 end)::bigint as malicious, sum(case when event_type = 'Data Breach' then 1 else 0 end)::bigint as breach, sum(case when event_type not in ('Malware', 'Ransomware', 'Phishing', 'Data Breach') or event_type is null then 1 else 0 end)::bigint as other from {ACTIVE} group by 1")
def a17(spark, d):
    t = F.col("event_type")
    bad = t.isin("Malware", "Ransomware", "Phishing")
    kind = F.coalesce(bad, F.lit(False)), F.coalesce(t == "Data Breach", F.lit(False))
    return active(spark, d).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.count_if(kind[0]).alias("malicious"), F.count_if(kind[1]).alias("breach"), F.count_if(~kind[0] & ~kind[1]).alias("other"))




@query("a21_half_year_average", f"select {HALF} as period, round(avg(records_affected), 4) as average from {ACTIVE} where records_affected between 1 and 1000000000 group by 1")
def a21(spark, d):
    return active(spark, d).where(inc.plausible_records(F.col("records_affected"))).groupBy(inc.half_year(F.col("event_date")).alias("period")).agg(F.round(F.avg("records_affected"), 4).alias("average"))


_TYPES = ("Ransomware", "Phishing", "Malware", "Data Breach")








@query("a28_duplicate_keys", "select decision_id, count(*) as n from decisions group by 1 having count(*) > 1")
def a28(spark, d):
    return table(spark, d, "decisions").groupBy("decision_id").agg(F.count("*").alias("n")).where("n > 1")


@query("a29_merged_unexplained", "select deduplicated_event_id, count(distinct enriched_event_id) as members from decisions x where action = 'merge' and deduplicated_event_id is not null and not exists (select 1 from snapshots s where s.deduplicated_event_id = x.deduplicated_event_id) group by 1 having count(distinct enriched_event_id) > 1")
def a29(spark, d):
    told = table(spark, d, "snapshots").select("deduplicated_event_id")
    merged = table(spark, d, "decisions").where("action = 'merge' and deduplicated_event_id is not null")
    return merged.groupBy("deduplicated_event_id").agg(F.countDistinct("enriched_event_id").alias("members")).where("members > 1").join(told, "deduplicated_event_id", "left_anti")


MEMBERS = "(select distinct deduplicated_event_id, enriched_event_id from decisions where action = 'merge' and superseded_by is null and deduplicated_event_id is not null and enriched_event_id is not null)"


def members(spark: SparkSession, d: str) -> DataFrame:
    """Live members of each incident."""
    return table(spark, d, "decisions").where("action = 'merge' and superseded_by is null and deduplicated_event_id is not null and enriched_event_id is not null").select("deduplicated_event_id", "enriched_event_id").distinct()


@query("a30_member_signature", f"select deduplicated_event_id, substr(sha256(string_agg(enriched_event_id, '|' order by enriched_event_id)), 1, 32) as signature, count(*) as members from {MEMBERS} group by 1")
def a30(spark, d):
    return members(spark, d).groupBy("deduplicated_event_id").agg(F.substring(F.sha2(F.concat_ws("|", F.array_sort(F.collect_list("enriched_event_id"))), 256), 1, 32).alias("signature"), F.count("*").alias("members"))




@query("a32_source_counts", f"select deduplicated_event_id, greatest(coalesce(m.n, 0), coalesce(s.n, 0), 1) as sources from (select deduplicated_event_id, count(*) as n from {MEMBERS} group by 1) m full outer join (select deduplicated_event_id, count(distinct snapshot_id) as n from snapshots group by 1) s using (deduplicated_event_id)")
def a32(spark, d):
    m = members(spark, d).groupBy("deduplicated_event_id").agg(F.count("*").alias("m"))
    s = table(spark, d, "snapshots").groupBy("deduplicated_event_id").agg(F.countDistinct("snapshot_id").alias("s"))
    return m.join(s, "deduplicated_event_id", "full_outer").select("deduplicated_event_id", F.greatest(F.coalesce("m", F.lit(0)), F.coalesce("s", F.lit(0)), F.lit(1)).alias("sources"))


@query("a33_entity_links", f"select m.deduplicated_event_id, n.entity_id, max(e.confidence_score) as confidence, count(*) as mentions from {MEMBERS} m join {EV} e using (enriched_event_id) join entities n on n.entity_name = e.primary_entity group by 1, 2")
def a33(spark, d):
    names = table(spark, d, "entities").select("entity_id", F.col("entity_name").alias("primary_entity"))
    rows = members(spark, d).join(events(spark, d), "enriched_event_id").join(names, "primary_entity")
    return rows.groupBy("deduplicated_event_id", "entity_id").agg(F.max("confidence_score").alias("confidence"), F.count("*").alias("mentions"))








@query("a37_months_by_year", f"select year(event_date)::int as year, count(distinct {MONTH}) as months, count(*) as n_events, round(count(distinct {MONTH}) / 12.0 * 100, 1) as completion from {ACTIVE} group by 1")
def a37(spark, d):
    m = F.countDistinct(inc.month(F.col("event_date")))
    return active(spark, d).groupBy(F.year("event_date").alias("year")).agg(m.alias("months"), F.count("*").alias("n_events"), F.round(m / 12.0 * 100, 1).alias("completion"))




@query("a41_quality_by_model", f"select model_used, count(*) as n, round(avg(confidence_score), 4) as mean, min(confidence_score) as least, max(confidence_score) as most, count(*) filter (where confidence_score >= 0.8) as high, count(*) filter (where confidence_score < 0.5) as low from {RISKED} group by 1")
def a41(spark, d):
    c = F.col("confidence_score")
    return risks(spark, d).groupBy("model_used").agg(F.count("*").alias("n"), F.round(F.avg(c), 4).alias("mean"), F.min(c).alias("least"), F.max(c).alias("most"), F.count_if(c >= 0.8).alias("high"), F.count_if(c < 0.5).alias("low"))


@query("a44_share_of_total", f"select impact_type, round(count(*) * 100.0 / sum(count(*)) over (), 1) as percent from {RISKED} group by 1")
def a44(spark, d):
    return risks(spark, d).groupBy("impact_type").agg(F.count("*").alias("c")).select("impact_type", F.round(F.col("c") * 100.0 / F.sum("c").over(Window.partitionBy()), 1).alias("percent"))




@query("a46_industry_mode", f"select victim_organization_name, arg_max(industry, n * 1000000 - k) as industry from (select *, row_number() over (partition by victim_organization_name order by industry) as k from (select victim_organization_name, victim_organization_industry as industry, count(*) as n from {RISKED} where victim_organization_name is not null and victim_organization_industry is not null group by 1, 2)) where n >= 2 group by 1")
def a46(spark, d):
    rows = risks(spark, d).where("victim_organization_name is not null and victim_organization_industry is not null").groupBy("victim_organization_name", F.col("victim_organization_industry").alias("industry")).agg(F.count("*").alias("n")).where("n >= 2")
    return rows.groupBy("victim_organization_name").agg(F.min(F.struct((-F.col("n")).alias("n"), "industry"))["industry"].alias("industry"))


@query("a47_mention_counts", f"select m.deduplicated_event_id, e.primary_entity, count(*) as n from {MEMBERS} m join {EV} e using (enriched_event_id) where trim(e.primary_entity) <> '' group by 1, 2")
def a47(spark, d):
    return members(spark, d).join(events(spark, d), "enriched_event_id").where("trim(primary_entity) <> ''").groupBy("deduplicated_event_id", "primary_entity").agg(F.count("*").alias("n"))
