"""Ledger and lineage queries, sinks and sources (SURVEY L, K, S and Z rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.operators import ledger as lg
from caseflux.plans.registry import query
from caseflux.plans.series import EV, MEMBERS, RISK, events, members
from caseflux.sources.tables import table

NOW_MEMBERS = "(select deduplicated_event_id, enriched_event_id from (select deduplicated_event_id, enriched_event_id, arg_max(action, (created_at, decision_id)) as action from (select distinct decision_id, enriched_event_id, deduplicated_event_id, action, created_at from decisions where superseded_by is null and enriched_event_id is not null and deduplicated_event_id is not null and action in ('merge', 'revert')) group by 1, 2) where action = 'merge')"




@query("l02_current_members", f"select deduplicated_event_id, count(*) as members from {NOW_MEMBERS} group by 1")
def l02(spark, d):
    return lg.membership(table(spark, d, "decisions")).groupBy("deduplicated_event_id").agg(F.count("*").alias("members"))


@query("l04_snapshot_payloads", f"select deduplicated_event_id, '{{\"members\":[' || string_agg('\"' || enriched_event_id || '\"', ',' order by enriched_event_id) || ']}}' as payload_json from {NOW_MEMBERS} group by 1")
def l04(spark, d):
    return lg.snapshot(table(spark, d, "decisions"))










@query("k04_export_summary", "select 'decisions' as name, count(*) as n from decisions union all select 'extracted_event_details', count(*) from extracted_event_details union all select 'match_evidence', count(*) from match_evidence union all select 'snapshots', count(*) from snapshots union all select 'entities', count(*) from entities")
def k04(spark, d):
    out = None
    for name in ("decisions", "extracted_event_details", "match_evidence", "snapshots", "entities"):
        one = table(spark, d, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("k08_latest_per_incident", f"select deduplicated_event_id, severity_category from (select deduplicated_event_id, severity_category, row_number() over (partition by deduplicated_event_id order by created_at desc nulls last, classification_id desc nulls last) as k from {RISK}) where k = 1")
def k08(spark, d):
    return lg.keep_latest(table(spark, d, RISK), ["deduplicated_event_id"], ["created_at", "classification_id"]).select("deduplicated_event_id", "severity_category")


@query("s17_unprocessed_queue", "select enriched_event_id from (select enriched_event_id, min(discovered_at) as seen from extracted_event_details where enriched_event_id not in (select enriched_event_id from decisions where action = 'merge' and enriched_event_id is not null) group by 1) order by seen nulls last, enriched_event_id limit 200")
def s17(spark, d):
    done = table(spark, d, "decisions").where("action = 'merge'").select("enriched_event_id")
    queue = table(spark, d, "extracted_event_details").join(done, "enriched_event_id", "left_anti").groupBy("enriched_event_id").agg(F.min("discovered_at").alias("seen"))
    return queue.orderBy(F.asc_nulls_last("seen"), "enriched_event_id").limit(200).select("enriched_event_id")


@query("s18_known_urls", "select distinct source_url from documents where source_url is not null")
def s18(spark, d):
    return table(spark, d, "documents").where("source_url is not null").select("source_url").distinct()




@query("s20_status", "select max(strftime(discovered_at, '%Y-%m-%d %H:%M:%S')) as last_seen, max(event_date)::varchar as latest_event, count(distinct enriched_event_id) as n from extracted_event_details")
def s20(spark, d):
    return table(spark, d, "extracted_event_details").agg(F.max(F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss")).alias("last_seen"), F.max("event_date").cast("string").alias("latest_event"), F.countDistinct("enriched_event_id").alias("n"))



