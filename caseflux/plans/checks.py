"""Data-quality assertions (SURVEY Q rows): one row a check, all unioned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflux.plans.registry import query
from caseflux.plans.series import EV, MEMBERS, RISK, events, members
from caseflux.sources.tables import table

# The domains of the coded columns.
SEVERITY_DOMAIN = ("Critical", "High", "Medium", "Low", "Unknown")
STATUS_DOMAIN = ("Active", "Merged", "Rejected")
CATEGORY_DOMAIN = tuple(f"C{k}" for k in range(1, 7))
ACTION_DOMAIN = ("merge", "keep_separate", "revert")


def count_bad(rows: DataFrame, name: str, bad: Column) -> DataFrame:
    """(check_name, ok, n_bad) of a row-wise assertion; a null condition is no breach."""
    n = F.count_if(F.coalesce(bad, F.lit(False)))
    return rows.agg(n.alias("n_bad")).select(F.lit(name).alias("check_name"), (F.col("n_bad") == 0).alias("ok"), "n_bad")


def count_rows(bad: DataFrame, name: str) -> DataFrame:
    """(check_name, ok, n_bad) of an assertion whose breaches are the rows."""
    return bad.agg(F.count("*").alias("n_bad")).select(F.lit(name).alias("check_name"), (F.col("n_bad") == 0).alias("ok"), "n_bad")


def _one(name: str, sql: str) -> str:
    return f"select '{name}' as check_name, n_bad = 0 as ok, n_bad from (select count(*) as n_bad from {sql})"


_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)
CHECKS_SQL = {
    "severity qualified": f"{EV} where severity like 'EventSeverity.%'",
    "type qualified": f"{EV} where event_type like '%.%'",
    "severity domain": f"{EV} where severity not in ({_IN(SEVERITY_DOMAIN)})",
    "status domain": f"{EV} where status not in ({_IN(STATUS_DOMAIN)})",
    "records range": f"{EV} where not records_affected between 1 and 1000000000",
    "confidence range": f"{EV} where not confidence_score between 0 and 1",
    "category domain": f"{RISK} where severity_category not in ({_IN(CATEGORY_DOMAIN)})",
    "risk orphans": f"(select distinct deduplicated_event_id from {RISK}) r where not exists (select 1 from {MEMBERS} m where m.deduplicated_event_id = r.deduplicated_event_id)",
    "action domain": f"decisions where action not in ({_IN(ACTION_DOMAIN)})",
    "certainty range": "decisions where not certainty between 0 and 1",
    "superseding decision missing": "(select distinct superseded_by from decisions where superseded_by is not null) x where superseded_by not in (select decision_id from decisions where decision_id is not null)",
    "decision delivered twice": "(select decision_id from decisions group by 1 having count(*) > 1)",
    "size band contradicts headcount": "entities where size_estimate <> 'UNKNOWN' and size_employees is not null and size_estimate <> case when size_employees < 20 then 'SMALL' when size_employees < 200 then 'MEDIUM' when size_employees < 5000 then 'LARGE' else 'HUGE' end",
    "batch unknown": "(select distinct batch_id from decisions where batch_id is not null) x where batch_id not in (select batch_id from batches)",
}


@query("q_all_checks", " union all ".join(_one(k, v) for k, v in CHECKS_SQL.items()))
def q_all(spark, d):
    ev, x, e = events(spark, d), table(spark, d, "decisions"), table(spark, d, "entities")
    risk = table(spark, d, RISK)
    n = F.col("size_employees")
    band = F.when(n < 20, "SMALL").when(n < 200, "MEDIUM").when(n < 5000, "LARGE").otherwise("HUGE")
    superseding = x.where("superseded_by is not null").select(F.col("superseded_by").alias("decision_id")).distinct()
    parts = [
        count_bad(ev, "severity qualified", F.col("severity").startswith("EventSeverity.")),
        count_bad(ev, "type qualified", F.col("event_type").contains(".")),
        count_bad(ev, "severity domain", ~F.col("severity").isin(*SEVERITY_DOMAIN)),
        count_bad(ev, "status domain", ~F.col("status").isin(*STATUS_DOMAIN)),
        count_bad(ev, "records range", ~F.col("records_affected").between(1, 1_000_000_000)),
        count_bad(ev, "confidence range", ~F.col("confidence_score").between(0, 1)),
        count_bad(risk, "category domain", ~F.col("severity_category").isin(*CATEGORY_DOMAIN)),
        count_rows(risk.select("deduplicated_event_id").distinct().join(members(spark, d), "deduplicated_event_id", "left_anti"), "risk orphans"),
        count_bad(x, "action domain", ~F.col("action").isin(*ACTION_DOMAIN)),
        count_bad(x, "certainty range", ~F.col("certainty").between(0, 1)),
        count_rows(superseding.join(x, "decision_id", "left_anti"), "superseding decision missing"),
        count_rows(x.groupBy("decision_id").agg(F.count("*").alias("c")).where("c > 1"), "decision delivered twice"),
        count_bad(e.where("size_employees is not null"), "size band contradicts headcount", (F.col("size_estimate") != "UNKNOWN") & (F.col("size_estimate") != band)),
        count_rows(x.select("batch_id").where("batch_id is not null").distinct().join(table(spark, d, "batches"), "batch_id", "left_anti"), "batch unknown"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("q01_malformed_severities", f"select severity, count(*) as n from {EV} where severity like 'EventSeverity.%' group by 1")
def q01(spark, d):
    return events(spark, d).where(F.col("severity").startswith("EventSeverity.")).groupBy("severity").agg(F.count("*").alias("n"))


@query("q06_risk_orphans", f"select distinct deduplicated_event_id from {RISK} r where not exists (select 1 from {MEMBERS} m where m.deduplicated_event_id = r.deduplicated_event_id)")
def q06(spark, d):
    return table(spark, d, RISK).select("deduplicated_event_id").distinct().join(members(spark, d), "deduplicated_event_id", "left_anti")




@query("q23_classification_shape", f"select deduplicated_event_id from (select distinct deduplicated_event_id, severity_category, confidence_score, reasoning_json from {RISK}) where severity_category is null or severity_category not in ({_IN(CATEGORY_DOMAIN)}) or confidence_score is null or not confidence_score between 0 and 1 or reasoning_json is null")
def q23(spark, d):
    rows = table(spark, d, RISK).select("deduplicated_event_id", "severity_category", "confidence_score", "reasoning_json").distinct()
    ok = F.col("severity_category").isin(*CATEGORY_DOMAIN) & F.col("confidence_score").between(0, 1) & F.col("reasoning_json").isNotNull()
    return rows.where(~F.coalesce(ok, F.lit(False))).select("deduplicated_event_id")
