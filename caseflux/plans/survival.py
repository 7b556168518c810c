"""Recurrence statistics of entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.operators import survival as sv
from caseflux.plans.registry import query
from caseflux.plans.series import ACTIVE, active

CENSOR = "2025-12-31"
SPELLS = f"""(select *, date_diff('day', start, "end") as duration_days from (select primary_entity as entity, event_date as start, coalesce(nxt, date '{CENSOR}') as "end", (nxt is not null)::int as event, ordinal from
 (select primary_entity, event_date, lead(event_date) over w as nxt, row_number() over w as ordinal from (select distinct primary_entity, event_date from {ACTIVE} where trim(primary_entity) <> '') window w as (partition by primary_entity order by event_date)) where event_date < date '{CENSOR}') where date_diff('day', start, "end") > 0)"""
SPLIT = f"(select band, label, least(duration_days::double, coalesce(hi, 1e18)) - lo as exposure, case when duration_days > lo and duration_days <= coalesce(hi, 1e18) then event else 0 end as events from {SPELLS} s, (values (0, 0, 180, '0-180'), (1, 180, 365, '181-365'), (2, 365, 730, '366-730'), (3, 730, null, '>730')) b(band, lo, hi, label) where least(duration_days::double, coalesce(hi, 1e18)) - lo > 0)"
RATES = f"(select band, label, sum(events)::bigint as events, sum(exposure) as exposure_days, sum(events) / sum(exposure) * 36525 as rate from {SPLIT} group by 1, 2)"


def spells(spark, d):
    days = active(spark, d).where("trim(primary_entity) <> ''").select("primary_entity", "event_date")
    return sv.build_spells(days, "primary_entity", "event_date", CENSOR)


@query("t02_spells", f'select entity, start::varchar as start, "end"::varchar as stop, duration_days::int as duration_days, event, ordinal from {SPELLS}')
def t02(spark, d):
    return spells(spark, d).select("entity", F.col("start").cast("string"), F.col("end").cast("string").alias("stop"), "duration_days", "event", "ordinal")


@query("t03_split_by_elapsed", f"select label, count(*) as n, sum(exposure) as exposure, sum(events)::bigint as events from {SPLIT} group by 1")
def t03(spark, d):
    return sv.split_by_elapsed(spells(spark, d)).groupBy("label").agg(F.count("*").alias("n"), F.sum("exposure").alias("exposure"), F.sum("events").alias("events"))


@query("t05_piecewise_rates", f"select band, label, events, exposure_days, round(rate, 6) as rate from {RATES}")
def t05(spark, d):
    return sv.piecewise_rates(spells(spark, d)).withColumn("rate", F.round("rate", 6))


@query("t05_exact_limits", None)
def t05_limits(spark, d):
    return sv.piecewise_summary(spells(spark, d))


@query("t06_constant_hazard_test", None)
def t06(spark, d):
    return sv.constant_hazard_test(spells(spark, d))


@query("t12_bootstrap_rates", None)
def t12(spark, d):
    return sv.bootstrap_rates(spells(spark, d))


@query("t13_exponential_fit", f"select sum(event)::bigint as events, sum(duration_days)::bigint as days, round(sum(duration_days) / sum(event), 6) as mean_days, round(sum(event) * ln(sum(event) / sum(duration_days)) - sum(event), 6) as log_likelihood, round(2 - 2 * (sum(event) * ln(sum(event) / sum(duration_days)) - sum(event)), 6) as aic, round(ln(count(*)) - 2 * (sum(event) * ln(sum(event) / sum(duration_days)) - sum(event)), 6) as bic from {SPELLS}")
def t13(spark, d):
    f = sv.exponential_fit(spells(spark, d))
    return f.select("events", "days", *(F.round(c, 6).alias(c) for c in ("mean_days", "log_likelihood", "aic", "bic")))


@query(
    "t14_survival_curve",
    f"with b as (select duration_days as t, sum(event) as e, count(*) as n from {SPELLS} group by 1), r as (select t, e, sum(n) over (order by t desc) as at_risk from b) select t::int as time_days, e::bigint as events, at_risk::bigint as at_risk, round(case when min(1 - e / at_risk) over (order by t) <= 0 then 0 else exp(sum(case when e < at_risk then ln(1 - e / at_risk) else 0 end) over (order by t)) end, 9) as survival, round(sum(e / at_risk) over (order by t), 9) as hazard from r where e > 0",
)
def t14(spark, d):
    return sv.survival_curve(spells(spark, d)).select("time_days", "events", "at_risk", F.round("survival", 9).alias("survival"), F.round("hazard", 9).alias("hazard"))


@query("t16_rate_ratio", f"with s as (select sum(events) filter (where band = 0) as e1, sum(exposure_days) filter (where band = 0) as x1, sum(events) filter (where band in (1, 2)) as e2, sum(exposure_days) filter (where band in (1, 2)) as x2 from {RATES}) select round((e2 / x2) / (e1 / x1), 6) as ratio, round(exp(ln((e2 / x2) / (e1 / x1)) - 1.96 * sqrt(1 / e1 + 1 / e2)), 6) as low, round(exp(ln((e2 / x2) / (e1 / x1)) + 1.96 * sqrt(1 / e1 + 1 / e2)), 6) as high from s")
def t16(spark, d):
    r = sv.rate_ratio(spells(spark, d))
    return r.select(*(F.round(c, 6).alias(c) for c in ("ratio", "low", "high")))
