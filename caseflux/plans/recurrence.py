"""Further statistics of recurrence (SURVEY T rows): covariates, double splits, regressions, phases, families."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflux.operators import regression as rg
from caseflux.operators import survival as sv
from caseflux.plans.dialect import sql_query
from caseflux.plans.registry import query
from caseflux.plans.survival import RATES, SPELLS, SPLIT, spells

SIZE = "case size_estimate when 'SMALL' then 1 when 'MEDIUM' then 2 when 'LARGE' then 3 when 'HUGE' then 4 end"
sql_query("t01_covariates", f"select e.entity_id, coalesce({SIZE}, m.mean)::double as size_rank, {SIZE} is null as imputed from entities e cross join (select avg({SIZE})::double as mean from entities) m", "Ordinal size; an unknown one takes the mean.")
CALENDAR = "(values (0, date '2020-01-01', date '2022-01-01'), (1, date '2022-01-01', date '2024-01-01'), (2, date '2024-01-01', date '2026-01-01')) c(era, since, until)"
_STOPPED = SPELLS.replace('"end"', "stop_day")
DOUBLE = f"""(select b.band, c.era, date_diff('day', greatest(s.start + b.lo, c.since), least(s.start + coalesce(b.hi, 100000), c.until, s.stop_day))::double as exposure, case when s.event = 1 and s.duration_days > b.lo and s.duration_days <= coalesce(b.hi, 100000) and s.stop_day > c.since and s.stop_day <= c.until then 1 else 0 end as events
 from {_STOPPED} s, (values (0, 0, 180), (1, 180, 365), (2, 365, 730), (3, 730, null)) b(band, lo, hi), {CALENDAR} where date_diff('day', greatest(s.start + b.lo, c.since), least(s.start + coalesce(b.hi, 100000), c.until, s.stop_day)) > 0)"""
sql_query("t04_double_split", f"select band, era, count(*) as cells, sum(exposure) as exposure, sum(events)::bigint as events from {DOUBLE} group by 1, 2", "Spells cut by elapsed and by calendar bands; an event lies in one cell.")
sql_query("t17_phase_summary", f"select phase, sum(events)::bigint as events, sum(exposure) as exposure, round(sum(events) / sum(exposure) * 36525, 6)::double as rate from (select case when band = 0 then 'early' when band in (1, 2) then 'middle' else 'late' end as phase, events, exposure from {DOUBLE}) group by phase", "Rates by phase.")
_CELLS = f"(select band, era, sum(events)::bigint as events, sum(exposure) as exposure from {DOUBLE} group by 1, 2)"
_POOLED = f"(select band, case when sum(events) over (partition by era) < 3 then 'pooled' else era::varchar end as era, events, exposure from {_CELLS})"
sql_query("t07_design_matrix", f"select band::varchar as band, era, sum(events)::bigint as events, round(ln(sum(exposure)), 9)::double as offset_term, (band = 1)::int as band_1, (band = 2)::int as band_2, (band = 3)::int as band_3, (era = '1')::int as era_1, (era = '2')::int as era_2, (era = 'pooled')::int as era_pooled from {_POOLED} group by band, era", "Design matrix with the first levels as reference; eras of fewer than three events are pooled.")


@query("t08_poisson_rates", f"select 'band=' || b.band::varchar as term, round(ln(b.rate / r.rate), 6)::double as coefficient, round(sqrt(1.0 / b.events + 1.0 / r.events), 6)::double as se, round(b.rate / r.rate, 6)::double as rate_ratio from {RATES} b, {RATES} r where r.band = 0 and b.band > 0 and b.events > 0 and r.events > 0 union all select 'intercept', round(ln(rate / 36525), 6)::double, round(sqrt(1.0 / events), 6)::double, round(rate / 36525, 6)::double from {RATES} where band = 0 and events > 0")
def t08(spark, d):
    """Poisson regression on elapsed bands; with one factor the closed form is its oracle."""
    fit = rg.poisson_glm(sv.split_by_elapsed(spells(spark, d)), ["band"], "events", "exposure")
    return fit.where("se < 100").select("term", *(F.round(c, 6).alias(c) for c in ("coefficient", "se", "rate_ratio")))


_LL = "sum(case when e > 0 then e * ln(e / x) else 0 end)"
_KIND_CELLS = f"(select band, ordinal > 1 as again, sum(events)::double as e, sum(exposure) as x from (select s.ordinal, b.band, least(s.duration_days::double, coalesce(b.hi, 1e18)) - b.lo as exposure, case when s.duration_days > b.lo and s.duration_days <= coalesce(b.hi, 1e18) then s.event else 0 end as events from {_STOPPED} s, (values (0, 0, 180), (1, 180, 365), (2, 365, 730), (3, 730, null)) b(band, lo, hi) where least(s.duration_days::double, coalesce(b.hi, 1e18)) - b.lo > 0) group by 1, 2)"


@query("t09_nested_models", f"select round(2 * (f.ll - r.ll), 4)::double as statistic, (f.n - r.n)::int as df from (select {_LL} as ll, count(*) as n from {_KIND_CELLS}) f, (select {_LL} as ll, count(*) as n from (select again, sum(e) as e, sum(x) as x from {_KIND_CELLS} group by again)) r")
def t09(spark, d):
    """Full against reduced model: bands within first and later spells against first and later spells alone."""
    s = spells(spark, d)
    cut = sv.split_by_elapsed(s.select(F.concat_ws("#", "entity", F.col("ordinal").cast("string")).alias("entity"), "start", "end", "duration_days", "event", "ordinal"))
    cut = cut.withColumn("again", F.element_at(F.split("entity", "#"), -1).cast("int") > 1).withColumn("cell", F.concat_ws("/", F.col("again").cast("string"), F.col("band").cast("string")))
    test = rg.likelihood_ratio(cut, ["cell"], ["again"], "events", "exposure")
    return test.select(F.round("statistic", 4).alias("statistic"), "df")


@query("t10_contrast", f"select round(ln(a.rate / b.rate), 6)::double as estimate, round(sqrt(1.0 / a.events + 1.0 / b.events), 6)::double as se, round(ln(a.rate / b.rate) / sqrt(1.0 / a.events + 1.0 / b.events), 5)::double as z from {RATES} a, {RATES} b where a.band = 1 and b.band = 2 and a.events > 0 and b.events > 0")
def t10(spark, d):
    """Second band against the third, as a contrast of the regression."""
    row = rg.contrast(sv.split_by_elapsed(spells(spark, d)), ["band"], "events", "exposure", {"band=1": 1.0, "band=2": -1.0})
    return row.where("se < 100").select(F.round("estimate", 6).alias("estimate"), F.round("se", 6).alias("se"), F.round("z", 5).alias("z"))


_PHASES = f"(select case when band = 0 then 'early' when band in (1, 2) then 'middle' else 'late' end as phase, sum(events)::double as e, sum(exposure_days) as x from {RATES} group by 1)"


@query("t11_u_shape", f"select round(0.5 * ln(a.e / a.x) + 0.5 * ln(c.e / c.x) - ln(b.e / b.x), 6)::double as estimate, round(sqrt(0.25 / a.e + 0.25 / c.e + 1 / b.e), 6)::double as se from {_PHASES} a, {_PHASES} b, {_PHASES} c where a.phase = 'early' and b.phase = 'middle' and c.phase = 'late' and a.e > 0 and b.e > 0 and c.e > 0")
def t11(spark, d):
    """Early and late phase against the middle: above nought where the hazard is U-shaped."""
    phase = F.when(F.col("band") == 0, "early").when(F.col("band").isin(1, 2), "middle").otherwise("zlate")
    rows = sv.split_by_elapsed(spells(spark, d)).withColumn("phase", phase)
    row = rg.contrast(rows, ["phase"], "events", "exposure", {"phase=zlate": 0.5, "phase=middle": -1.0})
    return row.where("se < 100").select(F.round("estimate", 6).alias("estimate"), F.round("se", 6).alias("se"))


@query("t11_phase_variants", None)
def t11_variants(spark, d):
    """The same contrast with the covariates of a spell, and with each of them dropped."""
    s = spells(spark, d)
    era = F.when(F.col("start") < "2022-01-01", "0").when(F.col("start") < "2024-01-01", "1").otherwise("2")
    key = F.concat_ws("#", "entity", era, (F.col("ordinal") > 1).cast("string"))
    phase = F.when(F.col("band") == 0, "early").when(F.col("band").isin(1, 2), "middle").otherwise("zlate")
    cut = sv.split_by_elapsed(s.withColumn("entity", key)).withColumn("phase", phase)
    cut = cut.withColumn("era", F.element_at(F.split("entity", "#"), -2)).withColumn("again", F.element_at(F.split("entity", "#"), -1))
    out = None
    for name, factors in (("all", ["phase", "era", "again"]), ("without era", ["phase", "again"]), ("without again", ["phase", "era"]), ("phase alone", ["phase"])):
        row = rg.contrast(cut, factors, "events", "exposure", {"phase=zlate": 0.5, "phase=middle": -1.0}).select(F.lit(name).alias("variant"), "estimate", "se", "z", "p_value")
        out = row if out is None else out.unionByName(row)
    return out


@query("t06_constant_hazard", f"select round(2 * (b.ll - case when t.e > 0 then t.e * ln(t.e / t.x) else 0 end), 6)::double as statistic, (b.n - 1)::int as df from (select {_LL} as ll, count(*) as n from (select events::double as e, exposure_days as x from {RATES})) b, (select sum(events)::double as e, sum(exposure_days) as x from {RATES}) t")
def t06_statistic(spark, d):
    """Likelihood ratio of one hazard a band against one for all (its p-value stands in t06_constant_hazard_test)."""
    return sv.constant_hazard_test(spells(spark, d)).select(F.round("statistic", 6).alias("statistic"), "df")


@query("t13_parametric_models", None)
def t13_models(spark, d):
    """Censored fits of five families with AIC and BIC."""
    return sv.parametric_models(spells(spark, d))


_GRID = "(values (30), (90), (180), (365), (730)) g(day)"
sql_query("t15_hazard_curves", f"select g.day, round(f.e / f.x, 9)::double as exponential, round(0.00155555556::double * power(g.day / 900.0::double, 0.4::double), 9)::double as weibull, round(0.002::double * power(g.day / 800.0::double, 0.6::double) / (1 + power(g.day / 800.0::double, 1.6::double)), 9)::double as log_logistic from {_GRID}, (select sum(event)::double as e, sum(duration_days)::double as x from {_STOPPED}) f", "Hazards on a grid: the fitted exponential, and two families at given parameters.")
_STOPPED_RATES = RATES.replace('"end"', "stop_day")
sql_query("z80_model_rows", f"select family, round(ll, 4)::double as log_likelihood, k::int as parameters, round(2 * k - 2 * ll, 4)::double as aic, round(k * ln(n) - 2 * ll, 4)::double as bic from (select 'exponential' as family, 1 as k, e * ln(e / x) - e as ll, n from (select sum(event)::double as e, sum(duration_days)::double as x, count(*) as n from {_STOPPED}) union all select 'two bands', 2, a.e * ln(a.e / a.x) + b.e * ln(b.e / b.x) - a.e - b.e, c.n from (select sum(events)::double as e, sum(exposure_days) as x from {_STOPPED_RATES} where band < 2) a, (select sum(events)::double as e, sum(exposure_days) as x from {_STOPPED_RATES} where band >= 2) b, (select count(*) as n from {_STOPPED}) c)", "Rows of a model comparison.")
_DAYS = f"(select duration_days as t, sum(event)::double as e, count(*)::double as n from {_STOPPED} group by 1)"
sql_query("w06_running_hazard", f"select t::int as time_days, at_risk, round(exp(sum(case when e < at_risk then ln(1 - e / at_risk) else 0 end) over (order by t rows between unbounded preceding and current row)), 9) as survival, round(sum(e / at_risk) over (order by t rows between unbounded preceding and current row), 9) as hazard from (select t, e, sum(n) over (order by t desc rows between unbounded preceding and current row) as at_risk from {_DAYS}) where e > 0 and e < at_risk", "Running product of survival and sum of hazards over those at risk.")
