"""Time-to-recurrence statistics over spells.

Everything up to the small aggregate frames stays distributed; only band and
event-time aggregates reach single-task windows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS = 36525  # days of 100 years: rates are events per 100 entity-years
BANDS = (0, 180, 365, 730, None)


def build_spells(days: DataFrame, entity: str, day: str, censor: str) -> DataFrame:
    """(entity, start, end, duration_days, event, ordinal): from each event to the next or the censor date.

    Spells that start on or after the censor date, or last no day, are left out.
    """
    w = Window.partitionBy(entity).orderBy(day)
    rows = days.where(F.col(entity).isNotNull() & F.col(day).isNotNull()).select(entity, day).distinct()
    nxt = F.lead(day).over(w)
    spells = rows.select(F.col(entity).alias("entity"), F.col(day).alias("start"), nxt.alias("next"), F.row_number().over(w).alias("ordinal"))
    limit = F.lit(censor).cast("date")
    spells = spells.where(F.col("start") < limit).withColumn("end", F.coalesce("next", limit))
    spells = spells.withColumn("duration_days", F.date_diff("end", "start")).withColumn("event", F.col("next").isNotNull().cast("int"))
    return spells.where("duration_days > 0").select("entity", "start", "end", "duration_days", "event", "ordinal")


def bands_frame(spark, bounds=BANDS) -> DataFrame:
    rows = [(k, float(lo), None if hi is None else float(hi), f">{lo}" if hi is None else f"{lo + (lo > 0)}-{hi}") for k, (lo, hi) in enumerate(zip(bounds, bounds[1:]))]
    return spark.createDataFrame(rows, "band int, lo double, hi double, label string")


def split_by_elapsed(spells: DataFrame, bounds=BANDS) -> DataFrame:
    """Spells cut at the band edges (lo, hi]; an event counts in the band it ends in."""
    upper = F.coalesce("hi", F.lit(float("inf")))
    cut = spells.join(F.broadcast(bands_frame(spells.sparkSession, bounds)))  # a handful of bands
    exposure = F.least(F.col("duration_days").cast("double"), upper) - F.col("lo")
    cut = cut.withColumn("exposure", exposure).where("exposure > 0")
    inside = (F.col("duration_days") > F.col("lo")) & (F.col("duration_days") <= upper)
    return cut.select("entity", "band", "label", "exposure", F.when(inside, F.col("event")).otherwise(0).alias("events"))


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by series or continued fraction."""
    if x <= 0:
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > total * 1e-15:
            k += 1
            term *= x / k
            total += term
        return total * scale
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 10_000):
        n = -i * (i - a)
        b += 2
        d = 1 / ((n * d + b) or 1e-300)
        c = (b + n / c) or 1e-300
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return 1 - scale * h


def chi2_sf(x: float, df: float) -> float:
    return 1 - _gamma_p(df / 2, x / 2)


def chi2_quantile(p: float, df: float) -> float:
    """Quantile by bisection; enough for the few bands of a summary."""
    lo, hi = 0.0, max(10.0, 4 * df + 40)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_p(df / 2, mid / 2) < p else (lo, mid)
    return (lo + hi) / 2


def poisson_limits(events: int, exposure: float) -> tuple[float, float]:
    """Exact 95 % limits of a rate per 100 entity-years."""
    low = 0.0 if events == 0 else chi2_quantile(0.025, 2 * events) / 2 / exposure
    return low * DAYS, chi2_quantile(0.975, 2 * (events + 1)) / 2 / exposure * DAYS


def piecewise_rates(spells: DataFrame, bounds=BANDS) -> DataFrame:
    """(band, label, events, exposure_days, rate): one row a band."""
    out = split_by_elapsed(spells, bounds).groupBy("band", "label").agg(F.sum("events").alias("events"), F.sum("exposure").alias("exposure_days"))
    return out.withColumn("rate", F.col("events") / F.col("exposure_days") * DAYS)


def piecewise_summary(spells: DataFrame, bounds=BANDS) -> DataFrame:
    """``piecewise_rates`` with exact limits; the bands' few rows are finished on the driver."""
    rows = piecewise_rates(spells, bounds).orderBy("band").collect()
    done = [(r["band"], r["label"], int(r["events"]), r["exposure_days"], r["rate"], *poisson_limits(int(r["events"]), r["exposure_days"])) for r in rows]
    return spells.sparkSession.createDataFrame(done, "band int, label string, events int, exposure_days double, rate double, rate_low double, rate_high double")


def constant_hazard_test(spells: DataFrame, bounds=BANDS) -> DataFrame:
    """Likelihood-ratio test of one hazard for all bands against one a band."""
    b = piecewise_rates(spells, bounds)
    term = lambda e, x: F.when(e > 0, e * F.log(e / x)).otherwise(0.0)
    s = b.agg(F.sum(term(F.col("events"), F.col("exposure_days"))).alias("alt"), F.sum("events").alias("e"), F.sum("exposure_days").alias("x"), F.count("*").alias("n"))
    s = s.select((2 * (F.col("alt") - term(F.col("e"), F.col("x")))).alias("statistic"), (F.col("n") - 1).alias("df")).first()
    p = chi2_sf(s["statistic"], s["df"]) if s["df"] else float("nan")
    return spells.sparkSession.createDataFrame([(s["statistic"], int(s["df"]), p)], "statistic double, df int, p_value double")


def survival_curve(spells: DataFrame) -> DataFrame:
    """Kaplan-Meier and Nelson-Aalen steps: (time_days, events, at_risk, survival, hazard).

    Spells are first counted by duration, so the running windows see one row
    for each distinct number of days.
    """
    by = spells.groupBy(F.col("duration_days").alias("time_days")).agg(F.sum("event").alias("events"), F.count("*").alias("n"))
    back = Window.orderBy(F.desc("time_days")).rowsBetween(Window.unboundedPreceding, 0)
    steps = by.withColumn("at_risk", F.sum("n").over(back)).where("events > 0")
    run = Window.orderBy("time_days").rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("events") / F.col("at_risk")
    # everybody left at once: the product is zero from there on
    zero = F.max(F.when(share >= 1, 1).otherwise(0)).over(run) == 1
    curve = F.exp(F.sum(F.when(share < 1, F.log(1 - share)).otherwise(0.0)).over(run))
    return steps.select("time_days", "events", "at_risk", F.when(zero, 0.0).otherwise(curve).alias("survival"), F.sum(share).over(run).alias("hazard"))


def exponential_fit(spells: DataFrame) -> DataFrame:
    """Censored maximum likelihood of one rate: (events, days, mean_days, log_likelihood, aic, bic)."""
    s = spells.agg(F.sum("event").alias("e"), F.sum("duration_days").alias("x"), F.count("*").alias("n"))
    e, x = F.col("e"), F.col("x")
    ll = e * F.log(e / x) - e
    return s.select(e.alias("events"), x.alias("days"), (x / e).alias("mean_days"), ll.alias("log_likelihood"), (2 - 2 * ll).alias("aic"), (F.log("n") - 2 * ll).alias("bic"))


def _log_upper_gamma(a: float, x: float) -> float:
    return math.log(max(1 - _gamma_p(a, x), 1e-300))


def _log_likelihood(family: str, theta: list[float], cells: list[tuple[float, float, float]]) -> float:
    """Censored log-likelihood: events give the density, the others the survival; parameters on the log scale."""
    total = 0.0
    for t, events, censored in cells:
        if family == "weibull":
            scale, shape = math.exp(theta[0]), math.exp(theta[1])
            h = (t / scale) ** shape
            density, survival = math.log(shape / t) + math.log(max(h, 1e-300)) - h, -h
        elif family == "log-normal":
            sigma = math.exp(theta[1])
            z = (math.log(t) - theta[0]) / sigma
            density, survival = -math.log(t * sigma) - 0.5 * math.log(2 * math.pi) - z * z / 2, math.log(max(math.erfc(z / math.sqrt(2)) / 2, 1e-300))
        elif family == "log-logistic":
            scale, shape = math.exp(theta[0]), math.exp(theta[1])
            u = (t / scale) ** shape
            density, survival = math.log(shape / t) + math.log(max(u, 1e-300)) - 2 * math.log1p(u), -math.log1p(u)
        else:  # generalised gamma: shape d, power p
            scale, d, p = (math.exp(v) for v in theta)
            x = (t / scale) ** p
            density = math.log(p) - d * math.log(scale) + (d - 1) * math.log(t) - x - math.lgamma(d / p)
            survival = _log_upper_gamma(d / p, x)
        total += events * density + censored * survival
    return total


def _climb(f, theta: list[float], steps: int = 4000) -> tuple[list[float], float]:
    """Largest value by steps along the axes that grow where they help and halve where they do not."""
    best, width = f(theta), [0.5] * len(theta)
    for _ in range(steps):
        for k in range(len(theta)):
            for sign in (1, -1):
                at = list(theta)
                at[k] += sign * width[k]
                try:
                    value = f(at)
                except (OverflowError, ValueError):
                    continue
                if value > best + 1e-12:
                    theta, best = at, value
                    width[k] *= 1.6
                    break
            else:
                width[k] /= 2
        if max(width) < 1e-7:
            break
    return theta, best


def parametric_models(spells: DataFrame) -> DataFrame:
    """(family, parameters, log_likelihood, aic, bic, theta) of five censored families.

    Spells are counted by duration first; what the driver fits are as many
    cells as there are distinct numbers of days.
    """
    by = spells.groupBy("duration_days").agg(F.sum("event").alias("e"), F.sum(1 - F.col("event")).alias("c")).collect()
    cells = [(float(r["duration_days"]), float(r["e"]), float(r["c"])) for r in by]
    n, e, x = sum(a + b for _, a, b in cells), sum(a for _, a, _ in cells), sum(t * (a + b) for t, a, b in cells)
    if not e:
        return spells.sparkSession.createDataFrame([], "family string, parameters int, log_likelihood double, aic double, bic double, theta array<double>")
    start = math.log(x / e)
    fits = [("exponential", [start], e * math.log(e / x) - e)]
    for family, theta in (("weibull", [start, 0.0]), ("log-normal", [start, 0.5]), ("log-logistic", [start, 0.0])):
        fits.append((family, *_climb(lambda t, f=family: _log_likelihood(f, t, cells), theta)))
    # a generalised gamma with d = p is a Weibull: it starts there and cannot do worse
    scale, shape = fits[1][1]
    fits.append(("generalised gamma", *_climb(lambda t: _log_likelihood("generalised gamma", t, cells), [scale, shape, shape], 300)))
    rows = [(f, len(t), float(ll), 2 * len(t) - 2 * float(ll), len(t) * math.log(n) - 2 * float(ll), [float(v) for v in t]) for f, t, ll in fits]
    return spells.sparkSession.createDataFrame(rows, "family string, parameters int, log_likelihood double, aic double, bic double, theta array<double>")


def rate_ratio(spells: DataFrame, bounds=BANDS) -> DataFrame:
    """Rate of the second and third band over the first, with log-normal limits."""
    b = piecewise_rates(spells, bounds)

    def total(c: str, bands: Column) -> Column:
        return F.sum(F.when(bands, F.col(c)))

    first, later = F.col("band") == 0, F.col("band").isin(1, 2)
    s = b.agg(total("events", first).alias("e1"), total("exposure_days", first).alias("x1"), total("events", later).alias("e2"), total("exposure_days", later).alias("x2"))
    ratio = (F.col("e2") / F.col("x2")) / (F.col("e1") / F.col("x1"))
    se = F.sqrt(1 / F.col("e1") + 1 / F.col("e2"))
    return s.select(ratio.alias("ratio"), F.exp(F.log(ratio) - 1.96 * se).alias("low"), F.exp(F.log(ratio) + 1.96 * se).alias("high"))


def bootstrap_rates(spells: DataFrame, bounds=BANDS, replicates: int = 200, seed: int = 11) -> DataFrame:
    """(band, label, low, high): percentile limits from resampling whole entities.

    Each entity gets a Poisson(1) weight in each replicate, drawn from the
    hash of (seed, replicate, entity), so the draw needs no shuffle and repeats
    exactly; exposure is first summed by entity and band.
    """
    cells = split_by_elapsed(spells, bounds).groupBy("entity", "band", "label").agg(F.sum("events").alias("e"), F.sum("exposure").alias("x"))
    drawn = cells.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    u = (F.pmod(F.xxhash64(F.lit(seed), "rep", "entity"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    weight, p, cum = F.lit(0), math.exp(-1), 0.0
    for k in range(8):
        cum += p
        weight = weight + F.when(u > cum, 1).otherwise(0)
        p /= k + 1
    sums = drawn.withColumn("w", weight).where("w > 0").groupBy("rep", "band", "label").agg(F.sum(F.col("w") * F.col("e")).alias("e"), F.sum(F.col("w") * F.col("x")).alias("x"))
    rate = F.col("e") / F.col("x") * DAYS
    return sums.groupBy("band", "label").agg(F.percentile(rate, 0.025).alias("low"), F.percentile(rate, 0.975).alias("high"))
