"""Poisson regression on aggregated cells, fitted on the driver.

The rows are first summed by covariate pattern; only the patterns (a product
of the level counts) reach the driver, where Newton steps fit the model.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_PATTERNS = 200_000


class Fit:
    """A fitted log-linear rate model: terms, coefficients, their covariance and the log-likelihood."""

    def __init__(self, names: list[str], b: np.ndarray, covariance: np.ndarray, log_likelihood: float):
        self.names, self.b, self.covariance, self.log_likelihood = names, b, covariance, log_likelihood


def fit_poisson(rows: DataFrame, factors: list[str], events: str, exposure: str) -> Fit:
    """Newton steps on the cells of ``rows``; the least level of each factor is the reference."""
    levels = [F.coalesce(F.col(f).cast("string"), F.lit("none")).alias(f) for f in factors]
    cells = rows.groupBy(*levels).agg(F.sum(events).alias("_e"), F.sum(exposure).alias("_x")).where("_x > 0").limit(MOST_PATTERNS + 1).collect()
    if len(cells) > MOST_PATTERNS:
        raise ValueError("too many covariate patterns for one model")
    if not cells:
        return Fit(["intercept"], np.zeros(1), np.full((1, 1), np.nan), 0.0)
    names, columns = ["intercept"], [np.ones(len(cells))]
    for f in factors:
        for level in sorted({c[f] for c in cells})[1:]:
            names.append(f"{f}={level}")
            columns.append(np.array([float(c[f] == level) for c in cells]))
    x = np.stack(columns, 1)
    y, t = np.array([float(c["_e"]) for c in cells]), np.array([float(c["_x"]) for c in cells])
    b = np.zeros(len(names))
    b[0] = math.log(max(y.sum(), 0.5) / t.sum())
    for _ in range(100):
        mu = t * np.exp(np.clip(x @ b, -30, 30))
        info = x.T @ (x * mu[:, None]) + 1e-9 * np.eye(len(b))
        step = np.clip(np.linalg.solve(info, x.T @ (y - mu)), -2, 2)
        b = b + step
        if np.abs(step).max() < 1e-10:
            break
    mu = t * np.exp(np.clip(x @ b, -30, 30))
    # the part that does not depend on the model is left out
    ll = float((y * np.where(y > 0, np.log(np.maximum(mu, 1e-300) / t), 0.0)).sum() - mu.sum())
    return Fit(names, b, np.linalg.inv(info), ll)


def poisson_glm(rows: DataFrame, factors: list[str], events: str, exposure: str) -> DataFrame:
    """(term, coefficient, se, z, p_value, rate_ratio) of a log-linear rate model.

    The least level of each factor is the reference; cells without exposure
    are left out, null levels are a level of their own ("none").
    """
    fit = fit_poisson(rows, factors, events, exposure)
    se = np.sqrt(np.diag(fit.covariance))
    z = fit.b / se
    p = [math.erfc(abs(v) / math.sqrt(2)) for v in z]
    out = [(n, *(float(v) for v in r)) for n, *r in zip(fit.names, fit.b, se, z, p, np.exp(fit.b))]
    return rows.sparkSession.createDataFrame(out, "term string, coefficient double, se double, z double, p_value double, rate_ratio double")


def likelihood_ratio(rows: DataFrame, full: list[str], reduced: list[str], events: str, exposure: str) -> DataFrame:
    """(statistic, df, p_value) of a model against one whose factors it contains."""
    from caseflux.operators.survival import chi2_sf

    a, b = fit_poisson(rows, full, events, exposure), fit_poisson(rows, reduced, events, exposure)
    statistic, df = 2 * (a.log_likelihood - b.log_likelihood), len(a.names) - len(b.names)
    p = chi2_sf(max(statistic, 0.0), df) if df > 0 else float("nan")
    return rows.sparkSession.createDataFrame([(float(statistic), df, p)], "statistic double, df int, p_value double")


def contrast(rows: DataFrame, factors: list[str], events: str, exposure: str, weights: dict[str, float]) -> DataFrame:
    """(estimate, se, z, p_value, p_greater) of a weighted sum of terms; terms that the model lacks count as its reference."""
    fit = fit_poisson(rows, factors, events, exposure)
    w = np.array([weights.get(n, 0.0) for n in fit.names])
    estimate, se = float(w @ fit.b), float(np.sqrt(max(w @ fit.covariance @ w, 0.0)))
    z = estimate / se if se > 0 else float("nan")
    two, one = (math.erfc(abs(z) / math.sqrt(2)), math.erfc(z / math.sqrt(2)) / 2) if se > 0 else (float("nan"), float("nan"))
    return rows.sparkSession.createDataFrame([(estimate, se, z, two, one)], "estimate double, se double, z double, p_value double, p_greater double")
