"""Bayesian logistic regression on tables of any size.

Every iteration reads the data once and returns a handful of sums (the normal equations and the
deviance); the driver solves a system as small as the number of coefficients.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundloom.functions.indices import (DEFAULT_SCORE_INTERCEPT, PRIOR_MEAN, linear_score, logistic, logit_score,
                                          threshold_class)
from groundloom.operators.votes import confusion_matrix, overall_accuracy
from groundloom.scale import grouped_quantiles


@dataclass(frozen=True)
class Prior:
    """Student-t priors, intercept first. An infinite scale means no prior."""

    mean: Sequence[float]
    scale: Sequence[float]
    df: float = 1.0


@dataclass(frozen=True)
class LogitModel:
    cols: list[str]
    coefficients: np.ndarray
    covariance: np.ndarray
    prior_sd: np.ndarray
    deviance: float
    iterations: int
    trace: list[float] = field(default_factory=list)

    def probability(self) -> Column:
        return logit_score(self.coefficients[0], list(self.coefficients[1:]), self.cols)


def flat_prior(n_cols: int) -> Prior:
    return Prior([0.0] * (n_cols + 1), [math.inf] * (n_cols + 1))


def _sums(df: DataFrame, cols: Sequence[str], label: str, beta: np.ndarray | None) -> tuple:
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in cols]]
    y = F.col(label).cast("double")
    if beta is None:                       # start from the label itself, shrunk towards one half
        mu = (y + 0.5) / 2.0
        staged = df.withColumn("_eta", F.ln(mu / (1 - mu))).withColumn("_mu", mu)
    else:
        staged = df.withColumn("_eta", linear_score(beta[0], list(beta[1:]), [F.col(c).cast("double") for c in cols]))
        staged = staged.withColumn("_mu", logistic(F.col("_eta")))
    mu = F.col("_mu")
    staged = staged.withColumn("_w", F.greatest(mu * (1 - mu), F.lit(2.220446049250313e-16)))
    w, z = F.col("_w"), F.col("_eta") + (y - mu) / F.col("_w")
    k = len(terms)
    log_lik = F.when(y == 1, F.ln(F.greatest(mu, F.lit(1e-300)))).otherwise(F.ln(F.greatest(1 - mu, F.lit(1e-300))))
    aggs = [F.sum(w * terms[i] * terms[j]) for i in range(k) for j in range(i, k)]
    aggs += [F.sum(w * t * z) for t in terms] + [F.sum(-2.0 * log_lik)]
    row = list(staged.agg(*aggs).first())
    xtwx = np.zeros((k, k))
    xtwx[np.triu_indices(k)] = row[:k * (k + 1) // 2]
    xtwx = xtwx + np.triu(xtwx, 1).T
    return xtwx, np.array(row[k * (k + 1) // 2:-1], dtype=float), float(row[-1])


def bayes_logit_fit(df: DataFrame, cols: Sequence[str], label: str, prior: Prior | None = None,
                    epsilon: float = 1e-8, max_iterations: int = 100) -> LogitModel:
    """Fit by iteratively reweighted least squares with an EM step for the t priors.

    The prior deviation of a coefficient follows from its distance to the prior mean, its
    variance and the prior scale (Gelman et al. 2008, Ann. Appl. Stat. 2:4).
    """
    cols = list(cols)
    prior = prior or flat_prior(len(cols))
    mean, scale = np.array(prior.mean, dtype=float), np.array(prior.scale, dtype=float)
    if len(mean) != len(cols) + 1 or len(scale) != len(mean):
        raise ValueError("the prior needs one mean and one scale per coefficient, intercept first")
    data = df.select(*cols, label).dropna().persist()
    sd, beta, last, trace = scale.copy(), None, math.inf, []
    try:
        for iteration in range(1, max_iterations + 1):
            xtwx, xtwz, deviance = _sums(data, cols, label, beta)
            if beta is not None:
                trace.append(deviance)
                if abs(deviance - last) / (0.1 + abs(deviance)) < epsilon:
                    break
                last = deviance
            pull = np.where(np.isinf(sd), 0.0, 1.0 / sd**2)
            covariance = np.linalg.inv(xtwx + np.diag(pull))
            beta = covariance @ (xtwz + pull * mean)
            if math.isfinite(prior.df):
                finite = np.isfinite(scale)
                var = np.diag(covariance)
                new = np.sqrt(((beta - mean)**2 + var + prior.df * np.where(finite, scale, 0.0)**2) / (1 + prior.df))
                sd = np.where(finite, new, math.inf)
        else:
            raise RuntimeError("the fit did not converge")
    finally:
        data.unpersist()
    return LogitModel(cols, beta, covariance, sd, deviance, iteration, trace)


def coefficient_table(spark: SparkSession, model: LogitModel) -> DataFrame:
    """Posterior mean and deviation per coefficient."""
    rows = [(name, float(b), float(math.sqrt(v))) for name, b, v in
            zip(["(Intercept)", *model.cols], model.coefficients, np.diag(model.covariance))]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double")


def draw_matrix(model: LogitModel, n: int = 2000, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).multivariate_normal(model.coefficients, model.covariance, size=n)


def standard_normal(draw: Column, term: int, seed: int) -> Column:
    """A standard normal number that depends on seed, draw and term only: two parts of an MD5, made normal by Box-Muller."""
    word = F.md5(F.concat_ws(":", F.lit(str(seed)), draw.cast("string"), F.lit(str(term))))

    def uniform(begin: int) -> Column:
        return (F.conv(F.substring(word, begin, 8), 16, 10).cast("double") + 0.5) / 2.0 ** 32

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * math.pi * uniform(9))


def posterior_draws(spark: SparkSession, model: LogitModel, n: int = 2000, seed: int = 7) -> DataFrame:
    """Seeded draws of the coefficients, one row per draw, for any number of draws.

    The executors make them from the number of the draw; only the Cholesky factor of the covariance, a number for each pair of
    coefficients, is part of the expression.
    """
    names = ["intercept", *model.cols]
    factor = np.linalg.cholesky(model.covariance)
    rows = spark.range(n).select(F.col("id").alias("draw"), *[standard_normal(F.col("id"), k, seed).alias(f"_z{k}") for k in range(len(names))])
    values = []
    for j, name in enumerate(names):
        value = F.lit(float(model.coefficients[j]))
        for k in range(j + 1):
            value = value + F.col(f"_z{k}") * float(factor[j, k])
        values.append(value.alias(name))
    return rows.select("draw", *values)


def posterior_as_prior(draws: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of the draws per coefficient, the prior of the next run."""
    cells = F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).alias("value")) for c in cols])
    return (draws.select(F.explode(cells).alias("_c")).select("_c.*").groupBy("term")
            .agg(F.avg("value").alias("prior_mean"), F.stddev_samp("value").alias("prior_scale")))


def next_prior(model: LogitModel, draws: DataFrame, df: float = 1.0) -> Prior:
    """Prior of the next run: the fitted coefficients with the deviation of their draws as scale."""
    terms = ["intercept", *model.cols]
    scale = draws.agg(*[F.stddev_samp(c).alias(c) for c in terms]).first()
    return Prior([float(b) for b in model.coefficients], [float(scale[c]) for c in terms], df)


def credible_interval(draws: DataFrame, cols: Sequence[str], low: float = 0.025, high: float = 0.975) -> DataFrame:
    """Quantiles of the draws per coefficient, linearly interpolated."""
    cells = F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).alias("value")) for c in cols])
    long = draws.select(F.explode(cells).alias("_c")).select("_c.*")
    return grouped_quantiles(long, ["term"], "value", [low, high], ["ci_low", "ci_high"])


def draw_scores(cols: Sequence[str], draws: Sequence[Sequence[float]]) -> Column:
    """Array with the probability of the row under every draw."""
    text = json.dumps([[float(v) for v in d] for d in draws])
    coefficients = F.from_json(F.lit(text), "array<array<double>>")          # folded to one literal

    def score(d: Column) -> Column:
        z = d[0]
        for i, c in enumerate(cols, start=1):
            z = z + d[i] * F.col(c)
        return logistic(z)

    return F.transform(coefficients, score)


def _sorted_quantile(values: Column, n: int, p: float) -> Column:
    at = (n - 1) * p
    low, high = math.floor(at), math.ceil(at)
    a, b = F.get(values, F.lit(low)), F.get(values, F.lit(high))
    return a + (at - low) * (b - a)


def predict_interval(points: DataFrame, draws: Sequence[Sequence[float]], cols: Sequence[str],
                     low: float = 0.025, high: float = 0.975) -> DataFrame:
    """Credible interval of the probability of each row, without a join.

    The draws are model parameters of fixed number. They travel with the expression, so every
    point is scored where it lies.
    """
    n = len(draws)
    scored = points.withColumn("_scores", F.sort_array(draw_scores(cols, draws)))
    return scored.withColumns({"ci_low": _sorted_quantile(F.col("_scores"), n, low),
                               "ci_high": _sorted_quantile(F.col("_scores"), n, high)}).drop("_scores")


def evaluate(df: DataFrame, probability: str, actual: str, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Confusion matrix and overall accuracy of a thresholded probability."""
    labelled = df.withColumn("_pred", threshold_class(probability, threshold))
    return confusion_matrix(labelled, "_pred", actual), overall_accuracy(labelled, "_pred", actual)


def default_prior_classifier(stack: DataFrame, c_rvi: str = "c_rvi", ndvi: str = "ndvi",
                             out: str = "probability") -> DataFrame:
    """Probability from the prior means alone, on radar and optical index composites."""
    return stack.withColumn(out, logit_score(DEFAULT_SCORE_INTERCEPT, PRIOR_MEAN[1:3], [c_rvi, ndvi]))
