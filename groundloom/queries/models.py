"""Queries: Bayesian logistic regression, intervals and evaluation."""

import re

import numpy as np
from pyspark.sql import functions as F

from groundloom.functions import indices
from groundloom.operators import bayes as ops
from groundloom.operators.grids import Grid
from groundloom.plans import jobs
from groundloom.queries.base import Tables, query, rounded

COLS = ["c_vv", "l_hh", "ndvi"]
DRAWS = np.round(np.random.default_rng(11).normal([0.2, -1.5, 2.0, 0.7], [0.3, 0.4, 0.5, 0.2], (120, 4)), 6).tolist()
_VALUES = ", ".join(f"({a!r}, {b!r}, {c!r}, {d!r})" for a, b, c, d in DRAWS)


def _cholesky_sql(p: int, cell, out: str) -> list[str]:
    """The lower factor of a p x p matrix, element by element; later elements use the names of earlier ones (see _nested)."""
    items = []
    for j in range(p):
        for i in range(j, p):
            less = "".join(f" - {out}{i}{t} * {out}{j}{t}" for t in range(j))
            items.append(f"SQRT({cell(i, j)}{less}) AS {out}{j}{j}" if i == j else f"({cell(i, j)}{less}) / {out}{j}{j} AS {out}{i}{j}")
    return items


def _nested(items: list[str], source: str) -> str:
    """SELECT of expressions that use the names of earlier ones: one subquery around another, by what each needs."""
    levels: dict[str, int] = {}
    for item in items:
        text, name = item.rsplit(" AS ", 1)
        levels[name] = 1 + max((levels.get(used, 0) for used in re.findall(r"[a-z]\d+", text)), default=0)
    for level in range(1, max(levels.values()) + 1):
        source = f"(SELECT *, {', '.join(i for i in items if levels[i.rsplit(' AS ', 1)[1]] == level)} FROM {source})"
    return source


def _model_sql(cols: list[str], means: list[float], scales: list[float], steps: int, last: str) -> str:
    """The fit on v_stack with any number of predictors, its steps written out; table s has b and v of each term, and g, the
    inverse of the factor of the precision matrix. ``last`` follows the tables."""
    p = len(cols) + 1
    low = [(i, j) for i in range(p) for j in range(i + 1)]
    sums = ", ".join([f"SUM(w * x{i} * x{j}) AS m{i}{j}" for i, j in low] + [f"SUM(w * x{i} * (eta + (y - mu) / w)) AS z{i}" for i in range(p)])
    solved = _cholesky_sql(p, lambda i, j: f"m{i}{j}" + (f" + p{i}" if i == j else ""), "l")
    for j in range(p):
        solved.append(f"1 / l{j}{j} AS g{j}{j}")
        solved += [f"-({' + '.join(f'l{i}{t} * g{t}{j}' for t in range(j, i))}) / l{i}{i} AS g{i}{j}" for i in range(j + 1, p)]
    solved += ["{} AS h{}".format(" + ".join(f"g{i}{t} * (z{t} + p{t} * ({means[t]}))" for t in range(i + 1)), i) for i in range(p)]
    for i in range(p):
        solved.append(f"{' + '.join(f'g{t}{i} * h{t}' for t in range(i, p))} AS b{i}")
        solved.append(f"{' + '.join(f'g{t}{i} * g{t}{i}' for t in range(i, p))} AS v{i}")
    eta, xs = " + ".join(f"b{i} * x{i}" for i in range(p)), ", ".join(f"x{i}" for i in range(p))
    tables = [f"""t AS MATERIALIZED (SELECT 1.0E0 AS x0, {', '.join(f'CAST({c} AS DOUBLE) AS x{i + 1}' for i, c in enumerate(cols))},
 CASE WHEN cat >= 5 THEN 1.0E0 ELSE 0.0E0 END AS y FROM v_stack WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*cols, 'cat'])})""",
              "r0 AS MATERIALIZED (SELECT *, LN(mu / (1 - mu)) AS eta, mu * (1 - mu) AS w FROM (SELECT *, (y + 0.5) / 2 AS mu FROM t))",
              f"q0 AS MATERIALIZED (SELECT {sums}, {', '.join(f'1 / {a * a!r}E0 AS p{i}' for i, a in enumerate(scales))} FROM r0)"]
    for k in range(1, steps + 1):
        pulls = ", ".join(f"2 / ((b{i} - ({means[i]})) * (b{i} - ({means[i]})) + v{i} + {scales[i] ** 2}) AS p{i}" for i in range(p))
        tables += [f"s{k} AS MATERIALIZED (SELECT * FROM {_nested(solved, f'q{k - 1}')})",
                   f"r{k} AS MATERIALIZED (SELECT *, mu * (1 - mu) AS w FROM (SELECT {xs}, y, {eta} AS eta, 1 / (1 + EXP(-({eta}))) AS mu FROM t, s{k}))",
                   f"q{k} AS MATERIALIZED (SELECT m.*, {pulls} FROM (SELECT {sums} FROM r{k}) m, s{k})"]
    return f"WITH {', '.join(tables[:-2])}, s AS (SELECT * FROM s{steps}){last}"


def _normal_sql(term: int, seed: int) -> str:
    """A standard normal number of seed, draw i and term: two parts of an MD5, made normal by Box-Muller."""
    def uniform(begin: int) -> str:
        return f"((CAST('0x' || SUBSTRING(MD5('{seed}:' || i || ':{term}'), {begin}, 8) AS BIGINT) + 0.5E0) / 4294967296)"
    return f"SQRT(-2 * LN({uniform(1)})) * COS(2 * PI() * {uniform(9)})"


_MEANS, _SCALES = [0.0, 0.5, -0.5, 0.0], [10.0, 2.5, 2.5, 2.5]
_TERMS = ["(Intercept)", *COLS]
_FIT_TABLE = _model_sql(COLS, _MEANS, _SCALES, 20, " " + " UNION ALL ".join(
    f"SELECT '{n}' AS term, ROUND(b{i}, 5) AS estimate, ROUND(SQRT(v{i}), 5) AS std_error FROM s" for i, n in enumerate(_TERMS)))
_FIT_DRAWS = _model_sql(COLS, _MEANS, _SCALES, 20, """,
f AS (SELECT * FROM {}), d AS (SELECT i, {} FROM range(2000) n(i))
SELECT i AS draw, {} FROM d, f""".format(
    _nested(_cholesky_sql(4, lambda i, j: "(" + " + ".join(f"g{t}{i} * g{t}{j}" for t in range(i, 4)) + ")", "c"), "s"),
    ", ".join(f"{_normal_sql(k, 7)} AS n{k}" for k in range(4)),
    ", ".join(f"ROUND(b{j} + {' + '.join(f'c{j}{k} * n{k}' for k in range(j + 1))}, 5) AS {name}"
              for j, name in enumerate(["intercept", *COLS]))))
_FIT_MAP = _model_sql(COLS, _MEANS, _SCALES, 20, """
SELECT pr, pc, ROUND(1 / (1 + EXP(-(b0 + {}))), 5) AS probability FROM v_stack, s""".format(
    " + ".join(f"b{i + 1} * {c}" for i, c in enumerate(COLS))))


def _training(t: Tables):
    return t.view("v_stack").withColumn("presence", (F.col("cat") >= 5).cast("int"))


def _fit(t: Tables):
    return ops.bayes_logit_fit(_training(t), COLS, "presence", ops.Prior(_MEANS, _SCALES), epsilon=1e-15)


@query("bayes_logit_fit", _FIT_TABLE, ("v_stack",))
def _(t: Tables):
    out = ops.coefficient_table(t.spark, _fit(t))
    return out.select("term", rounded("estimate", 5).alias("estimate"), rounded("std_error", 5).alias("std_error"))


@query("posterior_draws", _FIT_DRAWS, ("v_stack",))
def _(t: Tables):
    out = ops.posterior_draws(t.spark, _fit(t), 2000)
    return out.select("draw", *[rounded(c, 5).alias(c) for c in ("intercept", *COLS)])


@query("posterior_as_prior", " UNION ALL ".join(
       f"SELECT '{c}' AS term, ROUND(AVG({c}), 9) AS prior_mean, ROUND(STDDEV_SAMP({c}), 9) AS prior_scale FROM v_stack" for c in COLS),
       ("v_stack",))
def _(t: Tables):
    out = ops.posterior_as_prior(t.view("v_stack"), COLS)
    return out.withColumns({c: rounded(c, 9) for c in ("prior_mean", "prior_scale")})


@query("credible_interval", " UNION ALL ".join(
       f"SELECT '{c}' AS term, ROUND(QUANTILE_CONT({c}, 0.025), 9) AS ci_low, ROUND(QUANTILE_CONT({c}, 0.975), 9) AS ci_high FROM v_stack"
       for c in COLS), ("v_stack",))
def _(t: Tables):
    out = ops.credible_interval(t.view("v_stack"), COLS)
    return out.withColumns({c: rounded(c, 9) for c in ("ci_low", "ci_high")})


@query("predict_interval", f"""
WITH d(a, b, c, d) AS (VALUES {_VALUES}), s AS (SELECT pixel, 1 / (1 + EXP(-(a + b * c_vv + c * l_hh + d * ndvi))) AS p FROM v_stack, d)
SELECT pixel, ROUND(QUANTILE_CONT(p, 0.025), 9) AS ci_low, ROUND(QUANTILE_CONT(p, 0.975), 9) AS ci_high FROM s GROUP BY pixel""",
       ("v_stack",))
def _(t: Tables):
    out = ops.predict_interval(t.view("v_stack").select("pixel", *COLS), DRAWS, COLS)
    return out.select("pixel", rounded("ci_low", 9).alias("ci_low"), rounded("ci_high", 9).alias("ci_high"))


_SCORE = "CASE WHEN 1 / (1 + EXP(-(0.4 + 2.0 * c_vv - 3.0 * l_hh))) >= 0.5 THEN 1 ELSE 0 END"


@query("evaluate", f"""
SELECT {_SCORE} AS predicted, COUNT(*) FILTER (WHERE cat < 5) AS actual_0, COUNT(*) FILTER (WHERE cat >= 5) AS actual_1
FROM v_stack GROUP BY ALL""", ("v_stack",))
def _(t: Tables):
    scored = _training(t).withColumn("p", indices.logit_score(0.4, [2.0, -3.0], ["c_vv", "l_hh"]))
    return ops.evaluate(scored, "p", "presence")[0]


@query("evaluate_accuracy", f"SELECT ROUND(AVG(CASE WHEN {_SCORE} = (CASE WHEN cat >= 5 THEN 1 ELSE 0 END) THEN 1.0E0 ELSE 0.0E0 END), 9) "
       "AS accuracy FROM v_stack", ("v_stack",))
def _(t: Tables):
    scored = _training(t).withColumn("p", indices.logit_score(0.4, [2.0, -3.0], ["c_vv", "l_hh"]))
    return ops.evaluate(scored, "p", "presence")[1].withColumn("accuracy", rounded("accuracy", 9))


@query("default_prior_classifier", f"""
SELECT pixel, ROUND(1 / (1 + EXP(-({indices.DEFAULT_SCORE_INTERCEPT} + ({indices.PRIOR_MEAN[1]!r}) * c_vh + {indices.PRIOR_MEAN[2]!r} * ndvi))), 9)
AS probability FROM v_stack""", ("v_stack",))
def _(t: Tables):
    out = ops.default_prior_classifier(t.view("v_stack"), "c_vh", "ndvi")
    return out.select("pixel", rounded("probability", 9).alias("probability"))


def _point_model(t: Tables):
    px = t.view("v_px").withColumn("half", F.col("value") * F.col("value"))
    n_rows = px.agg(F.max("pr")).first()[0] + 1
    points = t.view("v_gpoints").join(t.view("v_points").select("pid", "cls"), "pid").withColumnsRenamed({"x": "lon", "y": "lat"})
    return jobs.point_model(points, px, Grid(0.0, 0.0, 1.0, n_rows, 120), ["value", "half"], "cls", "BUILDING",
                            ops.Prior([0.0, 0.0, 0.0], [10.0, 2.5, 2.5]))


@query("point_model")
def _(t: Tables):
    _, scored = _point_model(t)
    return scored.select("pid", "cls", "true_label", "predicted", rounded("probability", 5).alias("probability"))


@query("point_intervals")
def _(t: Tables):
    model, scored = _point_model(t)
    return jobs.point_intervals(scored, model, 500).select("pid", "ci_low", "probability", "ci_high")


@query("probability_map", _FIT_MAP, ("v_stack",))
def _(t: Tables):
    return jobs.probability_map(t.view("v_stack"), _fit(t)).select("pr", "pc", rounded("probability", 5).alias("probability"))


def _fit_sql(steps: int, last: str = "") -> str:
    """The fit with one predictor, its steps written out; t priors with means (0, 0.5) and scales (10, 2.5)."""
    sums = "SUM(w) AS a, SUM(w * x) AS b, SUM(w * x * x) AS c, SUM(w * (eta + (y - mu) / w)) AS d, SUM(w * x * (eta + (y - mu) / w)) AS e"
    tables = ["""t AS MATERIALIZED (SELECT c_vv AS x, CASE WHEN cat >= 5 THEN 1.0E0 ELSE 0.0E0 END AS y FROM v_stack)""",
              """r0 AS MATERIALIZED (SELECT *, LN(mu / (1 - mu)) AS eta, mu * (1 - mu) AS w FROM (SELECT x, y, (y + 0.5) / 2 AS mu FROM t))""",
              f"q0 AS MATERIALIZED (SELECT {sums}, 1 / 100.0E0 AS p0, 1 / 6.25E0 AS p1 FROM r0)"]
    for k in range(1, steps + 1):
        tables += [
            f"""s{k} AS MATERIALIZED (SELECT ((c + p1) * d - b * (e + p1 * 0.5)) / det AS b0, ((a + p0) * (e + p1 * 0.5) - b * d) / det AS b1,
 (c + p1) / det AS v0, (a + p0) / det AS v1 FROM (SELECT *, (a + p0) * (c + p1) - b * b AS det FROM q{k - 1}))""",
            f"""r{k} AS MATERIALIZED (SELECT *, mu * (1 - mu) AS w FROM (SELECT x, y, b0 + b1 * x AS eta, 1 / (1 + EXP(-(b0 + b1 * x))) AS mu
 FROM t, s{k}))""",
            f"""q{k} AS MATERIALIZED (SELECT m.*, 2 / (b0 * b0 + v0 + 100) AS p0, 2 / ((b1 - 0.5) * (b1 - 0.5) + v1 + 6.25) AS p1
 FROM (SELECT {sums} FROM r{k}) m, s{k})"""]
    return "WITH " + ", ".join(tables) + (last or f"""
SELECT '(Intercept)' AS term, ROUND(b0, 6) AS estimate, ROUND(SQRT(v0), 6) AS std_error FROM s{steps}
UNION ALL SELECT 'c_vv', ROUND(b1, 6), ROUND(SQRT(v1), 6) FROM s{steps}""")


def _line_fit(t: Tables):
    return ops.bayes_logit_fit(_training(t), ["c_vv"], "presence", ops.Prior([0.0, 0.5], [10.0, 2.5]), epsilon=1e-15)


def _draws_sql(steps: int, n: int, seed: int) -> str:
    """Draws of that fit: MD5 of seed, draw and term, Box-Muller, and the Cholesky factor of two coefficients written out."""
    return _fit_sql(steps, f""",
f AS (SELECT b0, b1, SQRT(v0) AS l0, v01 / SQRT(v0) AS l1, SQRT(v1 - v01 * v01 / v0) AS l2
 FROM s{steps}, (SELECT -b / ((a + p0) * (c + p1) - b * b) AS v01 FROM q{steps - 1})),
z AS (SELECT i, {_normal_sql(0, seed)} AS z0, {_normal_sql(1, seed)} AS z1 FROM range({n}) r(i))
SELECT i AS draw, ROUND(b0 + l0 * z0, 5) AS intercept, ROUND(b1 + l1 * z0 + l2 * z1, 5) AS c_vv FROM z, f""")


@query("posterior_draws_line", _draws_sql(25, 20000, 7), ("v_stack",))
def _(t: Tables):
    out = ops.posterior_draws(t.spark, _line_fit(t), 20000)
    return out.select("draw", rounded("intercept", 5).alias("intercept"), rounded("c_vv", 5).alias("c_vv"))


@query("bayes_logit_line", _fit_sql(25), ("v_stack",))
def _(t: Tables):
    out = ops.coefficient_table(t.spark, _line_fit(t))
    return out.select("term", rounded("estimate", 6).alias("estimate"), rounded("std_error", 6).alias("std_error"))
