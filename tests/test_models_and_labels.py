"""Regression, labels, sampling and shots on small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom.functions import cells, indices, names
from groundloom.operators import bayes, catalog, shots, strata, tables, votes


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2)) * [1.0, 2.0]
    p = 1 / (1 + np.exp(-(0.5 + 1.2 * x[:, 0] - 0.7 * x[:, 1])))
    y = (rng.random(400) < p).astype(int)
    return spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))


def normal_equations(pdf, beta):
    x = np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b])
    mu = 1 / (1 + np.exp(-x @ beta))
    return x, mu


def test_flat_prior_is_maximum_likelihood(training):
    model = bayes.bayes_logit_fit(training, ["a", "b"], "y")
    x, mu = normal_equations(training.toPandas(), model.coefficients)
    np.testing.assert_allclose(x.T @ (training.toPandas().y - mu), 0, atol=1e-5)
    np.testing.assert_allclose(model.covariance, np.linalg.inv(x.T @ (x * (mu * (1 - mu))[:, None])), rtol=1e-4)


def test_t_prior_reaches_its_fixed_point(training):
    mean, scale = np.array([0.0, 5.0, 0.0]), np.array([10.0, 0.3, 2.5])
    model = bayes.bayes_logit_fit(training, ["a", "b"], "y", bayes.Prior(mean, scale), epsilon=1e-12)
    pdf = training.toPandas()
    x, mu = normal_equations(pdf, model.coefficients)
    pull = 1 / model.prior_sd**2
    np.testing.assert_allclose(x.T @ (pdf.y - mu) - pull * (model.coefficients - mean), 0, atol=1e-3)
    var = np.diag(model.covariance)
    np.testing.assert_allclose(model.prior_sd**2, ((model.coefficients - mean)**2 + var + scale**2) / 2, rtol=1e-3)
    flat = bayes.bayes_logit_fit(training, ["a", "b"], "y")
    assert model.coefficients[1] > flat.coefficients[1]


def test_wide_normal_prior_changes_nothing(training):
    wide = bayes.bayes_logit_fit(training, ["a", "b"], "y", bayes.Prior([0.0] * 3, [1e6] * 3, math.inf))
    flat = bayes.bayes_logit_fit(training, ["a", "b"], "y")
    np.testing.assert_allclose(wide.coefficients, flat.coefficients, rtol=1e-6)


def test_draws_are_seeded_and_have_the_right_moments(spark, training):
    model = bayes.bayes_logit_fit(training, ["a", "b"], "y")
    draws = bayes.posterior_draws(spark, model, 4000, 1)
    assert draws.collect() == bayes.posterior_draws(spark, model, 4000, 1).collect()
    prior = {r.term: r for r in bayes.posterior_as_prior(draws, ["intercept", "a", "b"]).collect()}
    for i, term in enumerate(["intercept", "a", "b"]):
        assert prior[term].prior_mean == pytest.approx(model.coefficients[i], abs=0.02)
        assert prior[term].prior_scale == pytest.approx(math.sqrt(model.covariance[i, i]), rel=0.06)


def test_predict_interval_matches_numpy(training):
    draws = np.random.default_rng(0).normal(size=(50, 3))
    got = bayes.predict_interval(training, draws.tolist(), ["a", "b"], 0.1, 0.85).toPandas()
    x = np.column_stack([np.ones(len(got)), got.a, got.b])
    p = 1 / (1 + np.exp(-x @ draws.T))
    np.testing.assert_allclose(got[["ci_low", "ci_high"]], np.quantile(p, [0.1, 0.85], axis=1).T, rtol=1e-10)
    plan = bayes.predict_interval(training, draws.tolist(), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_evaluate(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.2, 0), (0.1, 1)], "p double, y int")
    matrix, accuracy = bayes.evaluate(df, "p", "y")
    assert sorted(matrix.collect()) == [(0, 1, 1), (1, 1, 1)] and accuracy.first().accuracy == 0.5


# ---- labels --------------------------------------------------------------------------------

def test_vote_mode_matches_pandas(spark):
    rng = np.random.default_rng(2)
    rows = [(p, f"u{u}", None if rng.random() < 0.3 else int(rng.integers(0, 3))) for p in range(200) for u in range(4)]
    got = {r[0]: r for r in votes.vote_mode(spark.createDataFrame(rows, "p long, who string, vote int"), ["p"]).collect()}
    for p, group in pd.DataFrame(rows, columns=["p", "who", "vote"]).groupby("p"):
        seen = group.vote.dropna()
        if len(seen):
            mode = seen.mode().iloc[0]
            assert (got[p]["class"], got[p]["count"]) == (mode, len(seen))
            assert got[p].confidence == pytest.approx((seen == mode).mean())
        else:
            assert tuple(got[p])[1:] == (None, 0.0, 0)


def test_consensus_of_a_single_labeler(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "p long, vote int")
    assert votes.consensus(df, ["p"], 1).count() == 0
    assert votes.consensus(df, ["p"], 1, strict=False).count() == 2


def test_exclusive_and_recode(spark):
    df = spark.createDataFrame([(1, 100, 0, 0), (2, 0, 0, 100), (3, 100, 100, 0), (4, None, 100, 0)], "p int, a int, b int, c int")
    out = votes.process_labels(df, {"a": "A", "b": "B", "c": "C", "p": "Point"}, ["A", "B", "C"],
                               {"A": 1, "B": 0, "C": 1}, ["Point"], [])
    assert sorted(out.collect()) == [(1, 1), (2, 1), (3, None), (4, 0)]


def test_impute_keeps_known_values(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("x", 3.0), ("y", None)], "c string, v double")
    assert sorted(votes.class_mean_impute(df, "c", ["v"]).collect(), key=str) == sorted(
        [("x", 1.0), ("x", 2.0), ("x", 3.0), ("y", None)], key=str)


# ---- sampling ------------------------------------------------------------------------------

def test_sizes(spark):
    df = spark.createDataFrame([(0, 900, 90.0), (1, 100, 10.0)], "cat int, pixel_ct long, pct_area double")
    got = strata.size_stehman_foody(df, 0.05, 0.95, 50, 0.85).collect()
    z = 1.959963984540054
    assert all(r.nh == int(z * z * 0.85 * 0.15 / 0.0025) == r.nh_adjusted for r in got)
    out = {r.cat: r for r in strata.size_olofsson(df, 0.1, 0.95, 30, 1, {0: 0.95, 1: 0.8}).collect()}
    total = (0.9 * math.sqrt(.95 * .05) + 0.1 * math.sqrt(.8 * .2)) / (0.1 * 0.1 / z)
    assert out[0].nh == int(0.9 * total**2) and out[1].nh_adjusted == max(30, int(0.1 * total**2))
    with pytest.raises(ValueError):
        strata.distribute_sample(df, df, {0: 0.5}, {1: 1.0})


def test_split_parts_are_disjoint_complete_and_exact(spark):
    df = spark.range(1003).withColumnRenamed("id", "p")
    out = strata.train_val_test_split(df, (0.6, 0.25, 0.15), 1, ["p"])
    counts = {r.usage: r.n for r in strata.split_counts(out).collect()}
    assert counts == {"train": 601, "validate": 250, "map_reference/test": 152}
    assert out.select("p").distinct().count() == 1003
    rest = tables.remainder(df, out.where("usage = 'train'"), "p")
    assert rest.count() == 402


# ---- catalog, names, cells -----------------------------------------------------------------

def test_latest_processing_and_times(spark):
    rows = [("OPERA_L2_RTC-S1_T1_20200101T010203Z_20200105T000000Z_S1A", 1), ("OPERA_L2_RTC-S1_T1_20200101T010203Z_20210105T000000Z_S1A", 2),
            ("OPERA_L2_RTC-S1_T1_20200201T010203Z_20200105T000000Z_S1A", 3)]
    df = spark.createDataFrame(rows, "name string, k int").withColumns(
        {"acq": names.acquisition_time("name"), "proc": names.processing_time("name")})
    assert sorted(r.k for r in catalog.latest_processing(df, ["acq"], "proc").collect()) == [2, 3]
    assert str(df.first().acq) == "2020-01-01 01:02:03"
    with pytest.raises(Exception, match="no acquisition time"):
        spark.createDataFrame([("nothing",)], "name string").select(names.acquisition_time("name")).collect()


def test_names(spark):
    df = spark.createDataFrame([(6, -75), (-3, 12), (0, 0), (-5, -5)], "la int, lo int")
    tiles = [r[0] for r in df.select(names.geo_tile_name("la", "lo")).collect()]
    assert tiles == ["N06W075", "S03E012", "N00E000", "S05W005"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in [*tiles, "S03W003"]], "t string")
           .select(names.parent_grid_name("t")).collect()]
    assert got == ["N10W075", "N00E010", "N00E000", "S05W005", "N00W005"]


def test_long_tile_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(-100, 2), (-161, -2), (-16, -2), (160, -1234)], "la int, lo int")
    named = df.withColumn("t", names.geo_tile_name("la", "lo"))
    lat, lon = names.tile_corner("t")
    got = [tuple(r) for r in named.select("t", lat, lon, names.parent_grid_name("t")).collect()]
    assert got == [("S100E002", -100, 2, "S100E000"), ("S161W002", -161, -2, "S160W005"), ("S16W002", -16, -2, "S15W005"),
                   ("N160W1234", 160, -1234, "N160W1235")]


def test_tile_keys_are_exact(spark):
    files = spark.createDataFrame([("s1_tile_x_a_b_h1_v1_VV.tif",), ("s1_tile_x_a_b_h1_v10_VV.tif",), ("readme.txt",)], "name string")
    parts = catalog.file_key_parts(files)
    assert sorted((r.h, r.v) for r in parts.collect()) == [(1, 1), (1, 10)]


def test_rename_needs_existing_columns(spark):
    with pytest.raises(ValueError):
        tables.rename_cols(spark.range(1), {"nope": "x"})


def test_byte_score_rules(spark):
    bands = [(0.1, 0.02, 30.0, 0.2, 0.05, 30.0, 0.5, 50.0), (0.0, 0.02, 30.0, 0.2, 0.05, 30.0, 0.5, 50.0),
             (None, 0.02, 30.0, 0.2, 0.05, 30.0, 0.5, 50.0)]
    df = spark.createDataFrame(bands, ", ".join(f"{b} double" for b in indices.STACK_BANDS))

    def score(intercept):
        return [r[0] for r in df.select(indices.logit_score_byte(intercept=intercept, weights=[0.0] * 10)).collect()]

    assert score(0.0) == [50, 255, 255]
    assert score(-5.2)[0] == 0          # 0.55 percent truncates to 0 and is no "no data"
    assert score(-800.0)[0] == 255      # exactly 0
    assert score(800.0)[0] == 255       # overflow


def test_robust_range_and_shots(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(100, 0.4, (300, 6)), columns=shots.ELEVATIONS)
    pdf.iloc[5, 2] = 400.0
    pdf.iloc[6] = 900.0
    pdf["file_no"], pdf["sensitivity"], pdf["rh95"] = np.arange(300) % 2, rng.uniform(0.85, 1, 300), rng.normal(3, 3, 300)
    got = shots.process_shots(spark.createDataFrame(pdf)).toPandas()
    want = []
    for _, part in pdf[pdf.sensitivity >= 0.9].groupby("file_no"):
        pool = part[shots.ELEVATIONS].to_numpy().ravel()
        mean, sd = pool.mean(), pool.std(ddof=1)
        for _, row in part.iterrows():
            kept = [e for e in row[shots.ELEVATIONS] if mean - 2 * sd <= e <= mean + 2 * sd]
            spread = max(kept) - min(kept) if kept else 99
            if abs(spread) < 2 and row.rh95 > 0:
                want.append(round(spread, 9))
    assert sorted(got.elev_range.round(9)) == sorted(want)


def test_check_exclusive_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(100, None), (50, None)], "a int, b int")
    out = df.select(*[c.alias(n) for n, c in cells.check_exclusive(["a", "b"]).items()])
    assert out.collect() == [(100, None), (None, None)]


def test_next_prior_takes_coefficients_and_spread(spark, training):
    model = bayes.bayes_logit_fit(training, ["a", "b"], "y")
    prior = bayes.next_prior(model, bayes.posterior_draws(spark, model, 3000, 2))
    np.testing.assert_allclose(prior.mean, model.coefficients)
    np.testing.assert_allclose(prior.scale, np.sqrt(np.diag(model.covariance)), rtol=0.08)
    again = bayes.bayes_logit_fit(training, ["a", "b"], "y", prior)
    assert (np.diag(again.covariance) < np.diag(model.covariance)).all()


def test_impossible_priors_are_refused(training):
    with pytest.raises(ValueError):
        bayes.bayes_logit_fit(training, ["a", "b"], "y", bayes.Prior([0.0], [1.0]))


def test_confusion_query_counts_both_predictions(spark):
    from __spark_entry__ import queries

    got = {r["predicted"]: (r["actual_0"], r["actual_1"]) for r in queries()["confusion_matrix_both"](spark, "/root/testdata/sf0.001").collect()}
    obs = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").toPandas()
    for k in (0, 1):
        rows = obs[((obs.l_extendedprice.astype(float) / 1e6) > 0.05) == bool(k)]
        is_a = rows.l_returnflag == "A"
        assert got[k] == (int((~is_a).sum()), int(is_a.sum())) and all(got[k])
