"""Resampling and point extraction against numpy."""

from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom.operators import composites, grids
from groundloom.operators.grids import Grid
from tests.test_neighborhood import image_of, table

SHAPE = (23, 31)
SRC = Grid(100.0, 900.0, 10.0, *SHAPE)


@pytest.fixture(scope="module")
def image():
    rng = np.random.default_rng(8)
    out = rng.normal(5, 2, SHAPE)
    out[rng.random(SHAPE) < 0.1] = np.nan
    return out


@pytest.fixture(scope="module")
def px(spark, image):
    df = table(spark, image)
    return df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


TARGETS = [Grid(100.0, 900.0, 10.0, 23, 31), Grid(90.0, 910.0, 27.0, 10, 13), Grid(103.0, 893.0, 4.0, 50, 60),
           Grid(100.0, 900.0, 20.0, 12, 16)]


def centres(dst):
    y = dst.y0 - (np.arange(dst.n_rows) + 0.5) * dst.res
    x = dst.x0 + (np.arange(dst.n_cols) + 0.5) * dst.res
    return y, x


@pytest.mark.parametrize("dst", TARGETS)
def test_nearest(px, image, dst):
    out = grids.resample(px, SRC, dst, "nearest")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    want = np.full((dst.n_rows, dst.n_cols), np.nan)
    for (i, y), (j, x) in ((a, b) for a in enumerate(centres(dst)[0]) for b in enumerate(centres(dst)[1])):
        r, c = int(np.floor((SRC.y0 - y) / SRC.res)), int(np.floor((x - SRC.x0) / SRC.res))
        if 0 <= r < SHAPE[0] and 0 <= c < SHAPE[1]:
            want[i, j] = image[r, c]
    np.testing.assert_array_equal(image_of(out, want.shape, "value"), want)


@pytest.mark.parametrize("dst", TARGETS)
def test_average(px, image, dst):
    want = np.full((dst.n_rows, dst.n_cols), np.nan)
    for i, j in np.ndindex(want.shape):
        top, left = dst.y0 - i * dst.res, dst.x0 + j * dst.res
        total = weight = 0.0
        for r, c in np.ndindex(SHAPE):
            high = min(top, SRC.y0 - r * 10) - max(top - dst.res, SRC.y0 - (r + 1) * 10)
            wide = min(left + dst.res, SRC.x0 + (c + 1) * 10) - max(left, SRC.x0 + c * 10)
            if high > 1e-9 and wide > 1e-9 and not np.isnan(image[r, c]):
                total, weight = total + high * wide * image[r, c], weight + high * wide
        if weight:
            want[i, j] = total / weight
    got = image_of(grids.resample(px, SRC, dst, "average"), want.shape, "value")
    np.testing.assert_allclose(got, want, rtol=1e-9)


@pytest.mark.parametrize("dst", TARGETS)
def test_bilinear(px, image, dst):
    want = np.full((dst.n_rows, dst.n_cols), np.nan)
    for (i, y), (j, x) in ((a, b) for a in enumerate(centres(dst)[0]) for b in enumerate(centres(dst)[1])):
        u, v = (SRC.y0 - y) / 10 - 0.5, (x - SRC.x0) / 10 - 0.5
        total = weight = 0.0
        for r in (int(np.floor(u)), int(np.floor(u)) + 1):
            for c in (int(np.floor(v)), int(np.floor(v)) + 1):
                w = (1 - abs(u - r)) * (1 - abs(v - c))
                if 0 <= r < SHAPE[0] and 0 <= c < SHAPE[1] and w > 1e-9 and not np.isnan(image[r, c]):
                    total, weight = total + w * image[r, c], weight + w
        if weight:
            want[i, j] = total / weight
    got = image_of(grids.resample(px, SRC, dst, "bilinear"), want.shape, "value")
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_bilinear_is_exact_far_from_the_corner(spark):
    far = spark.createDataFrame([(40247, 10, 4.8931544), (40248, 9, 0.5506687), (40248, 10, 0.0444017)], "pr int, pc int, value double")
    out = grids.resample(far, Grid(0.0, 0.0, 30.0), Grid(-10.0, 20.0, 70.0), "bilinear")
    got = {(r.pr, r.pc): r.value for r in out.collect()}
    total = weight = Fraction(0)
    for r, c, v in far.collect():
        w = ((1 - abs(Fraction(17249 * 70 + 35 - 20 - 15 - 30 * r, 30))) * (1 - abs(Fraction(4 * 70 + 35 - 10 - 15 - 30 * c, 30))))
        total, weight = total + w * Fraction(v), weight + w
    assert got[(17249, 4)] == pytest.approx(float(total / weight), abs=1e-13)


def test_clip_reaches_the_scan(spark, px, tmp_path):
    path = str(tmp_path / "px")
    px.write.parquet(path)
    out = grids.clip_to_box(spark.read.parquet(path), SRC, (120.0, 700.0, 199.0, 851.0))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pr,5)" in plan and "LessThanOrEqual(pc,9)" in plan
    assert out.agg(F.min("pr"), F.max("pr"), F.min("pc"), F.max("pc")).first() == (5, 19, 2, 9)


def test_window_skips_missing_and_refuses_the_border(spark, px, image):
    pts = spark.createDataFrame(pd.DataFrame({"pid": [1, 2, 3], "lon": [155.0, 101.0, 405.0], "lat": [833.0, 895.0, 675.0]}))
    got = {r.pid: r.value for r in grids.window_at_points(pts, px, SRC, ["value"]).collect()}
    assert got[2] is None
    r, c = int((900 - 833) / 10 - 1), int((155 - 100) / 10 - 1)
    assert got[1] == pytest.approx(np.nanmean(image[r:r + 3, c:c + 3]))
    assert got[3] is None


def test_reprojected_tiles_match_a_direct_lookup(spark, px):
    src = Grid(500000.0, 100000.0, 500.0)
    tiles = spark.createDataFrame([(0, 0, 500500.0, 92000.0, 508500.0, 99500.0)], "h int, v int, xmin double, ymin double, xmax double, ymax double")
    same = grids.resample_reprojected(px, src, 32618, tiles, 500.0, 32618)
    want = px.select((F.col("pr") - 1).alias("pr"), (F.col("pc") - 1).alias("pc"), "value").where("pr >= 0 and pc >= 0 and pr < 15 and pc < 16")
    assert sorted(same.select("pr", "pc", "value").collect(), key=str) == sorted(want.collect(), key=str)


def test_mosaic_is_idempotent_and_prefers_priority(spark):
    df = spark.createDataFrame([(0, 0, 1, 5.0), (0, 0, 2, float("nan")), (0, 0, 3, None), (0, 1, 1, 1.0), (0, 1, 2, 2.0)],
                               "pr int, pc int, priority int, value double")
    out = composites.mosaic(df, ["pr", "pc"], "priority")
    assert {(r.pr, r.pc): r.value for r in out.collect()} == {(0, 0): 5.0, (0, 1): 2.0}
    again = composites.mosaic(out.withColumn("priority", F.lit(1)), ["pr", "pc"], "priority")
    assert sorted(again.collect()) == sorted(out.collect())


def test_nodata_rules_of_temporal_statistics(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 2.0), (1, 4.0), (2, 0.0), (2, 0.0), (3, 5.0)], "k int, value double")
    mean = {r.k: r.mean for r in composites.temporal_mean_nz(df, ["k"]).collect()}
    var = {r.k: r.variance for r in composites.temporal_var_nz(df, ["k"]).collect()}
    assert mean == {1: 3.0, 2: 0.0, 3: 5.0} and var == {1: 1.0, 2: None, 3: 0.0}


def test_single_scene_bursts_are_left_out(spark):
    df = spark.createDataFrame([("a", 1, 0, 1.0), ("a", 2, 0, float("nan")), ("b", 1, 0, 3.0)], "burst string, acq int, pr int, value double")
    assert composites.temporal_mean_skipna(df, ["burst", "pr"]).collect() == [("a", 0, 1.0)]


def test_touch_all_nodata_bands(spark):
    row = [(0, 0.0, 0.0, 1.0, 2.0, 2.0, 1.0, None, 37.9)]
    cols = "pixel int, c_vv double, c_vh double, c_inc double, l_hh double, l_hv double, l_inc double, ndvi double, tc double"
    out = composites.condensed_stack(spark.createDataFrame(row, cols), ["pixel"]).first()
    assert tuple(out) == (0, -9999, 200, -9999, 37)
